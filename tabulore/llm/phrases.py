"""Phrase collocation mining after Toivonen: a sample proposes phrases, whole passes count them and their border.

A phrase is a run of words inside a piece of a text. Per language, phrases of up to ``max_words`` words that occur at
least ``least`` times are counted exactly:

* A sample of the texts proposes phrases of one to ``max_words - 1`` words: those it holds.
* The first whole pass counts all words, and every longer phrase whose two parts (without the last and without the first
  word) were proposed: the proposed phrases and their negative border.
* Border failures are frequent phrases that nobody proposed. Phrases that contain one have not been counted; a further
  pass counts those whose parts are now known to be frequent and which no pass before has counted. This goes on until a
  pass brings no failure; with phrases of n words there are at most n whole passes.

Proposals go to the executors as bit arrays of fixed size (``FILTER_BITS``); a phrase that shares its bit with a proposal is
counted without need, exactly, so that results never depend on them. Counts are made per block of text and then per
bucket of hashes; phrases of a language and length are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulore.llm.shingles import FOLDED, mix, small_batches, span_hashes, text_buffers
from tabulore.session import cut_lineage

LEAST = 10
SAMPLE = 8  # one of so many texts proposes phrases
FILTER_BITS = 1 << 25
BLOCK = 2 << 20  # bytes of text counted at a time
SALTS = 64
BUCKET = 32 << 20  # bytes of phrases summed at a time
TYPES = "lang string, words int, phrase string, proposed boolean, n long"
PACKED = pa.schema([
    ("bits", pa.int64()), ("slice", pa.int64()), ("lang", pa.string()), ("words", pa.int32()), ("phrases", pa.binary()), ("sizes", pa.binary()), ("proposed", pa.binary())])
PACKED_TYPES = "bits long, slice long, lang string, words int, phrases binary, sizes binary, proposed binary"
RADIX = 1024  # a power of two

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_OUTSIDE = _BREAK | _GAP
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, piece and text of every word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    inside = ~_OUTSIDE[data]
    fresh = np.zeros(len(data), bool)  # a piece begins here
    fresh[1:] = _BREAK[data[:-1]]
    fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | fresh[1:]
    last[:-1] &= ~inside[1:] | fresh[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    pieces = np.searchsorted(np.flatnonzero(fresh), starts, "right")
    return starts, ends, pieces, np.searchsorted(offsets, starts, "right") - 1


def _blocks(data: np.ndarray, offsets: np.ndarray, size: int, ahead: int) -> Iterator[tuple[int, int, int]]:
    """(first byte, end, end with the next ``ahead`` words); blocks end outside words."""
    at, n = 0, len(data)

    def gap(place: int, border: int, outside: bool) -> int:
        while place < border:
            found = np.flatnonzero(_OUTSIDE[data[place : min(border, place + 4096)]] == outside)
            if len(found):
                return place + int(found[0])
            place += 4096
        return border

    while at < n:
        end = more = min(at + size, n)
        if end < n:
            border = int(offsets[np.searchsorted(offsets, end)])  # the end of the text
            end = more = gap(end, border, True)
            for _ in range(ahead):
                more = gap(gap(more, border, False), border, True)
        yield at, end, more
        at = end


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = hashes & np.uint64(FILTER_BITS - 1)
    return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot, bit = _slots(hashes)
    return (bits[slot] & bit) != 0


class Words:
    """The words of a block: hashes of phrases by their first word, and the phrases themselves."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, lang_hashes: np.ndarray, own: int):
        self.data = data
        self.starts, self.ends, self.pieces, texts = _spans(data, offsets)
        self.own = int(np.searchsorted(self.starts, own))  # phrases begin at these words
        self.langs = langs[texts]
        self.hashes = {1: mix(span_hashes(data, self.starts, self.ends, FOLDED) + lang_hashes[self.langs])}

    def follow(self, words: int) -> np.ndarray:
        """Whether a phrase of so many words begins at a word."""
        out = np.zeros(len(self.starts), bool)
        if len(out) >= words:
            out[: len(out) - words + 1] = self.pieces[words - 1 :] == self.pieces[: len(out) - words + 1]
        return out

    def hashed(self, words: int) -> np.ndarray:
        for k in range(2, words + 1):
            if k not in self.hashes:
                last = np.zeros(len(self.starts), np.uint64)
                last[: len(last) - k + 1] = self.hashes[1][k - 1 :]
                self.hashes[k] = mix(self.hashes[k - 1] * _STEP + last)
        return self.hashes[words]

    def phrases(self, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the phrases that begin at the given words: lower case, a blank between words, a line break after each."""
        at = (first[:, None] + np.arange(words)[None, :]).ravel()
        starts, sizes = self.starts[at], self.ends[at] - self.starts[at]
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.full(int(begins[-1]), 0x20, np.uint8)
        out[begins[words::words] - 1] = 0x0A
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(begins[:-1], sizes) + within] = _LOWER[self.data[np.repeat(starts, sizes) + within]]
        return out, begins[::words]


def _lang_hash(lang: str) -> int:
    data = np.frombuffer(lang.encode(), np.uint8)
    found = span_hashes(data, np.zeros(1, np.int64), np.array([len(data)])) if len(data) else np.zeros(1, np.uint64)
    return int(mix(found * _STEP + np.uint64(1))[0])  # not the hash of the word that is spelled alike


def _word_blocks(batches: Iterator[pa.RecordBatch], ahead: int, size: int = BLOCK) -> Iterator[tuple[Words, list[str]]]:
    """Blocks of words of batches (lang, text)."""
    for batch in small_batches(batches, 1):
        langs = batch.column(0).dictionary_encode()
        names = langs.dictionary.to_pylist()
        hashes = np.array([_lang_hash(x) for x in names], np.uint64)
        number = langs.indices.to_numpy()
        data, offsets = text_buffers(batch.column(1))
        for at, end, more in _blocks(data, offsets, size, ahead):
            low, high = int(np.searchsorted(offsets, at, "right")) - 1, int(np.searchsorted(offsets, more, "left"))
            inner = np.clip(offsets[low : high + 1], at, more) - at
            yield Words(data[at:more], inner, number[low:high], hashes, end - at), names


def _count(texts: DataFrame, max_words: int, rounds: list[dict[int, object]], first: bool, least: int, block_bytes: int) -> DataFrame:
    """Counts (TYPES) of the phrases that the last of ``rounds`` (filters by length) adds to those before.

    The first pass also counts all words and gives the number of words of each language (0 words, no phrase).
    The phrases of a block go out packed by the first bits of their hash, ``RADIX`` rows a language and length, and are
    summed in groups of about ``BUCKET`` bytes. While there are more groups than values of the bits, the rows of one value
    are summed in several groups, which pack their sums by the next bits. So the rows moved grow with the text alone.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    radix = RADIX
    groups = size * max_words * (max_words + 1) // 2 // BUCKET + 1  # each word begins a phrase of every length

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, names in _word_blocks(batches, max_words - 1, block_bytes):
            if first and block.own:
                totals = np.bincount(block.langs[: block.own], minlength=len(names))
                yield _rows([(0, 0, x, 0, b"", np.int64(t).tobytes(), b"") for x, t in zip(names, totals, strict=True) if t])
            for k in range(1 if first else 2, max_words + 1):
                begins = block.follow(k)
                begins[block.own :] = False
                if k > 1:
                    part = block.hashed(k - 1)
                    both = [_both(r[k - 1].value, part) for r in rounds]
                    for earlier in both[:-1]:
                        begins &= ~earlier
                    begins &= both[-1]
                places = np.flatnonzero(begins)
                if not len(places):
                    continue
                hashes = block.hashed(k)[places]
                order = np.argsort(hashes, kind="stable")
                ranked = hashes[order]
                new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                place, sizes = places[order[new]], np.diff(np.append(new, len(ranked)))
                known = _held(rounds[-1][k].value, ranked[new]) if k < max_words else np.ones(len(new), bool)
                lang, slice_of = block.langs[place], int(ranked[0] >> np.uint64(33))
                data, offsets = block.phrases(place, k)
                bits = _bits(span_hashes(data, offsets[:-1], offsets[1:] - 1), radix, 1)
                order = np.lexsort((bits, lang))
                data, offsets = _taken(data, offsets, order)
                yield _rows(_packed(names, lang[order], bits[order], slice_of, k, data, offsets, sizes[order], known[order]))

    def summed(table: pa.Table, level: int, last: bool) -> pa.Table:
        parts: dict[tuple[str, int], list[tuple[bytes, bytes, bytes]]] = {}
        for _, _, lang, k, *row in zip(*(table[c].to_pylist() for c in PACKED.names), strict=True):
            parts.setdefault((lang, k), []).append(row)
        out = []
        for (lang, k), rows in parts.items():
            data, sizes, known = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*rows, strict=True), (np.uint8, np.int64, bool), strict=True))
            if not k:
                out.append(_counts(lang, 0, pa.nulls(1, pa.string()), np.ones(1, bool), sizes.sum(keepdims=True)) if last else
                           pa.Table.from_batches([_rows([(0, 0, lang, 0, b"", sizes.sum().tobytes(), b"")])]))
                continue
            offsets = np.concatenate([[0], np.flatnonzero(data == 0x0A) + 1])
            hashes = span_hashes(data, offsets[:-1], offsets[1:] - 1)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            n = np.add.reduceat(sizes[order], new)
            if last:
                at, n = order[new][n >= least], n[n >= least]
                found = pa.array([data[p:q].tobytes().decode() for p, q in zip(offsets[at].tolist(), (offsets[at + 1] - 1).tolist(), strict=True)], pa.string())
                out.append(_counts(lang, k, found, known[at], n))
            else:
                bits, at = _bits(ranked[new], radix, level + 1), order[new]  # hashes rise, and so do their first bits
                data, offsets = _taken(data, offsets, at)
                rows = _packed([lang], np.zeros(len(at), int), bits, int(ranked[0] & np.uint64(0x7FFFFFFF)), k, data, offsets, n, known[at])
                out.append(pa.Table.from_batches([_rows(rows)]))
        return pa.concat_tables(out)

    def at(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
        return lambda table: summed(table, level, last)

    moved, level = texts.mapInArrow(packed, PACKED_TYPES), 1
    while True:
        values = radix**level
        slices = -(-groups // values)
        tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(groups, values * slices))
        if slices == 1:  # neighbouring values of the bits share a group
            moved = moved.withColumn("bits", F.floor(F.col("bits") * (groups / values)))
        dealt = moved.withColumn("slice", F.col("slice") % slices).repartition(tasks, "bits", "slice").groupBy("bits", "slice")
        if slices == 1:
            return dealt.applyInArrow(at(level, True), TYPES)
        moved, level = dealt.applyInArrow(at(level, False), PACKED_TYPES), level + 1


def _bits(hashes: np.ndarray, radix: int, level: int) -> np.ndarray:
    """The first bits of hashes, as many as tell ``radix`` to the power of ``level`` apart."""
    return (hashes >> np.uint64(64 - level * (radix.bit_length() - 1))).astype(np.int64)


def _taken(data: np.ndarray, offsets: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``data`` in another order."""
    sizes = np.diff(offsets)[order]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(offsets[:-1][order] - begins[:-1], sizes) + np.arange(int(begins[-1]))], begins


def _packed(names, lang, bits, slice_of, k, data, offsets, sizes, known) -> list[tuple]:
    """Rows of PACKED for phrases in the order of language and bits."""
    cuts = np.flatnonzero(np.concatenate([[True], (bits[1:] != bits[:-1]) | (lang[1:] != lang[:-1]), [True]]))
    return [
        (int(bits[p]), slice_of, names[lang[p]], k, data[offsets[p] : offsets[q]].tobytes(), sizes[p:q].astype(np.int64).tobytes(), known[p:q].tobytes())
        for p, q in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PACKED, strict=True)], schema=PACKED)


def _counts(lang: str, words: int, phrases: pa.Array, known: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({
        "lang": pa.array([lang] * len(n), pa.string()), "words": pa.array(np.full(len(n), words, np.int32)), "phrase": phrases,
        "proposed": pa.array(known), "n": pa.array(n.astype(np.int64)),
    })


def _both(bits: np.ndarray, part: np.ndarray) -> np.ndarray:
    held = _held(bits, part)
    out = held.copy()
    out[:-1] &= held[1:]
    return out


def _filters(slots: DataFrame, lengths: range) -> dict[int, object]:
    """Bit arrays by number of words from rows (words, slot, bits); at most FILTER_BITS / 64 rows a length are collected."""
    context = slots.sparkSession.sparkContext
    summed = slots.groupBy("words", "slot").agg(F.expr("bit_or(bits)").alias("bits"))
    out = {k: np.zeros(FILTER_BITS >> 6, np.uint64) for k in lengths}
    for k in lengths:
        found = summed.where(F.col("words") == k).select("slot", "bits").toArrow()
        out[k][found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return {k: context.broadcast(bits) for k, bits in out.items()}


def _slot_rows(words: int, hashes: np.ndarray) -> pa.RecordBatch:
    slot, bit = _slots(hashes)
    order = np.argsort(slot, kind="stable")
    slot, bit = slot[order], bit[order]
    new = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
    bits = np.bitwise_or.reduceat(bit, new) if len(new) else bit
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(new), words, np.int32)), pa.array(slot[new]), pa.array(bits.view(np.int64))], names=["words", "slot", "bits"])


def _proposed(sample: DataFrame, max_words: int, block_bytes: int) -> dict[int, object]:
    """Filters of the phrases that the sample holds."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _word_blocks(batches, max_words - 1, block_bytes):
            for k in range(1, max_words):
                begins = block.follow(k)
                begins[block.own :] = False
                yield _slot_rows(k, block.hashed(k)[begins])

    return _filters(sample.mapInArrow(held, "words int, slot long, bits long"), range(1, max_words))


def _known(frequent: DataFrame, max_words: int) -> dict[int, object]:
    """Filters of the phrases known to be frequent."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for k in range(1, max_words):
                mine = pa.Table.from_batches([batch]).filter(pa.array(lengths == k)).select(["lang", "phrase"]).combine_chunks()
                for block, _ in _word_blocks(iter(mine.to_batches()), k - 1):
                    begins = block.follow(k)
                    begins[block.own :] = False
                    yield _slot_rows(k, block.hashed(k)[begins])

    rows = frequent.where(F.col("words").between(1, max_words - 1)).select("words", "lang", "phrase")
    return _filters(rows.mapInArrow(held, "words int, slot long, bits long"), range(1, max_words))


def frequent_phrases(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, max_words: int = 3, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """(lang, words, phrase, n): phrases of 1 to ``max_words`` words with at least ``least`` occurrences, stored.

    The rows of 0 words and no phrase sum up to the number of all words of the language. Overlapping occurrences count.
    """
    texts = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    drawn = texts.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(sample)) == 0)
    rounds, found = [_proposed(drawn, max_words, block)], None
    while True:
        counts = cut_lineage(_count(texts, max_words, rounds, found is None, least, block))
        found = counts if found is None else found.unionByName(counts)
        failures = counts.where((F.col("words") > 0) & (F.col("words") < max_words) & ~F.col("proposed"))
        if failures.isEmpty():
            return found.drop("proposed")
        rounds.append(_known(found, max_words))


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, max_words: int = 3, within: int = 50,
    top: int | None = 2000, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of 2 to ``max_words`` words that hold together best.

    A phrase with ``a`` occurrences, cut after k words into parts with l and r occurrences, has the score
    floor(1000000 a a / (l r)); the cut with the lowest score counts, of equal ones the first. A phrase whose words
    lie inside a longer one goes if the longer one has at least ``within`` hundredths of its occurrences. The first
    ``top`` of each language (all, if None) come by score, occurrences and phrase, ranked from 1; n is its number of words.

    A null language is called und and a null text is empty. Repeated rows count as often as they occur; keys and other
    columns are not looked at. Products are exact for up to 10**16 occurrences. An empty table gives no rows.
    """
    known = frequent_phrases(df, text, lang, least, max_words, sample, block)
    counts = known.where("words > 0").select("lang", "phrase", "n")
    long = known.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    long = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    size = F.size("w")
    cuts = long.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, size - F.col("k")), " ").alias("tail"))
    parts = lambda name, n: counts.select(F.col("lang").alias("part_lang"), F.col("phrase").alias(name), F.col("n").alias(n))
    heads, tails = parts("head", "l"), parts("tail", "r")
    cuts = cuts.join(heads, (F.col("lang") == F.col("part_lang")) & (cuts["head"] == heads["head"])).select("lang", "phrase", "a", "k", "tail", "l")
    cuts = cuts.join(tails, (F.col("lang") == F.col("part_lang")) & (cuts["tail"] == tails["tail"])).select("lang", "phrase", "a", "k", "l", "r")
    wide = "decimal(16,0)"
    score = F.expr(f"(1000000BD * (cast(a AS {wide}) * cast(a AS {wide}))) div (cast(l AS {wide}) * cast(r AS {wide}))")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    kept = scored.join(_covered(known, within, max_words), ["lang", "phrase"], "left_anti") if max_words > 2 else scored
    flat = kept.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
    totals = known.where("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))  # one row a language
    return _ranked(flat, top).join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _covered(known: DataFrame, within: int, max_words: int) -> DataFrame:
    """Phrases of two words and more inside a longer frequent phrase with enough occurrences."""
    longer = known.where("words > 2").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    most = longer.select("lang", F.col("n").alias("most"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    shorter = known.where(F.col("words").between(2, max_words - 1)).select("lang", "phrase", "n")
    return shorter.join(most, ["lang", "phrase"]).where(F.col("most") * 100 >= F.col("n") * within).select("lang", "phrase")


def _ranked(scored: DataFrame, top: int | None) -> DataFrame:
    """Ranks within each language; for a top, parts of a language are ranked first, so that no task gets a whole one."""
    order: list[Column] = [F.desc("score"), F.desc("a"), F.col("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    if top is not None:
        part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
        scored = scored.withColumn("part", part).withColumn("rank", rank("lang", "part")).where(F.col("rank") <= top).drop("part", "rank")
    scored = scored.withColumn("rank", rank("lang"))
    return scored if top is None else scored.where(F.col("rank") <= top)


def phrases_sql() -> str:
    """DuckDB SQL for the collocations of ``documents``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {lower} AS t FROM documents),
pieces AS (
  SELECT r, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece,
         generate_subscripts(string_split_regex(t, '[.,;:!?\x0A-\x0D]'), 1) AS p FROM texts),
words AS (
  SELECT r, lang, p, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w1,
         generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM pieces),
runs AS (SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM words WINDOW piece AS (PARTITION BY r, p ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS n FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND n >= 10),
parts AS (
  SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, w FROM candidates),
named AS (
  SELECT lang, k, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 : k], ' ') AS tail FROM parts),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.n AS l, y.n AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM named c JOIN grams x ON x.lang = c.lang AND x.phrase = c.head JOIN grams y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS longer FROM candidates WHERE k = 3),
covered AS (
  SELECT DISTINCT lang, phrase FROM inner_pairs p JOIN candidates c USING (lang, phrase) WHERE 100 * longer >= 50 * c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM best ANTI JOIN covered USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
