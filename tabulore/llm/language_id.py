"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of the vocabulary; the likelihood of a word is the sum over all
its segmentations into pieces, by a forward algorithm, and that of a text the product over its words (runs of
letters, lower-cased). Pieces do not cross words, so each distinct word of a block is scored once, all words of
a block and all languages in step. The probabilities are fitted by expectation maximisation over the counted
words of a bounded sample of labelled texts; expected counts are summed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.llm.shingles import KnownWords, byte_blocks, mix, powers, small_batches, span_hashes, text_buffers, word_spans
from tabulore.session import cut_lineage

FIT_DOCS = 500  # labelled texts per language
ROUNDS = 3
KNOWN_WORDS = 400_000  # words whose likelihoods a worker keeps
LONGEST_WORD = 48  # longer runs of letters are taken in parts
UNKNOWN = 1e-7
UNDETERMINED = "und"
START = "▁"
_LETTER_BYTES = np.zeros(256, bool)
_LETTER_BYTES[97:123] = True
_LETTER_BYTES[128:] = True  # letters outside ASCII; other signs have gone
_SIGNS = regex.compile(r"[^\p{L}\x00-\x7f]+")


def vocabulary_pieces(model_file: str) -> list[str]:
    """The pieces of letters, lower-cased, of a sentencepiece model; those that start a word begin with U+2581."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p and (p == START or p.removeprefix(START).isalpha()))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _sums(codes: np.ndarray) -> np.ndarray:
    up, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64, out=out[1:])
    return out


class Pieces:
    """Finds which piece starts at each place of a text."""

    def __init__(self, pieces: Sequence[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)
        codes = _codes("".join(pieces))
        ends = np.cumsum([len(p) for p in pieces]) if len(pieces) else np.zeros(0, np.int64)
        self.hashes = self._of(_sums(codes), ends - np.array([len(p) for p in pieces], np.int64), ends)
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        # The upper 20 bits of a hash lead to the place of the first hash with such bits.
        self.table = np.searchsorted(self.sorted, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)) if self.size else None
        if self.size:
            self.table[-1] = self.size
            self.steps = int(np.diff(self.table).max())

    @staticmethod
    def _of(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = powers(len(sums))
        return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))

    def at(self, sums: np.ndarray, length: int) -> np.ndarray:
        """For each place, the piece of ``length`` letters that starts there, or ``size`` if there is none."""
        begin = np.arange(len(sums) - length)
        found = np.full(len(begin), self.size, np.int32)
        if self.size and len(begin):
            wanted = self._of(sums, begin, begin + length)
            place = self.table[(wanted >> np.uint64(44)).astype(np.int64)]
            for step in range(self.steps):
                candidate = np.minimum(place + step, self.size - 1)
                hit = self.sorted[candidate] == wanted
                found[hit] = self.order[candidate[hit]]
        return found


class Lattice:
    """All segmentations of many words: node k of a word is the place after k of its letters."""

    def __init__(self, words: Sequence[str], pieces: Pieces):
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        codes = _codes("".join(f"{START}{w}\0" for w in words))
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(words) else np.zeros(0, np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths, self.starts, self.nodes = lengths[self.order], starts[self.order], len(codes)
        sums = _sums(codes)
        self.longest = int(self.lengths.max()) if len(words) else 0
        self.ids = [None] + [pieces.at(sums, n) for n in range(1, min(pieces.longest, self.longest) + 1)]
        self.size = pieces.size

    def steps(self) -> Iterator[tuple[int, np.ndarray]]:
        """(k, starts of the words with at least k letters) for k = 1, 2, ..."""
        active = np.searchsorted(-self.lengths, -np.arange(self.longest + 1), "right")
        for k in range(1, self.longest + 1):
            yield k, self.starts[: active[k]]

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """Sum over the segmentations of each word up to each node; chances: (size + 1) rows, the last for letters
        that are no piece."""
        alpha = np.zeros((self.nodes + 1, chances.shape[1]))
        alpha[self.starts] = 1
        for k, starts in self.steps():
            total = np.zeros((len(starts), chances.shape[1]))
            for n in range(1, min(k + 1, len(self.ids))):
                begin = starts + k - n
                ids = self.ids[n][begin]
                if n == 1:
                    total += alpha[begin] * chances[ids]
                else:
                    hit = np.flatnonzero(ids < self.size)
                    total[hit] += alpha[begin[hit]] * chances[ids[hit]]
            alpha[starts + k] = total
        return alpha

    def log_likelihoods(self, chances: np.ndarray) -> np.ndarray:
        """One row per word in the given order, one column per language."""
        out = np.empty((len(self.order), chances.shape[1]))
        alpha = self.forward(chances)
        out[self.order] = np.log(np.maximum(alpha[self.starts + self.lengths], 1e-300))
        return out

    def expected_counts(self, chances: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur ``times`` (words x languages) times."""
        alpha = self.forward(chances)
        beta = np.zeros_like(alpha)
        total = np.maximum(alpha[self.starts + self.lengths], 1e-300)
        beta[self.starts + self.lengths] = times[self.order] / total
        counts = np.zeros_like(chances)
        active = np.searchsorted(-self.lengths, -np.arange(self.longest + 1), "right")
        for k in range(self.longest, 0, -1):
            starts = self.starts[: active[k]]
            end = beta[starts + k]
            for n in range(1, min(k + 1, len(self.ids))):
                begin = starts + k - n
                ids = self.ids[n][begin]
                hit = np.arange(len(ids)) if n == 1 else np.flatnonzero(ids < self.size)
                ids, begin = ids[hit], begin[hit]
                back = end[hit] * chances[ids]
                np.add.at(counts, ids, back * alpha[begin])
                np.add.at(beta, begin, back)
        return counts


def _lower(column: pa.Array) -> pa.Array:
    """Texts in lower case with a blank for every run of signs outside ASCII that are no letters, as fitting has it."""
    return pa.array([(x if x.isascii() else _SIGNS.sub(" ", x)).lower() if x else "" for x in column.to_pylist()], pa.large_string())


def word_parts(words: Sequence[str]) -> tuple[list[str], list[int]]:
    """Words in parts of at most ``LONGEST_WORD`` letters, and the number of the word of each part."""
    parts, owner = [], []
    for i, w in enumerate(words):
        for j in range(0, len(w), LONGEST_WORD):
            parts.append(w[j : j + LONGEST_WORD])
            owner.append(i)
    return parts, owner


def word_log_likelihoods(words: Sequence[str], pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """A row per word; words over ``LONGEST_WORD`` letters are the product of their parts."""
    parts, owner = word_parts(words)
    each = Lattice(parts, pieces).log_likelihoods(chances)
    if len(parts) == len(words):
        return each
    out = np.zeros((len(words), chances.shape[1]))
    np.add.at(out, owner, each)
    return out


class Model:
    """Piece probabilities (pieces + 1 rows, a column per language)."""

    def __init__(self, languages: list[str], pieces: list[str], chances: np.ndarray):
        self.languages, self.pieces, self.chances = languages, pieces, chances
        self._finder = self._known = None

    def __getstate__(self):
        return self.__dict__ | {"_finder": None, "_known": None}

    def score(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, its probability among the languages) for each text of an Arrow column."""
        if self._finder is None:
            self._finder, self._known = Pieces(self.pieces), KnownWords(len(self.languages), KNOWN_WORDS)
        column = _lower(column)
        data, offsets = text_buffers(column)
        total = np.zeros((len(column), max(1, len(self.languages))))
        has_ascii = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123))])[offsets]
        letters = np.diff(has_ascii) > 0
        for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)).tolist():
            letters[i] = any(c.isalpha() for c in column[i].as_py())
        for begin, end in byte_blocks(data, offsets) if self.languages else ():
            first = int(np.searchsorted(offsets, begin, "right")) - 1
            last = int(np.searchsorted(offsets, end, "left"))
            block = data[begin:end]
            starts, ends, of_text = word_spans(block, np.clip(offsets[first : last + 1] - begin, 0, end - begin), _LETTER_BYTES)
            if not len(starts):
                continue
            distinct, example, index = np.unique(span_hashes(block, starts, ends), return_index=True, return_inverse=True)
            raw, first_byte, end_byte = block.tobytes(), starts[example].tolist(), ends[example].tolist()

            def compute(places: list[int], raw=raw, first_byte=first_byte, end_byte=end_byte) -> np.ndarray:
                words = [raw[first_byte[i] : end_byte[i]].decode(errors="replace") for i in places]
                return word_log_likelihoods(words, self._finder, self.chances)

            each = self._known.of(distinct, compute)
            for j in range(each.shape[1]):
                sums = np.concatenate([[0.0], np.cumsum(each[index, j])])
                total[first:last, j] += sums[of_text[1:]] - sums[of_text[:-1]]
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        known = letters & bool(self.languages)
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, score, 0.0)


def fit(df: DataFrame, model_file: str, text: str = "text", lang: str = "lang", docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """Learn from the rows with a language: ``docs`` texts of each by hash, so the fit does not grow with the table.

    Rows with a null text or language teach nothing. Without any the model knows no language.
    """
    given = df.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()
    by_hash = Window.partitionBy("lang").orderBy("h")
    hashed = given.select("lang", F.xxhash64("text").alias("h")).distinct()
    # A share of the hashes holds about four times as many as wanted, however many rows a language has.
    shares = hashed.groupBy("lang").agg((F.lit(4.0 * docs) / F.count(F.lit(1))).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("h"), 11).cast("double") * F.lit(2.0**-53)
    some = hashed.join(shares, "lang").where(place < F.col("share")).select("lang", "h")
    chosen = cut_lineage(some.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= docs).drop("r"))
    # At most ``docs`` rows per language.
    sample = given.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    counted = cut_lineage(
        sample.select("lang", words).where("word != ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("times"))
    )
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())
    pieces = vocabulary_pieces(model_file)
    chances = np.full((len(pieces) + 1, max(1, len(languages))), 1 / max(1, len(pieces)))
    chances[-1] = UNKNOWN
    if not languages:
        return Model([], pieces, chances)
    column = {name: i for i, name in enumerate(languages)}

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, counts = Pieces(pieces), np.zeros_like(chances)
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                given_words, owner = word_parts(part.column(1).to_pylist())
                times = np.zeros((len(given_words), len(languages)))
                languages_of = np.array([column[x] for x in part.column(0).to_pylist()], np.int64)
                times[np.arange(len(given_words)), languages_of[owner]] = part.column(2).to_numpy()[owner]
                counts += Lattice(given_words, finder).expected_counts(chances, times)
        piece, language = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(counts[piece, language])], names=["piece", "language", "uses"])

    for _ in range(rounds):
        counts = np.zeros_like(chances)
        summed = counted.mapInArrow(expect, "piece long, language long, uses double").groupBy("piece", "language").agg(F.sum("uses"))
        for piece, language, uses in summed.collect():  # at most pieces x languages rows
            counts[piece, language] = uses
        counts = counts[:-1] + 0.01
        chances = np.vstack([counts / counts.sum(0), np.full((1, len(languages)), UNKNOWN)])
    return Model(languages, pieces, chances)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the probability of the language among the learned ones.

    ``und`` with score 0 where the text is null, empty or has no letter, or the model knows no language; of equal
    likelihoods the first language by name. Every row stays; columns named like the two new ones are replaced.
    """
    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, kept.index(text)):
            names, score = shared.value.score(batch.column(kept.index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
