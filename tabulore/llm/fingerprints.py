"""Document fingerprints: one-permutation MinHash in Spark SQL expressions only.

Every shingle is hashed once; the top bits of the hash choose a bin and the bin keeps its least hash. An empty
bin takes the value of the first filled bin in a random order of its own (optimal densification). Of each bin
the low-order bits are stored, packed to hexadecimal digits; the estimate of the likeness takes chance
agreement of those bits into account. Nothing is exploded or shuffled: a text's bins are found by one sort of
its hashes, mixed with one greatest value per bin.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.operators.ranking import number_rows
from tabulore.session import cut_lineage

BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
WORDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def probe_masks(seed: int = 7) -> list[int]:
    """All non-zero masks of a bin number in random order: an empty bin j looks at the bins j ^ mask in turn.

    Each bin so sees all others, in an order of its own, and two empty bins never the same one at the same step.
    """
    masks = list(range(1, BINS))
    random.Random(seed).shuffle(masks)
    return masks


def with_bits(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the low-order bits of the bins of ``text``, as an array of ``BINS`` numbers.

    Shingles are 5 words, A-Z lower-cased, between ASCII white space; fewer words are one shingle. The array is
    empty for a text without words, or null.
    """
    shift, value = 64 - BIN_BITS, (1 << (64 - BIN_BITS)) - 1
    ends = [((b + BINS) % BINS) << shift | value for b in range(-BINS // 2, BINS // 2)]
    ends = [e - (1 << 64) if e >= 1 << 63 else e for e in ends]
    words = F.filter(F.split(F.translate(F.col(text), UPPER, LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # Each step is a column of its own: Spark then evaluates it once per row, not once per element.
    df = df.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_words")

    def shingle(h: Column, i: Column) -> Column:
        return F.xxhash64(h, *[F.get(F.col("_words"), i + k) for k in range(1, WORDS)])

    many = F.transform(F.slice("_words", 1, n - (WORDS - 1)), shingle)
    few = F.array(F.xxhash64(F.col("_words"), n))
    hashes = F.when(n >= WORDS, many).when(n > 0, few).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_sorted", F.sort_array(F.concat(hashes, F.lit(ends).cast("array<bigint>"))))
    bin_of = lambda x: F.shiftright(x, shift)
    first = F.filter("_sorted", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col("_sorted"), i - 1))))
    filled = F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(value)) != value, x.bitwiseAND(F.lit(value))))
    df = df.withColumn("_filled", F.size(F.col("_sorted")) > BINS).withColumn("_bins", filled)

    def densified(v: Column, j: Column) -> Column:
        return F.coalesce(v, *[F.get(F.col("_bins"), j.bitwiseXOR(mask)) for mask in probe_masks()])

    low = lambda v: v.bitwiseAND(F.lit((1 << BITS) - 1)).cast("short")
    bits = F.transform("_bins", lambda v, j: low(densified(v, j)))
    df = df.withColumn(name, F.when(F.col("_filled"), bits).otherwise(F.array().cast("array<smallint>")))
    return df.drop("_words", "_sorted", "_filled", "_bins")


def packed(bits: Column) -> Column:
    """The bits of all bins as hexadecimal digits; empty for a text without words."""
    return F.array_join(F.transform(bits, lambda v: F.lpad(F.lower(F.hex(v)), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness, 0 to 1: agreement of bins less that of chance. Two empty texts have 1, one has 0."""
    chance = 2.0**-BITS
    share = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(estimate)


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with the packed fingerprint of ``text``; a column of that name is replaced. No row moves.

    Other columns come through, whatever they are called.
    """
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    rows = df.select(F.struct(*map(quoted, df.columns)).alias("row"), quoted(text).alias("text"))
    kept = [F.col(f"row.`{c.replace('`', '``')}`").alias(c) for c in df.columns if c.lower() != name.lower()]
    return with_bits(rows, "text", "bits").select(*kept, packed(F.col("bits")).alias(name))


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one before in ``key`` (after the smallest the largest; null keys come last), rows
    of one key in order of their texts' digests; repeated rows of one key and text are one document here, each
    with its row in the result. The edited text has the last half of the text replaced by as many code points
    from the start of the next document, or all of it. A null text counts as empty. An empty table gives an
    empty result. Only keys and digests are put in order; texts are shuffled by key, once, and the halves once.
    """
    docs = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    docs = docs.withColumn("row", F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("-")), F.md5("text"))))
    described = with_bits(docs, "text", "bits").select("key", "row", F.length("text").cast("long").alias("n_chars"), "bits")
    described = cut_lineage(described).dropDuplicates(["row"])
    in_order = number_rows(described.select("key", "row", "n_chars"), [F.desc_nulls_last("key"), F.asc("row")], "number")
    in_order = cut_lineage(in_order)
    total = in_order.count()
    after = in_order.select(F.col("number").alias("next_number"), F.col("row").alias("next"))
    pairs = cut_lineage(
        in_order.join(after, F.pmod(F.col("number"), F.lit(max(1, total))) + 1 == F.col("next_number"))
        .select("key", "row", "n_chars", "next")
    )
    keyed = docs.select("row", "text")
    wanted = pairs.select(F.col("next").alias("of"), F.col("row").alias("for"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    heads = keyed.join(wanted, F.col("row") == F.col("of")).select("for", F.expr("substring(text, 1, half)").alias("head"))
    heads = heads.dropDuplicates(["for"])
    edited = keyed.join(heads, F.col("row") == F.col("for")).select(
        "row", F.expr("concat(substring(text, 1, length(text) - floor(length(text) / 2)), head)").alias("edited")
    )
    edited = with_bits(edited, "edited", "edited_bits").select("row", F.sha2("edited", 256).alias("edited_sha256"), "edited_bits")
    of_next = described.select(F.col("row").alias("next"), F.col("bits").alias("next_bits"))
    known = pairs.join(described.select("row", "bits"), "row").join(of_next, "next").select(
        "key", "row", "n_chars", "bits", likeness(F.col("bits"), F.col("next_bits")).alias("near_next")
    )
    return edited.join(known, "row").select(
        F.col("key").alias(key), "n_chars", "edited_sha256", packed(F.col("bits")).alias("fingerprint"),
        packed(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"), "near_next",
    )
