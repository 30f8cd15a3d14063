"""Line dedup by site-relative frequency.

For each host the pages that contain a line are divided by the pages of the host; lines above a ratio are
boilerplate of that host and are dropped from its pages. Only digests of lines travel for counting, counted
per page before the shuffle, so a hot host adds up in many tasks. A page of ``l`` distinct lines on average
leaves at most ``l / ratio`` boilerplate lines per host, so each host's lines fit in one array, and pages meet
the array of their host in one join (Spark broadcasts the arrays when they are small, else splits hot hosts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOILERPLATE_RATIO = 0.05
LEAST_PAGES = 4
SALTS = 32


def page_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines the same: their text without blanks, tabs and carriage returns at the ends."""
    return F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")


def line_frequencies(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(host, line_md5, pages, host_pages): in how many pages of its host each non-blank line occurs."""
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("text")).where("host IS NOT NULL")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.filter(F.transform(page_lines(F.col("text")), line_key), lambda x: x != "")
    digests = F.transform(F.array_distinct(keys), lambda x: F.md5(x.cast("binary")))
    counts = (
        pages.select("host", F.explode(digests).alias("line_md5"))
        .groupBy("host", "line_md5").agg(F.count(F.lit(1)).alias("pages"))
    )
    return counts.join(totals, "host")


def boilerplate_lines(
    df: DataFrame, text: str = "text", host: str = "source", ratio: float = BOILERPLATE_RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """The lines on more than ``ratio`` of their host's pages and on at least ``least_pages`` of them."""
    return line_frequencies(df, text, host).where(
        (F.col("pages") >= least_pages) & (F.col("pages") > F.lit(ratio) * F.col("host_pages"))
    )


def drop_boilerplate(
    df: DataFrame, text: str = "text", host: str = "source", ratio: float = BOILERPLATE_RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, and ``n_dropped``, the number of lines taken out.

    Other lines, blank ones included, keep their order. A null text stays null and an empty one empty (0
    dropped). Rows without a host belong to no site and stay as they are, and count for no host. A line that a
    page repeats counts once for the page and is dropped everywhere in it. Repeated rows are pages of their
    own. Every row stays; a page of nothing but boilerplate keeps an empty text. Other columns come through,
    whatever they are called; a column ``n_dropped`` of ``df`` is replaced.
    """
    kept = [c for c in df.columns if c.lower() != "n_dropped"]
    lines = (
        boilerplate_lines(df, text, host, ratio, least_pages)
        .groupBy("host").agg(F.collect_list("line_md5").alias("boilerplate"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    # The row travels as one column, so that no name of the table meets a name used here.
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    pages = df.select(F.struct(*map(quoted, kept)).alias("row"), quoted(host).alias("of"), quoted(text).alias("text"))
    pages = pages.withColumn("page_salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    joined = pages.join(lines, (F.col("of") == F.col("host")) & (F.col("page_salt") == F.col("salt")), "left")
    left = F.filter(
        page_lines(F.col("text")), lambda x: ~F.array_contains(F.col("boilerplate"), F.md5(line_key(x).cast("binary")))
    )
    clean = F.when(F.col("boilerplate").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    joined = joined.withColumn("clean", clean)
    breaks = F.size(page_lines(F.col("text")))
    dropped = F.when(F.col("boilerplate").isNull() | F.col("text").isNull(), F.lit(0)).otherwise(breaks - F.size(left))
    joined = joined.withColumn("dropped", dropped.cast("long"))
    out = [F.col("clean" if c == text else f"row.`{c.replace('`', '``')}`").alias(c) for c in kept]
    return joined.select(*out, F.col("dropped").alias("n_dropped"))
