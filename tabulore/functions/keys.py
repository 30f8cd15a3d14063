"""Reproducible pseudo-random order and sampling from md5 of a key.

The same key gives the same position on every run, engine and cluster size,
unlike ``rand(seed)`` whose stream depends on the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_DIGITS = 15  # 60 bits: the widest hex prefix that always fits a signed bigint


def key_text(columns: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if len(cols) == 1:
        return F.coalesce(cols[0].cast("string"), F.lit(""))
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def key_md5(columns: Sequence[str | Column]) -> Column:
    return F.md5(key_text(columns))


def key_position(columns: Sequence[str | Column]) -> Column:
    """Leading 60 bits of the key's md5 as a bigint, in md5 order."""
    return F.conv(F.substring(key_md5(columns), 1, PREFIX_DIGITS), 16, 10).cast("bigint")


def in_share(columns: Sequence[str | Column], share: float) -> Column:
    """Whether a key lies in the first ``share`` of all 60-bit positions."""
    if not 0.0 <= share <= 1.0:
        raise ValueError("share must lie between 0 and 1")
    return key_position(columns) < F.lit(round(share * 16**PREFIX_DIGITS)).cast("bigint")
