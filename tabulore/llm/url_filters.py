"""URL filters: allow and block entries in a trie over reversed host labels and path segments.

An entry is a host and the beginning of a path, written like ``example.net/en/``. It fits its host and all
subdomains, where the path of the URL starts with the path of the entry. Of the entries that fit, the longest
(characters of host and path, then of the host) decides; of two equal entries, the one that allows.

The trie goes to the executors while it has at most ``BROADCAST_ENTRIES`` entries of ``BROADCAST_CHARS`` characters
in all. Longer lists are joined by the host's endings and the path's directories, which are the paths from the root
of the same trie, so both ways give the same rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ENTRIES = 100_000
BROADCAST_CHARS = 16 << 20
VERDICTS = ("allow", "block")
RESULT = "rule string, verdict string"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both are empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    after = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    return lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0)), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def segments(path: str) -> tuple[list[str], str]:
    """The segments of a path up to its last slash, each with its slash, and what follows."""
    *whole, rest = path.split("/")
    return [x + "/" for x in whole], rest


class Trie:
    """Nodes are dictionaries: host labels from the last to the first, then path segments; leaves hold entries."""

    HOST, PATH, REST, LENGTHS = range(4)  # children by label and by segment, entries by what follows the last slash, its lengths

    def __init__(self, entries: list[tuple[str, str, str]]):
        self.root: list[dict] = self._node()
        for host, path, verdict in entries:
            node = self.root
            for label in reversed(host.split(".")):
                node = node[self.HOST].setdefault(label, self._node())
            whole, rest = segments(path)
            for segment in whole:
                node = node[self.PATH].setdefault(segment, self._node())
            there = node[self.REST].get(rest)
            if there is None or verdict == "allow":
                node[self.REST][rest] = (len(host) + len(path), len(host), host + path, verdict)
                node[self.LENGTHS][len(rest)] = True

    @staticmethod
    def _node() -> list[dict]:
        return [{}, {}, {}, {}]

    def fitting(self, host: str, path: str) -> Iterator[tuple[int, int, str, str]]:
        node = self.root
        for label in reversed(host.split(".")):
            node = node[self.HOST].get(label)
            if node is None:
                return
            if node[self.PATH] or node[self.REST]:
                yield from self._below(node, path)

    def _below(self, node: list[dict], path: str) -> Iterator[tuple[int, int, str, str]]:
        at = 0
        while node is not None:
            for length in node[self.LENGTHS]:
                entry = node[self.REST].get(path[at : at + length])
                if entry:
                    yield entry
            if not node[self.PATH] or (end := path.find("/", at)) < 0:
                return
            node, at = node[self.PATH].get(path[at : end + 1]), end + 1

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        best = max(self.fitting(host, path), default=None)
        return best and best[2:]


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has the columns ``host``, ``path`` and ``verdict`` (allow or block); rows with a null or another verdict
    count for nothing, and hosts are compared in lower case (A-Z). ``rule`` is the deciding entry as host and path, null
    where none fits; ``verdict`` is then ``default``. The host keeps a port or a user's name, so that an entry for
    ``example.net`` does not fit ``example.net:8080``. A URL without a path has an empty one, which starts with no ``/``.
    Rows are kept as they are, repeated ones too; of the input's columns, those called like a result are replaced.
    """
    entries = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").where(
        F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(*VERDICTS))
    size = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0))).first()
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    host, path = host_and_path(quoted(url))
    parts = F.struct(host.alias("host"), path.alias("path"))
    names = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    kept = F.struct(*map(quoted, names)).alias("row")
    named = df.select(kept if names else F.struct(F.lit(1)).alias("row"), parts.alias("at"))
    found = _by_trie if size[0] <= BROADCAST_ENTRIES and size[1] <= BROADCAST_CHARS else _by_join
    judged = found(named, entries)
    return judged.select(
        *[F.col("row")[c].alias(c) for c in names], F.col("at.host"), F.col("at.path"), F.col("found.rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def _by_trie(named: DataFrame, entries: DataFrame) -> DataFrame:
    context = named.sparkSession.sparkContext
    trie = context.broadcast(Trie([tuple(r) for r in entries.collect()]))

    @F.pandas_udf(RESULT)
    def longest(at: pd.DataFrame) -> pd.DataFrame:
        known = trie.value
        found = [known.longest(h, p) or (None, None) for h, p in zip(at["host"], at["path"], strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], index=at.index, dtype=object)

    return named.withColumn("found", longest("at"))


def _by_join(named: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct places (host, path) meet the entries on a host's ending and a directory of the path.

    A place takes part with no more labels and segments than the longest entries have.
    """
    labels, slashes = F.size(F.split("host", r"\.")), F.size(F.split("path", "/")) - 1
    most = entries.agg(F.max(labels), F.max(slashes)).first()
    best = entries.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))  # allow comes before block
    best = best.select(
        "host", F.when(slashes > 0, F.call_function("substring_index", F.col("path"), F.lit("/"), slashes)).otherwise("").alias("directory"), "path", "verdict")
    places = named.select("at.host", "at.path").distinct().withColumn("place", F.struct("host", "path"))
    ends = F.transform(F.sequence(F.lit(1), F.least(labels, F.lit(most[0]))), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    starts = F.transform(F.sequence(F.lit(0), F.least(slashes, F.lit(most[1]))), lambda i: F.when(i > 0, F.call_function("substring_index", F.col("path"), F.lit("/"), i)).otherwise(""))
    keyed = places.select("place", F.explode(ends).alias("host"), starts.alias("starts"))
    keyed = keyed.select("place", "host", F.posexplode("starts").alias("depth", "directory"))
    length = F.size(F.split("path", "/")) - 1
    met = keyed.join(best, ["host", "directory"]).where((length == F.col("depth")) & F.startswith("place.path", "path"))
    order = F.struct(F.length("host") + F.length("path"), F.length("host"))
    won = met.groupBy("place").agg(F.max_by(F.struct(F.concat("host", "path").alias("rule"), "verdict"), order).alias("found"))
    return named.join(won, F.col("at") == F.col("place"), "left")


def judge_sql(entries: list[tuple[str, str, str]], default: str = "allow") -> str:
    """DuckDB SQL for the verdict on every row of ``pages``."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in entries)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
cut AS (
  SELECT page_id, row_number() OVER () AS r,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, r, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
best AS (
  SELECT r, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host))) AS rule,
         arg_max(rule_verdict, (length(rule_host || rule_path), length(rule_host))) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM parts LEFT JOIN best USING (r)
"""
