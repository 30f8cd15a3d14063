"""Table profiles in a few passes per table.

Pass 1  one aggregation: row count, nulls, numeric statistics; then one scan for
        the correlations, from matrices of products around the means.
Pass 2  categorical cells counted (long ones by their digests), the top ones kept per column.
Pass 3  statistics of the numeric columns within the top categories.
Pass 4  exact quartiles, then conditional counts around fences and midpoints.

The results are small frames (metadata size: a bounded number of rows per
column), so a ``Profile`` may keep them in the shared checkpoint folder; all
question-answer templates are projections over them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property
from itertools import batched

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.functions.text import g6, ref, sql
from tabulore.operators import gram
from tabulore.operators.quantiles import (
    BUCKETS, COUNTED, DIRECT_LIMIT, Target, clean_double, select_ranks,
)
from tabulore.plans.templates import METADATA_KINDS
from tabulore.session import cut_lineage, cut_lineage_of_blocks
from tabulore.sources.tables import ColumnRole, TableSet, literal_rows, union_all


@dataclass(frozen=True)
class ProfileOptions:
    """Fixed values of the profiling rules, open to change per run."""

    top_values: int = 20
    fence_factor: float = 1.5
    direct_limit: int = DIRECT_LIMIT
    buckets: int = BUCKETS
    tables_per_plan: int = 64
    exclude_columns: frozenset[str] = field(default_factory=frozenset)
    id_columns: dict[str, str] = field(default_factory=dict)


NULL_FIELDS = "struct<column:string,position:int,n_null:bigint>"
NUMERIC_FIELDS = (
    "struct<column:string,position:int,is_fractional:boolean,n:bigint,min:double,max:double,avg:double,"
    "stddev:double,min_raw:string,max_raw:string>"
)
DIGEST_BYTES = 32
#: Types whose cells are shown in fewer bytes than a digest.
ALWAYS_SHORT = (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
GROUP_FIELDS = "struct<num:string,num_position:int,n:bigint,avg:double,stddev:double,min:double,max:double>"


def number(name: str) -> str:
    """SQL: a numeric column as double; NaN is a missing value."""
    return clean_double(f"cast({ref(name)} as double)")


def cell_key(value: str) -> str:
    """SQL: what tells a cell apart; a value shorter than a digest stands for itself, so no two kinds are equal."""
    return f"if(octet_length({value}) < {DIGEST_BYTES}, {value}, md5({value}))"


def array_of(items: list[str], fields: str) -> str:
    return f"cast(array({', '.join(items)}) as array<{fields}>)"


class Profile:
    """Profile frames of a table set.

    With ``keep=True`` each pass is run once and stored in the checkpoint
    folder; otherwise every frame is a lazy plan from the tables.
    """

    def __init__(self, tables: TableSet, options: ProfileOptions | None = None, keep: bool = False):
        self.tables = tables
        self.options = options or ProfileOptions()
        self.keep = keep

    def _kept(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df.repartition("table")) if self.keep else df

    def _kept_union(self, frames: Iterable[DataFrame]) -> DataFrame:
        """The union of one frame per table; stored ones are planned ``tables_per_plan`` at a time and appended."""
        if not self.keep:
            return union_all(frames)
        blocks = batched(frames, self.options.tables_per_plan)
        return cut_lineage_of_blocks(union_all(block).repartition("table") for block in blocks)

    def numeric_roles(self, table: str) -> list[ColumnRole]:
        return [
            r for r in self.tables.roles[table]
            if r.is_numeric and r.name not in self.options.exclude_columns
        ]

    def categorical_roles(self, table: str) -> list[ColumnRole]:
        return [
            r for r in self.tables.roles[table]
            if r.is_categorical and r.name not in self.options.exclude_columns
        ]

    # ---- pass 1 -------------------------------------------------------------

    def _summarise(self, table: str) -> DataFrame:
        numeric = self.numeric_roles(table)
        nulls = [
            f"struct({sql(r.name)}, {r.position}, count(1) - count({ref(r.name)}))" for r in self.tables.roles[table]
        ]
        stats = []
        for r in numeric:
            raw, x = ref(r.name), number(r.name)
            stats.append(
                f"struct({sql(r.name)}, {r.position}, {str(r.is_fractional).lower()}, count({x}), min({x}), max({x}), "
                f"avg({x}), stddev_samp({x}), cast(min({raw}) as string), cast(max({raw}) as string))"
            )
        return self.tables.tables[table].agg(
            F.expr("count(1)").alias("n_rows"),
            F.expr(array_of(nulls, NULL_FIELDS)).alias("nulls"),
            F.expr(array_of(stats, NUMERIC_FIELDS)).alias("numeric"),
        ).select(F.lit(table).alias("table"), "*")

    @cached_property
    def summary(self) -> DataFrame:
        """One row per table: n_rows, nulls[], numeric[]."""
        return self._kept_union(self._summarise(name) for name in self.tables.names)

    @cached_property
    def table_sizes(self) -> DataFrame:
        """(table, table_position, n_rows, n_cols, n_numeric, n_categorical, n_id)."""
        columns = self.tables.columns_frame()
        counted = columns.groupBy("table", "table_position").agg(
            F.count(F.lit(1)).alias("n_cols"),
            F.count_if("is_numeric").alias("n_numeric"),
            F.count_if("is_categorical").alias("n_categorical"),
            F.count_if("is_id").alias("n_id"),
        )
        return self.summary.select("table", "n_rows").join(counted, "table").select(
            "table", "table_position", "n_rows", "n_cols", "n_numeric", "n_categorical", "n_id"
        )

    @cached_property
    def nulls(self) -> DataFrame:
        """(table, column, position, n_rows, n_null, pct_null)."""
        return self.summary.select("table", "n_rows", F.inline("nulls")).select(
            "table", "column", "position", "n_rows", "n_null",
            F.try_divide(F.lit(100.0) * F.col("n_null"), F.col("n_rows")).alias("pct_null"),
        )

    @cached_property
    def completeness(self) -> DataFrame:
        """(table, n_cols, n_complete, pct_complete)."""
        return self.nulls.groupBy("table").agg(
            F.count(F.lit(1)).alias("n_cols"),
            F.count_if(F.col("n_null") == 0).alias("n_complete"),
            (F.lit(100.0) * F.count_if(F.col("n_null") == 0) / F.count(F.lit(1))).alias("pct_complete"),
        )

    @cached_property
    def numeric(self) -> DataFrame:
        """Statistics per numeric column, with CV, precision class and 95 % interval."""
        base = self.summary.select("table", "n_rows", F.inline("numeric"))
        return base.selectExpr(
            "*",
            f"if(is_fractional, {g6('min')}, min_raw) as min_text",
            f"if(is_fractional, {g6('max')}, max_raw) as max_text",
            "abs(stddev / nullif(avg, 0D)) as cv",
            "case when n >= 2 then stddev / sqrt(cast(n as double)) end as se",
        ).selectExpr(
            "*",
            "case when n >= 2 then case when cv < 0.1D then 'high' when cv < 0.3D then 'moderate' "
            "when cv >= 0.3D then 'low' end end as precision",
            "avg - 1.96D * se as ci_lo",
            "avg + 1.96D * se as ci_hi",
        )

    @cached_property
    def _moments(self) -> dict[tuple[str, str], tuple]:
        """Counts, means and deviations on the driver: one row per profiled numeric column."""
        rows = self.numeric.select("table", "column", "n_rows", "n", "avg", "stddev").collect()
        return {(row["table"], row["column"]): (row["n_rows"], row["n"], row["avg"], row["stddev"]) for row in rows}

    def _varying(self, table: str) -> list[ColumnRole]:
        """Numeric columns with a deviation."""
        return [r for r in self.numeric_roles(table) if self._moments[table, r.name][3]]

    @cached_property
    def correlations(self) -> DataFrame:
        """(table, col_a, pos_a, col_b, pos_b, r, rank) with rank by |r| descending."""
        varying = {name: roles for name in self.tables.names if len(roles := self._varying(name)) > 1}
        frames = [
            (name, self.tables.tables[name], [number(r.name) for r in roles], [self._moments[name, r.name][2] for r in roles])
            for name, roles in varying.items()
        ]
        # Equal up to rounding errors counts as equal.
        by_size = Window.partitionBy("table").orderBy(F.round(F.abs("r"), 12).desc(), "pos_a", "pos_b")
        if not frames:
            return literal_rows(
                self.tables.spark, [],
                "table string, col_a string, pos_a int, col_b string, pos_b int, r double, rank int",
            )
        names = literal_rows(
            self.tables.spark, [(name, n, r.name, r.position) for name, roles in varying.items() for n, r in enumerate(roles)],
            "table string, n int, column string, position int",
        )
        side = lambda x: names.select(
            "table", F.col("n").alias(x), F.col("column").alias(f"col_{x}"), F.col("position").alias(f"pos_{x}"))
        found = gram.table_correlations(frames).where("r is not null")
        named = found.join(side("a"), ["table", "a"]).join(side("b"), ["table", "b"])
        return self._kept(
            named.select("table", "col_a", "pos_a", "col_b", "pos_b", "r").withColumn("rank", F.row_number().over(by_size))
        )

    # ---- passes 2 and 3 -----------------------------------------------------

    def _cells(self, table: str, keep: list[str], roles: list[ColumnRole] | None = None) -> DataFrame | None:
        """Categorical cells of a table in long form, next to the ``keep`` expressions."""
        roles = self.categorical_roles(table) if roles is None else roles
        if not roles:
            return None
        cells = ", ".join(
            f"named_struct('column', {sql(r.name)}, 'position', {r.position}, 'value', {r.shown_sql})" for r in roles
        )
        return self.tables.tables[table].selectExpr(*keep, f"inline(array({cells}))")

    def _top_digests(self, table: str) -> DataFrame | None:
        cells = self._cells(table, [])
        if cells is None:
            return None
        counts = (
            cells.selectExpr("column", "position", f"{cell_key('value')} as key")
            .groupBy("column", "position", "key").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("digest", F.expr(f"if(octet_length(key) < {DIGEST_BYTES}, md5(key), key)"))
        )
        order = Window.partitionBy("column", "position").orderBy(F.desc("n"), F.asc_nulls_last("digest"))
        top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.options.top_values)
        # NULL takes one of the top places and is dropped afterwards.
        again = F.row_number().over(Window.partitionBy("column", "position").orderBy("rank"))
        fields = ["column", "position", "key", "digest", "n"]
        top = top.filter(F.col("digest").isNotNull()).select(*fields, again.cast("bigint").alias("rank"))
        # The least frequent value, whose rank is the number of distinct values. NULL is left out here and not by a filter
        # before, with which the cells would be counted a second time.
        place = F.when(F.col("digest").isNotNull(), F.struct(-F.col("n"), F.col("digest")))
        last = counts.groupBy("column", "position").agg(
            F.max_by(F.struct("key", "digest", "n"), place).alias("last"), F.count("digest").alias("rank")
        ).filter(F.col("rank") > 0).select("column", "position", "last.key", "last.digest", "last.n", "rank")
        both = top.unionByName(last).groupBy(*fields).agg(F.min("rank").alias("rank"), F.max("rank").alias("n_values"))
        is_last = F.max("n_values").over(Window.partitionBy("column"))
        return both.withColumn("n_values", is_last).select(F.lit(table).alias("table"), *fields, "rank", "n_values")

    @cached_property
    def top_digests(self) -> DataFrame | None:
        """(table, column, position, key, digest, n, rank, n_values): the ``top_values`` most and the one least frequent value per column."""
        frames = [f for f in (self._top_digests(name) for name in self.tables.names) if f is not None]
        return self._kept_union(frames) if frames else None

    def _top(self, table: str) -> DataFrame | None:
        return self.top_digests.filter(F.col("table") == table) if self.keep else self._top_digests(table)

    def _group(self, table: str) -> DataFrame | None:
        numeric = self.numeric_roles(table)
        cells = self._cells(table, [f"{number(r.name)} as num_{r.position}" for r in numeric])
        if cells is None:
            return None
        # Bounded: top_values + 1 rows per categorical column of one table.
        matched = cells.withColumn("key", F.expr(cell_key("value"))).join(
            F.broadcast(self._top(table).select("column", "key", "rank", "n_values")), ["column", "key"]
        )
        stats = [
            f"struct({sql(r.name)}, {r.position}, count({x}), avg({x}), stddev_samp({x}), min({x}), max({x}))"
            for r, x in ((r, f"num_{r.position}") for r in numeric)
        ]
        return matched.groupBy("column", "position", "rank", "n_values", "value").agg(
            F.expr("count(1)").alias("n"), F.expr(array_of(stats, GROUP_FIELDS)).alias("stats")
        ).select(F.lit(table).alias("table"), "*")

    @cached_property
    def _group_frame(self) -> DataFrame:
        frames = [f for f in (self._group(name) for name in self.tables.names) if f is not None]
        if not frames:
            return literal_rows(
                self.tables.spark, [], "table string, column string, position int, rank bigint, n_values bigint, value string, n bigint, "
                f"stats array<{GROUP_FIELDS}>",
            )
        return self._kept_union(frames)

    @cached_property
    def _long_columns(self) -> dict[str, set[str]]:
        """Columns per table with top values that are not their own keys; on the driver, at most one row per column."""
        found: dict[str, set[str]] = {}
        if self.keep and self.top_digests is not None:
            for row in self.top_digests.filter(f"octet_length(key) >= {DIGEST_BYTES}").select("table", "column").distinct().collect():
                found.setdefault(row["table"], set()).add(row["column"])
        elif not self.keep:
            for name in self.tables.names:
                found[name] = {r.name for r in self.categorical_roles(name) if not isinstance(r.data_type, ALWAYS_SHORT)}
        return found

    def _value(self, table: str) -> DataFrame | None:
        """The top values with the counts of pass 2; only long ones are looked up in the table."""
        top = self._top(table) if self.categorical_roles(table) else None
        if top is None:
            return None
        is_short = F.octet_length("key") < DIGEST_BYTES
        fields = ["table", "column", "position", "rank", "n_values", "value", "n"]
        known = top.filter(is_short).withColumn("value", F.col("key")).select(*fields)
        roles = [r for r in self.categorical_roles(table) if r.name in self._long_columns.get(table, ())]
        if not roles:
            return known
        sought = top.filter(~is_short).select("column", "key", "rank", "n_values", "n")
        # Bounded: top_values + 1 rows per categorical column of one table.
        cells = self._cells(table, [], roles).filter(F.octet_length("value") >= DIGEST_BYTES).withColumn("key", F.md5("value"))
        looked_up = cells.join(F.broadcast(sought), ["column", "key"]).select(F.lit(table).alias("table"), *fields[1:]).distinct()
        return known.unionByName(looked_up)

    @cached_property
    def _value_frame(self) -> DataFrame:
        if self.keep and "_group_frame" in self.__dict__:
            return self._group_frame.select("table", "column", "position", "rank", "n_values", "value", "n")
        frames = [f for f in (self._value(name) for name in self.tables.names) if f is not None]
        if not frames:
            return self._group_frame.select("table", "column", "position", "rank", "n_values", "value", "n")
        return self._kept_union(frames)

    @cached_property
    def values(self) -> DataFrame:
        """(table, column, position, rank, value, n): the most frequent values per column."""
        top = self._value_frame.filter(F.col("rank") <= self.options.top_values)
        return top.select("table", "column", "position", F.col("rank").cast("int").alias("rank"), "value", "n")

    @cached_property
    def distinct_values(self) -> DataFrame:
        """(table, column, n_values): how many values a categorical column has."""
        return self._value_frame.groupBy("table", "column").agg(F.max("n_values").alias("n_values"))

    @cached_property
    def groups(self) -> DataFrame:
        """Statistics of the numeric columns within each top category."""
        return self._group_frame.filter(F.col("rank") <= self.options.top_values).select(
            "table", F.col("column").alias("cat"), F.col("position").alias("cat_position"), F.col("rank").cast("int").alias("rank"),
            "value", F.inline("stats"),
        )

    # ---- pass 4 -------------------------------------------------------------

    def _fence_rows(self) -> DataFrame:
        """Quartiles by bracket narrowing, all columns of a table in one round; pass 1 gives the first brackets."""
        known = {
            (row["table"], row["column"]): row for row in self.numeric.select("table", "column", "n", "min", "max").collect()
        }
        sources, columns = [], []
        for name in self.tables.names:
            targets = []
            for r in self.numeric_roles(name):
                stats = known[name, r.name]
                bounds = {"lo": stats["min"], "hi": stats["max"], "inside": stats["n"]} if stats["n"] else {}
                targets += [
                    Target(f"{name}\t{r.position}\t{share}", number(r.name), share=share, **bounds) for share in (0.25, 0.75)
                ]
                columns.append((name, r))
            if targets:
                sources.append((self.tables.tables[name], targets))
        found = select_ranks(sources, self.options.direct_limit, self.options.buckets) if sources else {}
        rows = [
            (name, r.name, r.position, found.get(f"{name}\t{r.position}\t0.25"), found.get(f"{name}\t{r.position}\t0.75"))
            for name, r in columns
        ]
        return literal_rows(
            self.tables.spark, rows, "table string, column string, position int, q1 double, q3 double"
        ).filter(F.col("q1").isNotNull())

    @cached_property
    def fences(self) -> DataFrame:
        """Quartiles and outlier fences of the numeric columns with a spread."""
        reach = self.options.fence_factor
        return self._kept(
            self._fence_rows()
            .withColumn("iqr", F.col("q3") - F.col("q1"))
            .filter(F.col("iqr") != 0)
            .withColumn("lo_fence", F.col("q1") - reach * F.col("iqr"))
            .withColumn("hi_fence", F.col("q3") + reach * F.col("iqr"))
        )

    @cached_property
    def _limits(self) -> dict[tuple[str, str], dict[str, float | None]]:
        """Fences and value range per column, on the driver: one row per profiled numeric column.

        As literals they reach the scan as pushed filters and need no join.
        """
        fences = self.fences.select("table", "column", "lo_fence", "hi_fence")
        rows = self.numeric.select("table", "column", "min", "max").join(fences, ["table", "column"], "left").collect()
        return {(row["table"], row["column"]): row.asDict() for row in rows}

    def _limit(self, table: str, column: str, name: str) -> str:
        """SQL: one limit as a literal."""
        value = self._limits[table, column][name]
        return "cast(null as double)" if value is None else f"double('{value!r}')"

    def _outside(self, table: str, role: ColumnRole) -> str:
        x = number(role.name)
        return f"({x} < {self._limit(table, role.name, 'lo_fence')} or {x} > {self._limit(table, role.name, 'hi_fence')})"

    def _count_spread(self, table: str) -> DataFrame | None:
        roles = self.numeric_roles(table)
        if not roles:
            return None
        counts = []
        for r in roles:
            x, lo, hi = number(r.name), self._limit(table, r.name, "min"), self._limit(table, r.name, "max")
            halves = [
                f"count_if({x} < ({lo} + {hi}) / 2)", f"count_if({x} >= ({lo} + {hi}) / 2)",
                f"count_if({x} >= {lo} + ({hi} - {lo}) * 0.33D and {x} <= {lo} + ({hi} - {lo}) * 0.66D)",
            ]
            counts.append(f"struct({sql(r.name)}, {r.position}, count_if({self._outside(table, r)}), {', '.join(halves)})")
        fields = (
            "struct<column:string,position:int,n_outlier:bigint,n_lower_half:bigint,n_upper_half:bigint,n_middle:bigint>"
        )
        # Few columns in one aggregation, as for the order statistics.
        counted = union_all(
            self.tables.tables[table].agg(F.expr(array_of(list(some), fields)).alias("counts")) for some in batched(counts, COUNTED // 2)
        )
        return counted.select(F.lit(table).alias("table"), F.inline("counts"))

    @cached_property
    def spread(self) -> DataFrame:
        """(table, column, position, n_outlier, n_lower_half, n_upper_half, n_middle)."""
        frames = [f for f in (self._count_spread(name) for name in self.tables.names) if f is not None]
        return self._kept_union(frames)

    @cached_property
    def outliers(self) -> DataFrame:
        """Fences with the number and share of rows outside."""
        return (
            self.fences.join(self.spread.select("table", "column", "n_outlier"), ["table", "column"])
            .join(self.summary.select("table", "n_rows"), "table")
            .withColumn("pct_of_rows", F.lit(100.0) * F.col("n_outlier") / F.col("n_rows"))
        )

    def _multi_outliers(self, table: str) -> DataFrame | None:
        roles = self.numeric_roles(table)
        ids = [r.name for r in self.tables.roles[table] if r.is_id]
        id_column = self.options.id_columns.get(table) or (ids[0] if ids else None)
        if len(self.numeric_roles(table)) < 2 or id_column is None:
            return None
        outside = [self._outside(table, r) for r in roles]
        score = " + ".join(f"if({test}, 1, 0)" for test in outside)
        return (
            self.tables.tables[table].filter(" or ".join(outside))
            .selectExpr(f"cast({ref(id_column)} as string) as id", f"{score} as n_outlier")
            .filter(F.col("n_outlier") >= 2)
            .select(F.lit(table).alias("table"), "id", "n_outlier")
        )

    @cached_property
    def multi_outliers(self) -> DataFrame:
        """Rows outside the fences of several columns at once."""
        frames = [f for f in (self._multi_outliers(name) for name in self.tables.names) if f is not None]
        if not frames:
            return literal_rows(self.tables.spark, [], "table string, id string, n_outlier int")
        return self._kept_union(frames)

    # ---- frames derived from the passes ------------------------------------

    @cached_property
    def bimodality(self) -> DataFrame:
        """Columns whose values avoid the middle third of the range, with counts."""
        stats = self.numeric.select("table", "column", "stddev")
        total = F.col("n_lower_half") + F.col("n_upper_half")
        return (
            self.spread.join(stats, ["table", "column"])
            .withColumn("n_valid", total)
            .withColumn("middle_pct", F.try_divide(F.lit(100.0) * F.col("n_middle"), F.col("n_valid")))
            .withColumn(
                "is_bimodal",
                F.coalesce(
                    (F.col("stddev") != 0) & (F.col("middle_pct") < 15) & (F.col("n_valid") > 20), F.lit(False)
                ),
            )
            .drop("stddev")
        )

    @cached_property
    def class_balance(self) -> DataFrame:
        """Most and least frequent value of the first category with two values."""
        ranked = self._value_frame.groupBy("table", "column", "position").agg(
            F.max("n_values").alias("n_values"),
            F.min_by(F.struct("value", "n"), "rank").alias("top"),
            F.max_by(F.struct("value", "n"), "rank").alias("bottom"),
        ).filter(F.col("n_values") >= 2)
        first = F.row_number().over(Window.partitionBy("table").orderBy("position"))
        return ranked.withColumn("first", first).filter(F.col("first") == 1).select(
            "table", "column", F.col("top.value").alias("top_value"), F.col("top.n").alias("top_n"),
            F.col("bottom.value").alias("bottom_value"), F.col("bottom.n").alias("bottom_n"),
        )

    @cached_property
    def most_connected(self) -> DataFrame:
        """Column with the highest mean |r| per table and its three closest partners."""
        pairs = self.correlations
        sides = pairs.select("table", F.col("col_a").alias("column"), F.col("pos_a").alias("position"),
                             F.col("col_b").alias("partner"), "r", "rank").unionByName(
            pairs.select("table", F.col("col_b").alias("column"), F.col("pos_b").alias("position"),
                         F.col("col_a").alias("partner"), "r", "rank"))
        per_column = sides.groupBy("table", "column", "position").agg(
            F.avg(F.abs("r")).alias("mean_r"),
            F.slice(F.sort_array(F.collect_list(F.struct("rank", "partner", "r"))), 1, 3).alias("partners"),
        )
        best = Window.partitionBy("table").orderBy(F.desc(F.round("mean_r", 12)), "position")
        return per_column.withColumn("place", F.row_number().over(best)).filter(F.col("place") == 1).select(
            "table", "column", "mean_r", "partners"
        )

    @cached_property
    def corr_classes(self) -> DataFrame:
        """Correlations with their class: strong, weak, moderate, redundant."""
        size = F.abs("r")
        return self.correlations.select(
            "table", "col_a", "pos_a", "col_b", "pos_b", "r", "rank",
            F.when(size > 0.7, F.when(F.col("r") > 0, "strong_positive").otherwise("strong_negative"))
            .when(size < 0.2, "weak").when(size >= 0.3, "moderate").otherwise("slight").alias("class"),
            (size > 0.95).alias("is_redundant"),
        )

    @cached_property
    def metadata_presence(self) -> DataFrame:
        """Per table, whether each kind of recording metadata has a column."""
        name = F.lower("column")
        return self.tables.columns_frame().groupBy("table").agg(*[
            F.bool_or(name.rlike("|".join(hints))).alias(f"has_{kind}") for kind, hints, _, _ in METADATA_KINDS
        ])

    @cached_property
    def sufficiency(self) -> DataFrame:
        """Rows per numeric column and what that supports."""
        ratio = F.col("n_rows") / F.greatest(F.col("n_numeric"), F.lit(1))
        return self.table_sizes.select(
            "table", "n_rows", "n_numeric", ratio.alias("ratio"),
            F.when(ratio < 5, "underpowered").when(ratio < 20, "adequate").otherwise("well_powered").alias("power"),
            F.when(F.col("n_rows") < 30, "caution").when(F.col("n_rows") > 1000, "robust").alias("size_note"),
        )

    @cached_property
    def sanity(self) -> DataFrame:
        """(table, kind, name, value, n, pct): what to check before an analysis."""
        worst = (
            self.nulls.filter(F.col("n_null") > 0)
            .withColumn("place", F.row_number().over(Window.partitionBy("table").orderBy(F.desc("n_null"), "position")))
            .filter(F.col("place") == 1)
            .select("table", F.lit(1).alias("check"), F.lit("nulls").alias("kind"), "column",
                    F.lit(None).cast("string").alias("value"), F.col("n_null").alias("n"),
                    F.col("pct_null").alias("pct"))
        )
        constant = (
            self.numeric.filter(F.col("min") == F.col("max"))
            .withColumn("place", F.row_number().over(Window.partitionBy("table").orderBy("position")))
            .filter(F.col("place") == 1)
            .select("table", F.lit(2).alias("check"), F.lit("constant").alias("kind"), "column",
                    F.col("min_raw").alias("value"), "n", F.lit(None).cast("double").alias("pct"))
        )
        first_category = self.tables.columns_frame().filter("is_categorical").groupBy("table").agg(
            F.min_by("column", "position").alias("column")
        )
        dominant = (
            self.values.filter(F.col("rank") == 1).join(first_category, ["table", "column"])
            .join(self.summary.select("table", "n_rows"), "table")
            .filter(F.col("n") > 0.8 * F.col("n_rows"))
            .select("table", F.lit(3).alias("check"), F.lit("dominant").alias("kind"), "column", "value", "n",
                    (F.lit(100.0) * F.col("n") / F.col("n_rows")).alias("pct"))
        )
        return union_all([worst, constant, dominant])

    @cached_property
    def highlights(self) -> DataFrame:
        """Per table: top-CV column, strongest pair, stable / variable columns, strong pairs."""
        usable = self.numeric.filter((F.col("cv").isNotNull()) & (F.col("stddev") != 0))
        ordered = F.sort_array(F.collect_list(F.struct((-F.col("cv")).alias("key"), "position", "column", "cv")))
        by_cv = usable.groupBy("table").agg(ordered.alias("by_cv"))
        strongest = self.correlations.groupBy("table").agg(
            F.min_by(F.struct("col_a", "col_b", "r"), "rank").alias("strongest"),
            F.count_if(F.abs("r") > 0.7).alias("n_strong"),
        )
        names = lambda keep: F.slice(
            F.transform(F.filter("by_cv", keep), lambda item: item.getField("column")), 1, 3
        )
        return (
            self.table_sizes.join(by_cv, "table", "left").join(strongest, "table", "left")
            .select(
                "table", "n_rows", "n_numeric",
                F.get("by_cv", F.lit(0))["column"].alias("top_cv_column"), F.get("by_cv", F.lit(0))["cv"].alias("top_cv"),
                names(lambda item: item.getField("cv") < 0.1).alias("stable"),
                names(lambda item: item.getField("cv") > 0.3).alias("variable"),
                F.col("strongest.col_a").alias("col_a"), F.col("strongest.col_b").alias("col_b"),
                F.col("strongest.r").alias("r"), F.coalesce("n_strong", F.lit(0)).alias("n_strong"),
            )
        )
