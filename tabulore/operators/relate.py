"""Relations between tables: shared columns, value overlap, gain of a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.functions.text import ref
from tabulore.session import cut_lineage
from tabulore.sources.tables import TableSet, literal_rows, union_all

SLOTS = 4096  # hash slots of a column's sketch
PLANNED = 64  # tables in one plan


def shared_columns(columns: DataFrame) -> DataFrame:
    """(column, column_order, tables[]) for names that occur in several tables."""
    first_seen = F.min(F.struct("table_position", "position"))
    return (
        columns.groupBy("column")
        .agg(
            F.transform(
                F.sort_array(F.collect_set(F.struct("table_position", "table"))), lambda t: t.getField("table")
            ).alias("tables"),
            first_seen.alias("first_seen"),
        )
        .filter(F.size("tables") > 1)
        .select("column", "first_seen", "tables")
    )


def _common_type(types: list[T.DataType]) -> str:
    """Type in which the values of a shared column are compared."""
    if all(isinstance(t, T.IntegralType) for t in types):
        return "bigint"
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        # A double would make neighbouring keys equal beyond 2**53.
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        return f"decimal(38,{scale})"
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in types) and len(set(types)) > 1:
        return "timestamp_ntz"
    if all(isinstance(t, T.NumericType) for t in types):
        return "double"
    return "string"


def _shared_holders(tables: TableSet) -> dict[str, list[str]]:
    """Columns that several tables have, with the tables, in order of first appearance."""
    holders: dict[str, list[str]] = {}
    for name in tables.names:
        for role in tables.roles[name]:
            if role.role != "nested":
                holders.setdefault(role.name, []).append(name)
    return {column: names for column, names in holders.items() if len(names) > 1}


def _keys(tables: TableSet, shared: dict[str, list[str]], wanted: set[tuple[str, str]] | None = None) -> list[DataFrame]:
    """One frame a table: (column, value, held_by) of the cells of its shared columns, NULLs left out.

    All shared columns of a table come from one projection of it, so the plan has a branch a table and not a cell.
    """
    common = {
        column: _common_type([tables.tables[name].schema[column].dataType for name in names]) for column, names in shared.items()
    }
    number = {column: n for n, column in enumerate(shared)}
    cells: dict[str, list[str]] = {}
    for column, names in shared.items():
        value = f"cast(cast({ref(column)} as {common[column]}) as string)"
        # Long texts travel as a digest: only equality matters here.
        key = f"md5({value})" if common[column] == "string" else value
        for name in names:
            if wanted is None or (column, name) in wanted:
                cells.setdefault(name, []).append(f"named_struct('column', {number[column]}, 'value', {key})")
    position = {name: index for index, name in enumerate(tables.names)}
    return [
        tables.tables[name].selectExpr(f"inline(array({', '.join(exprs)}))").where("value is not null")
        .withColumn("held_by", F.lit(position[name]))
        for name, exprs in cells.items()
    ]


def _blocks(frames: list[DataFrame], reduce_block: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """``reduce_block`` of the union of every ``PLANNED`` frames; several blocks are stored one by one, so no plan holds them all."""
    blocks = [reduce_block(union_all(frames[i : i + PLANNED])) for i in range(0, len(frames), PLANNED)]
    if not blocks:
        return None
    return blocks[0] if len(blocks) == 1 else union_all(cut_lineage(b) for b in blocks)


def hopeful_holders(tables: TableSet) -> set[tuple[str, str]]:
    """(column, table) pairs that may have a value in common with another table.

    Each column of a table is sketched as the set of the ``SLOTS`` hash slots its values fall into; sketches merge by
    union. Columns without a slot in common have no value in common, so what is left out here cannot overlap. The
    driver gets names only.
    """
    shared = _shared_holders(tables)
    slots = lambda df: df.select("column", F.pmod(F.xxhash64("value"), F.lit(SLOTS)).alias("slot"), "held_by").distinct()
    sketch = _blocks(_keys(tables, shared), slots)
    if sketch is None:
        return set()
    met = sketch.groupBy("column", "slot").agg(F.collect_set("held_by").alias("held_by")).where(F.size("held_by") > 1)
    found = met.select("column", F.explode("held_by").alias("held_by")).distinct().collect()
    columns = list(shared)
    return {(columns[r["column"]], tables.names[r["held_by"]]) for r in found}


def column_overlap(tables: TableSet, skip_hopeless: bool = False) -> DataFrame:
    """Distinct values of each shared column per table pair, and how many are common.

    A value is reduced to the set of tables that hold it, and equal sets are counted. Pairs are formed from those
    counted sets, never from rows and never from all tables: only pairs with a common value appear. With
    ``skip_hopeless`` one more scan sketches the columns and finds those that cannot overlap with any other, which are
    then not counted; it pays where most shared names are chance. NULL is not a value.
    """
    schema = (
        "column string, table_a string, table_b string, n_a bigint, n_b bigint, n_overlap bigint, "
        "pct_of_smaller double"
    )
    shared = _shared_holders(tables)
    wanted = hopeful_holders(tables) if skip_hopeless and shared else None
    cells = _keys(tables, shared, wanted)
    if not cells:
        return literal_rows(tables.spark, [], schema)
    # The tables that hold a value are the bits of whole numbers, 64 tables in each, so a cell is moved once.
    held = _blocks(cells, lambda df: df.groupBy("column", "value", F.expr("held_by div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, held_by % 64))").alias("bits")))
    word = F.struct("word", "bits")
    if len(tables.names) > 64 or len(cells) > PLANNED:
        held = held.groupBy("column", "value").agg(F.sort_array(F.collect_list(word)).alias("held"))
    else:
        held = held.select("column", F.array(word).alias("held"))
    positions = "flatten(transform(held, w -> transform(filter(sequence(0, 63), i -> getbit(w.bits, i) = 1), i -> cast(w.word * 64 + i as int))))"
    # Few rows, and read three times below.
    sets = cut_lineage(
        held.groupBy("column", "held").agg(F.count(F.lit(1)).alias("n")).select("column", F.expr(f"array_sort({positions})").alias("held_by"), "n")
    )
    sizes = sets.select("column", F.explode("held_by").alias("held_by"), "n").groupBy("column", "held_by").agg(F.sum("n").alias("size"))
    with_later = F.transform("held_by", lambda a, i: F.struct(a.alias("a"), F.slice("held_by", i + 2, F.size("held_by")).alias("later")))
    pairs = sets.where(F.size("held_by") > 1).select("column", "n", F.explode(with_later).alias("p"))
    pairs = pairs.select("column", "n", F.col("p.a").alias("a"), F.explode("p.later").alias("b"))
    counted = pairs.groupBy("column", "a", "b").agg(F.sum("n").alias("n_overlap"))

    def side(key: str) -> DataFrame:
        return sizes.select("column", F.col("held_by").alias(key), F.col("size").alias(f"n_{key}"))

    named = counted.join(side("a"), ["column", "a"]).join(side("b"), ["column", "b"])
    columns, names = F.lit(list(shared)), F.lit(list(tables.names))
    return named.select(
        F.get(columns, F.col("column")).alias("column"), F.get(names, F.col("a")).alias("table_a"), F.get(names, F.col("b")).alias("table_b"),
        "n_a", "n_b", "n_overlap", (F.lit(100.0) * F.col("n_overlap") / F.least("n_a", "n_b")).alias("pct_of_smaller"),
    )


def join_gain(columns: DataFrame, overlap: DataFrame) -> DataFrame:
    """Numeric columns each table of a related pair adds to the other."""
    numeric = columns.filter("is_numeric").select("table", "column", "position")
    names = columns.select(F.col("table").alias("other"), F.col("column").alias("other_column"))
    pairs = overlap.select("column", "table_a", "table_b")

    def added(this: str, other: str, alias: str) -> DataFrame:
        wide = pairs.select("column", "table_a", "table_b").join(
            numeric.select(F.col("table").alias(this), F.col("column").alias("gain"), "position"), this
        )
        new = wide.join(
            names, (F.col(other) == F.col("other")) & (F.col("gain") == F.col("other_column")), "left_anti"
        )
        return new.groupBy("column", "table_a", "table_b").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("position", "gain"))), lambda g: g.getField("gain")).alias(alias)
        )

    key = ["column", "table_a", "table_b"]
    empty = F.expr("cast(array() as array<string>)")
    return (
        pairs.join(added("table_a", "table_b", "gain_a"), key, "left")
        .join(added("table_b", "table_a", "gain_b"), key, "left")
        .select(*key, F.coalesce("gain_a", empty).alias("gain_a"), F.coalesce("gain_b", empty).alias("gain_b"))
    )
