"""Rows, tables and schemas as text."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.functions.text import clean_name, fill, g6, joined, ordered, plain_name, readable_name, ref, sql, yes_no
from tabulore.operators.profile import Profile
from tabulore.operators.ranking import number_rows
from tabulore.operators.relate import shared_columns
from tabulore.plans.templates import PASSAGES
from tabulore.session import cut_lineage
from tabulore.sources.tables import ColumnRole, has_hint, literal_rows, union_all

# Hints that make a string column an identification field.
IDENTIFICATION_HINTS = ("id", "name", "code", "key", "sample")
ROWS_PER_PASSAGE = 5
PIECE_BYTES = 1 << 20  # of text gathered into passages at a time
MOVED_AS_THEY_ARE = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _group_of(role: ColumnRole) -> str:
    if role.is_numeric:
        return "measurements"
    if role.is_string and has_hint(role.name, IDENTIFICATION_HINTS):
        return "identification"
    return "properties"


def row_text(table: str, roles: Sequence[ColumnRole], cell: Callable[[ColumnRole], str] = lambda role: ref(role.name)) -> str:
    """SQL: one row as a sentence; NULL cells and empty groups are left out. ``cell`` names the column of a role."""
    groups: dict[str, list[str]] = {"identification": [], "measurements": [], "properties": []}
    for role in roles:
        if role.role != "nested":
            x = cell(role)
            shown = g6(x) if role.is_fractional else yes_no(x) if role.is_boolean else x
            groups[_group_of(role)].append(fill(PASSAGES["field"], name=sql(plain_name(role.name)), value=shown))
    parts = [sql(PASSAGES["record"].format(readable=readable_name(table), table=table))]
    for group, fields in groups.items():
        if fields:
            parts.append(fill(PASSAGES[group], fields=f"nullif(concat_ws('; ', {', '.join(fields)}), '')"))
    return f"concat_ws(' ', {', '.join(parts)})"


def row_to_text(df: DataFrame, table: str, roles: Sequence[ColumnRole], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.expr(row_text(table, roles)).alias("text"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut where more than ``PIECE_BYTES`` of text would come together; a batch is let go before the next is read."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64))
        at, seen = 0, 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, seen + PIECE_BYTES, "right")))
            yield batch.slice(at, end - at)
            at, seen = end, int(upto[end - 1])
        del batch


def closed_groups(lines: DataFrame, size: int, n_rows: int, written: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(closed, open): groups of ``size`` consecutive rows of ``lines`` (row, text), rows numbered from 1.

    Runs of consecutive rows are gathered where they stand. A run that is a whole group is closed: (passage_id, lines).
    Of the others, at the borders of files and tasks, the rows are returned as they are: (passage_id, row, text). Besides
    the batch that came, a task holds copies of some ``PIECE_BYTES`` of text. What is gathered is stored, as both results
    come from it and have to see the same borders; with ``written``, SQL over ``lines``, closed is (passage_id, written).
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(_pieces(batches), [None]):
            table = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks() if rest is not None or batch is not None else None
            if table is None or not table.num_rows:
                continue
            row, text = table["row"].to_numpy(), table["text"].combine_chunks()
            group = (row - 1) // size
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 1) | (np.diff(group) != 0), [True]]))
            if batch is not None:  # the last run may go on in the next batch
                rest = table.slice(cuts[-2]).to_batches()[0]
                cuts = cuts[:-1]
            if len(cuts) < 2:
                continue
            first, length = cuts[:-1], np.diff(cuts)
            whole = length == np.minimum(size, n_rows - group[first] * size)
            inside = np.repeat(whole, length)
            taken = text.take(pa.array(np.flatnonzero(inside)))
            offsets = np.concatenate([[0], np.cumsum(length[whole])]).astype(np.int32)
            nothing = pa.nulls(int(whole.sum()), pa.int64()), pa.nulls(int(whole.sum()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[first[whole]]), pa.ListArray.from_arrays(pa.array(offsets), taken), *nothing], names=names)
            apart = np.flatnonzero(~inside)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[apart]), pa.nulls(len(apart), pa.list_(pa.string())), pa.array(row[apart]), text.take(pa.array(apart))], names=names)

    names = ["passage_id", "lines", "row", "text"]
    found = lines.select("row", "text").mapInArrow(gather, "passage_id long, lines array<string>, row long, text string")
    whole = "lines" if written is None else "written"
    found = cut_lineage(found.selectExpr("passage_id", f"{written or 'lines'} as {whole}", "row", "text"))
    return found.where("row is null").select("passage_id", whole), found.where("row is not null").select("passage_id", "row", "text")


def build_passages(
    df: DataFrame, table: str, roles: Sequence[ColumnRole], n_rows: int,
    order_by: Sequence[str] = (), rows_per_passage: int = ROWS_PER_PASSAGE,
) -> DataFrame:
    """(table, passage_id, text): consecutive rows in groups of ``rows_per_passage``.

    The cells are numbered and moved, once; sentences are written where the numbered rows stand, since numbering in an
    order passes over its rows twice. Passages are closed inside the range partitions, and only the rows of the open ones
    at the borders travel again.
    """
    shown = [r for r in roles if r.role != "nested"]
    place = lambda role: f"_cell{role.position}"
    cells = [
        (F.col(ref(r.name)) if isinstance(r.data_type, MOVED_AS_THEY_ARE) else F.col(ref(r.name)).cast("string")).alias(place(r))
        for r in shown
    ]
    moved = {r.name: place(r) for r in shown if isinstance(r.data_type, MOVED_AS_THEY_ARE)}
    apart_keys = {c: f"_key{i}" for i, c in enumerate(order_by) if c not in moved}
    keys = [moved.get(c) or apart_keys[c] for c in order_by]
    numbered = number_rows(df.select(*[F.col(c).alias(k) for c, k in apart_keys.items()], *cells), keys, "_row")
    lines = numbered.select(F.col("_row").alias("row"), F.expr(row_text(table, roles, place)).alias("text"))
    passage = fill(
        PASSAGES["passage"], readable=sql(readable_name(table)), table=sql(table), name=sql(plain_name(table)),
        rows="array_join(lines, '\n')", n_rows=str(n_rows), n_cols=str(len(roles)),
    )
    closed, apart = closed_groups(lines, rows_per_passage, n_rows, passage)
    apart = apart.groupBy("passage_id").agg(F.expr(f"transform({ordered('row, text')}, i -> i.text)").alias("lines"))
    apart = apart.selectExpr("passage_id", f"{passage} as written")
    return closed.unionByName(apart).select(F.lit(table).alias("table"), "passage_id", F.col("written").alias("text"))


def readable_tables(profile: Profile) -> DataFrame:
    """(table, readable): display names, computed from metadata."""
    rows = [(name, readable_name(name)) for name in profile.tables.names]
    return literal_rows(profile.tables.spark, rows, "table string, readable string")


def table_overviews(profile: Profile) -> DataFrame:
    """(table, text): what a table holds."""
    names = lambda flag: (
        f"coalesce(nullif({joined(ordered('position, column as text', flag), ', ')}, ''), 'None')"
    )
    described = profile.tables.columns_frame().groupBy("table").agg(
        F.expr(joined(ordered("position, concat(column, ' (', data_type, ')') as text"), ", ")).alias("columns"),
        F.expr(names("is_numeric")).alias("numeric"),
        F.expr(names("is_string")).alias("strings"),
    )
    text = fill(
        PASSAGES["table_overview"], table="table", readable="readable", n_rows="n_rows", n_cols="n_cols",
        columns="columns", numeric="numeric", text="strings",
    )
    return profile.table_sizes.join(described, "table").join(readable_tables(profile), "table").selectExpr(
        "table", f"{text} as text"
    )


def shared_text(profile: Profile, template: str, sep: str, clean: bool) -> DataFrame:
    """One row: all shared columns joined into one text (NULL when there are none)."""
    shared = shared_columns(profile.tables.columns_frame())
    name = clean_name("column") if clean else "column"
    entry = fill(template, name=name, column=name, tables="array_join(tables, ', ')")
    return shared.agg(F.expr(f"nullif({joined(ordered(f'first_seen, {entry} as text'), sep)}, '')").alias("shared"))


def schema_overview(profile: Profile) -> DataFrame:
    """(text): one overview of the whole schema."""
    line = fill(PASSAGES["schema_table"], readable="readable", table="table", n_rows="n_rows", n_cols="n_cols")
    totals = profile.table_sizes.join(readable_tables(profile), "table").agg(
        F.expr("count(1)").alias("n_tables"), F.sum("n_rows").alias("n_rows"),
        F.expr(joined(ordered(f"table_position, {line} as text"), "")).alias("tables"),
    )
    shared = shared_text(profile, PASSAGES["schema_shared"], "", clean=False).scalar()
    text = fill(
        PASSAGES["schema_overview"], full_schema=sql(profile.tables.full_schema_name), n_tables="n_tables",
        n_rows="n_rows", tables="tables", shared=f"coalesce({sql(PASSAGES['schema_shared_head'])} || shared, '')",
    )
    return totals.withColumn("shared", shared).selectExpr(f"{text} as text")


def build_corpus(profile: Profile, order_by: dict[str, Sequence[str]] | None = None,
                 rows_per_passage: int = ROWS_PER_PASSAGE) -> DataFrame:
    """(kind, table, passage_id, text): schema overview, table overviews and all passages."""
    order_by = order_by or {}
    sizes = profile.tables.row_counts()
    parts = [
        schema_overview(profile).selectExpr("'schema' as kind", "'' as table", "cast(null as bigint) as passage_id", "text"),
        table_overviews(profile).selectExpr("'table' as kind", "table", "cast(null as bigint) as passage_id", "text"),
    ]
    for name in profile.tables.names:
        passages = build_passages(
            profile.tables.tables[name], name, profile.tables.roles[name], sizes[name],
            order_by.get(name, ()), rows_per_passage,
        )
        parts.append(passages.selectExpr("'passage' as kind", "table", "passage_id", "text"))
    return union_all(parts).filter("trim(text) != ''")
