"""Table sets: discovery, scans, column roles and text columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.functions.text import is_blank, ref, sql

# Name hints and preferred text column names.
ID_ONLY_HINTS = ("id", "key")
ID_TOO_HINTS = ("name", "code", "sample")
TEXT_COLUMN_NAMES = ("text", "content", "text_content", "body", "document", "doc_text")

NUMERIC, CATEGORICAL, IDENTIFIER, NESTED = "numeric", "categorical", "identifier", "nested"


def has_hint(name: str, hints: Iterable[str], whole_words: bool = False) -> bool:
    lowered = name.lower()
    if whole_words:
        return bool(set(lowered.replace("-", "_").split("_")) & set(hints))
    return any(hint in lowered for hint in hints)


@dataclass(frozen=True)
class ColumnRole:
    """What a column is used for; decided from its type and name only."""

    name: str
    position: int
    data_type: T.DataType
    role: str
    is_id: bool

    @property
    def is_numeric(self) -> bool:
        return self.role == NUMERIC

    @property
    def is_categorical(self) -> bool:
        return self.role == CATEGORICAL

    @property
    def is_fractional(self) -> bool:
        return isinstance(self.data_type, T.FractionalType) and not isinstance(self.data_type, T.DecimalType)

    @property
    def is_string(self) -> bool:
        return isinstance(self.data_type, T.StringType)

    @property
    def is_boolean(self) -> bool:
        return isinstance(self.data_type, T.BooleanType)

    @property
    def shown_sql(self) -> str:
        """SQL: the cell as displayed text (booleans capitalised)."""
        text = f"cast({ref(self.name)} as string)"
        return f"initcap({text})" if self.is_boolean else text


def classify(schema: T.StructType, whole_words: bool = False) -> list[ColumnRole]:
    """Assign a role to every column of a schema."""
    roles = []
    for position, column in enumerate(schema.fields):
        kind, is_id = CATEGORICAL, False
        if isinstance(column.dataType, T.NumericType):
            kind = NUMERIC
        elif isinstance(column.dataType, (T.StringType, T.CharType, T.VarcharType)):
            if has_hint(column.name, ID_ONLY_HINTS, whole_words):
                kind, is_id = IDENTIFIER, True
            else:
                is_id = has_hint(column.name, ID_TOO_HINTS, whole_words)
        elif isinstance(
            column.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)
        ):
            kind = NESTED
        roles.append(ColumnRole(column.name, position, column.dataType, kind, is_id))
    return roles


@dataclass
class TableSet:
    """Named tables of one schema, in a fixed order."""

    spark: SparkSession
    tables: Mapping[str, DataFrame]
    schema_name: str = "schema"
    catalog_name: str = ""
    whole_word_hints: bool = False
    known_sizes: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_directory(
        cls, spark: SparkSession, path: str, names: Sequence[str] | None = None,
        exclude: Sequence[str] = (), **kwargs,
    ) -> TableSet:
        """One table per ``<name>.parquet`` under ``path``."""
        found = list(names) if names is not None else list_parquet(spark, path)
        tables = {
            name: spark.read.parquet(f"{path}/{name}.parquet") for name in found if name not in set(exclude)
        }
        return cls(spark, tables, **kwargs)

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, database: str, exclude: Sequence[str] = (), **kwargs
    ) -> TableSet:
        """Every table of a catalog schema except the named output tables and temporary views."""
        names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.name not in set(exclude)]
        kwargs.setdefault("schema_name", database.split(".")[-1])
        return cls(spark, {name: read_table(spark, f"{database}.{name}") for name in names}, **kwargs)

    @property
    def full_schema_name(self) -> str:
        return f"{self.catalog_name}.{self.schema_name}" if self.catalog_name else self.schema_name

    @property
    def names(self) -> list[str]:
        return list(self.tables)

    @cached_property
    def roles(self) -> dict[str, list[ColumnRole]]:
        return {name: classify(df.schema, self.whole_word_hints) for name, df in self.tables.items()}

    def subset(self, names: Sequence[str]) -> TableSet:
        return TableSet(
            self.spark, {name: self.tables[name] for name in names}, self.schema_name, self.catalog_name,
            self.whole_word_hints, self.known_sizes,
        )

    def row_counts(self) -> dict[str, int]:
        """Row count per table: one number each, from one job over all tables."""
        missing = [name for name in self.names if name not in self.known_sizes]
        if missing:
            counts = union_all(
                self.tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
                for name in missing
            )
            self.known_sizes.update({row["table"]: row["n"] for row in counts.collect()})
        return {name: self.known_sizes[name] for name in self.names}

    def columns_frame(self) -> DataFrame:
        """Metadata of every column: one row per (table, column)."""
        rows = [
            (
                name, index, role.position, role.name, str(role.data_type), role.is_numeric,
                role.is_categorical, role.is_id, role.is_string,
            )
            for index, name in enumerate(self.names)
            for role in self.roles[name]
        ]
        schema = (
            "table string, table_position int, position int, column string, data_type string, "
            "is_numeric boolean, is_categorical boolean, is_id boolean, is_string boolean"
        )
        return literal_rows(self.spark, rows, schema)


def list_parquet(spark: SparkSession, path: str) -> list[str]:
    """Names of ``*.parquet`` entries of a directory on any file system Spark can reach."""
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    entries = [status.getPath().getName() for status in fs.listStatus(location)]
    return sorted(name[: -len(".parquet")] for name in entries if name.endswith(".parquet"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Metadata rows as an inline table, which the optimizer sees as a local relation."""
    fields = T.StructType.fromDDL(schema).fields

    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, str):
            return sql(value)
        return f"double('{value!r}')" if isinstance(value, float) else str(value).lower()

    types = [f.dataType.simpleString() for f in fields]
    if not rows:
        nothing = ", ".join(f"cast(null as {t}) as {ref(f.name)}" for f, t in zip(fields, types))
        return spark.sql(f"select {nothing} where false")
    names = ", ".join(ref(f.name) for f in fields)
    lines = ", ".join(
        "(" + ", ".join(f"cast({literal(v)} as {t})" for v, t in zip(row, types)) + ")" for row in rows
    )
    return spark.sql(f"select * from values {lines} as t({names})")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def find_text_column(schema: T.StructType, preferred: str = "text") -> str | None:
    """Preferred name, then the usual names, then the first string column."""
    names = schema.fieldNames()
    for candidate in (preferred, *TEXT_COLUMN_NAMES):
        if candidate in names:
            return candidate
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return strings[0] if strings else None


def load_schema_text(tables: TableSet, preferred: str = "text") -> DataFrame:
    """(table, text) over every table that has a text column, blanks dropped."""
    parts = []
    for name, df in tables.tables.items():
        column = find_text_column(df.schema, preferred)
        if column is not None:
            text = df.select(F.lit(name).alias("table"), F.col(column).cast("string").alias("text"))
            parts.append(text.filter(F.col("text").isNotNull() & ~is_blank(F.col("text"))))
    if not parts:
        raise ValueError(f"no text column in any table of {tables.full_schema_name}")
    return union_all(parts)


def extract_text(df: DataFrame, text_column: str, limit: int | None = None,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """Project one text column; the limit applies before NULL and '' are skipped."""
    if limit is not None:
        df = (df.orderBy(*order_by) if order_by else df).limit(limit)
    text = F.col(text_column)
    return df.filter(text.isNotNull() & (text != "")).select(text.alias("text"))
