"""Map and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulore.functions.text import sql


def sorted_entries(mapping: str, limit: int | None = None) -> str:
    """SQL: entries of a map sorted by key, optionally only the first few."""
    entries = f"array_sort(map_entries({mapping}))"
    return entries if limit is None else f"slice({entries}, 1, {limit})"


def entries_text(mapping: str, value: str = "e.value", sep: str = "; ", limit: int | None = None) -> str:
    """SQL: ``k: v; k: v`` over sorted entries ``e``; entries with NULL values are left out."""
    kept = f"filter({sorted_entries(mapping, limit)}, e -> e.value is not null)"
    return f"array_join(transform({kept}, e -> concat(e.key, ': ', {value})), {sql(sep)})"


def head_map(mapping: Column, limit: int) -> Column:
    """The first few entries of a map by key."""
    return F.map_from_entries(F.slice(F.array_sort(F.map_entries(mapping)), 1, limit))


def user_tags(tags: Column, system_prefix: str = "mlflow.") -> Column:
    """Drop the tags a tracking system writes on its own."""
    return F.map_filter(tags, lambda key, _: ~key.startswith(system_prefix))


def merge_tags(model_tags: Column, run_tags: Column) -> Column:
    """Run tags win over model tags."""
    empty = F.create_map().cast("map<string,string>")
    base = F.coalesce(model_tags, empty)
    over = F.coalesce(run_tags, empty)
    kept = F.map_filter(base, lambda key, _: ~F.map_contains_key(over, key))
    return F.map_concat(kept, over)


def names_seed(params: Column) -> Column:
    """Whether any parameter name mentions a seed."""
    return F.exists(F.map_keys(params), lambda key: F.lower(key).rlike("seed|random"))


def lenient_json(text: Column) -> Column:
    """Parse JSON, JSON wrapped in a JSON string, or single-quoted literals, as VARIANT.

    Text that is none of these comes back as a VARIANT string.
    """
    plain = F.try_parse_json(text)
    unwrapped = F.try_parse_json(F.try_variant_get(plain, "$", "string"))
    is_text = F.schema_of_variant(plain) == F.lit("STRING")
    repaired = F.try_parse_json(F.replace(text, F.lit("'"), F.lit('"')))
    raw = F.variant_get(F.try_parse_json(F.to_json(F.struct(text.alias("raw")))), "$.raw", "variant")
    return F.coalesce(F.when(is_text, unwrapped), plain, repaired, raw)
