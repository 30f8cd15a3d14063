"""Cleaning and formatting of text.

Expressions that end up in generated sentences are written as SQL text: helpers
take and return SQL, so that a sentence with dozens of parts is one expression
parsed once. All of it is built-in functions and stays inside generated code.

Number formats follow the C rules (round half to even on the exact binary
value), which ``format_number`` with an explicit pattern implements and
``format_string`` does not.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: whitespace when text is cleaned, Unicode white space and the four
# separator control characters.
WHITESPACE = r"(?U)[\s\x1C-\x1F]"
NOT_WHITESPACE = r"(?U)[^\s\x1C-\x1F]"

NOT_RECORDED = "not recorded"
NOT_AVAILABLE = "N/A"


def clean_text(text: Column) -> Column:
    """Collapse whitespace runs to one space and strip; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, WHITESPACE + "+", " ")), F.lit(""))


def is_blank(text: Column) -> Column:
    return ~text.rlike(NOT_WHITESPACE)


def plain_name(name: str) -> str:
    """A name known on the driver, underscores as spaces."""
    return name.replace("_", " ")


def readable_name(name: str) -> str:
    """Title-cased name known on the driver."""
    return plain_name(name).title()


# ---- SQL text --------------------------------------------------------------------

def sql(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ref(name: str) -> str:
    """A column reference."""
    return "`" + name.replace("`", "``") + "`"


def clean_name(x: str) -> str:
    return f"translate({x}, '_', ' ')"


def fixed(x: str, digits: int) -> str:
    """``%.{digits}f``; zeros stand in beyond the 17 digits a double holds."""
    pattern = "0." + "0" * digits if digits else "0"
    return f"format_number(cast({x} as double), '{pattern}')"


def _exponent_form() -> str:
    """SQL over ``v``: exponent form of a very small or very large number."""
    sci = "format_number(v, '0.00000E0')"
    exponent = f"try_cast(substring_index({sci}, 'E', -1) as int)"
    scaled = f"(v / pow(10D, {exponent} - 5))"
    mantissa = (
        f"if({exponent} >= 6 and abs({scaled} - floor({scaled})) = 0.5D, "
        f"format_number(rint({scaled}) / 100000D, '0.#####'), "
        f"regexp_replace(substring_index({sci}, 'E', 1), '[.]?0+$', ''))"
    )
    return (
        "case when isnan(v) then 'nan' when abs(v) = double('infinity') then if(v > 0, 'inf', '-inf') "
        f"when {exponent} = -4 then format_number(v, '0.####') "
        f"else concat({mantissa}, if({exponent} < 0, 'e-', 'e+'), if(abs({exponent}) < 10, '0', ''), abs({exponent})) end"
    )


EXPONENT_FORM = _exponent_form()


def g6(x: str) -> str:
    """``%.6g``: six significant digits, trailing zeros dropped.

    A value below 10^(k+1) needs at most 5-k decimals and ``#`` drops trailing
    zeros, so the magnitude picks one of ten constant patterns (a constant
    pattern is compiled once per task). Only very small and very large values
    take the exponent form, where an exact tie between two mantissas has to go
    to the even one; as a lambda it stays out of the generated method. Whole numbers
    and those below 100 with at most four decimals are their own six digits, and
    a cast shows them at a fraction of a format's cost.
    """
    x = f"cast({x} as double)"
    plain = " ".join(
        f"when abs({x}) < 1e{power}D then format_number({x}, '0.{'#' * (6 - power)}')" for power in range(-3, 6)
    )
    return (
        f"case when {x} = 0 then format_number({x}, '0') "
        f"when abs({x}) < 999999.5D and {x} = rint({x}) then cast(cast({x} as bigint) as string) "
        f"when abs({x}) >= 1e-3D and abs({x}) < 100D and {x} = rint({x} * 10000D) / 10000D then cast({x} as string) "
        f"when abs({x}) < 1e-4D or abs({x}) >= 999999.5D then element_at(transform(array({x}), v -> {EXPONENT_FORM}), 1) "
        f"{plain} else format_number({x}, '0') end"
    )


def metric_text(x: str) -> str:
    """Model metric: four decimals, or six significant digits when tiny or large."""
    return (
        f"case when {x} is null then {sql(NOT_AVAILABLE)} "
        f"when abs({x}) < 0.01D or abs({x}) > 10000D then {g6(x)} else {fixed(x, 4)} end"
    )


def format_value(x: str, fractional: bool) -> str:
    """A cell as text: binary fractions in six digits, NULL as 'not recorded'."""
    shown = g6(x) if fractional else f"cast({x} as string)"
    return f"coalesce({shown}, {sql(NOT_RECORDED)})"


def yes_no(x: str) -> str:
    return f"case when {x} then 'Yes' when not {x} then 'No' end"


def fill(template: str, /, **values: str) -> str:
    """Fill ``{name}`` places of a fixed text with SQL expressions; NULL if any is NULL."""
    parts = []
    for literal, place, _, _ in Formatter().parse(template):
        if literal:
            parts.append(sql(literal))
        if place is not None:
            parts.append(f"cast({values[place]} as string)")
    return f"concat({', '.join(parts)})"


def optional(condition: str, text: str, otherwise: str = "") -> str:
    """``text`` where the condition holds and the text exists, else a fixed string."""
    return f"coalesce(case when {condition} then {text} end, {sql(otherwise)})"


def ordered(fields: str, where: str | None = None, limit: int | None = None) -> str:
    """Aggregate: structs of ``fields`` collected and sorted, NULL rows left out."""
    item = f"struct({fields})" if where is None else f"case when {where} then struct({fields}) end"
    collected = f"sort_array(collect_list({item}))"
    return collected if limit is None else f"slice({collected}, 1, {limit})"


def joined(items: str, sep: str, text: str = "i.text") -> str:
    """Join ``text`` of each struct ``i`` of an array."""
    return f"array_join(transform({items}, i -> {text}), {sql(sep)})"
