"""Numbers, booleans and ratios from text. Three dialects of numbers differ in what a comma means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.bind import let
from quillon.functions.text import collapse_space

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
NULL_LIKE = ("", "-", "NULL", "N.D.", "N/D", "ND")


def _strict_double(c: Column) -> Column:
    """A double of plain digits; nan, inf and type suffixes are no numbers."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def _to_long(c: Column) -> Column:
    return F.coalesce(F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint")), _strict_double(c).try_cast("bigint"))


def int_safe(c: Column) -> Column:
    """Every comma goes; decimals are cut towards zero; junk is null."""
    return let(F.replace(collapse_space(c.cast("string")), F.lit(","), F.lit("")), _to_long)


def _count(c: Column, sign: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))


def _without(c: Column, sign: str) -> Column:
    return F.replace(c, F.lit(sign), F.lit(""))


def _last_is_decimal(t: Column) -> Column:
    """A number that holds both separators, with the last one as its point."""
    comma_last = F.instr(F.reverse(t), ",") < F.instr(F.reverse(t), ".")
    return F.when(comma_last, F.replace(_without(t, "."), F.lit(","), F.lit("."))).otherwise(_without(t, ","))


def numeric_safe(c: Column) -> Column:
    """`$`, `%` and blanks go. With both separators the last is the decimal one; a repeated one must
    group by threes; a single one before exactly three digits is ambiguous and null."""

    def plain(t: Column) -> Column:
        commas, dots = F.contains(t, F.lit(",")), F.contains(t, F.lit("."))
        several = lambda s: F.when(t.rlike(rf"^[+-]?\d{{1,3}}(\{s}\d{{3}})+$"), _without(t, s))
        return (
            F.when(commas & dots, _last_is_decimal(t))
            .when(~commas & ~dots, t)
            .when(_count(t, ",") > 1, several(","))
            .when(_count(t, ".") > 1, several("."))
            .when(t.rlike(r"^[+-]?\d+[.,]\d{3}$"), F.lit(None))
            .otherwise(F.replace(t, F.lit(","), F.lit(".")))
        )

    return let(let(F.regexp_replace(c.cast("string"), r"(?U)[\s$%]", ""), plain), _strict_double)


def bool_safe(c: Column) -> Column:
    t = F.lower(collapse_space(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y", "si", "sí", "s"), True).when(t.isin("false", "0", "no", "n"), False)


def budget_int(c: Column) -> Column:
    """No comma is dropped."""
    return let(collapse_space(c.cast("string")), _to_long)


def budget_numeric(c: Column) -> Column:
    """`-` is null; with both separators the last is the decimal one; one comma before one or two
    digits is decimal, any other is for thousands."""

    def plain(t: Column) -> Column:
        commas = F.contains(t, F.lit(","))
        return (
            F.when(t.isin("", "-"), F.lit(None))
            .when(~commas, t)
            .when(F.contains(t, F.lit(".")), _last_is_decimal(t))
            .when(t.rlike(r"^[^,]*,[^,]{1,2}$"), F.replace(t, F.lit(","), F.lit(".")))
            .otherwise(_without(t, ","))
        )

    return let(let(F.regexp_replace(c.cast("string"), r"(?U)[\s%]", ""), plain), _strict_double)


budget_percent = budget_numeric


def is_null_like(c: Column) -> Column:
    return F.coalesce(F.upper(collapse_space(c.cast("string"))), F.lit("")).isin(*NULL_LIKE)


def report_int(c: Column, zero_dash: bool = False) -> Column:
    """Null-like marks are null; a dash is 0 if asked."""
    number = lambda t: F.when(t == "-", F.lit(0 if zero_dash else None).cast("bigint")).when(~is_null_like(t), int_safe(t))
    return let(collapse_space(c.cast("string")), number)


def report_numeric(c: Column) -> Column:
    return let(collapse_space(c.cast("string")), lambda t: F.when(~is_null_like(t), numeric_safe(t)))


report_percent = report_numeric


def portal_number(c: Column) -> Column:
    """Blank and `-` are 0."""
    return F.coalesce(_strict_double(F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "")), F.lit(0.0))


def enrollment_number(c: Column) -> Column:
    """Digits and minus only; blank and dashes are 0."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"[^0-9\-]", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def ratio9(n: Column, d: Column) -> Column:
    """n / d at nine decimals, half up; null if d is 0 or null."""
    return F.round(F.try_divide(n.cast("decimal(20,0)"), F.nullif(d.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))), 9)


def safe_divide(n: Column, d: Column) -> Column:
    return F.try_divide(n.cast("double"), d.cast("double"))


def share_percent(c: Column) -> Column:
    """A share given as a ratio in [0, 1] or as a percentage, as a percentage."""
    return F.when((c >= 0) & (c <= 1), c * 100).otherwise(c)


def ratio_of_percent(c: Column) -> Column:
    return F.when(c > 1, c / 100).otherwise(c)


def at_least_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0).cast("bigint"))


# --- classes of values, for type suggestions ---------------------------------------------------


def value_class(c: Column) -> Column:
    """EMPTY, BOOLEAN, INTEGER, NUMERIC, DATE, TIMESTAMP or TEXT."""
    t = collapse_space(c.cast("string"))
    date = r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})"
    return (
        F.when(F.coalesce(t, F.lit("")) == "", "EMPTY")
        .when(F.lower(t).isin("true", "false", "si", "sí", "no", "yes"), "BOOLEAN")
        .when(t.rlike(r"^[+-]?\d+$"), "INTEGER")
        .when(t.rlike(r"^[+-]?\d{1,3}([.,]\d{3})*([.,]\d+)?$|^[+-]?\d+[.,]\d+$"), "NUMERIC")
        .when(t.rlike(date + r"[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?"), "TIMESTAMP")
        .when(t.rlike(date + "$"), "DATE")
        .otherwise("TEXT")
    )
