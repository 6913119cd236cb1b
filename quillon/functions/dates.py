"""Dates and period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import collapse_space, strip_accents

MONTHS = ("ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SETIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE")
#: Other spellings of months.
MONTH_ALIASES = {"SEPTIEMBRE": 9}
ROMAN = ("I", "II", "III", "IV")


def snapshot_date(c: Column) -> Column:
    """`dd/MM/yyyy` with or without a time; anything else is null."""
    t = collapse_space(c)
    day = F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}( \d{2}:\d{2}:\d{2})?$"), F.substring(t, 1, 10))
    return F.try_to_date(day, "dd/MM/yyyy")


def month_start(year: Column, month: Column) -> Column:
    return F.when(month.between(1, 12), F.make_date(year, F.coalesce(month, F.lit(1)), F.lit(1)))


def year_token(c: Column) -> Column:
    """The first 19xx or 20xx of a label."""
    return F.nullif(F.regexp_extract(c, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")


def is_preliminary(c: Column) -> Column:
    return F.contains(c, F.lit("(*)")) | F.lower(c).contains("preliminar")


def period(label: Column, year: Column) -> Column:
    """(kind, value, quarter, month, month_name) of a Spanish period label; without a period it is ANUAL."""
    t = F.upper(strip_accents(collapse_space(label)))
    months = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i))], *[x for m, i in MONTH_ALIASES.items() for x in (F.lit(m), F.lit(i))])
    word = F.regexp_extract(t, r"\b(" + "|".join((*MONTHS, *MONTH_ALIASES)) + r")\b", 1)
    month = F.when(word != "", F.element_at(months, word))
    digit = F.coalesce(F.nullif(F.regexp_extract(t, r"TRIMESTRE\s+([1-4])\b", 1), F.lit("")), F.nullif(F.regexp_extract(t, r"\b([1-4])\s*(?:ER|DO|RO|TO)?\.?\s*TRIM", 1), F.lit(""))).cast("int")
    roman = F.coalesce(F.nullif(F.regexp_extract(t, r"\b(IV|I{1,3})\s+TRIM", 1), F.lit("")), F.nullif(F.regexp_extract(t, r"TRIMESTRE\s+(IV|I{1,3})\b", 1), F.lit("")))
    quarter = F.coalesce(digit, F.nullif(F.array_position(F.array(*map(F.lit, ROMAN)), roman), F.lit(0)).cast("int"))
    kind = F.when(month.isNotNull(), "MENSUAL").when(quarter.isNotNull(), "TRIMESTRAL").otherwise("ANUAL")
    value = F.when(month.isNotNull(), F.format_string("%d-%02d", year, month)).when(quarter.isNotNull(), F.format_string("%d-Q%d", year, quarter)).otherwise(year.cast("string"))
    name = F.when(month.isNotNull(), F.element_at(F.array(*map(F.lit, MONTHS)), F.coalesce(month, F.lit(1))))
    return F.struct(kind.alias("kind"), value.alias("value"), F.coalesce(quarter, F.ceil(month / 3).cast("int")).alias("quarter"), month.alias("month"), name.alias("month_name"))


def duration_seconds(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1e6, 6)
