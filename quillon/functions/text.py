"""Cleaning, matching keys and issue codes for dirty text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.bind import let

#: White space as Unicode knows it, no-break spaces included.
SPACE = r"(?U)\s+"
CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
ASCII_PUNCTUATION = r"""[!-/:-@\[-`{-~]"""
# Symbols that are suspicious in names, and those that make spellings vary.
SUSPICIOUS = r"[@#$%^*_=+~`|\\<>\[\]{}]"
PUNCTUATION_VARIANT = r"[-/()]"
# Signs of a wrong decoding.
MOJIBAKE_MARKERS = ("Ã", "Â", "â", "ð", "Ð", "\ufffd")
# What stands in territorial columns in place of a territory, as matching keys.
TOTAL_KEYS = ("TOTAL", "TOTAL GENERAL", "SUBTOTAL", "TODOS", "TODAS", "NACIONAL", "PERU", "PAIS", "EXTRANJERO", "NO ESPECIFICADO", "SIN INFORMACION")
NATIONAL_KEYS = ("NACIONAL", "PERU", "PAIS", "TOTAL GENERAL")
EXCLUDED_KEYS = ("TOTAL", "SUBTOTAL", "TODOS", "TODAS")
AGGREGATE_KEYS = ("TOTAL", "TOTAL GENERAL", "SUBTOTAL")
# Territorial columns; where a child is a total beside a parent, the row is an aggregate.
PARENT_COLUMNS = ("region", "departamento", "region_postulacion", "departamento_postulacion")
CHILD_COLUMNS = ("provincia", "distrito", "provincia_postulacion", "distrito_postulacion")
TERRITORIAL_COLUMNS = (*PARENT_COLUMNS, *CHILD_COLUMNS, "ubigeo", "codigo_ubigeo")

#: What Windows-1252 shows for the bytes 80 to 9F that it defines.
_CP1252 = {bytes([b]).decode("cp1252"): chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and the letters they are without their marks."""
    pairs = []
    for c in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _plain_letters()


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse_space(c: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def blank_to_null(c: Column) -> Column:
    """Null for blank text, else the text as it is."""
    return F.when(trim_space(c) != "", c)


def clean_basic(c: Column) -> Column:
    """Collapsed and trimmed; blank is null."""
    return F.nullif(collapse_space(c), F.lit(""))


def strip_controls(c: Column) -> Column:
    """Tabs and line ends become blanks, other control characters go."""
    return F.regexp_replace(F.translate(c, "\t\r\n", "   "), CONTROLS, "")


def strip_accents(c: Column) -> Column:
    plain = lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(t, ACCENTED, PLAIN), r"\p{Mn}", "")).otherwise(t)
    return let(c, plain)


def _once_repaired(c: Column) -> Column:
    def repaired(t: Column) -> Column:
        def decoded(back: Column) -> Column:
            broken = back.rlike(r"^[\x00-\xFF]*$") & back.rlike(r"[\xC2-\xF4][\x80-\xBF]")
            read = F.try_validate_utf8(F.encode(F.when(broken, back).otherwise(F.lit("")), "ISO-8859-1").cast("string"))
            return F.when(broken, F.coalesce(read, t)).otherwise(t)

        # only a text with a lead byte's character before what Windows-1252 or Latin-1 shows for a continuation can be broken
        return F.when(t.rlike(r"[\xC2-\xF4][\x80-\xBF" + "".join(_CP1252) + "]"), let(F.translate(t, "".join(_CP1252), "".join(_CP1252.values())), decoded)).otherwise(t)

    return let(c, repaired)


def repair_mojibake(c: Column) -> Column:
    """Text that was UTF-8 but read as Windows-1252, once or twice, is put right; other text stays."""
    return _once_repaired(_once_repaired(c))


def to_case(c: Column, mode: str) -> Column:
    try:
        return {"upper": F.upper, "lower": F.lower, "title": F.initcap}[mode](c)
    except KeyError:
        raise ValueError(f"unknown case mode: {mode}") from None


def clean_display(c: Column) -> Column:
    """What cleaned tables show: repaired, without controls, collapsed; blank is null."""
    return clean_basic(strip_controls(repair_mojibake(c)))


def match_key(c: Column) -> Column:
    """The key for matching spellings: repaired, plain upper-case letters, punctuation as blanks."""
    key = F.upper(strip_accents(collapse_space(strip_controls(repair_mojibake(c)))))
    return clean_basic(F.regexp_replace(key, ASCII_PUNCTUATION, " "))


def region_name(c: Column) -> Column:
    return F.upper(strip_accents(clean_basic(c)))


def region_key(c: Column) -> Column:
    """The join key of regions: inner runs of blanks stay."""
    return F.trim(F.regexp_replace(strip_accents(F.upper(F.coalesce(c, F.lit("")))), "[^A-Z0-9 ]", " "))


def cell_text(c: Column) -> Column:
    """A table cell: collapsed, null as empty."""
    return F.coalesce(collapse_space(c), F.lit(""))


def portal_key(c: Column) -> Column:
    return F.translate(F.upper(cell_text(c)), "ÁÉÍÓÚÜÑ", "AEIOUUN")


def code_and_description(c: Column) -> Column:
    """`CODE: DESCRIPTION` as a struct; without a colon the code is empty."""
    pattern = r"^([^:]+):\s*(.+)$"
    cell = cell_text(c)
    hit = cell.rlike(pattern)
    return F.struct(F.when(hit, F.trim(F.regexp_extract(cell, pattern, 1))).otherwise("").alias("code"), F.when(hit, F.trim(F.regexp_extract(cell, pattern, 2))).otherwise(cell).alias("description"))


def contains_all(c: Column, terms: list[str]) -> Column:
    """Whether the text holds every term, whatever the case and accents."""
    out = F.lit(True)
    for t in terms:
        out &= F.contains(portal_key(c), portal_key(F.lit(t)))
    return out


_LEVELS = (("categoria_presupuestal", r"^\d{4}$"), ("producto", r"^3\d{6}$"), ("actividad", r"^5\d{6}$"), ("generica", r"^\d\.\d{1,2}$|^\d$"))


def hierarchy(c: Column) -> Column:
    """(level, code, description) of a budget descriptor: `LEVEL CODE: TEXT`, or the level told by the code."""
    named = r"(?i)^\s*(nivel|categor[ií]a|producto|actividad|gen[eé]rica|ejecutora|pliego|sector)\s+([0-9][0-9.\-]*)\s*:\s*(.*)$"
    cell = cell_text(c)
    split = code_and_description(cell)
    inferred = F.lit("entidad")
    for name, pattern in reversed(_LEVELS):
        inferred = F.when(split["code"].rlike(pattern), name).otherwise(inferred)
    hit = cell.rlike(named)
    return F.struct(
        F.when(hit, F.lower(strip_accents(F.regexp_extract(cell, named, 1)))).otherwise(inferred).alias("level"),
        F.when(hit, F.regexp_extract(cell, named, 2)).otherwise(split["code"]).alias("code"),
        F.when(hit, F.trim(F.regexp_extract(cell, named, 3))).otherwise(split["description"]).alias("description"),
    )


# --- predicates and issue codes -------------------------------------------------------------


def has_mojibake(c: Column) -> Column:
    """A sign of a wrong decoding, or a text that the repair changes."""
    return c.rlike("[" + "".join(MOJIBAKE_MARKERS) + "]") | (repair_mojibake(c) != c)


def has_replacement(c: Column) -> Column:
    return F.contains(c, F.lit("�"))


def has_controls(c: Column) -> Column:
    return c.rlike(CONTROLS)


def has_tab_or_newline(c: Column) -> Column:
    return c.rlike("[\\t\\r\\n]")


def has_edge_space(c: Column) -> Column:
    return c.rlike(r"(?U)^\s|\s\z")


def has_repeated_space(c: Column) -> Column:
    return c.rlike(" {2,}")


def has_non_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def has_accents(c: Column) -> Column:
    return c != strip_accents(c)


def has_suspicious(c: Column) -> Column:
    return c.rlike(SUSPICIOUS)


def is_long(c: Column) -> Column:
    """50 characters or more once white space is collapsed and trimmed; only so many are looked at."""
    return c.rlike(r"(?U)^\s*+\S(?:\S|\s++(?=\S)){49}")


# Issue codes, in the order in which they are listed.
ISSUES = (
    ("LEADING_OR_TRAILING_SPACE", has_edge_space),
    ("REPEATED_SPACES", has_repeated_space),
    ("TAB_OR_NEWLINE", has_tab_or_newline),
    ("CONTROL_CHARACTER", has_controls),
    ("MOJIBAKE_PATTERN", has_mojibake),
    ("REPLACEMENT_CHARACTER", has_replacement),
    ("ACCENTED_CHARACTER", has_accents),
    ("NON_ASCII_CHARACTER", has_non_ascii),
    ("SUSPICIOUS_SYMBOL", has_suspicious),
    ("LOWERCASE_OR_MIXED_CASE", lambda c: c.rlike(r"\p{Ll}")),
    ("PUNCTUATION_VARIANT", lambda c: c.rlike(PUNCTUATION_VARIANT)),
    ("LONG_TEXT_VARIANT", is_long),
)
EMPTY_ISSUE = "EMPTY_OR_WHITESPACE"
#: Codes of differences that a matching key takes away and that need no review.
MILD_ISSUES = ("ACCENTED_CHARACTER", "NON_ASCII_CHARACTER", "LOWERCASE_OR_MIXED_CASE", "PUNCTUATION_VARIANT", "LONG_TEXT_VARIANT")


def issues(c: Column) -> Column:
    """The issue codes of a text; a blank or null one has EMPTY_OR_WHITESPACE alone."""

    def codes(t: Column) -> Column:
        found = F.array_compact(F.array(*[F.when(test(t), F.lit(code)) for code, test in ISSUES]))
        return F.when(F.coalesce(t.rlike(r"(?U)\S"), F.lit(False)), found).otherwise(F.array(F.lit(EMPTY_ISSUE)))

    return let(c, codes)


def preview(c: Column) -> Column:
    """What each step of normalisation makes of a text, and its issues."""

    def steps(repaired: Column) -> Column:
        plain = strip_controls(repaired)
        return F.struct(
            c.alias("original_value"),
            repaired.alias("after_fix_mojibake"),
            plain.alias("after_remove_control_chars"),
            clean_basic(plain).alias("after_normalize_whitespace"),
            strip_accents(clean_basic(plain)).alias("after_strip_accents"),
            match_key(c).alias("after_normalize_for_matching"),
            issues(c).alias("issues"),
        )

    return let(repair_mojibake(c), steps)


def is_territorial(name: str) -> bool:
    return name.strip().lower() in TERRITORIAL_COLUMNS


def is_total(c: Column) -> Column:
    """Whether a value stands for several territories or none."""
    return F.coalesce(match_key(c).isin(*TOTAL_KEYS), F.lit(False))


def territorial_action(c: Column) -> Column:
    """What to do with a value in a territorial column."""
    return let(match_key(c), lambda k: F.when(k.isin(*NATIONAL_KEYS), "REVIEW_MAP_TO_NATIONAL_TOTAL").when(k.isin(*EXCLUDED_KEYS), "REVIEW_EXCLUDE_FROM_DETAIL_SILVER").when(k.isin(*TOTAL_KEYS), "REVIEW_KEEP_AS_AGGREGATE_TABLE").otherwise("REVIEW_UNKNOWN"))
