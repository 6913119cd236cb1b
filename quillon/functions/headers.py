"""Header names: done once for a plan, on the driver, from df.columns."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that don't tell headers apart.
STOP_WORDS = frozenset({"de", "del", "la", "los", "las", "el", "y", "en", "para", "con", "segun", "a", "o", "u"})


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def snake_case(header: str) -> str:
    text = _plain(header.replace("%", " porcentaje ").replace("°", "").replace("º", "")).lower()
    return re.sub(r"[^a-z0-9]+", "_", text).strip("_")


def tolerant_key(header: str) -> str:
    """A header without BOM, case, accents, underscores and stop words."""
    words = re.split(r"[\s_]+", _plain(header.replace("﻿", "")).strip().lower())
    return "".join(w for w in words if w and w not in STOP_WORDS)


def year_of(header: str) -> tuple[int, bool] | None:
    """(year, preliminary) of a year's header; total columns and others are none."""
    if is_total_header(header):
        return None
    m = re.search(r"(?:19|20)\d{2}", header)
    return (int(m[0]), "(*)" in header or "preliminar" in header.lower()) if m else None


def is_total_header(header: str) -> bool:
    return tolerant_key(header) == "total"


def landing_name(header: str) -> str:
    """`2012` -> anio_2012, `2026 (*)` -> anio_2026_preliminar, others in snake case."""
    found = year_of(header)
    if found and re.fullmatch(r"\s*\d{4}\s*(\(\*\))?\s*", header):
        return f"anio_{found[0]}" + "_preliminar" * found[1]
    return snake_case(header)


def resolve(columns: list[str], aliases: dict[str, list[str]], required: list[str] = ()) -> dict[str, str | None]:
    """For each contract name the column that holds it: its own name or the first alias present.

    Presence decides, so an alias whose values are blank still wins. Missing required names are an error.
    """
    by_key = {}
    for c in columns:
        by_key.setdefault(tolerant_key(c), c)
    out = {name: next((by_key[k] for a in [name, *others] if (k := tolerant_key(a)) in by_key), None) for name, others in aliases.items()}
    if missing := [n for n in required if out.get(n) is None]:
        raise ValueError(f"columns not found: {missing}; there are {columns}")
    return out


def rename_landing(df: DataFrame, metadata: dict[str, str] | None = None) -> DataFrame:
    """Landing headers normalised, with constant lineage columns added."""
    out = df.toDF(*[landing_name(c) for c in df.columns])
    return out.withColumns({k: F.lit(v) for k, v in (metadata or {}).items()})
