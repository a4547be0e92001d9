"""Spelling rules for the labels of a corpus: type, jurisdiction, source, language, split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a type that mean another one.
TYPE_ALIASES = {"case law": "caselaw", "case-law": "caselaw", "case_law": "caselaw", "legal_mc4": "legal-mc4"}
# Jurisdictions by their lower-case spelling.
JURISDICTIONS = {"us": "US", "eu": "EU", "uk": "UK", "switzerland": "Switzerland", "n/a": "N/A", "na": "N/A"}
# Spellings of a split.
SPLIT_ALIASES = {"val": "validation", "valid": "validation", "dev": "validation"}
UNKNOWN = "UNKNOWN"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bare(c: Column | str) -> Column:
    """Without outer white space; blank or empty becomes null."""
    trimmed = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    return F.when(trimmed != "", trimmed)


def _renamed(c: Column, names: dict[str, str], default: Column) -> Column:
    out = None
    for k, v in names.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(default)


def type_label(type_: Column | str, text_type: Column | str | None = None) -> Column:
    """Lower-case type with aliases resolved; ``text_type`` stands in for a missing one, else UNKNOWN."""
    raw = bare(type_) if text_type is None else F.coalesce(bare(type_), bare(text_type))
    low = F.lower(raw)
    return F.coalesce(_renamed(low, TYPE_ALIASES, low), F.lit(UNKNOWN))


def jurisdiction_label(c: Column | str) -> Column:
    """Canonical jurisdiction; unlisted ones keep their spelling, missing ones are UNKNOWN."""
    raw = bare(c)
    return F.coalesce(_renamed(F.lower(raw), JURISDICTIONS, raw), F.lit(UNKNOWN))


def source_label(c: Column | str) -> Column:
    """One spelling of a source: trimmed, lower case, ``-`` for ``_``; missing ones are UNKNOWN."""
    return F.coalesce(F.translate(F.lower(bare(c)), "_", "-"), F.lit(UNKNOWN))


def language_label(c: Column | str) -> Column:
    """Lower-case primary language tag (``en-GB`` is ``en``); missing ones are ``und``."""
    return F.coalesce(F.substring_index(F.translate(F.lower(bare(c)), "_", "-"), "-", 1), F.lit("und"))


def split_label(c: Column | str) -> Column:
    """Lower-case split name with aliases resolved; null stays null."""
    low = F.lower(bare(c))
    return _renamed(low, SPLIT_ALIASES, low)
