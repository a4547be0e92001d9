"""Validated settings of the operators, with a fingerprint for resumable stages.

A field declares its range beside its default; ``Settings`` checks all fields of all classes alike.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields
from typing import Any

UNICODE_FORMS = ("NFC", "NFKC", "NFD", "NFKD")


def ranged(default: Any, low: float | None = None, high: float | None = None, above: float | None = None, among: tuple = ()) -> Any:
    """A field with a default and what its values must keep: bounds (``above`` is strict), or a set of values."""
    return field(default=default, metadata={"low": low, "high": high, "above": above, "among": among})


class Settings:
    """Base of the settings: ranges of the fields, and a fingerprint over all of them."""

    def __post_init__(self) -> None:
        for f in fields(self):
            value, rule = getattr(self, f.name), f.metadata
            if not rule or value is None:
                continue
            broken = (
                (rule["among"] and value not in rule["among"])
                or (rule["low"] is not None and value < rule["low"])
                or (rule["high"] is not None and value > rule["high"])
                or (rule["above"] is not None and value <= rule["above"])
            )
            if broken:
                raise ValueError(f"{type(self).__name__}.{f.name} = {value!r} lies outside its range")
        self.check()

    def check(self) -> None:
        """What several fields must keep together."""

    def fingerprint(self) -> str:
        """SHA-256 of the settings' names and values."""
        body = json.dumps([type(self).__name__, asdict(self)], sort_keys=True, default=str)
        return hashlib.sha256(body.encode()).hexdigest()


@dataclass(frozen=True)
class Normalization(Settings):
    """What text normalization does; the steps run in the order of the fields."""

    decode_html_entities: bool = True
    strip_html: bool = True
    unicode_form: str = ranged("NFKC", among=UNICODE_FORMS)
    remove_control_characters: bool = True
    collapse_horizontal_whitespace: bool = True
    max_blank_lines: int = ranged(2, low=0)
    strip_text: bool = True


@dataclass(frozen=True)
class Rules(Settings):
    """Cleaning steps and thresholds of the quality rules; all comparisons with thresholds are strict."""

    remove_page_and_line_markers: bool = True
    collapse_repeated_punctuation: bool = True
    min_characters: int = ranged(200, low=0)
    max_characters: int | None = None
    min_words: int = ranged(30, low=0)
    min_alphabetic_ratio: float = ranged(0.20, low=0, high=1)
    max_replacement_character_ratio: float = ranged(0.01, low=0, high=1)
    max_repeated_line_ratio: float = ranged(0.60, low=0, high=1)
    repeated_ngram_size: int = ranged(10, low=1)
    max_repeated_ngram_ratio: float = ranged(0.50, low=0, high=1)
    reject_remaining_html: bool = False

    def check(self) -> None:
        if self.max_characters is not None and self.max_characters < self.min_characters:
            raise ValueError("Rules: more characters are needed than are allowed")


@dataclass(frozen=True)
class Perplexity(Settings):
    """Threshold and counting of the perplexity filter."""

    threshold: float = ranged(1500.0, above=0)
    min_words: int = ranged(1, low=0)
    include_bos: bool = True
    include_eos: bool = True


@dataclass(frozen=True)
class NearDuplicates(Settings):
    """Shingles, signatures and verification of near-duplicate removal. The builds ask for a similarity of 0.5."""

    similarity_threshold: float = ranged(0.8, above=0, high=1)
    ngram_size: int = ranged(5, low=1)
    min_words: int = ranged(5, low=1)
    num_permutations: int = ranged(128, low=1)
    bands: int = ranged(32, low=1)
    seed: int = 42
    verify: bool = True

    def check(self) -> None:
        if self.num_permutations % self.bands:
            raise ValueError("NearDuplicates: the bands must divide the permutations evenly")


#: The setting of large builds: more permutations and bands, so that pairs at a similarity of 0.5 meet with a chance of 0.98; verification may be left out.
BUILD_DUPLICATES = NearDuplicates(similarity_threshold=0.5, num_permutations=240, bands=60)
