"""Language names as they are spelled in the wild, reduced to two letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ISO 639-1, 639-2 and English names of the languages told apart.
LANGUAGES = ("en", "zh", "de", "fr", "es", "pt")
SPELLINGS = {
    "en": ("eng", "english"),
    "zh": ("zho", "chi", "cmn", "chinese"),
    "de": ("deu", "ger", "german", "deutsch"),
    "fr": ("fra", "fre", "french"),
    "es": ("spa", "spanish"),
    "pt": ("por", "portuguese"),
}


def language_of(label: Column) -> Column:
    """Two letters for any spelling (``__label__en``, ``en-US``, ``eng``, ``EN``); null if it names none of the six."""
    text = F.lower(F.regexp_replace(label, r"(?i)^\s*__label__|\s+", ""))
    stem = F.regexp_extract(text, "^[a-z]+", 0)
    out = F.when(stem.isin(*LANGUAGES), stem)
    for code, names in SPELLINGS.items():
        out = out.when(stem.isin(*names), F.lit(code))
    return out
