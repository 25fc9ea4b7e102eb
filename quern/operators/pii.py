"""Structured personal data: flags, typed placeholders and routing to a person-name stage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import once, spread
from quern.functions.text import BOUNDARY, RE2_SPACE

# The patterns of the structured kinds, in their order of replacement.
PATTERNS = {
    "email": (r"(?i)\b[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}\b", "<EMAIL>"),
    "ip4": (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "<IP>"),
    "ip6": (r"\b(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}\b", "<IP>"),
    "phone": (r"\b(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{2,4}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}\b", "<PHONE>"),
    "ssn": (r"\b\d{3}-\d{2}-\d{4}\b", "<SSN>"),
}
#: A character without which a kind can't occur: texts that lack it skip the pattern.
NEEDS = {"email": "@", "ip4": ".", "ip6": ":", "ssn": "-"}
# Words and shapes that send a text to the name stage.
CONTACT = (
    r"(?i)\b(contact|call|email\s+me|reach\s+me|tel|phone|ssn|wechat|whatsapp|line|telegram)\b"
    r"|联系我|电话|手机号|邮箱|微信|QQ|WhatsApp|Telegram|Line"
)
NAME_SHAPE = r"\b[A-Z][a-z]+ [A-Z][a-z]+\b"
# The script that makes a text Chinese, and the mark of a person's name.
CJK = r"[\x{4e00}-\x{9fff}]"
NAME_MARK = "<NAME>"
#: Given names that a pattern is made of at most.
MAX_NAMES = 5_000
FLAGS = tuple(f"pii_has_{k}" for k in PATTERNS)


def jvm(pattern: str) -> str:
    """An RE2 pattern with ASCII ``\\b`` and ``\\s``, for java.util.regex."""
    space = RE2_SPACE[1:-1]
    out, inside = "", False
    i = 0
    while i < len(pattern):
        c, two = pattern[i], pattern[i : i + 2]
        if two == r"\b":
            out, i = out + BOUNDARY, i + 2
        elif two == r"\s":
            out, i = out + (space if inside else RE2_SPACE), i + 2
        elif c == "\\":
            out, i = out + two, i + 2
        else:
            inside = c == "[" or (inside and c != "]")
            out, i = out + c, i + 1
    return out


def redacted(text: Column) -> Column:
    """All structured kinds replaced, one after the other; null stays null."""
    for kind, (pattern, mark) in PATTERNS.items():
        changed = F.regexp_replace(text, jvm(pattern), mark)
        text = F.when(text.contains(NEEDS[kind]), changed).otherwise(text) if kind in ("email", "ip6") else changed
    return text


def flags(text: Column) -> dict[str, Column]:
    """What the original text holds, by kind."""

    def holds(kind: str, pattern: str) -> Column:
        hit = text.rlike(jvm(pattern))
        return F.coalesce(text.contains(NEEDS[kind]) & hit if kind in NEEDS else hit, F.lit(False))

    return {f"pii_has_{k}": holds(k, p) for k, (p, _) in PATTERNS.items()}


def ner_language(text: Column, lang: Column | None = None) -> Column:
    """Two letters of the label, whatever its prefix; without one, by the script of the text."""
    guess = F.when(text.rlike(CJK), "zh").otherwise("en")
    if lang is None:
        return guess
    bare = F.regexp_replace(lang, "^__label__", "")
    return F.when(F.length(bare) >= 2, F.lower(F.substring(bare, 1, 2))).otherwise(guess)


def name_patterns(given: DataFrame, lang_col: str = "lang", name_col: str = "given_name") -> dict[str, str]:
    """RE2 patterns of given name and family name by language, from a table of given names.

    A small built-in stage for person names, which runs on the JVM: a listed given
    name, initials, particles and a capitalised family name; in Chinese a family
    name of one character before a listed given name. It finds no name whose given
    name is not listed; a model can take its place as a callable.
    """
    rows = given.select(F.lower(F.substring(F.regexp_replace(F.col(lang_col), "^__label__", ""), 1, 2)).alias("lang"), F.trim(name_col).alias("name")).where("lang <> '' and name <> ''").distinct().orderBy("lang", "name").limit(MAX_NAMES).collect()
    listed: dict[str, list[str]] = {}
    for r in rows:
        listed.setdefault(r["lang"], []).append(re.escape(r["name"]).replace("\\ ", " "))
    family = r"(?:[A-Z]\. ?)*(?:(?:de|da|di|del|van|von|der) )*(?:[A-Z]['’])?[A-Z][A-Za-zÀ-ÖØ-öø-ÿ]+(?:['’-][A-Z]?[A-Za-zÀ-ÖØ-öø-ÿ]+)*"
    return {x: rf"{CJK}(?:{'|'.join(names)})" if x == "zh" else rf"\b(?:{'|'.join(names)}) {family}" for x, names in listed.items()}


def redact(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str | None = None,
    keep_stats: bool = False,
    keep_routing: bool = False,
    names: Callable[[list[str], list[str]], list[str]] | dict[str, str] | None = None,
    name_langs: tuple[str, ...] = ("en", "zh"),
) -> DataFrame:
    """Overwrite the text with its redacted form.

    ``names`` is an optional stage for person names: patterns by language, or
    ``names(texts, langs)``, called in batches on the rows that look as if they had
    one; the others pass through it unseen, and a text that it fails on stays as it is. ``keep_stats`` keeps the flags, ``keep_routing`` need_ner and ner_lang.
    """
    src = F.col(text_col)
    rest = [c for c in df.columns if c not in (*FLAGS, "need_ner", "ner_lang")]
    looks = F.coalesce(src.contains("@") | src.rlike(jvm(CONTACT)) | src.rlike(jvm(NAME_SHAPE)), F.lit(False))
    wanted = {text_col: redacted(src)}
    if keep_stats or keep_routing or names is not None:
        wanted |= flags(src) | {"_looks": looks}
    out = once(spread(df).select(*rest), **wanted)
    if len(wanted) == 1:
        return out.select(*rest)
    gate = F.col("_looks")
    for c in FLAGS:
        gate = gate | F.col(c)
    out = out.withColumn("need_ner", gate)
    out = out.withColumn("ner_lang", ner_language(F.col(text_col), F.col(lang_col) if lang_col and lang_col in df.columns else None))
    if isinstance(names, dict):
        named = F.col(text_col)
        for lang in name_langs:
            if lang in names:
                named = F.when(F.col("need_ner") & (F.col("ner_lang") == lang), F.regexp_replace(F.col(text_col), jvm(names[lang]), NAME_MARK)).otherwise(named)
        out = out.withColumn(text_col, named)
    elif names is not None:

        @F.pandas_udf("string")
        def stage(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for text, need, lang in batches:
                pick = (need & lang.isin(name_langs) & text.notna()).to_numpy()
                text = text.copy()
                if pick.any():
                    try:
                        text[pick] = names(text[pick].tolist(), lang[pick].tolist())
                    except MemoryError:
                        raise
                    except Exception:  # noqa: BLE001 - a text that a backend can't read costs no other its redaction
                        for i in np.flatnonzero(pick):
                            try:
                                text.iloc[i] = names([text.iloc[i]], [lang.iloc[i]])[0]
                            except MemoryError:
                                raise
                            except Exception:  # noqa: BLE001
                                continue
                yield text

        out = out.withColumn(text_col, stage(text_col, "need_ner", "ner_lang"))
    return out.select(*rest, *(FLAGS if keep_stats else ()), *(("need_ner", "ner_lang") if keep_routing else ()))
