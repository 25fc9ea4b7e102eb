"""Language identification and quality scores: a contract with replaceable backends."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.functions.text import flatten_space

PREFIX = "__label__"
UNKNOWN = f"{PREFIX}unknown"
ADDED = ("quality_keep", "lang", "lang_score")


class LanguageModel(Protocol):
    """Anything that gives the best label and its probability for each of a batch of texts."""

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]: ...


_BUCKETS = 1 << 17


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every character trigram, text it is in); texts are padded by a space."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in padded])
    owner = np.repeat(np.arange(len(texts)), lengths)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) ^ codes[1:-1] * np.uint64(0x85EBCA77) ^ codes[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x9E3779B97F4A7C15)
    inside = owner[:-2] == owner[2:]
    return (mixed >> np.uint64(47)).astype(np.int64)[inside], owner[:-2][inside]


class TrigramModel:
    """Naive Bayes over hashed character trigrams, fitted on a bounded table of labelled texts."""

    MAX_ROWS = 20_000

    def __init__(self, labels: list[str], weights: np.ndarray):
        self.labels, self.weights = labels, weights

    @classmethod
    def fit(cls, rows: list[tuple[str, str]]) -> TrigramModel:
        labels = sorted({label for label, text in rows if text})
        counts = np.full((_BUCKETS, len(labels)), 0.02)
        for i, label in enumerate(labels):
            at, _ = _trigrams([t for x, t in rows if x == label and t])
            counts[:, i] += np.bincount(at, minlength=_BUCKETS)
        return cls(labels, np.log(counts / counts.sum(0)).astype(np.float32))

    @classmethod
    def train(cls, samples: DataFrame, label_col: str = "lang", text_col: str = "sample_text") -> TrigramModel:
        """From a labelled table; at most MAX_ROWS rows in a fixed order are used."""
        label = F.regexp_replace(F.col(label_col), f"^{PREFIX}", "")
        rows = samples.select(label.alias("a"), F.col(text_col).alias("b")).where("a <> '' and b <> ''").distinct().orderBy("a", "b").limit(cls.MAX_ROWS).collect()
        return cls.fit([(r["a"], r["b"]) for r in rows])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.labels:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        at, owner = _trigrams(texts)
        score = np.zeros((len(texts), len(self.labels)))
        for i in range(len(self.labels)):
            score[:, i] = np.bincount(owner, self.weights[at, i], len(texts))
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return [PREFIX + self.labels[i] for i in best], p[np.arange(len(texts)), best].tolist()


@dataclass
class LanguageFilter:
    """Keeps texts of the allowed languages whose score reaches the threshold."""

    model: LanguageModel | None = None
    allowed: tuple[str, ...] = ("zh", "en")
    threshold: float = 0.4
    _labels: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        if not self.allowed:
            raise ValueError("no languages given")
        self._labels = tuple(x if x.startswith(PREFIX) else PREFIX + x for x in self.allowed)

    def keep(self, lang: Column, score: Column) -> Column:
        return F.coalesce(lang.isin(*self._labels) & (score >= self.threshold), F.lit(False))

    def predict(self, text: Column) -> Column:
        """struct(lang, lang_score); blank texts and texts that the model fails on are unknown with score 0."""
        sent = self.model

        @F.pandas_udf("lang string, lang_score double")
        def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                full = [i for i, t in enumerate(texts) if t]

                def fill(at: list[int]) -> None:
                    labels, scores = sent.predict([texts.iloc[i] for i in at])
                    for i, a, b in zip(at, labels, [float(x) for x in scores], strict=True):
                        lang[i], score[i] = a, b

                try:
                    if full:
                        fill(full)
                except MemoryError:
                    raise
                except Exception:  # noqa: BLE001 - one text that a backend can't read costs no other its label
                    for i in full:
                        try:
                            fill([i])
                        except MemoryError:
                            raise
                        except Exception:  # noqa: BLE001 - it is unknown, not an error
                            lang[i], score[i] = UNKNOWN, 0.0
                yield pd.DataFrame({"lang": lang, "lang_score": score})

        return identify(flatten_space(text))

    def apply(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add quality_keep, lang and lang_score; columns of these names are replaced, also on empty input."""
        if self.model is None:
            raise RuntimeError("no language model given")
        base = spread(df.drop(*ADDED)).withColumn("_id", self.predict(F.col(text_col)))
        out = base.select(*df.drop(*ADDED).columns, F.col("_id.lang").alias("lang"), F.col("_id.lang_score").alias("lang_score"))
        return out.select(*df.drop(*ADDED).columns, self.keep(F.col("lang"), F.col("lang_score")).alias("quality_keep"), "lang", "lang_score")


def language_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


def keep_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("lang", "quality_keep").agg(F.count(F.lit(1)).alias("n"))


def keep_rate(df: DataFrame) -> DataFrame:
    """One row: total, kept, rate (0 for an empty input)."""
    kept = F.coalesce(F.sum(F.col("quality_keep").cast("long")), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("total"), kept.alias("kept")).withColumn("rate", F.when(F.col("total") > 0, F.col("kept") / F.col("total")).otherwise(F.lit(0.0)))


@dataclass
class QualityFilter:
    """A binary classifier over hashed words; blank texts score 0, a score of ``threshold`` passes."""

    pos_label: str
    threshold: float = 0.5
    features: int = 1 << 16
    max_rows: int = 50_000
    rounds: int = 150

    def _rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of every distinct word, text it is in)."""
        words = [sorted(set(t.lower().split())) for t in texts]
        at = np.array([crc32(w.encode()) % self.features for ws in words for w in ws], np.int64)
        return at, np.repeat(np.arange(len(texts)), [len(ws) for ws in words])

    def fit(self, labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> QualityFilter:
        """Logistic regression on at most ``max_rows`` labelled rows, by least hash of the text; the positive label must occur."""
        rows = labelled.select(flatten_space(F.col(text_col)).alias("t"), (F.col(label_col).cast("string") == self.pos_label).alias("y")).where("y is not null and t <> ''").orderBy(F.xxhash64("t"), "t", "y").limit(self.max_rows).toPandas()
        y = rows["y"].to_numpy(dtype=float)
        if not y.any():
            raise ValueError(f"label {self.pos_label!r} does not occur")
        at, owner = self._rows(rows["t"].tolist())
        share = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(y))))[owner]
        w, g2, bias = np.zeros(self.features), np.zeros(self.features), 0.0
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-(np.bincount(owner, w[at] * share, len(y)) + bias)))
            g = np.bincount(at, (p - y)[owner] * share, self.features) + 1e-3 * w
            g2 += g * g
            w -= 0.5 * g / np.sqrt(g2 + 1e-9)
            bias -= float((p - y).mean())
        self._weights, self._bias = w.astype(np.float32), bias
        return self

    def score(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add quality_score and quality_pass."""

        @F.pandas_udf("double")
        def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                at, owner = self._rows(texts.tolist())
                n = np.bincount(owner, minlength=len(texts))
                z = np.bincount(owner, self._weights[at], len(texts)) / np.sqrt(np.maximum(1, n)) + self._bias
                yield pd.Series(np.where(n > 0, 1 / (1 + np.exp(-z)), 0.0))

        out = df.withColumn("quality_score", judge(flatten_space(F.col(text_col))))
        return out.withColumn("quality_pass", F.col("quality_score") >= self.threshold)
