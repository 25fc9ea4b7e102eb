"""MinHash signatures over character n-grams, in NumPy batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.functions.text import fold

K, NGRAM, SEED = 128, 5, 42
#: Shingles hashed against all permutations at once; keeps a long text at a few MB.
_CHUNK = 8192


def permutations(k: int = K, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the k permutations of 64-bit values.

    Drawn as 32-bit halves in the order that published signatures depend on:
    high and low of the multipliers, then high and low of the offsets.
    """
    draw = np.random.RandomState(seed)
    halves = [draw.randint(0, 2**32, size=k, dtype=np.uint64) for _ in range(4)]
    up = np.uint64(32)
    return (halves[0] << up | halves[1]) | np.uint64(1), halves[2] << up | halves[3]


def char_ngrams(text: str, n: int = NGRAM) -> set[bytes]:
    """Distinct n-grams as UTF-8; a shorter text is its own only n-gram."""
    return {text[i : i + n].encode() for i in range(max(1, len(text) - n + 1))}


def hash64(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data)


def signature(text: str, k: int = K, n: int = NGRAM, seed: int = SEED, perms: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """k unsigned minima; all 0 for an empty text."""
    if not text:
        return np.zeros(k, np.uint64)
    a, b = perms or permutations(k, seed)
    h = np.fromiter(map(xxhash.xxh64_intdigest, char_ngrams(text, n)), np.uint64)
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), _CHUNK):
        np.minimum(low, (h[i : i + _CHUNK, None] * a + b).min(axis=0), out=low)
    return low


def jaccard_estimate(a, b) -> float:
    """Share of equal positions of two signatures."""
    if len(a) != len(b):
        raise ValueError("signatures of different lengths")
    return float(np.mean(np.asarray(a) == np.asarray(b))) if len(a) else 0.0


def signatures(k: int = K, n: int = NGRAM, seed: int = SEED):
    """A UDF from folded texts to arrays of BIGINT that hold the unsigned bit patterns."""

    @F.pandas_udf("array<bigint>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        perms = permutations(k, seed)
        for texts in batches:
            yield pd.Series([signature(t or "", k, n, seed, perms).view(np.int64) for t in texts])

    return compute


def with_signatures(df: DataFrame, text_col: str = "text", k: int = K, n: int = NGRAM, seed: int = SEED) -> DataFrame:
    """Add ``signature`` and ``length`` (code points of the text; null counts as empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return spread(df).withColumns({"signature": signatures(k, n, seed)(fold(F.col(text_col))), "length": F.length(text)})
