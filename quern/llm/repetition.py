"""Problem 1: repetition inside single documents, kept as a ledger of rule bits.

Every rule is evaluated once for every document; the ledger holds the
measurements and one bit for each failed rule. Policies are versioned sets of
rules: applying one is a bit test on the ledger, and what each rule contributes
to each policy is found by aggregating the distinct bit patterns (at most
2^rules), without looking at a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import cut, hadoop, spread
from quern.llm.batches import chunks, code_points, prefix_hashes, scramble, span_hashes, window_hashes

STRETCH = 30
#: Raised whenever a rule, its limit or its place among the bits changes: a stored ledger tells which rules its bits stand for.
RULES_VERSION = 1

#: (measurement, the least value that fails), in the order of the bits. The n-gram
#: and line limits are those published for the MassiveText corpus (fixed values).
RULES = (
    ("letter_stretches", 1 / 3),
    ("dup_lines", 0.30),
    ("dup_line_chars", 0.20),
    ("dup_paragraphs", 0.30),
    ("top_2gram_chars", 0.20),
    ("top_3gram_chars", 0.18),
    ("top_4gram_chars", 0.16),
    ("dup_5gram_chars", 0.15),
    ("dup_10gram_chars", 0.10),
    ("stored_dup_lines", 0.35),
)
MEASURES = tuple(name for name, _ in RULES)
#: Policies by version: the rules that drop a document.
POLICIES = {
    "found": ("letter_stretches",),
    "v1": ("dup_lines", "dup_line_chars", "dup_paragraphs"),
    "v2": tuple(m for m in MEASURES if m != "stored_dup_lines"),
    "v3": ("letter_stretches", "dup_lines", "dup_10gram_chars"),
}


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, 0 if it is no letter (Unicode category L)."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            table[c] = ord(s.lower()[0])
    return table


@lru_cache(1)
def _spaces() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x3001) if chr(c).isspace()]] = True
    return table


def repeated(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the same key with the same owner came earlier."""
    n = len(keys)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    # sort (key, place) packed in one word; what looks equal is compared in full
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    packed = scramble(keys ^ scramble(owner.astype(np.uint64)))
    order = np.sort((packed >> bits << bits) | np.arange(n, dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))
    order = order.astype(np.int64)
    a, b = order[:-1], order[1:]
    out[b[(keys[a] == keys[b]) & (owner[a] == owner[b])]] = True
    return out


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True at places in one of the spans [start, end)."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def letter_stretches(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Share of each document's letters in stretches that start earlier in it as well."""
    letters = _letters()[codes]
    is_letter = letters > 0
    bounds = np.concatenate([[0], np.cumsum(is_letter)])[starts]
    letters = letters[is_letter]
    grams = window_hashes(prefix_hashes(letters), STRETCH)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(bounds))
    at = np.flatnonzero(doc[: len(grams)] == doc[STRETCH - 1 : STRETCH - 1 + len(grams)])
    again = at[repeated(grams[at], doc[at])]
    cover = _covered(again, again + STRETCH, len(letters))
    return _share(_per_document(cover, bounds), np.diff(bounds))


def _segments(codes: np.ndarray, starts: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the pieces between places where ``cut`` is True; no empty pieces."""
    edge = np.zeros(len(codes) + 1, bool)
    edge[starts] = True
    edge[:-1] |= cut
    edge[1:] |= cut
    at = np.flatnonzero(edge)
    a, b = at[:-1], at[1:]
    keep = ~cut[a] if len(codes) else np.zeros(0, bool)
    a, b = a[keep], b[keep]
    return a, b, np.searchsorted(starts, a, side="right") - 1


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """All measurements but the stored one, for a list of texts."""
    codes, starts = code_points(texts)
    n_docs = len(texts)
    out = {"letter_stretches": letter_stretches(codes, starts)}
    space = _spaces()[codes]
    newline = codes == 10
    prefix = prefix_hashes(codes)
    dense = np.concatenate([[0], np.cumsum(~space)])
    total = _per_document(~space, starts)

    for name, cut in (("lines", newline), ("paragraphs", newline & np.concatenate([newline[1:], [False]]) | (np.concatenate([[False], newline[:-1]]) & newline))):
        a, b, doc = _segments(codes, starts, cut)
        size = dense[b] - dense[a]
        a, b, doc, size = a[size > 0], b[size > 0], doc[size > 0], size[size > 0]
        again = repeated(span_hashes(prefix, a, b), doc)
        count = np.bincount(doc, minlength=n_docs)
        # a document of one paragraph has nothing to repeat
        out[f"dup_{name}"] = _share(np.bincount(doc, again, n_docs), count)
        if name == "lines":
            out["dup_line_chars"] = _share(np.bincount(doc, size * again, n_docs), total)

    a, b, doc = _segments(codes, starts, space)
    word = span_hashes(prefix, a, b)
    wide = (b - a).astype(np.int64)
    ahead = np.concatenate([[0], np.cumsum(wide)])
    words = prefix_hashes(word)
    for n in (2, 3, 4, 5, 10):
        grams = window_hashes(words, n)
        at = np.flatnonzero(doc[: len(grams)] == doc[n - 1 : n - 1 + len(grams)])
        key, owner = grams[at], doc[at]
        if n < 5:
            # characters in copies of the commonest n-gram, if it comes twice
            mixed = scramble(key ^ scramble(owner.astype(np.uint64)))
            order = np.argsort(mixed)
            new = np.concatenate([[True], mixed[order][1:] != mixed[order][:-1]]) if len(at) else np.zeros(0, bool)
            first = order[new]
            times = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
            chars = times * (ahead[at[first] + n] - ahead[at[first]]) * (times > 1)
            # the commonest; of equally common ones the longest
            best = np.zeros(n_docs, np.int64)
            np.maximum.at(best, owner[first], (times << 32) + np.minimum(chars, (1 << 32) - 1))
            out[f"top_{n}gram_chars"] = np.minimum(1.0, _share(best & ((1 << 32) - 1), total))
        else:
            again = at[repeated(key, owner)]
            cover = _covered(again, again + n, len(word))
            out[f"dup_{n}gram_chars"] = _share(np.bincount(doc, wide * cover, n_docs), total)
    return out


def ledger(documents: DataFrame) -> DataFrame:
    """(doc_id, *measurements, failed, rules): one row per document row; bit i of ``failed`` is rule i of version ``rules``.

    Null and empty texts measure 0 everywhere and fail nothing. The stored
    ``m_dup_line`` is a rule of its own; null or NaN counts as 0. Repeated rows
    stay repeated; an empty table gives no rows; other columns are ignored.
    """
    own = [m for m in MEASURES if m != "stored_dup_lines"]
    kind = dict(documents.dtypes)["doc_id"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b["text"]]
            for i, j in chunks(texts):
                part = b.iloc[i:j]
                yield pd.DataFrame({"doc_id": part["doc_id"], **measure(texts[i:j]), "stored_dup_lines": part["stored"]})[["doc_id", *own, "stored_dup_lines"]]

    stored = F.col("m_dup_line").cast("double")
    stored = F.when(stored.isNull() | F.isnan(stored), 0.0).otherwise(stored)
    measured = spread(documents.select("doc_id", "text", stored.alias("stored"))).mapInPandas(scan, ", ".join([f"doc_id {kind}", *[f"{m} double" for m in (*own, "stored_dup_lines")]]))
    bits = sum((F.when(F.col(m) >= least - 1e-12, F.lit(1 << i)).otherwise(F.lit(0)) for i, (m, least) in enumerate(RULES)), F.lit(0))
    return measured.withColumn("failed", bits.cast("long")).withColumn("rules", F.lit(RULES_VERSION))


_stored: dict[tuple, DataFrame] = {}


def stored_ledger(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The ledger of a table as written to ``path``, or to the shared folder; measured at most once for the same files.

    Policies and ablations read it instead of the texts. A ledger at ``path``
    whose bits stand for other rules is an error; one in the shared folder lives
    as long as the session.
    """
    spark = documents.sparkSession
    if path is not None:
        fs, root = hadoop(spark, path)
        if not fs.exists(root):
            ledger(documents).write.parquet(path)
        found = spark.read.parquet(path)
        other = found.where(F.col("rules") != RULES_VERSION).limit(1).count()
        if other:
            raise ValueError(f"the ledger at {path} was made by other rules than version {RULES_VERSION}")
        return found
    files = tuple(sorted(documents.inputFiles()))
    stamp = tuple(fs.getFileStatus(p).getModificationTime() for fs, p in (hadoop(spark, f) for f in files[:1000]))
    key = (spark.sparkContext.applicationId, files, stamp)
    if not files or key not in _stored:
        _stored[key] = cut(ledger(documents))
    return _stored[key]


def policy_mask(policy: str) -> int:
    return sum(1 << MEASURES.index(m) for m in POLICIES[policy])


def fails(policy: str):
    """Predicate over a ledger: the document fails the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(policy))) != 0


def ablations(rows: DataFrame) -> DataFrame:
    """(policy, rule, rules, n_failed, n_by_rule, n_only_rule): what each rule adds to each policy.

    ``n_failed``: documents the policy drops; ``n_by_rule``: those that fail this
    rule; ``n_only_rule``: those that would be kept without it.
    """
    patterns = rows.groupBy("failed", "rules").agg(F.count(F.lit(1)).alias("_n"))
    cases = [(p, m, policy_mask(p), 1 << MEASURES.index(m)) for p, ms in POLICIES.items() for m in ms]
    settings = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(m).alias("rule"), F.lit(mask).cast("long").alias("_mask"), F.lit(bit).cast("long").alias("_bit")) for p, m, mask, bit in cases])
    each = patterns.select("failed", "rules", "_n", F.explode(settings).alias("s")).select("failed", "rules", "_n", "s.*")
    hit = F.col("failed").bitwiseAND(F.col("_mask"))
    return each.groupBy("policy", "rule", "rules").agg(
        F.sum(F.when(hit != 0, F.col("_n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("_bit")) != 0, F.col("_n")).otherwise(0)).alias("n_by_rule"),
        F.sum(F.when(hit == F.col("_bit"), F.col("_n")).otherwise(0)).alias("n_only_rule"),
    )
