"""Problem 8: passages of held-out test items inside corpus documents.

A document contains an item if it has a run of consecutive words of the item's
question at least 60 % as long as the question in which at most one word in ten
is exchanged. Items are short and documents long, so plain similarity is near 0;
the search is for containment:

* items are partitioned by size, and each partition cuts documents into windows
  of twice its largest size, overlapping by half, so that every run lies whole in
  a window whose size is close to the item's (the bound that turns containment
  into similarity is then tight);
* items and windows are compared by MinHash over word shingles, window sets being
  restricted to shingles that occur in the item set at all. One equal value out
  of PERMUTATIONS makes a candidate: a run that is one in ten of the union is
  missed once in 700,000 cases;
* a candidate is verified on the whole document: exact shingle containment along
  one alignment, then the run itself, word by word.

The items are the stated query set; they go to all documents in blocks of at most
BLOCK_BYTES (one item may be larger), so each broadcast has a bound. Documents are
scanned once, never shuffled: the words of a batch are hashed once and meet one
block after the other.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.llm.batches import chunks, scramble

SHARE = 0.6
ONE_EXCHANGED_IN = 10
SHINGLE = 3
PERMUTATIONS = 128
#: Bytes of sketches in one block of items.
BLOCK_BYTES = 32 << 20

_WORD = re.compile("[㐀-鿿豈-﫿\U00020000-\U0003ffff]|[^\\W_㐀-鿿豈-﫿\U00020000-\U0003ffff]+")
_MARK = regex.compile(r"\p{M}+")


def words(text: str | None) -> list[str]:
    """Words without case, accents and punctuation; of Chinese, single characters."""
    if not text:
        return []
    if not text.isascii():
        text = _MARK.sub("", unicodedata.normalize("NFKD", text))
    return _WORD.findall(text.casefold())


def least_run(n: int) -> int:
    """Words that a run of an item of ``n`` words must have."""
    return max(1, math.ceil(n * SHARE - 1e-9))


def intact_shingles(n: int, size: int) -> int:
    """The fewest shingles that any run that counts leaves unchanged on its alignment."""
    return max(1, min(m - size + 1 - size * (m // ONE_EXCHANGED_IN) for m in range(least_run(n), n + 1)))


def has_run(same: np.ndarray) -> bool:
    """Whether equal words (True) on one alignment hold a run that counts."""
    n = len(same)
    wrong = np.concatenate([[0], np.cumsum(~same)])
    for m in range(least_run(n), n + 1):
        if np.any(wrong[m:] - wrong[:-m] <= m // ONE_EXCHANGED_IN):
            return True
    return False


class Words(dict):
    """64-bit hashes of words, kept as long as they are few; 0 is none of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1
        return code

    def codes(self, text: str | None) -> np.ndarray:
        own = words(text)
        return np.fromiter(map(self.__getitem__, own), np.uint64, len(own))


def shingles(coded: np.ndarray, size: int) -> np.ndarray:
    """64-bit codes of all word shingles."""
    n = len(coded) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out = scramble(out + coded[k : k + n])
    return out


_SALTS = np.random.default_rng(11).integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_SLOTS = scramble(np.arange(PERMUTATIONS, dtype=np.uint64))


class ItemIndex:
    """Sketches of a block of items; ``search`` runs on executors."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.coded = [c for _, c in items]
        # items too short for a whole shingle in every run have shorter shingles
        parts: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, c in enumerate(self.coded):
            parts[min(SHINGLE, least_run(len(c))), (len(c) - 1).bit_length()].append(i)
        self.parts = []
        for (size, _), members in sorted(parts.items()):
            own = [shingles(self.coded[i], size) for i in members]
            sketches = np.array([scramble(x[:, None] ^ _SALTS).min(0) for x in own])
            keys, owner = scramble(sketches ^ _SLOTS).ravel(), np.repeat(np.arange(len(members), dtype=np.int32), PERMUTATIONS)
            order = np.argsort(keys, kind="stable")
            unique, first = np.unique(keys[order], return_index=True)
            codes = np.unique(np.concatenate(own))
            ranks = [np.searchsorted(codes, x).astype(np.int32) for x in own]
            places = [np.argsort(r, kind="stable").astype(np.int32) for r in ranks]
            self.parts.append({
                "size": size, "members": members, "codes": codes, "ranks": [r[o] for r, o in zip(ranks, places)], "places": places, "window": max(len(self.coded[i]) for i in members),
                "keys": unique, "first": np.concatenate([first, [len(keys)]]), "owners": owner[order], "least": [intact_shingles(len(self.coded[i]), size) for i in members],
            })

    @staticmethod
    def bytes_of(coded: np.ndarray) -> int:
        """What an item takes in a block: its sketch with owners and places, its words and shingles."""
        return PERMUTATIONS * 20 + 24 * len(coded)

    def search(self, coded: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """(text, item id) for each text, given by its words' codes, that contains the item."""
        starts = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
        flat = np.concatenate(coded) if coded else np.zeros(0, np.uint64)
        text = np.repeat(np.arange(len(coded)), np.diff(starts))
        grams: dict[int, np.ndarray] = {}
        for part in self.parts:
            size = part["size"]
            if size not in grams:
                grams[size] = shingles(flat, size)
            own = grams[size]
            rank = np.searchsorted(part["codes"], own)
            rank[rank == len(part["codes"])] = 0
            at = np.flatnonzero((part["codes"][rank] == own) & (text[: len(own)] == text[size - 1 : size - 1 + len(own)]))
            if len(at):
                yield from self._candidates(part, at, rank[at], text[at], starts, flat)

    def _candidates(self, part: dict, at: np.ndarray, rank: np.ndarray, text: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> Iterator[tuple[int, int]]:
        # windows of twice the size, in steps of the size: a place lies in two of them
        window = (at - starts[text]) // part["window"] + 1 + (text << 32)
        known, place = np.unique(rank, return_inverse=True)
        key, both = np.concatenate([window, window - 1]), np.concatenate([place, place])
        order = np.argsort(key, kind="stable")
        key, both = key[order], both[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        values = scramble(part["codes"][known][:, None] ^ _SALTS)
        pairs = set()
        for i in range(0, len(first), 512):  # a strip of windows at a time bounds what is gathered
            some = first[i : i + 512]
            end = first[i + 512] if i + 512 < len(first) else len(key)
            sketch = scramble(np.minimum.reduceat(values[both[some[0] : end]], some - some[0], axis=0) ^ _SLOTS)
            slot = np.searchsorted(part["keys"], sketch)
            slot[slot == len(part["keys"])] = 0
            row, column = np.nonzero(part["keys"][slot] == sketch)
            for t, k in {(int(key[f]) >> 32, int(k)) for f, k in zip(some[row].tolist(), slot[row, column].tolist())}:
                pairs.update((t, int(c)) for c in part["owners"][part["first"][k] : part["first"][k + 1]])
        bounds = np.searchsorted(text, np.arange(len(starts)))
        for t, c in sorted(pairs):
            a, b = bounds[t], bounds[t + 1]
            if self._contains(part, c, flat[starts[t] : starts[t + 1]], at[a:b] - starts[t], rank[a:b]):
                yield t, self.ids[part["members"][c]]

    def _contains(self, part: dict, c: int, coded: np.ndarray, at: np.ndarray, rank: np.ndarray) -> bool:
        item = self.coded[part["members"][c]]
        # all pairs of equal shingles, by the alignment they stand for
        own, places = part["ranks"][c], part["places"][c]
        lo = np.searchsorted(own, rank, "left")
        hit = own[np.minimum(lo, len(own) - 1)] == rank
        if np.count_nonzero(hit) < part["least"][c]:
            return False
        at, rank, lo = at[hit], rank[hit], lo[hit]
        times = np.searchsorted(own, rank, "right") - lo
        q = places[np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())]
        shift, n = np.unique(np.repeat(at, times) - q, return_counts=True)
        for s in shift[n >= part["least"][c]].tolist():
            same = np.zeros(len(item), bool)
            a, b = max(0, -s), min(len(item), len(coded) - s)
            same[a:b] = coded[a + s : b + s] == item[a:b]
            if has_run(same):
                return True
        return False


def leaks(documents: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id): each document with each item it contains.

    Null, empty or wordless questions and texts match nothing. Repeated rows of a
    doc_id give one row. Items may repeat a question: each is reported. An empty
    table on either side gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}"
    code, todo, size, blocks = Words(), [], 0, []

    def close() -> None:
        nonlocal todo, size
        if todo:
            blocks.append(spark.sparkContext.broadcast(ItemIndex(todo)))
        todo, size = [], 0

    for r in items.select("item_id", "question").where(F.col("item_id").isNotNull()).toLocalIterator():
        coded = code.codes(r["question"])
        if len(coded):
            more = ItemIndex.bytes_of(coded)
            if size and size + more > block_bytes:
                close()
            todo.append((r["item_id"], coded))
            size += more
    close()
    if not blocks:
        return spark.createDataFrame([], schema)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Words()
        for b in batches:
            ids, texts = b["doc_id"].tolist(), b["text"].tolist()
            parts = [(i, [hashes.codes(t) for t in texts[i:j]]) for i, j in chunks(texts, 1 << 18)]
            for block in blocks:
                index = block.value
                out = [(ids[i + t], item) for i, coded in parts for t, item in index.search(coded)]
                if len(blocks) > 1:
                    vars(block).pop("_value", None)  # one block in memory at a time; it is read again from the local file
                yield pd.DataFrame(out, columns=["doc_id", "item_id"])

    corpus = spread(documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") > 0)))
    return corpus.mapInPandas(scan, schema).distinct()


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, suite, n_documents): every test item with the number of documents it leaked into."""
    hits = leaks(documents, items).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))
    return items.select("item_id", "suite").join(hits, "item_id", "left").select("item_id", "suite", F.coalesce("n_documents", F.lit(0)).alias("n_documents"))
