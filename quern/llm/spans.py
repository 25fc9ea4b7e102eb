"""Problem 10: long spans that several records share verbatim, and the fuzzy passages around them.

Seeds are minimizers: of the ``SPAN - K + 1`` windows of K characters in every
run of SPAN characters the one with the least hash. Two records that share a run
of SPAN characters share its seed at the same place in the run, whatever
surrounds the run, so nothing is lost although only about one in eighty
positions is a seed; and as seeds are much shorter than SPAN, passages that
differ in a few places share most of theirs.

1. Seeds that occur in one document only are dropped; (seed, least and largest
   document) is an aggregate that combines map-side, so a passage that a third
   of all records carry costs no more than any other.
2. A seed stands for all runs of which it is the least window: one stretch, its
   context. Records with equal contexts (equal hashes of seed and of context, 128
   bits together) form a class; each is joined to the class's first document, a
   star instead of all pairs; what the first document repeats is joined to the
   class's last. Where one seed has several contexts, the runs of SPAN characters
   in one member of each class are matched by sorting their hashes, the texts are
   compared, and each is joined to the first document that has the run, again a
   star. There, a class is also stood for by a member of its last document, and a
   class of one document by all its hits. A seed with very many classes is split
   by the hash of the run. Any two records with a common run are thus linked,
   directly or through a centre, and every copy of a shared run is matched with
   another document.
3. Seeds with several contexts are anchors themselves, K characters long, of each
   record with the seed's first document. All anchors of a document with one centre
   are chained: those in order in both texts are joined under a cost for the gap
   between them, by dynamic programming over a Fenwick tree. Anchors that overlap
   on one diagonal give the exact runs; chains that bridge gaps are aligned to give
   fuzzy passages, which need no exact run of SPAN characters.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import chain as flat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import cut, salted_lookup, spread
from quern.llm.batches import chunks, code_points, prefix_hashes, scramble, sliding_min, span_hashes, window_hashes

SPAN = 200
K = 48
#: What a character of gap costs, and the widest gap a chain may bridge. Seeds are a sample, so gaps between them are no differences yet.
GAP_COST = 0.02
WIDEST_GAP = 1000
#: Share of a gap's characters that its alignment must keep, or the chain is parted there.
GAP_IDENTITY = 0.75
#: Share of a passage's characters that its alignment must keep.
IDENTITY = 0.8

#: Classes of one seed whose runs one task matches; a seed with more is split by the runs' hashes.
CLASSES_PER_SLICE = 20_000

_BITS = 22  # positions within one chunk of texts


def _seeds_of(ids: np.ndarray, texts: list[str], span: int, k: int) -> pd.DataFrame:
    codes, starts = code_points(texts)
    lengths = np.diff(starts)
    prefix = prefix_hashes(codes)
    grams = window_hashes(prefix, k)
    w = span - k + 1
    runs = len(codes) - span + 1
    if runs <= 0:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("seed", "context", "doc_id", "pos", "lo", "hi")})
    # the low bits hold the place: the least hash, leftmost first, and where it is
    bits = max(_BITS, int(len(grams)).bit_length())
    place = np.uint64((1 << bits) - 1)
    least = sliding_min((grams & ~place) | np.arange(len(grams), dtype=np.uint64), w)
    at = (least & place).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)[:runs]
    inside = np.arange(runs) + span <= starts[doc + 1]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    lo = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    hi = np.flatnonzero(last)
    pos, d = at[lo], doc[lo]
    context = span_hashes(prefix, lo, hi + span) + (pos - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return pd.DataFrame({"seed": grams[pos].view(np.int64), "context": context.view(np.int64), "doc_id": ids[d], "pos": pos - starts[d], "lo": lo - starts[d], "hi": hi - starts[d]})


def seeds(documents: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(seed, context, doc_id, pos, lo, hi): every seed, its place and its first and last run."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, ids = b["text"].tolist(), b["doc_id"].to_numpy(np.int64)
            for i, j in chunks(texts):
                yield _seeds_of(ids[i:j], texts[i:j], span, k)

    long_enough = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") >= span))
    return spread(long_enough).mapInPandas(scan, "seed long, context long, doc_id long, pos long, lo long, hi long")


def _star(hits: DataFrame, key: str) -> DataFrame:
    """(doc_id, centre, pos, centre_pos, n): each hit against its key's first document.

    Keys of one document only are dropped. Of several hits of the centre the first
    is the one that others meet; the rest are matched with the key's last document.
    """
    place = F.struct("doc_id", "start")
    heads = hits.groupBy(key).agg(F.min(place).alias("_h"), F.max(place).alias("_l"), F.count(F.lit(1)).alias("_rows")).where("_h.doc_id <> _l.doc_id").select(key, F.col("_h.doc_id").alias("centre"), F.col("_h.start").alias("centre_pos"), F.col("_l.doc_id").alias("_last"), F.col("_l.start").alias("_last_pos"), "_rows")
    met = salted_lookup(hits, key, cut(heads), "inner", counts="_rows").where("doc_id <> centre or start <> centre_pos")
    own = F.col("doc_id") == F.col("centre")
    return met.select(F.when(own, F.col("_last")).otherwise(F.col("doc_id")).alias("doc_id"), "centre", F.when(own, F.col("_last_pos")).otherwise(F.col("start")).alias("pos"), F.when(own, F.col("start")).otherwise(F.col("centre_pos")).alias("centre_pos"), "n")


def _hits_of(docs: list, los: list, others: list, other_los: list, more: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first hit of each piece, document and start of every hit)."""
    each = [sorted({(d, lo), (e, lo_e), *((d, int(r)) for r in m)}) for d, lo, e, lo_e, m in zip(docs, los, others, other_los, more)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in each])])
    rows = np.array(list(flat.from_iterable(each)), np.int64).reshape(-1, 2)
    return bounds, rows[:, 0], rows[:, 1]


def match_runs(groups: np.ndarray, fans: np.ndarray, slices: np.ndarray, pieces: list[str], hits: tuple[np.ndarray, np.ndarray, np.ndarray], span: int) -> pd.DataFrame:
    """(doc_id, centre, pos, centre_pos, n): equal runs of ``span`` characters in pieces of one group, a star for each run."""
    codes, starts = code_points(pieces)
    grams = window_hashes(prefix_hashes(codes), span)
    piece = np.repeat(np.arange(len(pieces)), np.diff(starts))[: len(grams)]
    at = np.flatnonzero(np.arange(len(grams)) + span <= starts[piece + 1]) if len(grams) else np.zeros(0, np.int64)
    at = at[grams[at] % fans[piece[at]].astype(np.uint64) == slices[piece[at]].astype(np.uint64)]
    key = scramble(grams[at] ^ scramble(groups[piece[at]].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    often = np.bincount(run)[run] > 1 if len(run) else new
    at, run = at[often], run[often]
    # every hit of every piece that has the run
    bounds, hit_doc, hit_start = hits
    p = piece[at]
    times = (bounds[1:] - bounds[:-1])[p]
    row = np.repeat(np.arange(len(at)), times)
    hit = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + bounds[p][row]
    run, offset = run[row], (at - starts[p])[row]
    doc, start = hit_doc[hit], hit_start[hit] + offset
    order = np.lexsort((start, doc, run))
    run, doc, start, p, offset = run[order], doc[order], start[order], p[row][order], offset[order]
    if not len(run):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("doc_id", "centre", "pos", "centre_pos", "n")})
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    last = np.concatenate([first[1:], [len(run)]]) - 1
    nth = np.repeat(np.arange(len(first)), last - first + 1)
    head, tail = first[nth], last[nth]
    # a run in one document only is no match; what the centre repeats meets the run's last document
    pick = np.flatnonzero((doc[head] != doc[tail]) & (np.arange(len(run)) != head))
    own = doc[pick] == doc[head[pick]]
    a, b = np.where(own, tail[pick], pick), np.where(own, pick, head[pick])
    # runs that follow each other on one diagonal are one match
    order = np.lexsort((start[a], start[b] - start[a], p[b], p[a], doc[b], doc[a]))
    a, b = a[order], b[order]
    same = (doc[a[1:]] == doc[a[:-1]]) & (doc[b[1:]] == doc[b[:-1]]) & (p[a[1:]] == p[a[:-1]]) & (p[b[1:]] == p[b[:-1]]) & (start[a[1:]] == start[a[:-1]] + 1) & (start[b[1:]] == start[b[:-1]] + 1)
    begin = np.flatnonzero(np.concatenate([[True], ~same]))[: len(a)]
    n = span + np.diff(np.concatenate([begin, [len(a)]])) - 1
    a, b = a[begin], b[begin]
    true = [pieces[i][x : x + m] == pieces[j][y : y + m] for i, x, j, y, m in zip(p[a].tolist(), offset[a].tolist(), p[b].tolist(), offset[b].tolist(), n.tolist())]
    return pd.DataFrame({"doc_id": doc[a], "centre": doc[b], "pos": start[a], "centre_pos": start[b], "n": n})[np.array(true, bool)]


def matches(documents: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, centre, pos, centre_pos, n): verbatim matches: those of at least ``span`` characters, and seeds."""
    shared = seeds(documents, span, k).groupBy("seed").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("_rows")).where("a <> b").select("seed", "_rows")
    # the texts are scanned again rather than kept: a scan is cheaper than all seeds on disk
    hits = cut(salted_lookup(seeds(documents, span, k), "seed", cut(shared), "inner", counts="_rows"))
    both = F.struct("seed", "context")
    same = _star(hits.select(both.alias("both"), "doc_id", F.col("lo").alias("start"), (F.col("hi") - F.col("lo") + span).alias("n")), "both")

    classes = cut(hits.groupBy("seed", "context").agg(F.min(F.struct("doc_id", "lo", "hi")).alias("_m"), F.max(F.struct(F.col("doc_id").alias("other"), F.col("lo").alias("other_lo"))).alias("_l"), F.count(F.lit(1)).alias("_hits")))
    several = cut(classes.groupBy("seed").agg(F.count(F.lit(1)).alias("_n"), F.sum("_hits").alias("_rows")).where("_n > 1"))
    anchors = salted_lookup(hits.select("seed", "doc_id", F.col("pos").alias("start")), "seed", several.select("seed", "_rows"), "inner", counts="_rows")
    members = salted_lookup(classes, "seed", several.select("seed", "_n", F.ceil(F.col("_n") / CLASSES_PER_SLICE).cast("int").alias("fan")), "inner", counts="_n").select("seed", "context", "fan", "_m.*", "_l.*", "_hits")
    # what other classes share with a class of one document, each of its hits shares with them
    lone = members.where("doc_id = other and _hits > 1").select("seed", "context", F.col("lo").alias("_lo"))
    more = hits.join(lone, ["seed", "context"]).where("lo <> _lo").groupBy("seed", "context").agg(F.collect_set("lo").alias("more"))
    members = members.join(more, ["seed", "context"], "left").withColumn("more", F.coalesce("more", F.array().cast("array<long>")))
    # at most one seed per position of a text: an array never outgrows its document
    wanted = members.groupBy("doc_id").agg(F.collect_list(F.struct("seed", "fan", "lo", "hi", "other", "other_lo", "more")).alias("places"))
    sources = documents.select("doc_id", "text").where(F.length("text") >= span).join(wanted, "doc_id")

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text, places in zip(b["doc_id"].tolist(), b["text"], b["places"]):
                for r in places:
                    # a repeated doc_id may bring another text: places beyond its end do not exist
                    if r["hi"] + span <= len(text):
                        out.append((r["seed"], r["fan"], doc_id, r["lo"], r["other"], r["other_lo"], r["more"], text[r["lo"] : r["hi"] + span]))
            yield pd.DataFrame(out, columns=["seed", "fan", "doc_id", "lo", "other", "other_lo", "more", "piece"])

    pieces = sources.mapInPandas(cut_out, "seed long, fan int, doc_id long, lo long, other long, other_lo long, more array<long>, piece string")
    pieces = pieces.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("fan") - 1))).repartition("seed", "slice").sortWithinPartitions("seed", "slice")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def close(b: pd.DataFrame) -> pd.DataFrame:
            group = np.cumsum(np.concatenate([[0], (np.diff(b["seed"].to_numpy()) != 0) | (np.diff(b["slice"].to_numpy()) != 0)]))
            hits = _hits_of(*(b[c].tolist() for c in ("doc_id", "lo", "other", "other_lo", "more")))
            return match_runs(group, b["fan"].to_numpy(), b["slice"].to_numpy(), b["piece"].tolist(), hits, span)

        for b in batches:
            held.append(b)
            size += int(b["piece"].str.len().sum())
            if size > 1 << 20:
                # all groups but the last, which may go on
                all_ = pd.concat(held, ignore_index=True)
                seed, part = all_["seed"].to_numpy(), all_["slice"].to_numpy()
                done = int(np.flatnonzero((seed != seed[-1]) | (part != part[-1]))[-1]) + 1 if len(all_) and ((seed != seed[-1]) | (part != part[-1])).any() else 0
                if done:
                    yield close(all_.iloc[:done])
                held = [all_.iloc[done:]]
                size = int(held[0]["piece"].str.len().sum())
        rest = pd.concat(held, ignore_index=True) if held else pd.DataFrame()
        if len(rest):
            yield close(rest)

    paired = pieces.mapInPandas(compare, "doc_id long, centre long, pos long, centre_pos long, n long")
    return same.unionByName(paired).unionByName(_star(anchors.withColumn("n", F.lit(k).cast("long")), "seed"))


_LEAST = (float("-inf"), -1)


class Fenwick:
    """Maxima over ranges of ranks, with the index that reached each; a rank's value may rise and fall."""

    def __init__(self, n: int):
        self.n = n
        self.own = [_LEAST] * (n + 1)
        self.best = [_LEAST] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        self.own[i] = value
        while i <= self.n:
            # the node's own value and the nodes just below it
            top, j, low = self.own[i], i - 1, i - (i & -i)
            while j > low:
                if self.best[j] > top:
                    top = self.best[j]
                j -= j & -j
            self.best[i] = top
            i += i & -i

    def drop(self, i: int) -> None:
        self.put(i, _LEAST)

    def top(self, low: int, high: int) -> tuple[float, int]:
        """The largest value at ranks from ``low`` to below ``high``."""
        out = _LEAST
        while high > low:
            step = high & -high
            if high - step >= low:
                if self.best[high] > out:
                    out = self.best[high]
                high -= step
            else:
                if self.own[high] > out:
                    out = self.own[high]
                high -= 1
        return out


def merge_diagonals(anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping or touching matches on one diagonal become one exact run."""
    out: list[tuple[int, int, int]] = []
    for diagonal, x, n in sorted((y - x, x, n) for x, y, n in anchors):
        if out and out[-1][1] - out[-1][0] == diagonal and x <= out[-1][0] + out[-1][2]:
            x0, y0, n0 = out[-1]
            out[-1] = (x0, y0, max(n0, x + n - x0))
        else:
            out.append((x, x + diagonal, n))
    return sorted(out)


def chain(anchors: list[tuple[int, int, int]], gap_cost: float = GAP_COST, widest: int = WIDEST_GAP) -> list[list[tuple[int, int, int]]]:
    """Collinear chains of (x, y, length) matches, best first, each match in one chain.

    A match may follow another that ends before it in both texts, by at most
    ``widest`` in each. With a gap cost that is linear in the characters skipped
    in either text, the score of a link splits into a part of each match alone, so
    the best predecessor is a maximum over a range of ends in y, while matches are
    visited in order of x and ends too far back in x are dropped. All chains are
    traced back from one pass: the best end first, each as far as a match that a
    better chain has.
    """
    anchors = merge_diagonals(anchors)
    if len(anchors) == 1:
        return [anchors]
    by_y = sorted(range(len(anchors)), key=lambda i: (anchors[i][1] + anchors[i][2], i))
    rank = {i: r for r, i in enumerate(by_y)}
    ends = [anchors[i][1] + anchors[i][2] for i in by_y]
    tree = Fenwick(len(anchors))
    score, back = [0.0] * len(anchors), [-1] * len(anchors)
    by_x = sorted(range(len(anchors)), key=lambda i: (anchors[i][0] + anchors[i][2], i))
    put = dropped = 0
    for i, (x, y, n) in enumerate(anchors):
        while put < len(by_x) and (e := sum(anchors[by_x[put]][::2])) <= x:
            j = by_x[put]
            tree.put(rank[j], (score[j] + gap_cost * (e + anchors[j][1] + anchors[j][2]), -j))
            put += 1
        while dropped < put and sum(anchors[by_x[dropped]][::2]) < x - widest:
            tree.drop(rank[by_x[dropped]])
            dropped += 1
        value, j = tree.top(bisect.bisect_left(ends, y - widest), bisect.bisect_right(ends, y))
        score[i] = n
        if value - gap_cost * (x + y) > 0:
            score[i], back[i] = n + value - gap_cost * (x + y), -j
    used, out = [False] * len(anchors), []
    for i in sorted(range(len(anchors)), key=lambda i: (-score[i], i)):
        picked = []
        while i >= 0 and not used[i]:
            used[i] = True
            picked.append(anchors[i])
            i = back[i]
        if picked:
            out.append(picked[::-1])
    return out


def chains(documents: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, centre, start, end, centre_start, centre_end, exact_chars, longest_run, anchors) for each chain."""
    found = matches(documents, span, k).distinct()
    near = found.repartition("doc_id", "centre").sortWithinPartitions("doc_id", "centre")

    def close(doc_id: int, centre: int, group: list[tuple[int, int, int]]) -> Iterator[tuple]:
        for c in chain(group):
            yield doc_id, centre, c[0][0], c[-1][0] + c[-1][2], c[0][1], c[-1][1] + c[-1][2], sum(n for _, _, n in c), max(n for _, _, n in c), [list(a) for a in c]

    columns = ["doc_id", "centre", "start", "end", "centre_start", "centre_end", "exact_chars", "longest_run", "anchors"]

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows of one pair follow each other; a pair is as many rows as its texts have common places
        key, group, out = None, [], []
        for b in batches:
            for doc_id, centre, x, y, n in zip(*(b[c].tolist() for c in ("doc_id", "centre", "pos", "centre_pos", "n"))):
                if key != (doc_id, centre):
                    if key is not None:
                        out.extend(close(*key, group))
                    key, group = (doc_id, centre), []
                group.append((x, y, n))
            if out:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if key is not None:
            yield pd.DataFrame(list(close(*key, group)), columns=columns)

    return near.mapInPandas(link, "doc_id long, centre long, start long, end long, centre_start long, centre_end long, exact_chars long, longest_run long, anchors array<array<long>>")


def sharing_documents(documents: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id): documents with a run of ``span`` or more characters that another document has too.

    Characters are code points exactly as stored. Null and shorter texts share
    nothing; rows with a null doc_id are ignored. Rows of the same doc_id count
    as one document: a run found only among them is not shared.
    """
    runs = chains(documents, span, k).where(F.col("longest_run") >= span)
    return runs.select(F.explode(F.array("doc_id", "centre")).alias("doc_id")).distinct()


def shared_share(documents: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share): the part of each sharing document that lies in exact runs found elsewhere."""
    anchors = chains(documents, span, k).where(F.col("longest_run") >= span).select("doc_id", "centre", F.explode("anchors").alias("a")).where(F.col("a")[2] >= span)
    mine = anchors.select("doc_id", F.col("a")[0].alias("s"), (F.col("a")[0] + F.col("a")[2]).alias("e"))
    theirs = anchors.select(F.col("centre").alias("doc_id"), F.col("a")[1].alias("s"), (F.col("a")[1] + F.col("a")[2]).alias("e"))
    # distinct stretches of a document are at most as many as its places, however many records share them
    stretches = mine.unionByName(theirs).groupBy("doc_id", "s").agg(F.max("e").alias("e")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("r"))
    zero = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("upto"))
    union = F.aggregate("r", zero, lambda acc, x: F.struct((acc["covered"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], acc["upto"]))).alias("covered"), F.greatest(acc["upto"], x["e"]).alias("upto")))
    sizes = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    return stretches.select("doc_id", union["covered"].alias("shared_chars")).join(sizes, "doc_id").select("doc_id", "n_chars", "shared_chars", (F.col("shared_chars") / F.col("n_chars")).alias("share"))


def _same(a: str, b: str) -> int:
    """Characters that an alignment of two short stretches keeps (longest common subsequence, bit-parallel)."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def passages(documents: DataFrame, span: int = SPAN, k: int = K, identity: float = IDENTITY) -> DataFrame:
    """(doc_id, centre, start, end, centre_start, centre_end, identity): aligned fuzzy passages.

    Each chain's gaps are aligned, and a chain is parted at gaps that do not agree.
    What is left is a passage if it has at least ``span`` characters in both texts
    and if its identity, twice the aligned characters over the characters of both
    sides, reaches ``identity``. Texts meet only for linked documents; of rows that
    share a doc_id, the largest text stands for the document.
    """
    found = cut(chains(documents, span, k).where((F.col("end") - F.col("start") >= span) & (F.col("centre_end") - F.col("centre_start") >= span)))
    place = ["doc_id", "centre", "start", "end", "centre_start", "centre_end"]
    whole = found.where(F.size("anchors") == 1).select(*place, F.lit(1.0).alias("identity"))
    # chains with gaps take the two stretches of text along, which are cut out in one pass over the texts
    gaps = found.where(F.size("anchors") > 1)
    texts = documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= span)).groupBy(F.col("doc_id").alias("_doc")).agg(F.max("text").alias("text"))
    own = F.struct(F.col("doc_id").alias("_doc"), F.col("start").alias("a"), F.col("end").alias("b"), F.lit(True).alias("own"))
    other = F.struct(F.col("centre").alias("_doc"), F.col("centre_start").alias("a"), F.col("centre_end").alias("b"), F.lit(False).alias("own"))
    sides = cut(gaps.select(*place, F.explode(F.array(own, other)).alias("s")).select(*place, "s.*"))
    piece = F.substring("text", (F.col("a") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int"))
    pieces = salted_lookup(sides, "_doc", texts, "inner").select(*place, "own", piece.alias("piece"))
    pairs = pieces.groupBy(*place).agg(F.max(F.when(F.col("own"), F.col("piece"))).alias("text"), F.max(F.when(~F.col("own"), F.col("piece"))).alias("other"))
    both = gaps.join(pairs, place)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, centre, anchors, start, centre_start, text, other in zip(b["doc_id"].tolist(), b["centre"].tolist(), b["anchors"], b["start"].tolist(), b["centre_start"].tolist(), b["text"], b["other"]):
                kept, first, end = 0, None, (0, 0)

                def close() -> None:
                    x, y = end[0] - first[0], end[1] - first[1]
                    if x >= span and y >= span and 2 * kept >= identity * (x + y):
                        out.append((doc_id, centre, first[0], end[0], first[1], end[1], 2 * kept / (x + y)))

                for x, y, n in (map(int, a) for a in anchors):
                    if first is None:
                        first = (x, y)
                    else:
                        same, most = _same(text[end[0] - start : x - start], other[end[1] - centre_start : y - centre_start]), max(x - end[0], y - end[1])
                        if same < GAP_IDENTITY * most and most > 20:
                            close()
                            kept, first = 0, (x, y)
                        else:
                            kept += same
                    kept, end = kept + n, (x + n, y + n)
                close()
            yield pd.DataFrame(out, columns=["doc_id", "centre", "start", "end", "centre_start", "centre_end", "identity"])

    return whole.unionByName(both.mapInPandas(align, "doc_id long, centre long, start long, end long, centre_start long, centre_end long, identity double"))
