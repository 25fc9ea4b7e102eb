import random

import numpy as np
import pytest

from quern.llm.batches import prefix_hashes, sliding_min, span_hashes, window_hashes
from quern.llm.spans import Fenwick, _same, chain, merge_diagonals, passages, seeds, sharing_documents, shared_share


def test_batch_helpers():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 300).astype(np.uint64)
    for w in (1, 7, 300, 301):
        assert sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
    p = prefix_hashes(x)
    h = window_hashes(p, 5)
    spans = {}
    for i in range(296):
        assert h[i] == span_hashes(p, np.array([i]), np.array([i + 5]))[0]
        assert spans.setdefault(tuple(x[i : i + 5]), h[i]) == h[i]
    assert len(set(spans.values())) == len(spans)


def corpus():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefgh äß中") for _ in range(n))
    docs = [(i, word(rng.randrange(0, 400))) for i in range(60)]
    n = 100
    for length in (39, 40, 41, 60, 90, 200):
        for _ in range(4):
            run = word(length)
            for _ in range(rng.choice([2, 2, 3, 6])):
                docs.append((n, word(rng.randrange(0, 60)) + run + word(rng.randrange(0, 60))))
                n += 1
    boiler = word(35)  # a short common stretch in very many contexts
    docs += [(1000 + i, word(30) + boiler + word(i % 9) + "zz" + word(20)) for i in range(60)]
    docs += [(2000, "q" * 300), (2001, None), (2002, ""), (2003, "xy" * 100), (2004, "yx" * 100), (2005, "p" * 300), (2005, "p" * 300), (None, "q" * 300)]
    return docs


def brute(docs, span):
    where = {}
    for d, t in docs:
        if d is not None and t:
            for i in range(len(t) - span + 1):
                where.setdefault(t[i : i + span], set()).add(d)
    return {d for s in where.values() if len(s) > 1 for d in s}, where


@pytest.mark.parametrize(("k", "most"), [(20, 20_000), (31, 20_000), (20, 3), (12, 1)])
def test_same_as_brute_force(spark, k, most, monkeypatch):
    monkeypatch.setattr("quern.llm.spans.CLASSES_PER_SLICE", most)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("x", "y")
    want, where = brute(docs, 40)
    assert {r.doc_id for r in sharing_documents(df, 40, k).collect()} == want
    share = {r.doc_id: r for r in shared_share(df, 40, k).collect()}
    assert set(share) == want
    texts = {d: t for d, t in docs if d is not None}
    for d in want:
        cover = set()
        for i in range(len(texts[d]) - 39):
            if len(where[texts[d][i : i + 40]]) > 1:
                cover.update(range(i, i + 40))
        assert share[d].shared_chars == len(cover) and share[d].n_chars == len(texts[d])
    assert all(r.identity >= 0.8 for r in passages(df, 40, k).collect())
    assert seeds(df, 40, k).count() < sum(len(t or "") for _, t in docs) / 4


def repeats():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh äß中") for _ in range(n))
    p, q = word(60), word(60)
    docs = [(1, p + p), (2, p), (3, q), (4, q + q)]  # repeated in the smallest id, and in the largest
    for i in range(5):  # one context twice or more, shared in part with others; ids in any order
        r = word(50)
        inner = [(word(25) + r + word(3) + r + word(25)), r + "!" + r, word(30) + r, r + word(30) + r + word(2), (r + "#" * 5) * 3, ("?" * 45 + r + "?" * 45) * 3]
        docs += list(zip(rng.sample(range(10 + 100 * i, 90 + 100 * i), 6), inner))
    blocks = [word(rng.choice([15, 30, 45, 70])) for _ in range(12)]
    docs += [(1000 + i, "".join(rng.choice([*blocks, word(5)]) for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    docs += [(2000, "xy" * 100), (2001, "yx" * 60), (2002, "z" * 99), (2003, "z" * 50 + word(9) + "z" * 45)]
    return docs


@pytest.mark.parametrize(("k", "most"), [(20, 20_000), (31, 20_000), (20, 3), (12, 1)])
def test_every_copy_counts(spark, k, most, monkeypatch):
    monkeypatch.setattr("quern.llm.spans.CLASSES_PER_SLICE", most)
    docs = repeats()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want, where = brute(docs, 40)
    covers = {}
    for d, t in docs:
        cover = set()
        for i in range(len(t) - 39):
            if len(where[t[i : i + 40]]) > 1:
                cover.update(range(i, i + 40))
        if cover:
            covers[d] = len(cover)
    got = {r.doc_id: (r.shared_chars, r.share) for r in shared_share(df, 40, k).collect()}
    assert {d: c for d, (c, _) in got.items()} == covers and got[1] == (120, 1.0) and got[4] == (120, 1.0)
    assert {r.doc_id for r in sharing_documents(df, 40, k).collect()} == want
    copies = {(r.centre_start, r.centre_end) for r in passages(df, 40, k).where("centre = 1 and doc_id = 2").collect()}
    assert copies == {(0, 60), (60, 120)}


def test_chaining_and_alignment():
    assert chain([(0, 100, 50), (25, 125, 50), (90, 190, 40), (500, 10, 30)]) == [[(0, 100, 75), (90, 190, 40)], [(500, 10, 30)]]
    assert [len(c) for c in chain([(0, 0, 30), (1100, 1100, 30)])] == [1, 1]
    # a far match that is worth more than a near one is out of reach, the near one is not
    assert chain([(0, 0, 5000), (5600, 5600, 300), (5950, 5950, 6000)], 0.5, 400) == [[(5600, 5600, 300), (5950, 5950, 6000)], [(0, 0, 5000)]]
    assert _same("kitten", "sitting") == 4 and _same("", "a") == 0


def test_best_chain_same_as_all_pairs():
    rng = random.Random(4)
    for _ in range(200):
        found = merge_diagonals([(rng.randrange(120), rng.randrange(120), rng.randrange(1, 15)) for _ in range(rng.randrange(2, 25))])
        score = []
        for i, (x, y, n) in enumerate(found):
            reach = [score[j] - 0.5 * (x - a - m + y - b - m) for j, (a, b, m) in enumerate(found[:i]) if 0 <= x - a - m <= 30 and 0 <= y - b - m <= 30]
            score.append(n + max([0, *reach]))
        best = chain(found, 0.5, 30)
        first = best[0]
        got = sum(n for _, _, n in first) - sum(0.5 * (x - a - m + y - b - m) for (a, b, m), (x, y, _) in zip(first, first[1:]))
        assert got == max(score) and sorted(a for c in best for a in c) == sorted(found)


def test_fenwick():
    rng = random.Random(6)
    tree, plain = Fenwick(13), [(float("-inf"), -1)] * 13
    for _ in range(500):
        i, v = rng.randrange(13), (rng.randrange(50), rng.randrange(9))
        if rng.random() < 0.3:
            tree.drop(i)
            plain[i] = (float("-inf"), -1)
        else:
            tree.put(i, v)
            plain[i] = v
        a, b = sorted((rng.randrange(14), rng.randrange(14)))
        assert tree.top(a, b) == max(plain[a:b], default=(float("-inf"), -1))


def test_fuzzy_passage_without_a_long_run(spark):
    """3,000 characters with an edit every 120: no run of 200, but one passage."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    a = word(3000)
    b = "".join(a[i : i + 119] + "#" for i in range(0, 3000, 120))
    df = spark.createDataFrame([(1, word(300) + a + word(300)), (2, b), (3, word(3000))], "doc_id long, text string")
    rows = passages(df).collect()
    assert [(r.doc_id, r.centre) for r in rows] == [(2, 1)] and rows[0].identity > 0.97
    assert rows[0].start < 240 and rows[0].end > 2760 and abs(rows[0].centre_start - rows[0].start - 300) < 3
    assert sharing_documents(df).count() == 0 and shared_share(df).count() == 0
    # two exact passages with unlike text between them stay two
    p, q = word(260), word(260)
    two = spark.createDataFrame([(1, p + word(500) + q), (2, p + word(480) + q)], "doc_id long, text string")
    assert sorted((r.start, r.end, r.identity) for r in passages(two).collect()) == [(0, 260, 1.0), (740, 1000, 1.0)]


def test_fuzzy_passage_is_one_chain(spark):
    rng = random.Random(7)
    a = "".join(rng.choice("abcdefghij") for _ in range(100))
    b = a[:48] + "?!" + a[50:]
    rows = passages(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), 40, 20).collect()
    assert [(r.start, r.end, r.centre_start, r.centre_end) for r in rows] == [(0, 100, 0, 100)] and abs(rows[0].identity - 0.98) < 1e-9


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharing_documents(df).count() == 0 and passages(df).count() == 0
