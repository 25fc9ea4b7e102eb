import hashlib
import random

import numpy as np
import pytest

from quern.operators import dedup, minhash
from quern.operators.graph import components


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(700, 760)] + [(None, 3), (4, None), (900, 900), (901, None), (None, 902)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_string_ids(spark):
    got = {r.node: r.component for r in components(spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "x")], "u string, v string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x"}


def test_permutation_values():
    a, b = minhash.permutations()
    assert (int(a[0]), int(a[1]), int(b[0]), int(b[1])) == (6909045635214430971, 14693624575865297083, 128244179682839588, 3037364338235307167)


def test_ngrams_and_hash():
    assert minhash.char_ngrams("test text", 2) == {b"te", b"es", b"st", b"t ", b" t", b"ex", b"xt"}
    assert minhash.char_ngrams("ab", 3) == {b"ab"} and minhash.char_ngrams("", 2) == {b""}
    assert minhash.hash64(b"test") == minhash.hash64(b"test") and 0 <= minhash.hash64(b"test") < 2**64


def test_signatures(spark):
    s = minhash.signature
    assert (s("") == 0).all() and len(s("", 64)) == 64
    assert len(s("aaaaa", 64)) == 64 and s("aaaaa", 64).any()
    assert (s("some text") == s("some text")).all() and not (s("some text", seed=42) == s("some text", seed=123)).all()
    assert not (s("some longer text", n=3) == s("some longer text", n=7)).all()
    assert minhash.jaccard_estimate([1, 2, 3, 4, 5], [1, 2, 6, 7, 8]) == 0.4 and minhash.jaccard_estimate([1], [1]) == 1
    with pytest.raises(ValueError):
        minhash.jaccard_estimate([1], [1, 2])
    near = minhash.jaccard_estimate(s("the quick brown fox jumps over the dog"), s("the quick brown fox jumps over the cat"))
    assert near > minhash.jaccard_estimate(s("the quick brown fox jumps over the dog"), s("nothing in common with it"))
    long = "".join(random.Random(2).choice("abcdefghij") for _ in range(30_000))
    a, b = minhash.permutations()
    h = np.array([minhash.hash64(g) for g in minhash.char_ngrams(long)], np.uint64)
    assert (s(long) == (h[:, None] * a + b).min(axis=0)).all()
    rows = minhash.with_signatures(spark.createDataFrame([(1, "  Some\tTEXT  here "), (2, None), (3, "")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert rows[0].signature == s("some text here").view(np.int64).tolist() and rows[0].length == 18
    assert rows[1].signature == rows[2].signature == [0] * 128 and rows[1].length == 0


def test_clustering(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(300)) for _ in range(6)]
    rows = []
    for i, t in enumerate(base):
        for j in range(i + 1):
            rows.append((i * 100 + j, t[: 300 - j], 5 if j == 1 else 0))
    rows += [(901, None, 0), (902, "", 0), (903, "alone in the world", None), (0, base[0], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ts long")
    c = dedup.Clustering(minhash.with_signatures(df))
    kept = sorted(r.doc_id for r in c.result.collect())
    assert kept == sorted([0, 0, 101, 201, 301, 401, 501, 902, 903])
    stats = c.stats.first()
    assert (stats.total_docs, stats.kept, stats.removed) == (24, 8, 16) and abs(stats.dedup_rate - 16 / 24) < 1e-9
    assert c.sample.count() <= 50
    bands = dedup.band_rows(minhash.with_signatures(df))
    sig = minhash.signature(base[0]).tolist()
    first = bands.where("doc_id = 0 and band_id = 0").first()
    assert first.band_hash == hashlib.sha1(",".join(map(str, sig[:4])).encode()).hexdigest()
    assert bands.count() == 32 * len(rows) and dedup.bucket_pairs(bands).first().buckets > 0


def test_missing_signatures(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, signature array<long>")
    with pytest.raises(Exception, match="signature is missing"):
        dedup.band_rows(df).collect()
    with pytest.raises(ValueError):
        dedup.with_signature_column(spark.createDataFrame([(1,)], "doc_id long"))
    with pytest.raises(ValueError):
        dedup.band_rows(df, 5)
    assert "signature" in dedup.with_signature_column(df.withColumnRenamed("signature", "minhash_sig")).columns
