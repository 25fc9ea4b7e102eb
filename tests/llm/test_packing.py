import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.packing import pack_items, packed_sequences, plan_packs, slots


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20))
def test_plan_uses_up_the_histogram(hist):
    plan = plan_packs(hist, 50)
    used = Counter()
    for packs, pattern in plan:
        assert packs > 0 and sum(pattern) <= 50
        for n in pattern:
            used[n] += packs
    assert used == Counter(hist)
    tokens = sum(k * v for k, v in hist.items())
    assert sum(p for p, _ in plan) <= max(1, -(-tokens * 2 // 50)) if hist else not plan
    ranks = Counter()
    for length, start, end, *_ in slots(plan):
        assert start == ranks[length]
        ranks[length] = end
    assert ranks == Counter(hist)


def test_round_trip_with_dirty_rows(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 7 == 0 else i, [rng.randrange(9) for _ in range(rng.choice([0, 1, 5, 30, 64, 200]))], -1, 99) for i in range(200)]
    rows += [(1000, 1, None, 5, 1), (1001, None, [1] * 64, None, 1), (1001, None, [1] * 64, None, 1), (None, None, [2] * 3, 3, 1)]
    df = spark.createDataFrame(rows, "sample_id long, doc_id long, input_ids array<int>, length int, pack_id long")
    got = pack_items(df, 64, keep_tokens=True).collect()
    assert sum(r.n_tokens for r in got) == sum(len(r[2] or ()) for r in rows)
    assert sum(r.pack_id is None for r in got) == sum(not r[2] for r in rows)
    places = Counter((r.pack_id, r.pack_offset + i) for r in got if r.n_tokens for i in range(r.n_tokens))
    assert max(places.values()) == 1 and all(p < 64 for _, p in places)
    whole = {}
    for r in got:
        whole.setdefault((r.sample_id, r.doc_id), []).append((r.piece, tuple(r.tokens) if r.n_tokens else ()))
    for s, d, ids, _, _ in rows:
        want = ids or []
        assert [x for _, t in sorted(set(whole[s, d])) for x in t] == want
        if len(want) <= 64:
            assert {p for p, _ in whole[s, d]} == {0}
    seqs = packed_sequences(df, 64).collect()
    assert all(len(r.input_ids) == r.n_tokens <= 64 for r in seqs)
    assert Counter(x for r in seqs for x in r.input_ids) == Counter(x for r in rows for x in r[2] or ())


def test_hot_length_is_salted(spark, monkeypatch):
    monkeypatch.setattr("quern.llm.packing.ROWS_PER_SLICE", 10)
    df = spark.createDataFrame([(i, i, [1] * (3 if i % 3 else 5)) for i in range(120)], "sample_id long, doc_id long, input_ids array<int>")
    got = pack_items(df, 16).collect()
    assert len(got) == 120 and len({(r.pack_id, r.pack_offset) for r in got}) == 120


def test_empty_table(spark):
    df = spark.createDataFrame([], "sample_id long, doc_id long, input_ids array<int>")
    assert pack_items(df).count() == 0 and packed_sequences(df).count() == 0
