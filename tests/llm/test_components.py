import random

import pytest

from quern.functions.dist import salted_lookup
from quern.llm.components import connected_groups


def union_find(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def groups(spark, pairs):
    df = spark.createDataFrame([(a, b, 0, "x") for a, b in pairs], "u long, v long, group_id int, node string")
    rows = connected_groups(df).collect()
    assert len(rows) == len({r.node_id for r in rows})
    return {r.node_id: r.group_id for r in rows}


def cases():
    rng = random.Random(5)
    star = [(5000, i) for i in range(300)]
    path = [(i, i + 1) for i in range(1000, 1120)]
    ring = [(2000 + i, 2000 + (i + 1) % 37) for i in range(37)]
    sparse = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    dense = [(3000 + rng.randrange(30), 3000 + rng.randrange(30)) for _ in range(150)]
    dirty = [(None, 7), (7, None), (None, None), (9001, 9001), (9002, 9001), (9001, 9002), (9009, 9009)]
    lollipop = [(4000, 4001), (4001, 4002), (4002, 4000), (4000, 4010), (4010, 4011), (4011, 4012)]
    return star + path + ring + dense + dirty + lollipop, sparse + dirty, [], [(None, 1)], [(-3, 4), (4, -3)]


@pytest.mark.parametrize("core", [1_000_000, 0])
@pytest.mark.parametrize("pairs", cases(), ids=range(len(cases())))
def test_same_as_union_find(spark, pairs, core, monkeypatch):
    monkeypatch.setattr("quern.llm.components.CORE_EDGES", core)
    assert groups(spark, pairs) == union_find(pairs)


def test_lookup_with_hot_key(spark):
    big = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)] + [(300, None)], "id long, k long")
    small = spark.createDataFrame([(i, i * 10) for i in range(200)], "k long, w long")
    got = {r.id: r.w for r in salted_lookup(big, "k", small, rows_per_slice=20).collect()}
    assert got == {i: (10 if i % 3 else (i * 10 if i < 200 else None)) for i in range(300)} | {300: None}
