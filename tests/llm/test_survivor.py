import random
from itertools import product

from quern.llm.components import connected_groups
from quern.llm.survivor import branch_and_bound, chosen_bundles, survivors

SCHEMA = "doc_id long, ts long, length int, url string, lang string, warc_date string, group_id string, signature array<long>"


def run(spark, records, pairs):
    groups = connected_groups(spark.createDataFrame(pairs, "u long, v long"))
    return {r.group_id: r for r in survivors(spark.createDataFrame(records, SCHEMA), groups).collect()}


def test_choice_order_and_bundles(spark):
    records = [
        (1, 100, 5, "u1", "en", "d1", "x", None),
        (2, 100000000000000, 1, None, None, None, "x", None),  # milliseconds: 10^11 s
        (3, 0, 9, "u3", "de", None, "x", None),
        (3, 0, 9, "u3", "de", None, "x", None),
        (10, None, -1, "", None, " ", "x", None),
        (11, 0, None, "u", "fr", "d", "x", None),
        (20, 5, 5, None, None, None, "x", None),
        (None, 5, 5, None, None, None, "x", None),
        (30, 7, 1, "a", None, "d", "x", None),
        (31, 6, 1, "a", "pt", None, "x", None),
        (32, 6, 9, "b", "es", "e", "x", None),
    ]
    got = run(spark, records, [(1, 2), (2, 3), (10, 11), (20, 20), (40, 41), (30, 31), (31, 32)])
    assert set(got) == {1, 10, 30}
    assert (got[1].doc_id, got[1].url, got[1].warc_date, got[1].lang, got[1].filled) == (2, "u1", "d1", "en", "url,warc_date,lang")
    assert got[10].doc_id == 11
    # lang depends on url, which the survivor has: pt was seen with url a, es was not
    assert (got[30].doc_id, got[30].lang) == (30, "pt")


def test_branch_and_bound_is_optimal():
    rng = random.Random(1)
    for _ in range(200):
        options = [sorted([(rng.randrange(1, 50), {f"f{b}": rng.randrange(4)}) for _ in range(rng.randrange(4))], key=lambda x: -x[0]) + [(0, {})] for b in range(3)]
        bad = {(rng.randrange(4), rng.randrange(4)) for _ in range(6)}

        def allowed(c):
            return (c.get("f0"), c.get("f1")) not in bad and (c.get("f1"), c.get("f2")) not in bad

        want = max(sum(t for t, _ in c) for c in product(*options) if allowed({k: v for _, x in c for k, v in x.items()}))
        assert branch_and_bound(options, allowed)[0] == want


def test_empty_and_random(spark):
    assert run(spark, [], [(1, 2)]) == {}
    rng = random.Random(4)
    pick = lambda *x: rng.choice([None, *x])
    records = [(rng.randrange(60), pick(0, 5, 9), pick(-1, 3, 4), pick("a", "b", ""), pick("en", "de"), pick("1", "2"), "g", None) for _ in range(200)]
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    got = run(spark, records, pairs)
    for g, r in got.items():
        assert r.url != "" and isinstance(r.filled, str)


def test_no_fillable_field_stays_null(spark):
    records = [
        (1, 9, 1, "u", None, None, "x", None),  # dates: with no url, with another, and a newer one with another
        (2, 5, 1, None, None, "d2", "x", None),
        (3, 6, 1, "v", "en", "d3", "x", None),
        (10, 9, 1, "u", "de", None, "x", None),  # only beside another url
        (11, 5, 1, "v", "de", "d", "x", None),
        (20, 9, 1, None, None, None, "x", None),  # no whole bundle; the language goes with the url
        (21, 5, 1, "u", "de", None, "x", None),
        (22, 6, 1, None, "en", "d", "x", None),
        (30, 9, 1, "u", "de", None, "x", None),  # a whole bundle that agrees comes first
        (31, 1, 1, "u", None, "d1", "x", None),
        (32, 6, 1, None, "en", "d2", "x", None),
    ]
    got = run(spark, records, [(1, 2), (2, 3), (10, 11), (20, 21), (21, 22), (30, 31), (31, 32)])
    assert {g: (r.doc_id, r.url, r.lang, r.warc_date, r.filled) for g, r in got.items()} == {
        1: (1, "u", "en", "d2", "warc_date,lang"),
        10: (10, "u", "de", "d", "warc_date"),
        20: (20, "u", "de", "d", "url,warc_date,lang"),
        30: (30, "u", "de", "d1", "warc_date"),
    }


def test_null_only_where_the_group_has_nothing(spark):
    rng = random.Random(5)
    pick = lambda *x: rng.choice([None, None, *x])
    records = [(i, rng.randrange(9), 1, pick("a", "b", "c"), pick("en", "de"), pick("1", "2"), "g", None) for i in range(200)]
    got = run(spark, records, [(i, i - i % 4) for i in range(200)])
    assert set(got) == set(range(0, 200, 4))
    for g, r in got.items():
        group = records[g : g + 4]
        own = next(x for x in group if x[0] == r.doc_id)
        for i, f in ((3, "url"), (4, "lang"), (5, "warc_date")):
            values = {x[i] for x in group} - {None}
            assert r[f] == own[i] if own[i] else r[f] in (values or {None})
            assert (f in r.filled.split(",")) == (own[i] is None and bool(values))


def hidden_trust(r):
    return sum(x is not None for x in r[3:6]) * (1 << 38) + r[1]


def test_best_url_and_language_same_as_exhaustive_search(spark):
    """Survivors with nothing but a time; no record has a date, so url and language are chosen under the dependency alone."""
    rng = random.Random(11)
    pick = lambda *x: rng.choice([None, *x])
    records, groups = [], {}
    for g in range(0, 400, 10):
        rows = [(g, 1000, 1, None, None, None, "g", None)] + [(g + i, rng.randrange(1, 900), 1, pick("a", "b", "c", "d"), pick("en", "de", "fr"), None, "g", None) for i in range(1, rng.randrange(2, 10))]
        groups[g] = rows
        records += rows
    survived = survivors(spark.createDataFrame([(a, b, c, d, f, e, h, i) for a, b, c, d, e, f, h, i in records], "doc_id long, ts long, length int, url string, warc_date string, lang string, group_id string, signature array<long>"), connected_groups(spark.createDataFrame([(r[0], g) for g, rs in groups.items() for r in rs if r[0] != g], "u long, v long")))
    got = {r.group_id: r for r in survived.collect()}
    assert set(got) == set(groups)
    for g, rows in groups.items():
        best = {f: {} for f in (3, 4)}
        for r in rows[1:]:
            for f in (3, 4):
                if r[f]:
                    best[f][r[f]] = max(best[f].get(r[f], 0), hidden_trust(r))
        beside = {}
        for r in rows[1:]:
            if r[3] and r[4]:
                beside.setdefault(r[3], set()).add(r[4])
        worth = lambda u, x: best[3].get(u, 0) + best[4].get(x, 0)
        allowed = [(u, x) for u in (best[3] or {None: 0}) for x in (best[4] or {None: 0}) if u not in beside or x in beside[u]]
        r = got[g]
        assert r.doc_id == g and (r.url, r.lang) in allowed and worth(r.url, r.lang) == max(worth(u, x) for u, x in allowed), (rows, r)
        for f, i in (("url", 3), ("lang", 4)):
            assert r[f] is None or any(x[0] == r[f"{f}_from"] and x[i] == r[f] and hidden_trust(x) == best[i][r[f]] for x in rows)
    told = {(r.group_id, r.field): (r.value, r.source_doc_id, r.bundle) for r in chosen_bundles(survived).collect()}
    assert all(told.get((g, "url")) == (None if r.url is None else (r.url, r.url_from, "url+warc_date")) for g, r in got.items())


def test_two_dependencies(spark):
    rng = random.Random(12)
    pick = lambda *x: rng.choice([None, *x])
    records = [(i, rng.randrange(9), 1, pick("a", "b"), pick("en", "de"), pick("1", "2"), "g", None) for i in range(120)]
    groups = connected_groups(spark.createDataFrame([(i, i - i % 4) for i in range(120)], "u long, v long"))
    df = spark.createDataFrame(records, SCHEMA)
    rows = survivors(df, groups, (("url",), ("lang",), ("warc_date",)), (("url", "lang"), ("lang", "warc_date"))).collect()
    assert len(rows) == 30
    for r in rows:
        group = records[r.group_id : r.group_id + 4]
        for a, b, i, j in ((r.url, r.lang, 3, 4), (r.lang, r.warc_date, 4, 5)):
            seen = {x[j] for x in group if a and x[i] == a and x[j]}
            own = next(x for x in group if x[0] == r.doc_id)
            assert not (seen and b) or b in seen or own[j]  # what the survivor has itself stays
