from quern.llm.mixing import Mixture, tree_budgets, water_fill

TARGETS = "source string, weight double, max_repeats int, language string"


def mix(spark, docs, targets, **kw):
    return Mixture(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, copies int"), spark.createDataFrame(targets, TARGETS), **kw)


def test_shortages_go_to_siblings_first():
    leaves = [{"path": ("a", "en", "a1"), "weight": 1, "cap": 10}, {"path": ("a", "en", "a2"), "weight": 1, "cap": 1000}, {"path": ("b", "en", "b1"), "weight": 2, "cap": 1000}]
    assert tree_budgets(leaves, 200) == {"a1": 10, "a2": 90, "b1": 100}
    leaves[1]["cap"] = 20
    assert tree_budgets(leaves, 200) == {"a1": 10, "a2": 20, "b1": 170}
    assert water_fill([1, 0, 3], [5, 5, 1e9], 100) == [5, 0.0, 95]


def test_shares_repeats_and_dirty_rows(spark, monkeypatch):
    monkeypatch.setattr("quern.llm.mixing.ROWS_PER_BUCKET", 8)
    docs = [(i, "word " * 20, "en", ["Big-One", "big one", " BIG_ONE"][i % 3], 1) for i in range(300)]
    docs += [(1000 + i, "word " * 20, "__label__de", "small", 1) for i in range(10)]
    docs += [(2000, None, None, "big_one", 1), (2001, "", "en", "small", 1), (2002, "x", "en", None, 1), (2003, "x", "en", "  ", 1), (2004, "x", "en", "untargeted", 1)]
    targets = [("big one", 3.0, 1, "x"), ("small", 1.0, 4, None), ("absent", 2.0, 9, None), ("bad", float("nan"), None, None), (None, 5.0, 1, None)]
    m = mix(spark, docs, targets, total="exact")
    rows = m.selected.collect()
    assert all(r.copies <= (1 if r.source_key == "big_one" else 4) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    share = {r.source_key: r for r in m.shares.collect()}
    assert abs(share["big_one"].actual_share - 0.75) < 0.02 and abs(share["small"].actual_share - 0.25) < 0.02
    assert share["absent"].mixed_tokens == 0 and abs(sum(r.actual_share for r in share.values()) - 1) < 1e-9
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(spark, docs, targets, total="exact").selected.collect()))
    full = {r.source_key: r for r in mix(spark, docs, targets).shares.collect()}
    assert full["small"].most_copies == 4 and full["small"].budget == 4 * full["small"].source_tokens


def test_empty_tables(spark):
    m = mix(spark, [], [("a", 1.0, 1, None)])
    assert m.selected.count() == 0 and m.shares.first().actual_share == 0
    assert mix(spark, [(1, "x", "en", "a", 1)], []).shares.count() == 0


def test_selected_rows_are_those_of_the_shares(spark):
    from quern.llm.queries import queries

    d = "/root/testdata/sf0.001"
    found = {name: queries()[name](spark, d).collect() for name in ("p9_mixture", "p9_shares", "p9_mixture_exact", "p9_shares_exact")}
    size = {name: sum(r.n_tokens * r.copies for r in found[name]) for name in ("p9_mixture", "p9_mixture_exact")}
    assert size["p9_mixture"] > size["p9_mixture_exact"]
    for rows, shares in (("p9_mixture", "p9_shares"), ("p9_mixture_exact", "p9_shares_exact")):
        assert size[rows] == sum(r.mixed_tokens for r in found[shares])
        limit = {r.source_key: r.max_repeats for r in found[shares]}
        assert all(r.copies <= limit[r.source_key] for r in found[rows])
    # some source runs out of repeats, and others get its shortage
    short = [r for r in found["p9_shares"] if r.source_tokens and r.actual_share < 0.8 * r.target_share]
    more = [r for r in found["p9_shares"] if r.actual_share > 1.05 * r.target_share > 0]
    assert short and more
