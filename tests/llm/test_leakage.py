import random

import numpy as np

from quern.llm.leakage import ItemIndex, has_run, leak_report, leaks, words


def brute(text, question):
    d, q = words(text), words(question)
    n = len(q)
    for m in range(max(1, -(-n * 6 // 10)), n + 1):
        for i in range(n - m + 1):
            for j in range(len(d) - m + 1):
                if sum(x != y for x, y in zip(q[i : i + m], d[j : j + m])) <= m // 10:
                    return True
    return False


def test_words():
    assert words("Où EST l’été_2?") == ["ou", "est", "l", "ete", "2"]
    assert words("第1600年 ABC中") == ["第", "1600", "年", "abc", "中"]
    assert words(None) == words("") == words("?!") == []


def test_run_rule():
    a = np.ones(15, bool)
    assert has_run(a)
    a[7] = False  # 14 of 15
    assert has_run(a)
    a[3] = False  # 3 + 1 + ... : words 4..14 hold one exchange in 11
    assert has_run(a)
    a[11] = False
    assert not has_run(a)


def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    line = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, "s", " ".join(line(rng.choice([1, 2, 3, 4, 5, 9, 15, 16, 17, 33, 40])))) for i in range(60)]
    items += [(100, "s", None), (101, "s", ""), (102, "s", "?!"), (103, "s", "如果可以换一个罐那么"), (104, "t", items[20][2])]
    docs = []
    for i in range(150):
        q = words(rng.choice(items)[2])
        if q:
            m = min(len(q), max(1, round(len(q) * rng.choice([0.5, 0.58, 0.6, 0.65, 0.8, 1]))))
            a = rng.randrange(len(q) - m + 1)
            q = q[a : a + m]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                q[rng.randrange(m)] = "other"
        docs.append((i, " ".join(line(rng.randrange(60)) + [x.upper() for x in q] + line(rng.randrange(60)))))
    docs += [(900, None), (901, ""), (902, "我们如果可以换一个罐好"), (902, "x"), (None, items[20][2])]
    return docs, items


def test_same_as_brute_force(spark):
    docs, items = corpus()
    want = {(d, i) for d, t in docs if d is not None and t for i, _, q in items if words(q) and brute(t, q)}
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, suite string, question string")
    got = [tuple(r) for r in leaks(df, it).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    assert {tuple(r) for r in leaks(df, it, block_bytes=20_000).collect()} == want
    report = {r.item_id: r.n_documents for r in leak_report(df, it).collect()}
    assert len(report) == len(items) and report[100] == 0


def test_empty(spark):
    df, it = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, suite string, question string")
    assert leaks(df, it).count() == 0
    assert leaks(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), it).count() == 0
    assert list(ItemIndex([]).search([np.zeros(1, np.uint64)])) == []
