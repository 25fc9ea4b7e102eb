import random
from collections import Counter

import pytest

from quern.llm.repetition import MEASURES, POLICIES, ablations, fails, ledger, measure


def stretches(text):
    letters = [c.lower() for c in text if c.isalpha()]
    seen, cover = set(), set()
    for i in range(len(letters) - 29):
        g = tuple(letters[i : i + 30])
        if g in seen:
            cover.update(range(i, i + 30))
        seen.add(g)
    return len(cover) / max(1, len(letters))


def slow(text):
    lines = [x for x in text.split("\n") if x.strip()]
    dense = sum(not c.isspace() for c in text)
    out = {"letter_stretches": stretches(text)}
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out["dup_lines"] = len(again) / max(1, len(lines))
    out["dup_line_chars"] = sum(len("".join(x.split())) for x in again) / max(1, dense)
    words = text.split()
    for n in (2, 3, 4):
        c = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        top = max(((k, k * sum(map(len, g)) if k > 1 else 0) for g, k in c.items()), default=(0, 0))
        out[f"top_{n}gram_chars"] = min(1.0, top[1] / max(1, dense))
    for n in (5, 10):
        seen, cover = set(), set()
        for i in range(len(words) - n + 1):
            g = tuple(words[i : i + n])
            if g in seen:
                cover.update(range(i, i + n))
            seen.add(g)
        out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in cover) / max(1, dense)
    return out


def texts():
    rng = random.Random(8)
    vocab = ["alpha", "Beta", "GAMMA", "düse", "中文字", "e", "x1"]
    out = ["", "a", "ab " * 40, "x" * 29, "x" * 30, "x" * 31, "1234 " * 50, "\n\n", "a\n\nb\n\na\n\nb", "İstanbul " * 9]
    for _ in range(60):
        line = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 12))]
        out.append("\n".join(rng.choice(line) for _ in range(rng.randrange(1, 20))))
    return out


def test_same_as_brute_force():
    all_ = texts()
    got = measure(all_)
    for i, t in enumerate(all_):
        for m, v in slow(t).items():
            assert got[m][i] == pytest.approx(v), (m, t)


def test_ledger_policies_and_ablations(spark):
    all_ = texts()
    rows = [(i, t, 0.5 if i % 2 else None, 7) for i, t in enumerate(all_)] + [(900, None, float("nan"), 7), (900, None, 0.1, 7), (None, "x", 0.0, 7)]
    led = ledger(spark.createDataFrame(rows, "doc_id long, text string, m_dup_line double, failed int"))
    got = led.collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in led.where(fails("found")).collect()} == {i for i, t in enumerate(all_) if 3 * stretches(t) >= 1}
    table = {(r.policy, r.rule): r for r in ablations(led).collect()}
    assert set(table) == {(p, m) for p, ms in POLICIES.items() for m in ms}
    for (p, m), r in table.items():
        hits = [{x for x in POLICIES[p] if g.failed >> MEASURES.index(x) & 1} for g in got]
        assert (r.n_failed, r.n_by_rule, r.n_only_rule) == (sum(bool(h) for h in hits), sum(m in h for h in hits), sum(h == {m} for h in hits))


def test_empty(spark):
    led = ledger(spark.createDataFrame([], "doc_id long, text string, m_dup_line double"))
    assert led.count() == 0 and ablations(led).count() == 0


def test_stored_ledger(spark, tmp_path):
    from quern.llm import repetition

    docs = spark.createDataFrame([(1, "ab " * 90, 0.5), (2, "one two", None)], "doc_id long, text string, m_dup_line double")
    path = str(tmp_path / "ledger")
    first = sorted(map(tuple, repetition.stored_ledger(docs, path).collect()))
    assert first == sorted(map(tuple, repetition.stored_ledger(docs.limit(0), path).collect())) == sorted(map(tuple, repetition.ledger(docs).collect()))
    assert {r.rules for r in repetition.stored_ledger(docs, path).collect()} == {repetition.RULES_VERSION}
    repetition.ledger(docs).withColumn("rules", repetition.F.lit(0)).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError):
        repetition.stored_ledger(docs, path)
