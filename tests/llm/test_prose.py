import os
import re

import numpy as np
import pytest

from quern.llm.prose import MEASURES, WEIGHTS, Lines, lexicon, measure, not_prose, statistics

SF = "/root/testdata/sf0.1"
COMMON = ["the", "a", "of", "and", "is", "in", "to", "for", "le", "la", "de", "et", "der", "die", "und", "ist", "的", "了", "是", "我们", "也"]
KNOWN = lexicon(COMMON)
SENTENCE = "The mill is in the valley of the river and the road leads to the sea."

PROSE = [
    SENTENCE, SENTENCE.upper(), SENTENCE.rstrip("."), f'"{SENTENCE}"', "\n".join([SENTENCE] * 9), "- " + SENTENCE + "\n- A second part of the walk leads to the old town and the sea",
    "这座石塔影响了河边的村小学，我们也看到了山后的灯塔。", "Le moulin de la colline et la gare de la ville sont fermés en hiver.",
    # languages whose words are not listed, and short sentences
    "Kot śpi na kanapie, a pies biega po ogrodzie.", "Wczoraj padał deszcz. Dzisiaj świeci słońce.", "Вчера мы гуляли в парке. Дети кормили уток и смеялись.", "Il gatto dorme sul divano mentre il cane corre in giardino.",
    "Children played outside. Dogs barked loudly. Everyone laughed.", "昨日は雨が降りました。今日は晴れています。", "Η γάτα κοιμάται στον καναπέ και ο σκύλος τρέχει.",
]
JUNK = [
    "\n".join(f"| the mill | Place{i} | {i}.5 | 7.25 |" for i in range(9)), "\n".join(f"{i}. the mill" for i in range(9)), "\n".join(f"the mill: {i}.20 kg" for i in range(9)),
    "board, choir, school, barrier, fence, group, hall, league, team", "kqwj xkcv bnnq wwzt " * 9, "0001 0a ff 3c 2d 99 10 " * 9, "var a = b(12);\nif (a.b > 3) {\n} else { c[d] = 4; }", "\n".join("the mill of the valley." for _ in range(5)),
    "\n".join(f"the mill      Town{i:<6}    {i}.50     3.20" for i in range(9)), "老街上的灯塔。\n山后的茶馆。\n湖边的石塔。\n城墙外的舞厅。", "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVoxMjM0NTY3ODkwYWJjZGVmZ2hpams=", "the mill » the road » the town » the sea", "ÃÂâ€œ™ Ÿ¿½¼ »†‡Ñ ÃÂ™ œ™Ÿ",
]


@pytest.mark.parametrize("text", PROSE)
def test_prose(text):
    assert measure([text], KNOWN)["sentence_share"][0] >= 0.5


@pytest.mark.parametrize("text", JUNK)
def test_junk(text):
    assert measure([text], KNOWN)["sentence_share"][0] < 0.5


def test_a_batch_is_its_texts():
    texts = [*PROSE, "", " \n\t", *JUNK, "x", "\r\n\r\n", "a\rb\r\nc\nd"]
    whole = measure(texts, KNOWN)
    for i, t in enumerate(texts):
        assert all(measure([t], KNOWN)[m][0] == pytest.approx(whole[m][i]) for m in MEASURES), t
    assert whole["lines"][-1] == 4 and whole["lines"][-2] == 0 and measure([], KNOWN)["lines"].tolist() == []


def test_counts_same_as_plain_python():
    texts = PROSE + JUNK
    got = measure(texts, KNOWN)
    for i, t in enumerate(texts):
        size = sum(not c.isspace() for c in t)
        lines = [x for x in t.split("\n") if x.strip()]
        assert got["lines"][i] == len(lines)
        assert got["symbol_ratio"][i] == pytest.approx(sum(not c.isspace() and not c.isalpha() and not c.isdigit() for c in t) / size)
        assert got["digit_ratio"][i] == pytest.approx(sum(c.isdigit() for c in t) / size)
        if t.isascii():
            words = re.findall(r"[a-z]+", t.lower())
            assert got["n_words"][i] == len(words) and got["common_word_share"][i] == pytest.approx(sum(w in COMMON for w in words) / max(1, len(words)))


def test_alignment_same_as_comparing_columns():
    rows = ["the mill   Town    3.5", "the road   Sea     2.5", "nothing here", "the hill   Vale   1", "a | b | c", "d | e | f", "x"]
    x = Lines(["\n".join(rows)], KNOWN)

    def columns(r):
        return {m.end() for m in re.finditer(r"(?<=\S)\s{2,}(?=\S)", r)}

    def like(p, q):
        if min(len(columns(p)), len(columns(q))) >= 2 and len(columns(p) & columns(q)) * 2 >= min(len(columns(p)), len(columns(q))):
            return True
        return any(p.count(c) and p.count(c) == q.count(c) for c in "|;\t=")

    want = [any(0 <= j < len(rows) and like(rows[min(i, j)], rows[max(i, j)]) for j in (i - 1, i + 1)) for i in range(len(rows))]
    assert x.alignment.tolist() == [float(w) for w in want]


def test_periodicity_and_autocorrelation():
    every = Lines(["\n".join("- item" for _ in range(8))], KNOWN)
    assert every.periodicity.min() == 1 and every.autocorrelation.min() == 1
    pairs = Lines(["\n".join(["# Head one", "and some more text"] * 6)], KNOWN)  # a period of two lines
    assert pairs.periodicity[2:-2].min() == 1 and pairs.autocorrelation[2:-2].min() > 0.99
    ragged = Lines(["One.\n" + "word " * 40 + "\n- a line of other length\nAnd a last line that is longer than the one before it, and of other kind; it ends so;"], KNOWN)
    assert ragged.periodicity.max() == 0 and ragged.autocorrelation.max() < 0.8
    apart = Lines(["- a", "- b", "- c"], KNOWN)  # lines of other texts are no neighbours
    assert apart.periodicity.max() == apart.autocorrelation.max() == apart.alignment.max() == 0
    a, b = 12.0, 30.0
    two = Lines(["x" * 12 + "\n" + "y" * 30 + "\n" + "x" * 12], KNOWN)
    assert two.autocorrelation[1] == pytest.approx(a * b / ((a * a + b * b) / 2))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_shape_signal_decides_documents():
    import pandas as pd

    texts = pd.read_parquet(f"{SF}/documents.parquet", columns=["text"])["text"].dropna().tolist()
    known = lexicon(pd.read_parquet(f"{SF}/common_words.parquet")["word"].dropna().tolist())

    def found(weights):
        m = measure(texts, known, weights=weights)
        return frozenset(np.flatnonzero((m["lines"] > 0) & (m["sentence_share"] < 0.5)).tolist())

    every = found(WEIGHTS)
    for signal in ("alignment", "periodicity", "autocorrelation", "cells", "garbled"):
        assert len(found(WEIGHTS | {signal: 0.0}) ^ every) >= 10, signal


def test_rows_and_dirty_texts(spark):
    texts = [SENTENCE, JUNK[0], None, "", " \n\t ", "x" * 100_000, "\r\n".join([SENTENCE] * 2)]
    df = spark.createDataFrame([(i, t, None if i % 2 else 0.5, 0.1, 0.2, 9.0) for i, t in enumerate(texts)] + [(0, SENTENCE, 0.1, 0.1, 0.1, 9.0)], "doc_id long, text string, m_non_ws double, m_alpha_cjk double, m_punct double, sentence_share double")
    words = spark.createDataFrame([(w, "en") for w in COMMON] + [(None, "en"), ("", "en")], "word string, lang string")
    stats = statistics(df, words)
    rows = stats.collect()
    assert len(rows) == len(texts) + 1 and set(MEASURES) < set(stats.columns)
    assert {r.doc_id for r in not_prose(stats).collect()} == {1, 5}
    assert all(r.lines == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert statistics(df.limit(0), words).count() == 0 and statistics(df, words.limit(0)).count() == len(rows)
