import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from quern.functions import text
from quern.operators.clean import CleanRules, score_clean, split_clean

NON_WS, CJK = re.compile(r"\S"), re.compile(r"[A-Za-z一-鿿]")


def judged(raw, rules):
    t = re.sub("\n{3,}", "\n\n", (raw or "").replace("\r\n", "\n").replace("\r", "\n").strip())
    n = len(t)
    lines = [x.strip() for x in t.split("\n") if x.strip()]
    if n < rules.min_chars:
        return t, "too_short", 0, 0, 0, 0
    if n > rules.max_chars:
        return t, "too_long", 0, 0, 0, 0
    m = len(NON_WS.findall(t)) / n, len(CJK.findall(t)) / n, sum(not re.match(r"[\w\s一-鿿]", c) for c in t) / n
    for bad, reason in ((m[0] < rules.min_non_ws_ratio, "too_sparse"), (m[1] < rules.min_alpha_cjk_ratio, "low_language_signal"), (m[2] > rules.max_punct_ratio, "too_much_punct")):
        if bad:
            return t, reason, *m, 0
    dup = sum(c for c in Counter(lines).values() if c > 1) / len(lines) if len(lines) >= 5 else 0
    return t, "dup_lines" if dup > rules.max_dup_line_ratio else "ok", *m, dup


def samples():
    fill = "The mill is in the valley and the road is long. "
    return [
        None, "", " \x1c\x85 　 ", "short", fill * 5, "　" + fill * 5 + "\x1f\r\n", "a\r\n\r\n\r\n\r\nb\rc" + fill * 5, "x" * 199, "x" * 200, "x" * 200_000, "x" * 200_001,
        ("ab" + " " * 8) * 40, "x" * 140 + " " * 59 + "y" * 1, "12345 " * 60, "a!b?c." * 50, "中文字符。" * 60, "line one is here\n" * 20, "\n".join(f"line {i} is here and long enough to count" for i in range(9)),
        "\n".join(["same line that is long enough"] * 4 + [f"line {i} other words here" for i in range(9)]), "\n".join(["same line that is long enough to be kept whole here"] * 4), "é" * 300, "x" * 80 + "1" * 120, "x" * 150 + "!" * 50,
        "a​b" * 100, "\n\n\n".join(f" line {i % 3} of the text here " for i in range(12)),
    ]


def test_clean_same_as_specification(spark):
    rules = CleanRules()
    rows = [(i, t, True, 3) for i, t in enumerate(samples())]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, m_punct int")
    got = {r.doc_id: r for r in score_clean(df).collect()}
    for i, t, *_ in rows:
        want, r = judged(t, rules), got[i]
        assert (r.text, r.drop_reason) == want[:2], t
        assert (r.m_non_ws, r.m_alpha_cjk, r.m_punct, r.m_dup_line) == want[2:], t
        assert r.kept == (want[1] == "ok")
    assert {r.drop_reason for r in got.values()} == {"too_short", "too_long", "too_sparse", "low_language_signal", "too_much_punct", "dup_lines", "ok"}
    kept, dropped = split_clean(df)
    assert kept.count() + dropped.count() == len(rows)
    assert score_clean(df.limit(0)).columns == score_clean(df).columns


def test_white_space_of_all_code_points(spark):
    points = [i for i in range(0x110000) if not 55296 <= i <= 57343]
    df = spark.createDataFrame(pd.DataFrame({"id": points, "c": [chr(i) for i in points]}))
    got = {r.id for r in df.where(F.length(text.strip(F.col("c"))) == 0).collect()}
    assert got == {i for i in range(0x110000) if chr(i).isspace() and not 55296 <= i <= 57343}


def test_scalar_functions(spark):
    import xxhash

    r = spark.createDataFrame([(" A \t b\n", -1, "p")], "s string, n long, p string").select(
        text.flatten_space(F.col("s")).alias("flat"), text.fold(F.col("s")).alias("fold"), text.unsigned_text(F.col("n")).alias("u"), text.xxh64(F.col("p")).alias("h"),
        text.document_id(F.col("p"), F.lit(None).cast("string"), F.lit("d"), F.lit("r")).alias("id"),
    ).first()
    import hashlib

    assert (r.flat, r.fold, r.u) == ("A b", "a b", str(2**64 - 1))
    assert r.h % 2**64 == xxhash.xxh64_intdigest(b"p") and r.id == hashlib.sha1(b"p\n\nd\nr").hexdigest()
    assert unicodedata.unidata_version
