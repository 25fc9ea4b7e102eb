import pyarrow as pa
import pyarrow.compute as pc

from quern.operators import pii

TEXTS = [
    "mail a.b+c@sub.example.co.uk now", "电话13800138000", "12:34:56", "std::vector and a::b", "999.1.1.1 and 192.168.1.1", "123-45-6789", "+1 212 555 1234", "(020) 555-1234 x", "2001:db8::1", "call me, John Smith",
    "联系我", "nothing", "", None, "John Smith", "a@b", "tel 5551234", "QQ", "fe80::1%eth0 ::", "é123-45-6789é",
]


def test_same_as_re2(spark):
    rows = {r.i: r for r in pii.redact(spark.createDataFrame(list(enumerate(TEXTS)), "i long, text string"), keep_stats=True, keep_routing=True).collect()}
    arr = pa.array(TEXTS)
    for name, (pattern, _) in pii.PATTERNS.items():
        want = pc.fill_null(pc.match_substring_regex(arr, pattern), False).to_pylist()
        assert [rows[i][f"pii_has_{name}"] for i in range(len(TEXTS))] == want, name
    out = arr
    for pattern, mark in pii.PATTERNS.values():
        out = pc.replace_substring_regex(out, pattern, mark)
    assert [rows[i].text for i in range(len(TEXTS))] == out.to_pylist()
    contact = pc.fill_null(pc.match_substring_regex(arr, pii.CONTACT), False).to_pylist()
    shape = pc.fill_null(pc.match_substring_regex(arr, pii.NAME_SHAPE), False).to_pylist()
    for i, t in enumerate(TEXTS):
        flags = any(rows[i][f"pii_has_{k}"] for k in pii.PATTERNS)
        assert rows[i].need_ner == (flags or contact[i] or shape[i] or "@" in (t or ""))
        assert rows[i].ner_lang == ("zh" if any("一" <= c <= "鿿" for c in rows[i].text or "") else "en")


def test_name_stage_sees_only_routed_rows(spark):
    df = spark.createDataFrame([(1, "John Smith was here", "__label__en"), (2, "plain words", "en"), (3, "Jean Dupont", "fr-FR"), (4, None, None)], "id long, text string, lang string")

    def names(texts, langs):
        assert "plain words" not in texts and set(langs) <= {"en", "zh"}
        return [t.replace("John Smith", "<NAME>") for t in texts]

    got = {r.id: r for r in pii.redact(df, lang_col="lang", names=names).collect()}
    assert got[1].text == "<NAME> was here" and got[2].text == "plain words" and got[3].text == "Jean Dupont" and got[4].text is None
    assert pii.redact(df).columns == df.columns


def test_names_by_listed_given_names(spark):
    given = spark.createDataFrame([("en", "John"), ("__label__en", "Mary Ann"), ("zh", "建国"), (None, "x"), ("en", None)], "lang string, given_name string")
    patterns = pii.name_patterns(given)
    df = spark.createDataFrame([(1, "Call John R. van Dyke-Smith or Mary Ann O'Neil, not john or Johnny Doe.", "en"), (2, "电话：王建国。", "zh"), (3, "John Smith", "fr"), (4, None, "en"), (5, "plain", "en")], "id long, text string, lang string")
    got = {r.id: r.text for r in pii.redact(df, lang_col="lang", names=patterns).collect()}
    assert got == {1: "Call <NAME> or <NAME>, not john or Johnny Doe.", 2: "电话：<NAME>。", 3: "John Smith", 4: None, 5: "plain"}


def test_a_failing_name_stage_costs_only_its_text(spark):
    def names(texts, langs):
        if any("bad" in t for t in texts):
            raise ValueError
        return [t.replace("Ann Lee", "<NAME>") for t in texts]

    df = spark.createDataFrame([(1, "Ann Lee here"), (2, "Tom Roe bad"), (3, "Ann Lee there")], "id long, text string").coalesce(1)
    got = {r.id: r.text for r in pii.redact(df, names=names).collect()}
    assert got == {1: "<NAME> here", 2: "Tom Roe bad", 3: "<NAME> there"}
