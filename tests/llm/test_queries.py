"""The pN_ queries on the smallest tables: columns, and SQL or plain Python where it can say the same."""

import glob
import os
from collections import Counter

import pytest

from quern.llm.oracles import oracle_sql
from quern.llm.queries import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "p1_found": ["doc_id"], "p2_found": ["doc_id", "kind", "line_no"], "p3_found": ["doc_id"], "p4_found": ["node_id", "group_id"], "p6_found": ["doc_id", "lang_found"],
    "p7_found": ["group_id", "doc_id"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries()))
def test_runs(spark, name):
    df = queries()[name](spark, SF)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    if name in oracle_sql():
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for f in glob.glob(f"{SF}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
        want = con.execute(oracle_sql()[name])
        order = [df.columns.index(c[0]) for c in want.description]
        assert Counter(tuple(r[i] for i in order) for r in rows) == Counter(want.fetchall())


def test_every_problem_has_a_query():
    assert {int(n[1:].split("_")[0]) for n in queries()} == set(range(1, 11))
