"""SQL for the pN_ queries that SQL can express on whole tables."""

from __future__ import annotations

_GROUPS = """
WITH RECURSIVE e AS (
  SELECT u AS a, v AS b FROM dup_edges WHERE u IS NOT NULL AND v IS NOT NULL
  UNION SELECT v, u FROM dup_edges WHERE u IS NOT NULL AND v IS NOT NULL
), reach(a, b) AS (
  SELECT a, a FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a
), g AS (SELECT a AS node_id, min(b) AS group_id FROM reach GROUP BY a)
"""

_SURVIVORS = """, r AS (
  SELECT doc_id, CASE WHEN ts IS NULL OR ts < 0 THEN 0 WHEN ts > 100000000000 THEN ts // 1000 ELSE ts END AS ts,
         CASE WHEN length IS NULL OR length < 0 THEN 0 ELSE length END AS length
  FROM minhash_docs
), k AS (
  SELECT g.group_id, r.doc_id, row_number() OVER (PARTITION BY g.group_id ORDER BY r.ts DESC, r.length DESC, r.doc_id DESC) AS n
  FROM r JOIN g ON r.doc_id = g.node_id
  WHERE g.group_id IN (SELECT group_id FROM g GROUP BY group_id HAVING count(*) > 1)
) SELECT group_id, doc_id FROM k WHERE n = 1
"""

_REPETITION = r"""
WITH l AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}]', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, length(t) AS n, i, substring(t, i, 30) AS g FROM (SELECT doc_id, t, unnest(range(1, length(t) - 28)) AS i FROM l)),
a AS (SELECT doc_id, n, i, min(i) OVER (PARTITION BY doc_id, g) AS f FROM w),
c AS (SELECT doc_id, n, least(30, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 30)) AS k FROM a WHERE i > f)
SELECT doc_id FROM c GROUP BY doc_id, n HAVING 3 * sum(k) >= n
"""

_SHARED = """
WITH w AS (SELECT doc_id, substring(text, i, 200) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents))
SELECT DISTINCT doc_id FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING count(DISTINCT doc_id) > 1)
"""

_HAN = r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}]"


def _words(text: str) -> str:
    """Words without case, accents and punctuation; of Chinese, single characters."""
    return rf"regexp_extract_all(regexp_replace(lower(strip_accents({text})), '({_HAN})', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"


# equal words of an item and a text on one alignment; from two of them, a run that is lengthened by exchanged words
_LEAKS = f"""
WITH d AS (SELECT doc_id, unnest(range(len(ws))) AS p, unnest(ws) AS w FROM (SELECT doc_id, {_words("text")} AS ws FROM documents WHERE text IS NOT NULL)),
q AS (SELECT item_id, len(ws) AS n, greatest(1, ceil(len(ws) * 0.6 - 1e-9)) AS least, unnest(range(len(ws))) AS p, unnest(ws) AS w FROM (SELECT item_id, {_words("question")} AS ws FROM eval_items WHERE question IS NOT NULL)),
m AS (SELECT doc_id, item_id, n, least, d.p - q.p AS shift, list(q.p ORDER BY q.p) AS ps FROM d JOIN q USING (w) GROUP BY ALL HAVING count(*) >= 0.9 * least - 1),
i AS (SELECT *, unnest(range(len(ps))) AS a FROM m),
r AS (SELECT *, unnest(range(a, len(ps))) AS b FROM i),
x AS (SELECT doc_id, item_id, n, least, ps[b + 1] - ps[a + 1] + 1 AS size, b - a + 1 AS same, unnest(range(n // 10 + 2)) AS more FROM r)
SELECT DISTINCT doc_id, item_id FROM x WHERE size + more <= n AND size + more >= least AND size - same + more <= (size + more) // 10
"""

_PACKING = """
WITH s AS (SELECT len(input_ids) AS n FROM token_samples WHERE len(input_ids) > 0)
SELECT sum(ceil(n / 4096))::BIGINT AS pieces, sum(n)::BIGINT AS tokens, ceil(sum(n) / 4096)::BIGINT AS packs_at_least, 0::BIGINT AS bad_packs, true AS close FROM s
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _REPETITION,
        "p5_checks": _PACKING,
        "p8_found": _LEAKS,
        "p10_found": _SHARED,
        "p4_found": _GROUPS + "SELECT node_id, group_id FROM g",
        "p4_group_sizes": _GROUPS + "SELECT group_id, count(*) AS n_ids FROM g GROUP BY group_id",
        "p7_found": _GROUPS + _SURVIVORS,
    }
