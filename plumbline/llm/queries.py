"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from plumbline.llm.debruijn_dedup import op8_substring_dedup
from plumbline.llm.decontamination import op2_benchmark_decontamination
from plumbline.llm.jaccard_join import op1_ngram_jaccard_join
from plumbline.llm.language_id import op3_language_id
from plumbline.llm.maxscore import op5_exact_topk_search
from plumbline.llm.piece_sampling import op6_sentencepiece_sampling
from plumbline.llm.sharding import op9_sharding
from plumbline.llm.suffix_dedup import op4_suffix_array_dedup
from plumbline.llm.token_files import op10_token_files
from plumbline.llm.url_filter import op7_url_filter

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_language_id": op3_language_id,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_exact_topk_search": op5_exact_topk_search,
    "op6_sentencepiece_sampling": op6_sentencepiece_sampling,
    "op7_url_filter": op7_url_filter,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_token_files": op10_token_files,
}

ORACLE_SQL = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reach = l.x),
m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.doc_id = d.doc_id
""",
    "op2_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_WORD}) AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), {_WORD}) AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(ws), 5) AS k, unnest(list_transform(range(1, len(ws) - least(len(ws), 5) + 2), lambda j: array_to_string(ws[j:j + least(len(ws), 5) - 1], ' '))) AS s FROM i WHERE len(ws) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM g GROUP BY item_id),
k AS (SELECT DISTINCT k FROM g),
h AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS s FROM d CROSS JOIN k WHERE len(ws) >= k)
SELECT doc_id, item_id, n_item, count(*) AS n_found FROM h JOIN g USING (k, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
""",
    "op5_exact_topk_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS t FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.t, c.t)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s QUALIFY rank <= 10
""",
    "op4_suffix_array_dedup": """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, length(h) // 2 AS n, unnest(range(0, length(h) // 2)) AS i FROM t),
w AS (SELECT doc_id, i, CASE WHEN i + 400 <= n THEN md5_number(substring(h, 2 * i + 1, 800)) END AS k, substring(h, 2 * i + 1, 2) AS x FROM b),
c AS (SELECT doc_id, i, x, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN i END AS s FROM w),
r AS (SELECT doc_id, i, x, max(s) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM c),
e AS (SELECT doc_id, i, x, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM r),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
  coalesce(string_agg(x, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT t.doc_id, coalesce(g.n, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM t LEFT JOIN g ON g.doc_id = t.doc_id
""",
    "op8_substring_dedup": f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
b AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM t),
w AS (SELECT doc_id, i, ws[i] AS x, CASE WHEN i + 34 <= len(ws) THEN md5_number(array_to_string(ws[i:i + 34], ' ')) END AS k FROM b),
c AS (SELECT doc_id, i, x, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN i END AS s FROM w),
r AS (SELECT doc_id, i, x, max(s) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM c),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN g ON g.doc_id = t.doc_id
""",
}
