"""The queries of this subpackage and the SQL that must give the same rows, where SQL can express them."""

from __future__ import annotations

from graphloom.llm.decontaminate import op10_decontamination
from graphloom.llm.line_dedup import OP13_SQL, op13_line_dedup
from graphloom.llm.language_model import op3_language_model
from graphloom.llm.minhash import op5_minhash
from graphloom.llm.mixing import op2_mixing
from graphloom.llm.phrases import OP11_SQL, op11_phrases
from graphloom.llm.pivots import op4_pivots
from graphloom.llm.quality import op6_quality
from graphloom.llm.ranked_search import OP12_SQL, op12_ranked_search
from graphloom.llm.sharding import op7_sharding
from graphloom.llm.token_counts import OP9_SQL, op9_token_counts
from graphloom.llm.token_files import op8_token_files
from graphloom.llm.toxicity import op1_toxicity

OP4_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([1 FOR x IN embedding IF x <> 0]) > 0),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    SELECT vec_id AS node, vec_id AS r FROM embeddings
    UNION SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.r),
named AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE links.u = node) AS n_links, component_id, node = component_id AS kept
FROM named
"""

OP5_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
    FROM w, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_sides AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT u, v FROM both_sides JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 85 * (a.n + b.n - k)),
reach AS (
    SELECT doc_id AS node, doc_id AS r FROM documents
    UNION SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.r),
named AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node)
SELECT node AS doc_id, coalesce(n, 0) AS n_shingles, component_id, node = component_id AS kept FROM named LEFT JOIN n ON doc_id = node
"""

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_mixing, op3_language_model, op4_pivots, op5_minhash, op6_quality, op7_sharding, op8_token_files,
    op9_token_counts, op10_decontamination, op11_phrases, op12_ranked_search, op13_line_dedup)}
SQL: dict[str, str] = {"op4_pivots": OP4_SQL, "op5_minhash": OP5_SQL, "op9_token_counts": OP9_SQL, "op11_phrases": OP11_SQL, "op12_ranked_search": OP12_SQL,
                      "op13_line_dedup": OP13_SQL}
