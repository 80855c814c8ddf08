"""Queries and oracle SQL of the corpus operators."""

from __future__ import annotations

from outflow.llm.decontamination import op5_benchmark_decontamination
from outflow.llm.digests import op2_document_fingerprints
from outflow.llm.htmltext import op10_html_extraction
from outflow.llm.infilling import FILL_IN_MIDDLE_SQL, op12_fill_in_middle
from outflow.llm.mergedropout import op6_sentencepiece
from outflow.llm.minhash import NEAR_DUPLICATES_SQL, op13_minhash_near_dedup
from outflow.llm.phrases import COLLOCATIONS_SQL, op11_phrase_collocations
from outflow.llm.pii import op8_pii
from outflow.llm.recompression import op1_substring_dedup
from outflow.llm.secrets import op9_secrets
from outflow.llm.simhash import op4_simhash_near_dedup
from outflow.llm.span_sql import pii_sql, secrets_sql
from outflow.llm.tokencounts import op3_token_counts
from outflow.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_token_counts": op3_token_counts,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_secrets": op9_secrets,
    "op10_html_extraction": op10_html_extraction,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

ORACLE_SQL = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos, len(ws) AS n FROM w),
g AS (SELECT *, CASE WHEN pos + 19 <= n THEN string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS win FROM t),
f AS (SELECT *, CASE WHEN win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 THEN 1 ELSE 0 END AS rep FROM g),
c AS (SELECT *, sum(rep) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS cov FROM f),
k AS (SELECT doc_id, count(*) FILTER (WHERE cov > 0) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE cov = 0) AS kept FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
""",
    "op8_pii": pii_sql(),
    "op9_secrets": secrets_sql(),
    "op11_phrase_collocations": COLLOCATIONS_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
    "op13_minhash_near_dedup": NEAR_DUPLICATES_SQL,
}
