"""Queries of the training-data operators and, where SQL can express them, the same in SQL."""

from __future__ import annotations

from .centroids import centroid_sql, op13_centroids
from .decontaminate import op8_decontamination
from .html_text import op9_html_extraction
from .jaccard_join import op7_ngram_jaccard_join
from .kneser_ney import op2_quality_classifier
from .merkle import merkle_sql, op11_merkle_manifest
from .mixing import SQL as MIX_SQL
from .mixing import op12_source_mix
from .packing import op1_packing
from .quality_rules import op5_quality_rules
from .substring_dedup import op4_substring_dedup
from .suffix_dedup import op3_suffix_array_dedup
from .toxicity import op6_toxicity
from .token_output import op10_token_output

QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_html_extraction": op9_html_extraction,
    "op10_token_output": op10_token_output,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_mix": op12_source_mix,
    "op13_centroids": op13_centroids,
}

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, pattern: str, source: str, key: str) -> str:
    return f"SELECT {key}, list_filter(regexp_split_to_array(coalesce({text}, ''), '{pattern}'), lambda x: x <> '') AS ws FROM {source}"


SQL: dict[str, str] = {
    "op4_substring_dedup": f"""WITH d AS ({_words("text", "[ \\t-\\r]+", "documents", "doc_id")}),
 p AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM d WHERE len(ws) >= 35), w AS (SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS t FROM p),
 r AS (SELECT doc_id, i FROM w WHERE t IN (SELECT t FROM w GROUP BY t HAVING count(*) > 1)), c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
 a AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM d), k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM a ANTI JOIN c USING (doc_id, j) GROUP BY 1)
 SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op7_ngram_jaccard_join": f"""WITH RECURSIVE d AS ({_words(LOWER, "[ \\t-\\r]+", "documents", "doc_id")}),
 g AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 3, 2))) AS i, ws FROM d WHERE len(ws) > 0), s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS h FROM g), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2), l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
 r(doc_id, t) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.t = l.a)
 SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(t) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op8_decontamination": f"""WITH d AS ({_words(LOWER, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "documents", "doc_id")}), b AS ({_words(LOWER, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "benchmark", "item_id")}),
 q AS (SELECT item_id, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 8, 2))) AS i, ws FROM b WHERE len(ws) > 0), pt AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS t FROM q),
 v AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM d, (SELECT DISTINCT n FROM pt) WHERE len(ws) >= n), h AS (SELECT doc_id, v.n, i, item_id FROM v JOIN pt ON v.n = pt.n AND array_to_string(ws[i : i + v.n - 1], ' ') = pt.t),
 c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY 1), m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY 1)
 SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op11_merkle_manifest": merkle_sql(),
    "op12_source_mix": MIX_SQL,
    "op13_centroids": centroid_sql(),
}
