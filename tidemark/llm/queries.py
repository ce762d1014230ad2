"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .chat import op3_reply_trees
from .edit_counts import op5_edit_aware_counts
from .html_text import op10_tree_scoring
from .lines import OP2_SQL, op2_line_spread
from .pseudonyms import op4_feistel_pseudonyms
from .quality import op1_boosted_trees
from .sentencepiece_bpe import op7_sentencepiece_rounds
from .simhash import op9_simhash_anchors
from .substring import op8_seed_extend
from .wumanber import op6_wu_manber

QUERIES = {
    f.__name__: f
    for f in (
        op1_boosted_trees, op2_line_spread, op3_reply_trees, op4_feistel_pseudonyms, op5_edit_aware_counts,
        op6_wu_manber, op7_sentencepiece_rounds, op8_seed_extend, op9_simhash_anchors, op10_tree_scoring,
    )
}

_OP3_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\s'), '### ', '\o'), '</turn>', '\c') AS body FROM given
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS win FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw))
), hits AS (
  SELECT doc_id, n, k, item_id FROM dw JOIN bw USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM (SELECT DISTINCT doc_id, n, k FROM hits)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13)
), first AS (
  SELECT run, min(doc_id) AS f FROM runs GROUP BY 1
), repeated AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS k FROM runs JOIN first USING (run) WHERE doc_id > f
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d
), kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN repeated USING (doc_id, k) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op2_line_spread": OP2_SQL, "op3_reply_trees": _OP3_SQL, "op6_wu_manber": _OP6_SQL, "op8_seed_extend": _OP8_SQL}
