"""The operators' queries over the test tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripcast.llm.bagminhash import op1_bagminhash
from tripcast.llm.chat import op7_chat_format
from tripcast.llm.chunk_reuse import op8_bpe_chunk_reuse
from tripcast.llm.ctw import op4_context_tree_weighting
from tripcast.llm.decontaminate import op3_benchmark_decontamination
from tripcast.llm.fingerprint import op5_fingerprints
from tripcast.llm.html_main import op9_html_main_text
from tripcast.llm.language_id import op10_language_id
from tripcast.llm.lexical import op13_fp_tree_search
from tripcast.llm.part_codes import op12_part_codes
from tripcast.llm.sanitise import op11_information_sanitising
from tripcast.llm.token_counts import op2_token_counts
from tripcast.llm.warc import op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bagminhash": op1_bagminhash,
    "op2_token_counts": op2_token_counts,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_context_tree_weighting": op4_context_tree_weighting,
    "op5_fingerprints": op5_fingerprints,
    "op6_warc": op6_warc,
    "op7_chat_format": op7_chat_format,
    "op8_bpe_chunk_reuse": op8_bpe_chunk_reuse,
    "op9_html_main_text": op9_html_main_text,
    "op10_language_id": op10_language_id,
    "op11_information_sanitising": op11_information_sanitising,
    "op12_part_codes": op12_part_codes,
    "op13_fp_tree_search": op13_fp_tree_search,
}

# Equal payloads of at least 100 bytes: the smallest page_id is the response.
_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f"""

# One character per control string is added by escaping; each turn has 23 characters of marks.
_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
parts AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS role_n,
         length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS text_n
  FROM rows
),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(role_n + text_n + 23) AS formatted_chars
  FROM parts GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM c"""

# Terms, weights and lengths as they stand, all scores, the 20 best of each item.
_SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
lengths AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM size, corpus),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tf, corpus GROUP BY term, docs),
wanted AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20"""


def _codes(rounds: int = 4) -> str:
    """Rounds of assignment and replacement, one table each."""
    ctes = ["""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1024) AS BIGINT)) AS q, len(embedding) // 4 AS p
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""", """x AS MATERIALIZED (
  SELECT r, pos, i, q[pos * p + i + 1] AS v
  FROM kept, unnest([0, 1, 2, 3]) AS a(pos), unnest(range(p)) AS b(i)
)""", "book0 AS MATERIALIZED (SELECT pos, r - 1 AS entry, i, v FROM x WHERE r <= 256)"]
    for k in range(rounds + 1):
        ctes.append(f"""near{k} AS MATERIALIZED (
  SELECT r, pos, min({{'d': d, 'entry': entry}}) AS best
  FROM (SELECT r, x.pos, entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d
        FROM x JOIN book{k} b ON x.pos = b.pos AND x.i = b.i GROUP BY r, x.pos, entry)
  GROUP BY r, pos
)""")
        if k < rounds:
            ctes.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.pos, b.entry, b.i, coalesce(n.v, b.v) AS v
  FROM book{k} b LEFT JOIN (
    SELECT x.pos, best.entry AS entry, i, CAST(floor(sum(x.v)::DOUBLE / count(*)) AS BIGINT) AS v
    FROM x JOIN near{k} USING (r, pos) GROUP BY x.pos, best.entry, i) n
  ON b.pos = n.pos AND b.entry = n.entry AND b.i = n.i
)""")
    return "WITH " + ",\n".join(ctes) + f""",
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY pos, entry, i)) AS codebooks_sha256 FROM book{rounds}),
coded AS (
  SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, label
FROM coded JOIN kept USING (r), digest"""


ORACLE_SQL: dict[str, str] = {"op6_warc": _WARC, "op7_chat_format": _CHAT, "op12_part_codes": _codes(), "op13_fp_tree_search": _SEARCH}
