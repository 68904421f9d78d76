"""The registered queries of this subpackage, one per operator, and SQL for those that SQL can
express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.alignment import op12_alignment
from salesmart.llm.bpe import op9_bpe
from salesmart.llm.chat import op4_chat
from salesmart.llm.class_lm import op6_class_lm
from salesmart.llm.common import let_workers_import
from salesmart.llm.license_scan import op11_licenses
from salesmart.llm.line_dedup import OP2_SQL, op2_line_dedup
from salesmart.llm.mixing import op10_mixing
from salesmart.llm.near_dedup import op7_near_dedup
from salesmart.llm.neighbours import op3_neighbours
from salesmart.llm.quality import op1_quality
from salesmart.llm.secret_scan import op8_secrets
from salesmart.llm.substring_dedup import op5_substring_dedup
from salesmart.llm.whitening import op13_whitening

QUERIES = [
    op1_quality, op2_line_dedup, op3_neighbours, op4_chat, op5_substring_dedup, op6_class_lm,
    op7_near_dedup, op8_secrets, op9_bpe, op10_mixing, op11_licenses, op12_alignment,
    op13_whitening,
]

OP4_SQL = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), loss AS (
        SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text
        FROM turns WHERE role = 'assistant' GROUP BY conv_id
    ), listed AS (
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                   AS turns_sha256,
               CAST(sum(17 + length(role) + length(text) + len(regexp_extract_all(text,
                   '<\\*(\|turn\|>|\|end\|>|\|endoftext\|>|\|im_start\|>|\|im_end\|>|s>|/s>)'
                   || '|\[\\*(INST\]|/INST\])'))) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, turns_sha256, length(coalesce(loss.text, '')) AS loss_chars,
           sha256(coalesce(loss.text, '')) AS loss_sha256, formatted_chars
    FROM listed LEFT JOIN loss USING (conv_id)
"""

_NEXT = ", ".join(f"lead(word, {n}) OVER text" for n in range(1, 20))
OP5_SQL = rf"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), placed AS (
        SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
    ), windows AS (
        SELECT doc_id, place, concat_ws(' ', word, {_NEXT}) AS window_text,
               lead(word, 19) OVER text IS NOT NULL AS whole
        FROM placed WINDOW text AS (PARTITION BY doc_id ORDER BY place)
    ), again AS (
        SELECT doc_id, place FROM windows WHERE whole
        QUALIFY row_number() OVER (PARTITION BY window_text ORDER BY doc_id, place) > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM again
    ), kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
        FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def reachable(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            let_workers_import(spark)
            return query(spark, folder)

        return run

    return {query.__name__: reachable(query) for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2_SQL, "op4_chat": OP4_SQL, "op5_substring_dedup": OP5_SQL,
    }
