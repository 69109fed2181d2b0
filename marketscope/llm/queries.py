"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.llm.chat_format import chat_format
from marketscope.llm.common import ROW, read_table
from marketscope.llm.decontaminate import contamination
from marketscope.llm.exact_dedup import exact_dedup
from marketscope.llm.html_extract import extract
from marketscope.llm.language_id import LANG, held_out, with_language
from marketscope.llm.line_dedup import line_dedup
from marketscope.llm.packing import pack
from marketscope.llm.phrases import collocations
from marketscope.llm.secret_scan import secret_scan
from marketscope.llm.simhash_dedup import near_dedup
from marketscope.llm.substring_dedup import substring_dedup
from marketscope.llm.warc import warc_round_trip
from marketscope.llm.whitening import embedding_whitening


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(read_table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = with_language(docs.select("doc_id", "text"), docs.where(~held_out(F.col("doc_id"))))
    doc_id = F.col(f"{ROW}.doc_id")
    return out.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"),
                      F.col(f"{LANG}.lang").alias("lang_pred"), F.col(f"{LANG}.score").alias("score"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                        "spans", "n_token")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening(read_table(spark, sf_dir, "embeddings"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(read_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_exact_dedup, op2_warc, op3_substring_dedup, op4_simhash_dedup, op5_decontaminate, op6_line_dedup,
    op7_language_id, op8_secret_scan, op9_best_fit_packing, op10_html_extract, op11_phrases, op12_whitening,
    op13_chat_format, pipeline)}

_OP1 = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents),
groups AS (
    SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM texts GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
"""

_OP2 = """
WITH payloads AS (
    SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
first AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM payloads)
SELECT page_id, url, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM first
"""

_OP11 = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
pieces AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM texts),
totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang HAVING sum(len(w)) > 0),
grams AS (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS phrase
    FROM pieces, range(1, 5) AS sizes(k) WHERE len(w) >= k),
f AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (
    SELECT lang, k, phrase, a, j, string_split(phrase, ' ') AS w FROM f, range(1, 4) AS places(j) WHERE j < k),
scores AS (
    SELECT c.lang, c.k, c.phrase, c.a, x.a AS l, y.a AS r, j, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
                JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
    SELECT lang, a, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, k - m + 2)]) AS phrase
    FROM (SELECT lang, k, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 3), range(2, 4) AS lengths(m) WHERE m < k),
covered AS (
    SELECT lang, phrase, max(a) AS b FROM inside GROUP BY lang, phrase),
kept AS (
    SELECT best.* FROM best LEFT JOIN covered USING (lang, phrase) WHERE b IS NULL OR 100 * b < 80 * a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": _OP1, "op2_warc": _OP2, "op11_phrases": _OP11}
