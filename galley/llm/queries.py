"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.decontaminate import contaminated
from galley.llm.exact import exact_dedup
from galley.llm.licenses import license_scan
from galley.llm.lm import score_documents
from galley.llm.near import near_dedup
from galley.llm.packing import pack_documents
from galley.llm.sharding import shard_documents
from galley.llm.substring import substring_dedup
from galley.llm.tokencount import section_tokens
from galley.llm.toxicity import fit_chain, score_toxicity
from galley.session import make_importable

#: The chain over the labels table: quality first, as its probability helps to tell toxic texts.
CATEGORIES = ("quality", "toxic")

OP1_SQL = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


#: Lengths 13, 26, 52, ... of op4: none is longer than the longest texts (some 20,000 words) for the last but one.
_LENGTHS = [13 << k for k in range(12)]


def _again(rows: str) -> str:
    """Windows of rows (r, i, k) that more than one document has."""
    return f"SELECT r, i, k FROM ({rows}) QUALIFY min(r) OVER (PARTITION BY k) <> max(r) OVER (PARTITION BY k)"


_DOUBLED = ", ".join(
    ["s13 AS (" + _again("SELECT r, i, md5(k) AS k FROM windows WHERE n = 13") + ")"]
    + [f"s{2 * n} AS (" + _again(f"SELECT a.r, a.i, md5(a.k || b.k) AS k FROM s{n} a JOIN s{n} b ON b.r = a.r AND b.i = a.i + {n}") + ")" for n in _LENGTHS[:-1]]
    + ["longest AS (SELECT r, max(n) AS longest FROM (" + " UNION ALL ".join(f"SELECT r, {n} AS n FROM s{n}" for n in _LENGTHS) + ") GROUP BY r)"]
)

OP4_SQL = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM docs),
windows AS (SELECT doc_id, r, i, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS n FROM words WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
owners AS (SELECT k, min(doc_id) AS d FROM windows WHERE n = 13 GROUP BY k),
hits AS (SELECT r, i FROM windows JOIN owners USING (k) WHERE n = 13 AND (d < doc_id OR (doc_id IS NULL AND d IS NOT NULL))),
marked AS (SELECT w.r, w.i, w.w, max(h.i) OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) IS NOT NULL AS dead FROM words w LEFT JOIN hits h ON h.r = w.r AND h.i = w.i),
spans AS (SELECT *, dead AND NOT coalesce(lag(dead) OVER (PARTITION BY r ORDER BY i), false) AS begins FROM marked),
kept AS (SELECT r, count(*) FILTER (dead) AS n_removed, count(*) FILTER (begins) AS n_spans, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT dead), '') AS t FROM spans GROUP BY r),
""" + _DOUBLED + """
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256, coalesce(k.n_spans, 0) AS n_spans, CAST(coalesce(l.longest, 0) AS BIGINT) AS longest FROM docs d LEFT JOIN kept k USING (r) LEFT JOIN longest l USING (r)
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).drop("row")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans", "longest")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # the table has no paths: a document lies in a directory of its source, and there of its language
    path = F.concat_ws("/", docs.source, docs.lang, F.concat(docs.doc_id.cast("string"), F.lit(".txt")))
    return license_scan(docs, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    chain = fit_chain(docs, _table(spark, sf_dir, "labels"), CATEGORIES)
    return score_toxicity(docs, chain, CATEGORIES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op4_substring_dedup": OP4_SQL}
