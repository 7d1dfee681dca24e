"""One query per operator, with production parameters, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_dir

PIECES, IDS = "piece_bpe_32k.model", "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.pieces import encode_documents

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path(PIECES), scores="zipf").drop("text")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.warc import read_archive, write_archive

    archive = scratch_dir(spark, "warc")
    write_archive(table(spark, folder, "pages"), archive)
    return read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.decontamination import contained_items

    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("content")


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.html_text import extract

    return extract(table(spark, folder, "pages"))


def op6_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.repeated_passages import passages

    return passages(table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, folder, "documents")).drop("content", "lang", "source")


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.near_duplicates import classes

    return classes(table(spark, folder, "documents")).drop("content")


def op9_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.quality_model import quality_scores

    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.secret_scan import find_secrets

    return find_secrets(table(spark, folder, "documents"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.packing import pack

    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path(IDS))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.vector_codes import compress

    return compress(table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm.periodic_runs import periodic_runs, strongest, with_planted_runs

    rows = periodic_runs(with_planted_runs(table(spark, folder, "documents"))).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_sentencepiece, op3_warc, op4_decontamination, op5_html_text, op6_repeated_passages, op7_quality_rules, op8_near_duplicates, op9_quality_model, op10_secret_scan, op11_packing, op12_vector_codes, op13_periodic_runs,
    )
}

def _vector_codes_sql(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """SQL for op12_vector_codes: every part against every entry."""

    def nearest(book: str) -> str:
        return f"""
            SELECT vec_id, p, e, d, part FROM (
                SELECT vec_id, s.p, b.e, s.part, list_sum(list_transform(list_zip(s.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d,
                       row_number() OVER (PARTITION BY vec_id, s.p ORDER BY d, b.e) AS place
                FROM parts s JOIN {book} b ON s.p = b.p)
            WHERE place = 1"""

    steps = [
        f"""kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS (
            SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS part
            FROM kept, (SELECT unnest(range({parts})) AS p))""",
        f"""book0 AS (
            SELECT p, e, part FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id)
            WHERE e < {entries})""",
    ]
    for r in range(rounds):
        steps.append(f"near{r} AS ({nearest(f'book{r}')})")
        steps.append(f"""book{r + 1} AS (
            SELECT b.p, b.e, coalesce(m.part, b.part) AS part FROM book{r} b LEFT JOIN (
                SELECT p, e, list(mean ORDER BY i) AS part FROM (
                    SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
                    FROM (SELECT p, e, unnest(part) AS x, unnest(range(len(part))) AS i FROM near{r}) GROUP BY p, e, i)
                GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)""")
    steps.append(f"coded AS ({nearest(f'book{rounds}')})")
    steps.append("""rows AS (
        SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM coded JOIN kept USING (vec_id) GROUP BY vec_id)""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
        FROM rows"""


#: Each payload's least page is its response where the payload is long enough for revisits.
_WARC_SQL = """
    SELECT page_id, url, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
    FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_page
          FROM (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                       sha256(coalesce(html, '')) AS payload_digest FROM pages))"""

#: SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {"op3_warc": _WARC_SQL, "op12_vector_codes": _vector_codes_sql()}
