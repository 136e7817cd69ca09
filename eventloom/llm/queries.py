"""The operators over whole tables, as registered in ``__spark_entry__``, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .class_lm import score_documents
from .cover_codes import vector_codes
from .importance import importance_resample
from .langid import identify_languages
from .lines import line_dedup
from .minhash import near_duplicates
from .mixing import mix_sources
from .packing import pack_documents
from .quality import quality_scores
from .sharding import shard_documents
from .stream_dedup import stream_dedup
from .token_files import id_checksums, read_token_files, write_token_files
from .topk import top_k


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_documents(spark, sf_dir))


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(_documents(spark, sf_dir))
    law = F.lit("rows").alias("law")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), path)
    files = read_token_files(spark, path).withColumnRenamed("doc", "doc_id")
    return files.mapInArrow(id_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stream_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir))


def op11_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = importance_resample(_documents(spark, sf_dir), target)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_dedup, op2_exact_topk, op3_language_id, op4_feistel_shards, op5_line_dedup, op6_best_fit_packing,
        op7_token_files, op8_stream_dedup, op9_class_lm, op10_temperature_mixing, op11_quality_gam, op12_cover_codes, op13_importance_resampling,
    )
}

# Fixed values of the rules, as SQL text.
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _codes_sql(rounds: int) -> str:
    """Lloyd rounds one after the other, each an assignment of all parts and the means of what was assigned."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
          SELECT vec_id, part, p.x, min(CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 16 + entry) AS least
          FROM p JOIN b{i} b USING (part) GROUP BY vec_id, part, p.x
        )""")
        if i < rounds:
            steps.append(f"""m{i} AS (
          SELECT part, entry, list(m ORDER BY pos) AS x FROM (
            SELECT part, entry, pos, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS m
            FROM (SELECT part, least % 16 AS entry, unnest(x) AS c, unnest(range(len(x))) AS pos FROM a{i}) GROUP BY part, entry, pos
          ) GROUP BY part, entry
        ), b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (part, entry))""")
    return f"""
        WITH v AS MATERIALIZED (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS MATERIALIZED (
          SELECT vec_id, part, w[part * (len(w) // 8) + 1:(part + 1) * (len(w) // 8)] AS x FROM v, (SELECT unnest(range(8)) AS part)
        ), b0 AS MATERIALIZED (
          SELECT part, entry, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < 16) USING (vec_id)
        ), {", ".join(steps)},
        c AS (
          SELECT vec_id, string_agg(format('{{:02x}}', least % 16), '' ORDER BY part) AS code, CAST(sum(least // 16) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id
        ), h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM c JOIN v USING (vec_id), h"""


ORACLE_SQL = {
    "op12_cover_codes": _codes_sql(6),
    "op1_minhash_dedup": rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS t FROM documents
        ), s AS (
          SELECT doc_id, unnest(list_distinct(CASE
            WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
            ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END)) AS g
          FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), e AS (
          SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * common >= 85 * (nx.n + ny.n - common)
        ), r AS (
          SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached
        ), c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)""",
    "op2_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
            CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op5_line_dedup": f"""
        WITH l AS (
          SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), k AS (
          SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l
        ), f AS (
          SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
          GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), m AS (
          SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
          FROM k LEFT JOIN f USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op8_stream_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
          doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    # The checksum byte by byte, by the table that its polynomial makes.
    "op13_importance_resampling": rf"""
        WITH tab AS (
          SELECT list_transform(range(256), lambda n: list_reduce(
            [n] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
        ), w AS (
          SELECT 0 AS aim, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_RUNS}') AS w FROM documents
          UNION ALL SELECT 1, NULL, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_RUNS}') FROM benchmark
        ), f AS (
          SELECT aim, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM w
        ), n AS (SELECT aim, doc_id, f, count(*) AS n FROM f GROUP BY ALL),
        c AS (
          SELECT f, xor(4294967295, list_reduce(
            [4294967295] || list_transform(range(1, strlen(f) + 1), lambda i: CAST('0x' || substr(hex(f), 2 * i - 1, 2) AS BIGINT)),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 10000 AS bucket
          FROM (SELECT DISTINCT f FROM n), tab
        ), b AS (
          SELECT bucket, coalesce(sum(n) FILTER (aim = 0), 0) AS s, coalesce(sum(n) FILTER (aim = 1), 0) AS t FROM n JOIN c USING (f) GROUP BY bucket
        ), g AS (
          SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (sum(s) OVER () + 10000) / ((CAST(s AS DOUBLE) + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
          FROM b
        ), d AS (
          SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
          FROM n JOIN c USING (f) JOIN g USING (bucket) WHERE aim = 0 GROUP BY doc_id
        ), r AS (
          SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS enough,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
          FROM w LEFT JOIN d USING (doc_id) WHERE aim = 0
        ), o AS (
          SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM r WHERE enough
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
        FROM r LEFT JOIN o USING (doc_id)""",
}
