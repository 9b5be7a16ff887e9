"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.llm import (
    decontaminate,
    fm_dedup,
    jaccard_trees,
    kneser_ney,
    licences,
    packing,
    part_codes,
    quality_mil,
    sketches,
    spelling,
    suffix_dedup,
    super_minhash,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.hit_report(decontaminate.mark_hits(docs, benchmark))


def public_tokenizer(name: str) -> str:
    """Place of a public tokenizer file on this machine; the files are installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.piece_report(packing.pack(docs, public_tokenizer("word_bpe_49k.json")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_trees.similar(_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents")).drop("places")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_records(warc.archive(_table(spark, sf_dir, "pages")))
    return found.select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    network = quality_mil.train(docs, _table(spark, sf_dir, "labels"))
    return quality_mil.score(docs, network).select(
        "doc_id",
        quality_mil.held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= quality_mil.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = quality_mil.held_out("doc_id", 10)
    scored = kneser_ney.score(docs, kneser_ney.train(docs.filter(~out)))
    return scored.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.code_report(_table(spark, sf_dir, "embeddings"))


def op12_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_fingerprints": op5_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_licence_scan": op7_licence_scan,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_language_model": op10_language_model,
    "op11_vector_codes": op11_vector_codes,
    "op12_super_minhash": op12_super_minhash,
    "op13_spelling": op13_spelling,
}


def _vector_codes_sql(rounds: int = part_codes.ROUNDS) -> str:
    """Every distance to every entry, round by round; distances of whole numbers in doubles are exact."""
    near = """near{r} AS MATERIALIZED (
            SELECT p.pos, p.part, any_value(p.n) AS n, min(CAST(list_dot_product(p.part, p.part)
                - 2 * list_dot_product(p.part, b.part) + list_dot_product(b.part, b.part) AS BIGINT) * 256 + b.entry) AS best
            FROM part p JOIN book{r} b USING (pos) GROUP BY p.pos, p.part
        )"""
    step = """mean{r} AS (
            SELECT pos, best % 256 AS entry, i, floor(sum(n * part[i]) / sum(n)) AS x
            FROM near{r}, range(1, 17) AS place(i) WHERE i <= len(part) GROUP BY ALL
        ), moved{r} AS (
            SELECT pos, entry, list(x ORDER BY i) AS part FROM mean{r} GROUP BY ALL
        ), book{s} AS MATERIALIZED (
            SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part FROM book{r} b LEFT JOIN moved{r} m USING (pos, entry)
        )"""
    steps = [x.format(r=r, s=r + 1) for r in range(rounds) for x in (near, step)] + [near.format(r=rounds)]
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), cut AS MATERIALIZED (
            SELECT vec_id, label, pos, v[pos * len(v) // 4 + 1 : (pos + 1) * len(v) // 4] AS part FROM kept, range(4) AS place(pos)
        ), part AS MATERIALIZED (
            SELECT pos, part, count(*) AS n FROM cut GROUP BY ALL
        ), book0 AS MATERIALIZED (
            SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, part FROM cut
            WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
        ), {", ".join(steps)}, coded AS (
            SELECT c.vec_id, c.label, string_agg(printf('%02x', f.best % 256), '' ORDER BY c.pos) AS code,
                   CAST(sum(f.best // 256) AS BIGINT) AS error
            FROM cut c JOIN near{rounds} f ON f.pos = c.pos AND f.part = c.part GROUP BY c.vec_id, c.label
        ), digest AS (
            SELECT sha256(string_agg(CAST(CAST(part[i] AS BIGINT) AS VARCHAR), ',' ORDER BY pos, entry, i)) AS codebooks_sha256
            FROM book{rounds}, range(1, 17) AS place(i) WHERE i <= len(part)
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded, digest
    """


ORACLE: dict[str, str] = {
    "op11_vector_codes": _vector_codes_sql(),
    "op8_warc": """
        WITH page AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), kept AS (
            SELECT sha1(body) AS digest, max(page_id) AS page_id
            FROM page WHERE octet_length(body) >= 1000 GROUP BY 1
        )
        SELECT p.page_id, CAST(octet_length(p.body) AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
               CASE WHEN k.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN k.page_id <> p.page_id THEN k.page_id END AS refers_to
        FROM page p LEFT JOIN kept k ON octet_length(p.body) >= 1000 AND k.digest = sha1(p.body)
    """,
}
