"""Queries of the corpus operators over the given tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import brown, language_id, token_counts, toxicity
from sensorflow.llm.alignment import align
from sensorflow.llm.exact_dedup import exact_dedup
from sensorflow.llm.filter_audit import audit
from sensorflow.llm.iblt import edited_fingerprints
from sensorflow.llm.license_scan import scan_licenses
from sensorflow.llm.license_texts import TEMPLATES
from sensorflow.llm.near_dedup import near_dedup
from sensorflow.llm.packing import pack_documents
from sensorflow.llm.piece_codec import encode_decode
from sensorflow.llm.sharding import interleave
from sensorflow.session import discard


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remainder(divisor: int):
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from text and lang of the rows that are not held out."""
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(remainder(4) != 2).select("text", "lang"))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
                        "lang_mix.lang_pred", "lang_mix.score", "lang_mix.mixture")


TOXIC_FROM = 0.7


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of held-out rows are never read into the model.  Labels grow
    with the documents, so the join shuffles both at every size."""
    docs = documents(spark, sf_dir)
    train = (docs.select("doc_id", "text").filter(remainder(3) != 1)
             .join(labels(spark, sf_dir).select("doc_id", "toxic").distinct().hint("merge"), "doc_id"))
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(train), out_col="score")
    return scored.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", "codec.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("row")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after three edits to every document: 12 characters
    out at a fifth of the text, a remark in at its middle, a line at its end."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = documents(spark, sf_dir).select("doc_id", "text")
    n = F.coalesce(F.char_length("text"), F.lit(0))

    def one(at, cut: int, put):
        return F.struct(at.cast("int").alias("at"), F.lit(cut).alias("cut"), put.alias("put"))

    docs = docs.withColumn("edits", F.array(
        one(F.floor(n / 5), 12, F.lit("")),
        one(F.floor(n / 2), 0, F.concat(F.lit(" (see: "), F.coalesce(F.substring("text", 1, 20), F.lit("")), F.lit(")"))),
        one(n + 100, 0, F.lit("\nRevised."))))
    done = token_counts.recount(docs, path, pattern)
    return done.select(
        "doc_id", n.cast("long").alias("n_chars"), "counts.n_tokens", "counts.edited_n_chars",
        "counts.edited_n_tokens", F.col("counts.encoded").alias("encoded_chars"), "counts.edited_sha256")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                          limit=4096, end_id=1)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match; documents without a licence have none."""
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"), TEMPLATES)
    return found.select("doc_id", F.explode("licenses").alias("m")).select("doc_id", "m.*")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), shingle=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: counts at most one apart.  Rows are dealt one by one, so
    equal texts need not share a shard."""
    return interleave(documents(spark, sf_dir), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), labels(spark, sf_dir))


def op12_brown_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the texts that are not held out; one without an id is not."""
    blocks = brown.encode(documents(spark, sf_dir), remainder(7) != 2)
    model = brown.fit(blocks)
    scored = brown.score(blocks, model)
    discard(blocks, model.words)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_piece_codec": op3_piece_codec,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_license_scan": op8_license_scan,
    "op9_near_dedup": op9_near_dedup,
    "op10_sharding": op10_sharding,
    "op11_filter_audit": op11_filter_audit,
    "op12_brown_score": op12_brown_score,
    "op13_alignment": op13_alignment,
}

ORACLE = {
    "op4_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS x
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id,
               count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY x) AS kept,
               sha256(x) AS text_sha256
        FROM t""",
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
        l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, (len(ws) < 200)::INT AS a, (100 * len(list_distinct(ws)) < 50 * len(ws))::INT AS b,
                   (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT AS c,
                   regexp_matches(t, '[#$%&*|]')::INT AS d,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e,
                   coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
            FROM w LEFT JOIN l USING (doc_id)),
        g AS (SELECT part, a, b, c, d, e, good, bad, count(*) AS n FROM f GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS q),
        o AS (SELECT p.q || r.q || s.q || t.q || u.q AS filter_order FROM x p, x r, x s, x t, x u
              WHERE len(list_distinct([p.q, r.q, s.q, t.q, u.q])) = 5),
        z AS (
            SELECT g.*, filter_order, least(
                CASE a WHEN 1 THEN instr(filter_order, 'A') ELSE 6 END, CASE b WHEN 1 THEN instr(filter_order, 'B') ELSE 6 END,
                CASE c WHEN 1 THEN instr(filter_order, 'C') ELSE 6 END, CASE d WHEN 1 THEN instr(filter_order, 'D') ELSE 6 END,
                CASE e WHEN 1 THEN instr(filter_order, 'E') ELSE 6 END) AS gone
            FROM g, o),
        y AS (
            SELECT z.*, step, substr(filter_order, step, 1) AS letter,
                   CASE substr(filter_order, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
            FROM z, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
        r AS (
            SELECT part, filter_order, step, letter,
                   sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN fails = 1 AND gone < step THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN fails = 1 AND a + b + c + d + e = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN gone = step AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
                   sum(CASE WHEN gone = step AND bad = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
            FROM y GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
        FROM r""",
}
