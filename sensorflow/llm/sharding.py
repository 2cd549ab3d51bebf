"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; sorted by
``(rank - 1/2) / rows of the source``, every stretch of the order holds the
sources in their overall proportions, and cutting it into equal stretches
gives shards that match the mixture.

Ranks are exact and no task sees a whole source: rows are dealt to buckets of
the hash (then of the fractional rank), bucket counts give each bucket's
offset, and only the rows of one bucket are sorted together.  The number of
buckets follows the number of rows and is at most ``MAX_BUCKETS``, which bounds
the windows over counts.  DataFrame functions only.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096
MAX_BUCKETS = 4096  # three hexadecimal digits


def interleave(df: DataFrame, shards: int = 16, seed: int = 17, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id, source, size, text_crc32, shard, slot``.

    Shard counts differ by one row at most; ``slot`` runs gapless from 0 in
    each shard.  ``size`` is the text's UTF-8 bytes plus 1 (NULL: 1).  NULL is
    a source of its own.  Rows alike in id and text may swap places, which
    changes nothing; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
        key.alias("key"))
    total = df.count()
    buckets = 2 ** min(ceil(log2(max(1, total / BUCKET_ROWS))), int(log2(MAX_BUCKETS)))

    rows = rows.withColumn("b", F.conv(F.substring("key", 1, 3), 16, 10).cast("int") % buckets)
    counts = rows.groupBy("stratum", "b").agg(F.count(F.lit(1)).alias("n"))
    in_stratum = Window.partitionBy("stratum")
    counts = counts.select(
        "stratum", "b", F.sum("n").over(in_stratum).alias("stratum_rows"),
        (F.sum("n").over(in_stratum.orderBy("b")) - F.col("n")).alias("before"))
    place = Window.partitionBy("stratum", "b").orderBy("key", "id", "crc", "size")
    rank = F.col("before") + F.row_number().over(place)
    rows = (rows.join(counts, ["stratum", "b"])
            .withColumn("at", (rank * 2 - 1) / (F.col("stratum_rows") * 2).cast("double"))
            .drop("before"))

    rows = rows.withColumn("g", F.floor(F.col("at") * buckets).cast("int"))
    counts = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("g", (F.sum("n").over(Window.orderBy("g")) - F.col("n")).alias("before"))
    place = Window.partitionBy("g").orderBy("at", "key", "stratum", "id", "crc", "size")
    pos = F.col("before") + F.row_number().over(place) - 1
    # integer arithmetic: shard s starts at ceil(s * total / shards)
    shard = F.expr(f"int(pos * {shards}L div {max(total, 1)}L)")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (rows.join(counts, "g").withColumn("pos", pos).withColumn("shard", shard)
            .select(F.col("id").alias(id_col), "source", "size", F.col("crc").alias("text_crc32"),
                    "shard", (F.col("pos") - start).cast("long").alias("slot")))
