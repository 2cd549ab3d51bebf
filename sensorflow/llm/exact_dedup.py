"""Exact dedup by distributed MSD radix partitioning.

A text is the byte record *length, bytes*.  Groups are split by the length
and the first bytes, then by the next run of bytes, and so on; a row leaves as
soon as it is alone in its group or its record has ended.  Rows of one group
that ended together are equal byte by byte, so equality never rests on a
digest.

* Each digit is one map-side combined ``groupBy(group, digit)``; a hot group
  arrives as one row per map task.  Groups of two rows or more are written out
  and joined back to the rows; read from a table, they share no shuffle with
  the aggregate, so Spark may split the rows of a hot group in that join.
* Digits grow eightfold, so a text of n bytes takes O(log n) rounds.  Length
  comes first, so mostly true copies survive the first digit.
* Every round is written to the shared checkpoint folder; a lost executor
  re-reads that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.rows import number
from sensorflow.session import discard, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REST = 2**31 - 1


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on texts that are ASCII
    throughout; others take the slower ``translate``."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first: int = 32, growth: int = 8, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256,
    row``, the last being the number stored in ``row_col``; without one, rows
    are numbered and written first.

    Texts are equal when identical after lower-casing A-Z; NULL counts as the
    empty text.  The row with the largest id of a group stays; NULL ids sort
    lowest, and of rows with the same id exactly one stays.  ``first`` is the
    number of bytes in the first digit, ``growth`` the factor from one digit
    to the next.  ``text_sha256`` is only reported, never compared.  Other
    columns of ``df`` are ignored; an empty table gives an empty result.
    """
    text = ascii_lower(F.col(text_col)).cast("binary")
    spent: list[DataFrame] = []
    if row_col:
        rows = df.select(F.col(row_col).alias("rid"), F.col(id_col).alias("id"), text.alias("text"))
    else:
        rows = number(df.select(F.col(id_col).alias("id"), text.alias("text")), "rid")
        spent.append(rows)
    rows = rows.select("rid", "id", F.octet_length("text").alias("n"),
                       F.substring("text", 1, first).alias("digit"),
                       F.substring("text", first + 1, REST).alias("rest"),
                       F.sha2("text", 256).alias("sha"))
    level = materialize(_split(rows, ["n", "digit"], first, spent), "radix")
    levels, at, width = [level], first, first * growth
    while level.filter("not done").limit(1).count():
        alive = level.filter("not done").select(
            "rid", "id", "n", F.col("top.rid").alias("grp"),
            F.substring("rest", 1, width).alias("digit"),
            F.substring("rest", width + 1, REST).alias("rest"), "sha")
        at, width = at + width, width * growth
        level = materialize(_split(alive, ["grp", "digit"], at, spent), "radix")
        levels.append(level)
    ended = None
    for x in levels:
        x = x.filter("done").select("rid", "id", "top", "size", "sha")
        ended = x if ended is None else ended.unionByName(x)
    if len(levels) > 1:  # the texts of earlier rounds are not needed any more
        out = materialize(ended, "radix")
        discard(*levels)
    else:
        out = ended
    discard(*spent)
    return out.select(
        F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("rid") == F.col("top.rid")).alias("kept"), F.col("sha").alias("text_sha256"),
        F.col("rid").alias("row"))


def _split(rows: DataFrame, key: list[str], at: int, spent: list[DataFrame]) -> DataFrame:
    """Split each group by its digit.  ``top`` names the new group: the row
    that would stay.  A row is done when alone, or when its bytes have ended;
    the rest of its text is then dropped."""
    groups = materialize(
        rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "rid")).alias("top"))
        .filter("size > 1"), "groups")
    spent.append(groups)
    done = F.col("size").isNull() | (F.col("n") <= at)
    return (rows.join(groups.hint("merge"), key, "left")  # groups grow with the rows: one plan at every size
            .select("rid", "id", "n", "sha", F.coalesce("size", F.lit(1)).alias("size"),
                    F.coalesce("top", F.struct("id", "rid")).alias("top"), done.alias("done"),
                    F.when(~done, F.col("rest")).alias("rest")))
