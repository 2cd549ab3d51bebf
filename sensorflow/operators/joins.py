"""Joins (D1-D4; D5 is part of ``operators.upsert``).

Only equi-joins.  A side is broadcast only after its size is proven
(``bounded_broadcast``); otherwise the planner decides and AQE may still switch
to a broadcast at run time from measured shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What is broadcast without the planner's own estimate takes no more than this.
BROADCAST_BYTES = 64 * 2**20
TEXT_BYTES = 64  # counted for a text or other value of no fixed size


def fits_broadcast(df: DataFrame, columns: list[str], rows: int | None) -> bool:
    """Whether ``rows`` (a known count or bound) of ``columns`` stay within
    ``BROADCAST_BYTES``."""
    if rows is None:
        return False
    fixed = ("int", "bigint", "smallint", "tinyint", "boolean", "date", "timestamp", "timestamp_ntz", "double", "float")
    width = sum(8 if df.schema[c].dataType.simpleString() in fixed else TEXT_BYTES for c in columns)
    return rows * (width + 16) <= BROADCAST_BYTES


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint iff ``df`` has at most ``max_rows`` rows and these stay within
    ``BROADCAST_BYTES``.

    The proof is a ``limit(max_rows + 1).count()`` job, which stops early on
    large inputs; above the bound the frame is returned unchanged (shuffle join).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows and fits_broadcast(df, df.columns, n) else df


def enrich_left(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                take: dict[str, str], dim_max_rows: int | None = None) -> DataFrame:
    """D1+D2: ``fact LEFT JOIN dim``; ``take`` maps output name -> dim column.

    Taken columns come from the dimension even when it has no match (then
    NULL); the dimension must be unique on ``dim_key`` (dedupe it first), so
    the join never fans out.
    """
    right = dim.select(F.col(dim_key).alias("__dim_key"),
                       *[F.col(src).alias(f"__dim_{out}") for out, src in take.items()])
    if dim_max_rows is not None:
        right = bounded_broadcast(right, dim_max_rows)
    joined = fact.join(right, F.col(fact_key) == F.col("__dim_key"), "left")
    keep = [c for c in fact.columns if c not in take]
    return joined.select(*keep, *[F.col(f"__dim_{out}").alias(out) for out in take])


def referenced_dim_rows(dim: DataFrame, refs: DataFrame, dim_key: str, ref_col: str) -> DataFrame:
    """D3/E5: dimension rows referenced by ``refs`` (EXISTS); refs are reduced
    to distinct ids first so a hot id costs one row in the shuffle."""
    ids = refs.select(F.col(ref_col).alias(dim_key)).distinct()
    return dim.join(ids, dim_key, "left_semi")


def orphan_keys(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str,
                child_rows: int | None = None) -> DataFrame:
    """Distinct non-NULL values of ``child_col`` with no parent (column ``__fk``).

    Only distinct key values travel.  When the child's keys are known to be
    small (``child_rows`` of them stay within ``BROADCAST_BYTES``, e.g. a
    counted micro-batch) they are broadcast and the parent is streamed through
    a semi-join instead of being shuffled; otherwise both distinct key sets
    shuffle on the key.
    """
    keys = child.select(F.col(child_col).alias("__fk")).filter(F.col("__fk").isNotNull()).distinct()
    pkeys = parent.select(F.col(parent_col).alias("__fk"))
    if fits_broadcast(child, [child_col], child_rows):
        # both broadcast sides are bounded by the child's key count
        present = pkeys.join(F.broadcast(keys), "__fk", "left_semi").distinct()
        return keys.join(F.broadcast(present), "__fk", "left_anti")
    return keys.join(pkeys.distinct(), "__fk", "left_anti")


def fk_orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str,
               child_rows: int | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (NULL FK passes).

    Skew-safe: distinct FK values are checked against the parent keys
    (map-side distinct collapses hot keys), and only the orphan key set is
    joined back to the child rows.
    """
    orphans = orphan_keys(child, parent, child_col, parent_col, child_rows)
    if fits_broadcast(child, [child_col], child_rows):
        orphans = F.broadcast(orphans)
    return child.join(orphans, F.col(child_col) == F.col("__fk"), "left_semi")
