"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A paragraph's digest carries its own 16-bit check.  A sketch has four rows of
``width`` cells; a digest adds 1 to the count of one cell a row and is XORed
into it.  The sketch of one version is subtracted from the other's, cell by
cell; equal paragraphs cancel, and peeling cells that hold a single digest
recovers the paragraphs that differ.  A document with many paragraphs has its
digests split by hash into parts of a few, each with a sketch of its own, so
the work is nearly linear in the text.  Parts that cannot be peeled are written
out and tried again with twice the width and other hashes until none is left.

DataFrame functions only.  A row is one document, so nothing depends on how
often a text occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.rows import number
from sensorflow.session import discard, materialize

WIDTH = 4            # cells in each of the four rows of a sketch
PART = 6             # digests of both versions in a part, on average
RANGE_ROWS = 20_000
MAX_RANGES = 4096
CODEC = "zstd"       # of the tables that hold texts and fingerprints
#: A paragraph is a line; a line of several sentences is cut into them.
PARAGRAPH_END = r"\\n|(?<=[.!?])\\s+"


def digests(text: str) -> str:
    """SQL: distinct paragraph digests; the last 16 bits check the others."""
    return (f"array_distinct(transform(filter(split({text}, '{PARAGRAPH_END}'), p -> p != ''), "
            f"p -> transform(array(xxhash64(p) & ~65535L), h -> h | (xxhash64(h) & 65535L))[0]))")


def _mask(d: str, width: int, seed: int) -> str:
    """SQL: a bit for each of the four cells of digest ``d``."""
    cells = " | ".join(f"shiftleft(1L, {k * width} + int(pmod(shiftright(h, {k * 12}), {width}L)))" for k in range(4))
    return f"transform(array(xxhash64({d}, {seed})), h -> {cells})[0]"


def _cells(signed: str, width: int, seed: int) -> str:
    """SQL: the cells of an array of ``struct<d, s>``, s being 1 or -1."""
    return (f"transform(array(transform({signed}, e -> struct(e.d AS d, e.s AS s, {_mask('e.d', width, seed)} AS m))), es -> "
            f"transform(sequence(0, {4 * width - 1}), i -> aggregate(filter(es, e -> (shiftright(e.m, i) & 1L) = 1L), "
            f"struct(0 AS n, 0L AS x), (c, e) -> struct(c.n + e.s AS n, c.x ^ e.d AS x))))[0]")


def _signed(a: str, b: str | None = None) -> str:
    plus = f"transform({a}, d -> struct(d AS d, 1 AS s))"
    return plus if b is None else f"concat({plus}, transform({b}, d -> struct(d AS d, -1 AS s)))"


def fingerprint(array: str, width: int = WIDTH) -> str:
    """SQL: count and XOR of each cell over all digests, in hexadecimal."""
    return (f"array_join(transform({_cells(_signed(array), width, 0)}, "
            f"c -> concat(lower(hex(c.n)), ':', lower(hex(c.x)))), ' ')")


def _peel(a: str, b: str, width: int, seed: int) -> str:
    """SQL: ``struct<ok, da, db>``: whether the difference of the two sketches
    peels, and how many digests were recovered on either side."""
    pure = (f"filter(transform(s.cells, (c, i) -> struct(c.n AS n, c.x AS x, i AS i)), c -> abs(c.n) = 1 "
            f"AND (c.x & 65535L) = (xxhash64(c.x & ~65535L) & 65535L))")
    take = (f"transform(array({_mask('p.x', width, seed)}), m -> IF((shiftright(m, p.i) & 1L) = 1L, struct("
            f"transform(s.cells, (c, i) -> IF((shiftright(m, i) & 1L) = 1L, struct(c.n - p.n AS n, c.x ^ p.x AS x), c)) AS cells, "
            f"s.da + int(p.n = 1) AS da, s.db + int(p.n = -1) AS db, false AS stuck), "
            f"struct(s.cells AS cells, s.da AS da, s.db AS db, true AS stuck)))[0]")
    step = (f"IF(s.stuck, s, transform(array({pure}), ps -> IF(size(ps) = 0, "
            f"struct(s.cells AS cells, s.da AS da, s.db AS db, true AS stuck), "
            f"transform(array(ps[0]), p -> {take})[0]))[0])")
    start = f"struct({_cells(_signed(a, b), width, seed)} AS cells, 0 AS da, 0 AS db, false AS stuck)"
    return (f"aggregate(sequence(0, size({a}) + size({b})), {start}, (s, i) -> {step}, "
            f"s -> struct(forall(s.cells, c -> c.n = 0 AND c.x = 0L) AS ok, s.da AS da, s.db AS db))")


def _parts(a: str, b: str, seed: int) -> str:
    """SQL: array of ``struct<a, b>``, the digests dealt by hash to about
    ``(|a| + |b|) / PART`` parts, in two steps of the root of that number."""
    def deal(x: str, shift: int) -> str:
        pick = f"pmod(shiftright(xxhash64(d, {seed + 7}), {shift}), bigint(r)) = bigint(k)"
        return (f"transform(sequence(0, r - 1), k -> struct(filter({x}.a, d -> {pick}) AS a, "
                f"filter({x}.b, d -> {pick}) AS b))")

    root = f"int(ceil(sqrt((size({a}) + size({b})) / {PART}.0)))"
    return (f"transform(array(greatest(1, {root})), r -> flatten(transform("
            f"transform(array(struct({a} AS a, {b} AS b)), w -> {deal('w', 0)})[0], "
            f"y -> {deal('y', 24)})))[0]")


def _compare(a: str, b: str, seed: int = 1, width: int = WIDTH) -> str:
    """SQL: ``struct<da, db, failed>``; ``failed`` holds the parts left over."""
    return (f"transform(array(transform({_parts(a, b, seed)}, w -> struct({_peel('w.a', 'w.b', width, seed)} AS r, w AS w))), "
            f"rs -> struct(aggregate(filter(rs, x -> x.r.ok), 0, (t, x) -> t + x.r.da) AS da, "
            f"aggregate(filter(rs, x -> x.r.ok), 0, (t, x) -> t + x.r.db) AS db, "
            f"transform(filter(rs, x -> NOT x.r.ok), x -> x.w) AS failed))[0]")


def differences(df: DataFrame, key: str, pairs: dict[str, tuple[str, str]], spent: tuple = ()) -> DataFrame:
    """``df`` with, for each name of ``pairs`` (two columns of digests), a
    column ``name``: struct of the digests only in the first (``da``) and only
    in the second (``db``), counted by peeling.  ``key`` must be unique.  ``spent``
    are tables that only ``df`` reads; they go once it has been written."""
    first = df.select("*", *[F.expr(_compare(a, b)).alias(name) for name, (a, b) in pairs.items()])
    drop = {c for ab in pairs.values() for c in ab}
    first = materialize(first.drop(*drop), "sketch", CODEC)
    discard(*spent)
    solved, open_, tables, seed, width = [], None, [], 1, WIDTH
    for name in pairs:
        rows = first.select(key, F.lit(name).alias("pair"), F.explode(f"{name}.failed").alias("w"))
        open_ = rows if open_ is None else open_.unionByName(rows)
    open_ = materialize(open_, "unpeeled")
    while open_.limit(1).count():
        seed, width = seed + 1, min(2 * width, 15)  # 60 cells fill a 64-bit mask
        tried = materialize(open_.select(key, "pair", F.expr(
            f"transform(array({_compare('w.a', 'w.b', seed, width)}), r -> r)[0]").alias("r")), "sketch")
        tables += [open_, tried]
        solved.append(tried.select(key, "pair", "r.da", "r.db"))
        open_ = materialize(tried.select(key, "pair", F.explode("r.failed").alias("w")), "unpeeled")
    out = first
    if solved:
        more = solved[0]
        for s in solved[1:]:
            more = more.unionByName(s)
        more = more.groupBy(key).agg(*[
            F.sum(F.when(F.col("pair") == name, F.col(side))).alias(f"{name}_{side}")
            for name in pairs for side in ("da", "db")])
        out = out.join(more, key, "left")
        out = out.select(*df.drop(*drop).columns, *[F.struct(*[
            (F.col(f"{name}.{side}") + F.coalesce(f"{name}_{side}", F.lit(0))).alias(side) for side in ("da", "db")
        ]).alias(name) for name in pairs])
    out = materialize(out, "differences", CODEC)
    discard(first, open_, *tables)
    return out


def likeness(na: str, nb: str, pair: str) -> Column:
    """Shared paragraphs over all paragraphs of two versions; 1 if neither has any."""
    union = F.col(na) + F.col(f"{pair}.db")
    return F.when(union == 0, F.lit(1.0)).otherwise((F.col(na) - F.col(f"{pair}.da")) / union)


def neighbours(rows: DataFrame) -> DataFrame:
    """``row, prev_row, prev_n`` for ``row, id, n``: who comes before in
    ascending (id, row); the last comes before the first.  Ranges of the order
    are linked to each other by their ends, so no task sees all rows."""
    ranges = min(MAX_RANGES, max(8, rows.count() // RANGE_ROWS))
    rows = materialize(rows.repartitionByRange(ranges, "id", "row")
                       .withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy("id", "row")
    last = rows.groupBy("part").agg(F.max_by(F.struct("row", "n"), F.struct("id", "row")).alias("last"))
    across = Window.orderBy("part")  # one row a range
    ends = last.select("part", F.coalesce(F.lag("last").over(across), F.last("last").over(
        across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    rows = rows.withColumn("lag", F.lag(F.struct("row", "n")).over(inside)).join(ends, "part")
    prev = F.coalesce("lag", "before")
    return rows.select("row", prev["row"].alias("prev_row"), prev["n"].alias("prev_n"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` and paragraph counts.

    The edited text is the text with its last ``floor(n_chars / 4)`` code
    points replaced by the first as many (or all) of the next document's, in
    ascending id order (after the last, the first; equal or NULL ids by row).
    NULL counts as empty; a lone document is its own next.  ``near_*`` is the
    share of paragraphs two versions have in common, from peeled sketches.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = number(df.select(F.col(id_col).alias("id"), text.alias("text")), "row", CODEC)
    order = materialize(neighbours(base.select("row", "id", F.char_length("text").cast("long").alias("n"))), "order")
    # One shuffle of the texts serves both sides of the second join.
    dealt = base.join(order, "row").withColumn("n", F.char_length("text").cast("long"))
    heads = dealt.select(F.col("prev_row").alias("row"), F.col("id").alias("next_id"),
                         F.expr("substring(text, 1, int(prev_n div 4))").alias("head"),
                         F.expr(digests("text")).alias("next_digests"))
    both = (dealt.select("row", "id", "n", "text").join(heads, "row")
            .withColumn("edited", F.expr("concat(substring(text, 1, int(n - n div 4)), head)"))
            .select("row", "id", "next_id", "n", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
                    F.expr(digests("text")).alias("a"), F.expr(digests("edited")).alias("e"), "next_digests")
            .select("*", F.expr(fingerprint("a")).alias("fp"), F.expr(fingerprint("e")).alias("fe"),
                    *[F.size(c).alias(n) for c, n in (("a", "na"), ("e", "ne"), ("next_digests", "nn"))]))
    found = differences(both, "row", {"edit": ("a", "e"), "next": ("a", "next_digests")}, spent=(order, base))
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        F.col("fp").alias("fingerprint"), F.col("fe").alias("edited_fingerprint"),
        likeness("na", "ne", "edit").alias("near_edited"), likeness("na", "nn", "next").alias("near_next"),
        F.col("na").alias("paragraphs"), F.col("ne").alias("edited_paragraphs"), F.col("next_id").alias("next_doc_id"))
