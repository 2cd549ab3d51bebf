"""Table constraints (F1-F5) with a quarantine output.

A row that breaks a rule is not dropped silently and does not abort the
write: it goes to the quarantine frame with the rule name and its JSON text
(so it can be re-driven once, e.g., its parent arrives).  ``mode="strict"``
raises instead, like a database rejecting the statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.joins import fits_broadcast, fk_orphans, orphan_keys
from sensorflow.schemas import TableSpec


# Row JSON keeps microseconds, and reads back what it wrote.
ROW_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _any_null(cols: list[str]):
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def check_primary_key(df: DataFrame, key: list[str]) -> DataFrame:
    """key values that are NULL or occur more than once, with their row count ``n``."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | _any_null(key)))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows with a NULL in any of ``columns``."""
    return df.filter(_any_null(columns))


def check_max_length(df: DataFrame, limits: dict) -> DataFrame:
    """rows whose text is longer than VARCHAR(n) allows (characters, not bytes)."""
    cond = F.lit(False)
    for c, n in limits.items():
        cond = cond | (F.char_length(F.col(c)) > n)
    return df.filter(cond)


def check_foreign_key(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """rows whose non-NULL ``column`` has no parent row."""
    return fk_orphans(df, parent, column, parent_column)


class Checked(tuple):
    """``(valid, quarantine)``; ``flagged`` is the frame behind both, cached
    when ``validate(..., cache=True)`` (release it when done)."""

    flagged: DataFrame

    def rejected(self) -> int:
        """Rows that break a rule, however many they break."""
        return self.flagged.filter(F.size("__rules") > 0).count()

    def release(self) -> None:
        self.flagged.unpersist()


def validate(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None,
             mode: str = "quarantine", with_columns: bool = False,
             cache: bool = False, unique_key: bool = False,
             rows_hint: int | None = None) -> Checked:
    """Apply every rule of ``spec``; return ``(valid, quarantine)``.

    Quarantine columns: ``table, rule, row_json`` (+ the row's own columns when
    ``with_columns``), one row per broken rule.  Foreign keys are checked for
    the parents given in ``parents`` (table name -> frame of that table).
    ``cache`` persists the flagged rows so both outputs share one evaluation
    (release it with ``.release()`` on the result).  ``unique_key`` skips the
    duplicate-key aggregation when the caller deduped on the key already;
    ``rows_hint`` (a known row count) lets foreign-key checks broadcast the
    frame's key set instead of shuffling the parent.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError("mode must be 'quarantine' or 'strict'")
    key = list(spec.key)
    cols = df.columns
    rules = []
    for c in spec.not_null:
        if c in cols:
            rules.append((F.col(c).isNull(), f"not_null:{c}"))
    for c, n in spec.max_length.items():
        if c in cols:
            rules.append((F.char_length(F.col(c)) > n, f"max_length:{c}"))
    rules.append((_any_null(key), "pk_null"))

    flagged = df
    if not unique_key:
        dup_keys = (df.filter(~_any_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
                    .filter(F.col("__n") > 1).select(*key, F.lit(True).alias("__dup")))
        flagged = flagged.join(dup_keys, key, "left")
        rules.append((F.col("__dup").isNotNull(), "pk_duplicate"))

    for i, fk in enumerate(spec.foreign_keys):
        if not parents or fk.parent not in parents or fk.column not in cols:
            continue
        orphan = (orphan_keys(df, parents[fk.parent], fk.column, fk.parent_column, rows_hint)
                  .select(F.col("__fk").alias(f"__fkv{i}"), F.lit(True).alias(f"__orphan{i}")))
        if fits_broadcast(df, [fk.column], rows_hint):
            orphan = F.broadcast(orphan)  # at most the frame's distinct key count
        flagged = flagged.join(orphan, F.col(fk.column) == F.col(f"__fkv{i}"), "left")
        rules.append((F.col(f"__orphan{i}").isNotNull(), f"fk:{fk.column}->{fk.parent}"))

    flagged = flagged.withColumn(
        "__rules", F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in rules])))
    if cache:
        flagged = flagged.select(*cols, "__rules").persist()
    valid = flagged.filter(F.size("__rules") == 0).select(*cols)
    extra = [F.col(c) for c in cols] if with_columns else []
    quarantine = flagged.filter(F.size("__rules") > 0).select(
        F.lit(spec.name).alias("table"), F.explode("__rules").alias("rule"),
        F.to_json(F.struct(*[F.col(c) for c in cols]), ROW_JSON).alias("row_json"),
        *extra)
    if mode == "strict":
        bad = quarantine.limit(5).collect()
        if bad:
            raise ValueError(f"{spec.name}: constraint violations, e.g. {[r.asDict() for r in bad]}")
    out = Checked((valid, quarantine))
    out.flagged = flagged
    return out


def parent_first_order(specs: list[TableSpec]) -> list[str]:
    """write order in which every parent precedes its children."""
    names = {s.name for s in specs}
    deps = {s.name: {fk.parent for fk in s.foreign_keys if fk.parent in names and fk.parent != s.name}
            for s in specs}
    order: list[str] = []
    while deps:
        ready = sorted(n for n, d in deps.items() if not d - set(order))
        if not ready:
            raise ValueError(f"foreign-key cycle among {sorted(deps)}")
        order.extend(ready)
        for n in ready:
            del deps[n]
    return order


def redrive(quarantine: DataFrame, spec: TableSpec, rules: list[str] | None = None,
            schema: T.StructType | None = None) -> DataFrame:
    """Typed rows back from a quarantine of ``spec``'s table (optionally only
    rows that broke one of ``rules``), one per quarantined row even when it
    broke several rules -- ready to be validated and upserted again, e.g.
    once a late parent row has arrived.  ``schema`` gives other types than the
    table's, such as those of the frame that was quarantined."""
    q = quarantine.filter(F.col("table") == spec.name)
    if rules:
        q = q.filter(F.col("rule").isin(rules))
    parsed = q.select("row_json").distinct().select(
        F.from_json("row_json", schema or spec.struct_type(), ROW_JSON).alias("__r"))
    return parsed.select(*[F.col(f"__r.{c}").alias(c) for c in spec.column_names])
