"""JDBC sink (A4, A5 database form).

The batch is written to a staging table with Spark's JDBC writer (parallel,
one connection per partition), then one set-based statement merges it into
the target.  The statement text is generated here for two dialects; running
it needs a database client on the driver, which the caller passes as
``execute(sql) -> rows`` (no client library is bundled).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorflow.functions.casts import conform_casts


def quote(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


def jdbc_stage_overwrite(df: DataFrame, url: str, table: str, properties: dict | None = None,
                         casts: dict | None = None, num_partitions: int | None = None) -> None:
    """A4: overwrite ``table`` with ``df`` (optional B11 casts first)."""
    opts = {"url": url, "dbtable": table}
    opts.update(properties or {})
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    conform_casts(df, casts).write.format("jdbc").options(**opts).mode("overwrite").save()


def upsert_sql(stage: str, target: str, columns: list[str], key: str | list[str],
               dialect: str = "postgres", with_counts: bool = False) -> str:
    """Set-based upsert of ``stage`` into ``target`` replacing every non-key column.

    ``postgres``: ``INSERT ... ON CONFLICT (key) DO UPDATE`` (optionally
    returning insert/update counts through ``xmax = 0``); ``merge``: standard
    SQL ``MERGE``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = ", ".join(quote(c) for c in columns)
    non_key = [c for c in columns if c not in keys]
    if dialect == "postgres":
        sets = ", ".join(f"{quote(c)} = EXCLUDED.{quote(c)}" for c in non_key)
        action = f"DO UPDATE SET {sets}" if non_key else "DO NOTHING"
        stmt = (f"INSERT INTO {quote(target)} ({cols}) SELECT {cols} FROM {quote(stage)} "
                f"ON CONFLICT ({', '.join(quote(k) for k in keys)}) {action}")
        if not with_counts:
            return stmt + ";"
        return (f"WITH upserted AS ({stmt} RETURNING (xmax = 0) AS is_insert) "
                "SELECT COUNT(*) FILTER (WHERE is_insert) AS inserts, "
                "COUNT(*) FILTER (WHERE NOT is_insert) AS updates FROM upserted;")
    if dialect == "merge":
        on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys)
        sets = ", ".join(f"{quote(c)} = s.{quote(c)}" for c in non_key)
        vals = ", ".join(f"s.{quote(c)}" for c in columns)
        matched = f"WHEN MATCHED THEN UPDATE SET {sets} " if non_key else ""
        return (f"MERGE INTO {quote(target)} t USING {quote(stage)} s ON ({on}) {matched}"
                f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")
    raise ValueError(f"unknown dialect {dialect!r}")


def drop_sql(table: str) -> str:
    return f"DROP TABLE IF EXISTS {quote(table)};"


def match_count_sql(stage: str, target: str, key: str | list[str]) -> str:
    """Rows staged, and how many of them the target already has."""
    keys = [key] if isinstance(key, str) else list(key)
    on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys)
    return (f"SELECT COUNT(*), COUNT(t.{quote(keys[0])}) FROM {quote(stage)} s "
            f"LEFT JOIN {quote(target)} t ON ({on})")


class JdbcUpsertSink:
    """Stage + merge into a database table, with the interface of ``KeyedTable``
    (``upsert``, ``read``, ``exists``), so jobs and streams take either.

    ``execute`` runs SQL on the driver and returns rows; ``write`` stages a
    frame (default: Spark's JDBC writer).  The statement is atomic, so readers
    never see half a batch.  A key that occurs twice is refused by the database.
    """

    def __init__(self, spark: SparkSession, url: str, target: str, columns: list[str], key: str | list[str],
                 execute: Callable[[str], list], properties: dict | None = None,
                 stage: str | None = None, dialect: str = "postgres", drop_stage: bool = True,
                 casts: dict | None = None, num_partitions: int | None = None,
                 write: Callable[..., None] = jdbc_stage_overwrite):
        self.spark, self.url, self.target, self.columns, self.key = spark, url, target, columns, key
        self.execute, self.properties = execute, properties or {}
        self.stage = stage or f"stage_{target}"
        self.dialect, self.drop_stage = dialect, drop_stage
        self.casts, self.num_partitions, self.write = casts, num_partitions, write

    def exists(self) -> bool:
        return True  # the target is created by the database's own DDL

    def read(self) -> DataFrame:
        opts = {"url": self.url, "dbtable": quote(self.target), **self.properties}
        return self.spark.read.format("jdbc").options(**opts).load()

    def upsert(self, df: DataFrame, source_rows: int | None = None,
               batch_id: int | None = None) -> tuple[int, int]:
        """Returns ``(inserts, updates)``.  With ``merge``, which reports none,
        they are counted between stage and target just before the statement."""
        self.write(df.select(*self.columns), self.url, self.stage, self.properties, self.casts,
                   self.num_partitions)
        returning = self.dialect == "postgres"
        if not returning:
            total, matched = self.execute(match_count_sql(self.stage, self.target, self.key))[0][:2]
        rows = self.execute(upsert_sql(self.stage, self.target, self.columns, self.key,
                                       self.dialect, with_counts=returning))
        if returning:
            inserts, updates = rows[0][:2]
        else:
            inserts, updates = total - matched, matched
        if self.drop_stage:
            self.execute(drop_sql(self.stage))
        return int(inserts), int(updates)
