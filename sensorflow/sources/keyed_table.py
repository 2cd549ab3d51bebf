"""Keyed parquet table with upsert (the DataFrame sink of A5/A6).

No transactional table format is on the classpath, so the table is plain
parquet partitioned by columns that are functions of the key (a hash bucket
``pmod(xxhash64(key), buckets)`` or the caller's, e.g. the day of a timestamp
that is part of the key).  An upsert rewrites only the partitions the batch
touches:

1. the distinct values of each partition column, NULL among them, prune the
   scan of the table (the driver holds these values: days times buckets);
2. old rows of touched partitions are joined once with the batch's keys; those
   without a hit stay, the others are counted as updates;
3. stay and batch are written with dynamic partition overwrite in the same job:
   files go to a job-private folder and the touched partitions are swapped at
   job commit, after all tasks have read the old files, so a lost executor's
   retried task still reads the old data.

The batch must be unique on the key; a key that occurs twice fails the job
before anything is committed, as the database statement would.  The swap at job
commit moves one folder after the other: a driver that dies in it leaves some
partitions old and some new, and the replay completes them.  With readers or
writers at the same time use the database sink (``sources.jdbc``).

*Order.*  With ``order`` (columns of the message order, stored with the row) a
row replaces a stored one only if it is not older, so batches may arrive in any
order; older rows are counted as ``stale``.

*Changes.*  With ``changes_path`` the merge of a batch is first decided and
written there, one folder a batch: for every row of the batch its ``op``
(``insert``, ``update``, ``same``: equal in every column, ``stale``) with the old
and the new image.  The table is then brought up to that record.  A replayed
batch finds the record and does not decide again, so its counts and changes are
those of the first time, wherever the driver had died.  Without it counts are
taken against the table as it is, and a replayed batch reports updates.
"""

from __future__ import annotations

import uuid
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.joins import fits_broadcast
from sensorflow.operators.upsert import upsert, upsert_counts
from sensorflow.schemas import TableSpec
from sensorflow.session import hadoop_path, path_exists

CHANGED = ("insert", "update")


class KeyedTable:
    """``partition_by`` (name to column) or ``buckets`` fixes the layout; one
    bucket should hold what a task can rewrite, so ``buckets`` grows with the
    table.  With ``spec`` the table exists from the start, empty and typed."""

    def __init__(self, spark: SparkSession, path: str, key: list[str] | str,
                 partition_by: dict[str, Column] | None = None, buckets: int | None = None,
                 spec: TableSpec | None = None, order: list[str] | None = None,
                 changes_path: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        if partition_by is None:
            if not buckets:
                raise ValueError("partition_by or buckets must be given")
            partition_by = {"_bucket": F.pmod(F.xxhash64(*[F.col(k) for k in self.key]), F.lit(buckets))}
        self.partition_by = partition_by
        self.partition_cols = list(partition_by)
        self.spec = spec
        self.order = list(order or [])
        self.changes_path = changes_path.rstrip("/") if changes_path else None
        self.stale = 0  # rows of the last upsert that were older than the stored ones
        self._schema: T.StructType | None = None

    # -- reading ---------------------------------------------------------
    def _raw(self) -> DataFrame | None:
        """The stored rows with their partition columns.  The schema is read
        from the files once; later reads give it."""
        if not path_exists(self.spark, self.path):
            return None
        if self._schema is None:
            df = self.spark.read.parquet(self.path)  # an unreadable table is not an empty one
            names = [c for c in df.columns if c not in self.partition_cols]
            typed = self.spark.createDataFrame([], df.select(*names).schema).withColumns(self.partition_by).schema
            self._schema = T.StructType([f if f.name in names else T.StructField(f.name, f.dataType) for f in typed])
        return self.spark.read.schema(self._schema).parquet(self.path)  # a folder's name does not tell NULL's type

    def exists(self) -> bool:
        return self.spec is not None or self._raw() is not None

    def read(self, with_partition_cols: bool = False, with_order: bool = False) -> DataFrame:
        """The table as it is now: files are listed at each call.  Order
        columns that are not the table's own are left out unless asked for."""
        df = self._raw()
        if df is None:
            if self.spec is None:
                raise FileNotFoundError(f"keyed table {self.path} has no data yet")
            return self.spec.empty(self.spark)
        hidden = [] if with_order else self._order_only()
        return df.drop(*hidden) if with_partition_cols else df.drop(*hidden, *self.partition_cols)

    def _order_only(self) -> list[str]:
        own = self.spec.column_names if self.spec is not None else []
        return [c for c in self.order if c not in own and c.startswith("_")]

    # -- writing ---------------------------------------------------------
    def _once(self, source: DataFrame) -> DataFrame:
        """``source``, failing at run time on a key that occurs twice."""
        others = [c for c in source.columns if c not in self.key]
        rows = source.groupBy(*self.key).agg(
            F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
        twice = F.raise_error(F.concat(F.lit("duplicate key in upsert: "),
                                       F.to_json(F.struct(*self.key))))
        first = self.key[0]
        return rows.withColumn(first, F.when(F.col("__n") > 1, twice.cast(source.schema[first].dataType))
                               .otherwise(F.col(first))).select(*source.columns)

    def _touched(self, rows: DataFrame, counts: dict[str, Column] | None = None, only: Column | None = None
                 ) -> tuple[dict[str, int], tuple[dict, int]]:
        """Number of rows (``n``) and other ``counts``; for each partition column the
        values of the rows (``only`` some), and whether NULL is one; how many
        partitions these rows are in.  One job."""
        def kept(c: Column) -> Column:
            return c if only is None else F.when(only, c)

        null = [F.col(c).isNull() & (F.lit(True) if only is None else only) for c in self.partition_cols]
        found = rows.agg(F.count(kept(F.lit(1))).alias("n"), *[c.alias(name) for name, c in (counts or {}).items()],
                         *[F.collect_set(kept(F.col(c))).alias(f"v{i}") for i, c in enumerate(self.partition_cols)],
                         *[F.count_if(c).alias(f"null{i}") for i, c in enumerate(null)],
                         F.size(F.collect_set(kept(F.struct(*self.partition_cols)))).alias("partitions")).first()
        return ({name: found[name] for name in ("n", *(counts or {}))},
                ({c: (sorted(found[f"v{i}"]), found[f"null{i}"] > 0) for i, c in enumerate(self.partition_cols)},
                 found["partitions"]))

    def _pruned(self, old: DataFrame, touched: tuple[dict, int], rows: DataFrame) -> DataFrame:
        """Old rows of the partitions that ``rows`` are in."""
        values_of, partitions = touched
        for c, (values, null) in values_of.items():
            hit = F.col(c).isin(values) if values else F.lit(False)
            old = old.filter(hit | F.col(c).isNull() if null else hit)
        if partitions == prod(len(values) + null for values, null in values_of.values()):
            return old
        # the values' product holds other partitions; a join that shuffled would move every old row
        here = rows.select(*[F.col(c).alias(f"__here_{c}") for c in self.partition_cols]).distinct()
        here = F.broadcast(here) if fits_broadcast(here, here.columns, partitions) else here
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__here_{c}")) for c in self.partition_cols])
        return old.join(here, same, "left_semi")

    def _write(self, rows: DataFrame) -> None:
        # rebalance: rows of a partition meet in few files, and AQE splits a large partition over tasks
        (rows.hint("rebalance", *self.partition_cols)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_cols).parquet(self.path))

    def upsert(self, source: DataFrame, source_rows: int | None = None,
               batch_id: int | None = None) -> tuple[int, int]:
        """Upsert ``source``; returns ``(inserts, updates)``, and leaves the
        number of older rows in ``stale``.  ``source_rows``, a known bound of the
        batch's rows, lets its keys be broadcast; ``batch_id`` names the
        batch in the record of changes."""
        if self.spec is not None:
            more = [c for c in self.order if c not in self.spec.column_names]
            source = source.select(*[F.col(c).cast(t) for c, t in self.spec.columns], *more)
        if self.changes_path:
            return self._recorded(source, source_rows, batch_id)
        src, laid = self._once(source).withColumns(self.partition_by), source.withColumns(self.partition_by)
        counts, touched = self._touched(laid)
        self.stale = 0
        if not counts["n"]:
            return 0, 0
        old = self._raw()
        if old is None:
            merged = src.withColumns({"__new": F.lit(True), "__hit": F.lit(False), "__out": F.lit(False), "__stale": F.lit(False)})
        elif self.order:
            merged = self._newer(self._pruned(old, touched, laid), src)
        else:
            keys = src.select(*self.key, F.lit(True).alias("__hit"))
            stay = (self._pruned(old, touched, laid).join(keys, self.key, "left")
                    .withColumn("__hit", F.coalesce("__hit", F.lit(False)))
                    .withColumns({"__new": F.lit(False), "__out": F.col("__hit"), "__stale": F.lit(False)}))
            src = src.select(*old.columns).withColumns(
                {"__new": F.lit(True), "__hit": F.lit(False), "__out": F.lit(False), "__stale": F.lit(False)})
            merged = stay.select(*src.columns).unionByName(src)
        obs = Observation(f"keyed_upsert_{uuid.uuid4().hex}")
        counted = merged.observe(obs, F.count_if("__new").alias("n"), F.count_if("__hit").alias("u"),
                                 F.count_if("__stale").alias("s"))
        self._write(counted.filter(~F.col("__out")).drop("__new", "__hit", "__out", "__stale"))
        updates, self.stale = int(obs.get["u"]), int(obs.get["s"])
        return int(obs.get["n"]) - updates, updates

    def _newer(self, old: DataFrame, src: DataFrame) -> DataFrame:
        """Old rows and batch merged on the key, the newer one of two.  A row
        of equal order is the same message again and replaces."""
        both = (old.select(*self.key, F.struct(*old.columns).alias("__o"))
                .join(src.select(*self.key, F.struct(*old.columns).alias("__s")), self.key, "full_outer"))
        has_old, has_new = F.col("__o").isNotNull(), F.col("__s").isNotNull()
        wins = has_new & (~has_old | self._not_older(F.col("__s"), F.col("__o")))
        row = F.when(wins, F.col("__s")).otherwise(F.col("__o"))
        return both.select(row.alias("__r"), wins.alias("__new"), (wins & has_old).alias("__hit"), F.lit(False).alias("__out"),
                           (has_new & ~wins).alias("__stale")).select("__r.*", "__new", "__hit", "__out", "__stale")

    def _not_older(self, new: Column, old: Column) -> Column:
        def order(row: Column) -> Column:
            return F.struct(*[row[c] for c in self.order])
        return order(new) >= order(old)

    # -- changes ---------------------------------------------------------
    def _folder(self, batch_id: int) -> str:
        return f"{self.changes_path}/batch_id={batch_id}"

    def _is_recorded(self, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self._folder(batch_id)}/_SUCCESS")

    def _batches(self) -> list[int]:
        """Numbers of the recorded batches, from the names of their folders."""
        fs, root = hadoop_path(self.spark, self.changes_path)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(b for b in (int(n.split("=")[1]) for n in names if n.startswith("batch_id=")) if self._is_recorded(b))

    def _decide(self, source: DataFrame, source_rows: int | None, batch_id: int) -> None:
        """Writes what the batch does to every key it holds, against the table as it is."""
        src, laid = self._once(source).withColumns(self.partition_by), source.withColumns(self.partition_by)
        counts, touched = self._touched(laid)
        old = self._raw() if counts["n"] else None
        new = F.struct(*source.columns)
        if old is None:
            decided = src.select(*self.partition_cols, F.lit("insert").alias("op"),
                                 F.lit(None).cast(src.select(new.alias("s")).schema["s"].dataType).alias("old"), new.alias("new"))
        else:
            keys = src.select(*self.key)
            if fits_broadcast(source, self.key, source_rows):
                keys = F.broadcast(keys)
            hits = self._pruned(old, touched, laid).join(keys, self.key, "left_semi").select(
                *self.key, F.struct(*source.columns).alias("old"))
            both = src.select(*self.key, *self.partition_cols, new.alias("new")).join(hits, self.key, "left")
            older = ~self._not_older(F.col("new"), F.col("old")) if self.order else F.lit(False)
            op = (F.when(F.col("old").isNull(), "insert").when(older, "stale")
                  .when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("update"))
            decided = both.select(*self.partition_cols, op.alias("op"), "old", "new")
        decided.write.mode("overwrite").parquet(self._folder(batch_id))

    def recorded(self, batch_id: int) -> bool:
        """Whether the batch has been decided, here or before a restart."""
        return self.changes_path is not None and self._is_recorded(batch_id)

    def _recorded(self, source: DataFrame, source_rows: int | None, batch_id: int | None) -> tuple[int, int]:
        if batch_id is None:
            batches = self._batches()
            batch_id = batches[-1] + 1 if batches else 0
        if not self._is_recorded(batch_id):
            self._decide(source, source_rows, batch_id)
        return self.replay(batch_id)

    def replay(self, batch_id: int) -> tuple[int, int]:
        """Brings the table up to the record of a batch; its counts."""
        batches = self._batches()
        decided = self.spark.read.parquet(self._folder(batch_id))
        wins = F.col("op").isin(*CHANGED)
        counts, touched = self._touched(decided, {op: F.count_if(F.col("op") == op) for op in (*CHANGED, "same", "stale")}, wins)
        if batch_id >= batches[-1] and counts["n"]:  # earlier batches were applied before later ones were decided
            wins = decided.filter(wins)
            new = wins.select("new.*", *self.partition_cols)
            old = self._raw()
            if old is not None:
                keys = new.select(*self.key)
                keys = F.broadcast(keys) if fits_broadcast(new, self.key, counts["n"]) else keys
                new = self._pruned(old, touched, wins).join(keys, self.key, "left_anti").unionByName(new.select(*old.columns))
            self._write(new)
        self.stale = counts["stale"]
        return counts["insert"], counts["update"] + counts["same"]

    def changes(self, batch_id: int | None = None) -> DataFrame:
        """``batch_id, op, old, new`` of each row that a batch (or every one)
        inserted or replaced by a different one."""
        batches = self._batches() if batch_id is None else [batch_id]
        if not batches:
            raise FileNotFoundError(f"no batch is recorded in {self.changes_path}")
        df = self.spark.read.option("basePath", self.changes_path).parquet(*map(self._folder, batches))
        hidden = self._order_only()
        return df.filter(F.col("op").isin(*CHANGED)).select(
            F.col("batch_id").cast("bigint").alias("batch_id"), "op",
            *[(F.col(c).dropFields(*hidden) if hidden else F.col(c)).alias(c) for c in ("old", "new")])

    def delete(self, keys: DataFrame, keys_rows: int | None = None) -> int:
        """Removes the rows whose key is in ``keys``; returns their number.
        Partitions that are left empty go with their folder."""
        old = self._raw()
        if old is None:
            return 0
        gone = keys.select(*self.key).distinct()
        gone = F.broadcast(gone) if fits_broadcast(gone, self.key, keys_rows) else gone
        marked = old.join(gone.withColumn("__gone", F.lit(True)), self.key, "left")
        found = marked.groupBy(*self.partition_cols).agg(F.count("__gone").alias("__hits"), F.count(F.lit(1)).alias("__all")).filter(
            "__hits > 0").collect()  # partitions, not rows
        if not found:
            return 0
        emptied = [r for r in found if r["__hits"] == r["__all"]]
        some = [r for r in found if r["__hits"] < r["__all"]]
        if some:
            values_of = {c: (sorted({r[c] for r in some} - {None}), any(r[c] is None for r in some)) for c in self.partition_cols}
            here = self.spark.createDataFrame([tuple(r[c] for c in self.partition_cols) for r in some],
                                              old.select(*self.partition_cols).schema)
            self._write(self._pruned(old, (values_of, len(some)), here).join(gone, self.key, "left_anti"))
        for row in emptied:
            fs, path = hadoop_path(self.spark, "/".join([self.path, *(
                f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in self.partition_cols)]))
            fs.delete(path, True)
        return sum(r["__hits"] for r in found)


class VersionedTable:
    """Snapshot-per-batch keyed table: replay-exact counts, atomic reads.

    Batch ``n`` merges its source into the newest committed version below
    ``n`` and writes the result as the snapshot ``v=n``; a small commit record
    written afterwards makes it visible.  Replaying batch ``n`` rebuilds the
    same snapshot from the same base, so table *and* insert/update counts are
    identical, and readers always see one whole snapshot.  Every batch
    rewrites the table, so this mode suits dimension-sized tables; facts use
    the partitioned ``KeyedTable``.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str] | str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)

    def _versions(self) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.path}/_commits"):
            return None
        return (self.spark.read.option("recursiveFileLookup", "true").schema("version bigint")
                .json(f"{self.path}/_commits"))

    def latest_version(self, below: int | None = None) -> int | None:
        commits = self._versions()
        if commits is None:
            return None
        if below is not None:
            commits = commits.filter(F.col("version") < below)
        return commits.agg(F.max("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame:
        v = self.latest_version(None if version is None else version + 1)
        if v is None:
            raise FileNotFoundError(f"versioned table {self.path} has no committed version")
        return self.spark.read.parquet(f"{self.path}/v={v}")

    def upsert(self, source: DataFrame, source_rows: int | None = None,
               batch_id: int | None = None) -> tuple[int, int]:
        if batch_id is None:
            last = self.latest_version()
            batch_id = 0 if last is None else last + 1
        base_v = self.latest_version(below=batch_id)
        if base_v is None:
            merged, counts = source, None
        else:
            base = self.spark.read.parquet(f"{self.path}/v={base_v}")
            source = source.select(*base.columns)
            counts = upsert_counts(base, source, self.key, source_rows).first()
            merged = upsert(base, source, self.key, source_rows)
        merged.write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        (self.spark.createDataFrame([(int(batch_id),)], "version bigint")
         .write.mode("overwrite").json(f"{self.path}/_commits/{batch_id}"))
        if counts is None:
            n = source_rows if source_rows is not None else self.spark.read.parquet(
                f"{self.path}/v={batch_id}").count()
            return int(n), 0
        return int(counts["inserts"]), int(counts["updates"])
