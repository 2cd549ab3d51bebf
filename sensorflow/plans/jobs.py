"""Writing the star schema (I1/I2 tails, C6, F5, A5).

``write_in_order`` validates and upserts a set of table frames parent first.
Foreign keys are checked against the parent rows accepted in this run plus
those already stored; orphans go to quarantine instead of failing the write.
``location_table`` and ``sensor`` are written only when both have rows (the
original job's guard), counted on the checked rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.constraints import Checked, parent_first_order, validate
from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.plans.dims import country_parameter_dims, location_sensor_dims
from sensorflow.schemas import MESSAGES, TABLES, MessageSchemas, TableSpec
from sensorflow.session import discard, materialize
from sensorflow.sources.envelope import decode_value, kafka_batch_source
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.sources.quarantine import QuarantineStore, Ready

GUARDED_PAIRS = (("location_table", "sensor"),)


def write_in_order(spark: SparkSession, frames: dict[str, DataFrame], tables: dict[str, KeyedTable],
                   specs: dict[str, TableSpec] | None = None, mode: str = "quarantine",
                   quarantine_path: str | None = None,
                   unique: frozenset[str] = frozenset(), run_id: str = "0",
                   store: QuarantineStore | None = None) -> dict[str, dict]:
    """``unique`` names frames already deduped on their key (the duplicate-key
    check is skipped for them; NULL keys are still quarantined).  Quarantined
    rows are stored under ``run_id``; a run repeated under its id replaces
    them.  A table whose frame is empty is left alone.

    With ``store`` refused rows are held there, and rows that it holds for any of
    ``tables`` come back as soon as their parents are stored or accepted in this
    run (``released``), however many levels of them are missing."""
    specs = specs or TABLES
    order = parent_first_order([specs[n] for n in (tables if store else frames)])
    results: dict[str, dict] = {}
    checks: dict[str, Checked] = {}
    rows: dict[str, tuple[int, int]] = {}
    back: dict[str, Ready | None] = {}
    try:
        # every frame is computed once: its check fills the cache that counts, children and the write read
        for name in order:
            spec, parents = specs[name], {}
            for fk in spec.foreign_keys:
                keys = [checks[fk.parent][0].select(fk.parent_column)] if fk.parent in checks else []
                table = tables.get(fk.parent)
                if table is not None and table.exists():
                    keys.append(table.read().select(fk.parent_column))
                if keys:
                    parents[fk.parent] = reduce(DataFrame.unionByName, keys)
            back[name] = ready = store.ready(spec, parents) if store else None
            if name not in frames and ready is None:
                continue
            frame, only = frames.get(name), name in unique
            if ready:
                # of several rows with a key the delivered one counts; among those that come back any, but always the same
                returned = ready.rows(spec.struct_type())
                returned = dedupe_by_key(returned.withColumn("__text", F.to_json(F.struct(*returned.columns))),
                                         list(spec.key), ["__text"]).drop("__text")
                if frame is not None:
                    returned = returned.join(frame.select(*spec.key), list(spec.key), "left_anti")
                    frame = frame.unionByName(returned.select(*[F.col(f.name).cast(f.dataType) for f in frame.schema]))
                else:
                    frame, only = returned, True
            checks[name] = checked = validate(frame, spec, parents, mode=mode, cache=True, unique_key=only)
            rows[name] = checked.flagged.agg(F.count(F.lit(1)), F.count_if(F.size("__rules") > 0)).first()
        skip = {n for pair in GUARDED_PAIRS if all(p in frames for p in pair) and not all(rows[p][0] for p in pair) for n in pair}
        for name in order:
            total, bad = rows.get(name, (0, 0))
            if name in skip or not total:
                if name in frames:
                    results[name] = {"inserts": 0, "updates": 0, "quarantined": 0, "skipped": True}
                continue
            valid, quarantine = checks[name]
            if bad and quarantine_path:
                q = quarantine.withColumn("run_id", F.lit(run_id))
                (q.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("table", "run_id").parquet(quarantine_path))
            inserts, updates = tables[name].upsert(valid) if total > bad else (0, 0)
            results[name] = {"inserts": inserts, "updates": updates, "quarantined": bad, "skipped": False}
            if store:
                results[name]["released"] = store.settle(specs[name], checks[name], back[name])
    finally:
        for c in checks.values():
            c.release()
    return results


def dimension_job(spark: SparkSession, tables: dict[str, KeyedTable],
                  country_decoded: DataFrame | None = None, parameter_decoded: DataFrame | None = None,
                  location_decoded: DataFrame | None = None, extra: dict[str, DataFrame] | None = None,
                  quarantine_path: str | None = None,
                  schemas: MessageSchemas = MESSAGES, run_id: str = "0",
                  store: QuarantineStore | None = None) -> dict[str, dict]:
    """The dimension batch job: I1 and/or I2 on decoded topics, then
    validation and upserts in foreign-key order.  Parsed messages are
    materialized once (lineage cut) because each feeds two tables, and removed
    when the tables are written."""
    staged: list[DataFrame] = []

    def stage(df: DataFrame, *args) -> DataFrame:
        staged.append(materialize(df, *args))
        return staged[-1]

    frames: dict[str, DataFrame] = dict(extra or {})
    deduped = set()
    if country_decoded is not None and parameter_decoded is not None:
        deduped |= {"country", "parameter"}
        frames["country"], frames["parameter"] = country_parameter_dims(
            country_decoded, parameter_decoded, stage=stage, schemas=schemas)
    if location_decoded is not None:
        deduped |= {"location_table", "sensor"}
        frames["location_table"], frames["sensor"] = location_sensor_dims(
            location_decoded, stage=stage, schemas=schemas)
    try:
        return write_in_order(spark, frames, tables, quarantine_path=quarantine_path,
                              unique=frozenset(deduped), run_id=run_id, store=store)
    finally:
        discard(*staged)


def dimension_job_from_topics(spark: SparkSession, tables: dict, read: Callable[[str], DataFrame] | None = None,
                              bootstrap_servers: str | None = None, min_partitions: int | None = None,
                              **options) -> dict[str, dict]:
    """The batch job from topics to tables: reads ``country``, ``parameter``
    and ``locations`` whole (``read(topic)``, by default from the brokers) and
    runs ``dimension_job``.  ``tables`` are sinks of any kind."""
    def kafka(topic: str) -> DataFrame:
        return kafka_batch_source(spark, bootstrap_servers, topic, min_partitions=min_partitions)

    read = read or kafka
    return dimension_job(spark, tables, country_decoded=decode_value(read("country")),
                         parameter_decoded=decode_value(read("parameter")),
                         location_decoded=decode_value(read("locations")), **options)
