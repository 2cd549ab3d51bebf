"""Queries over a stream with corrections, late messages, refused rows and parents
that arrive while it runs, each against SQL over the base tables.

Four batches, by day of month.  Batch k brings the events of part k, corrected
values of the purchases of part k - 1 (a newer message of the same key), and old
messages of the clicks of part k - 2 (with a value that must not count).
``error`` events come as NaN.  Customers of segment MACHINERY become known before
batch 2, those of HOUSEHOLD never.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorflow.functions.casts import instant_to_utc_ntz
from sensorflow.plans import catalog, feeds
from sensorflow.plans.catalog import register, utc
from sensorflow.plans.common import MSG_ORDER
from sensorflow.plans.feeds import table
from sensorflow.plans.marts import measurement_star
from sensorflow.schemas import MEASUREMENT_TABLE
from sensorflow.schemas import WIDE_MESSAGES as W

LATER = 10**12  # between the offsets of two deliveries of an event

# every delivery: event, batch, value, and its rank among the event's messages
_LIVE_SQL = """
    WITH base AS (
        SELECT event_id, user_id, ts, event_type AS kind, value, c_mktsegment AS segment,
               concat_ws('_', user_id, user_id, CAST(ts AS VARCHAR)) AS latest_id,
               CASE WHEN day(ts) <= 8 THEN 0 WHEN day(ts) <= 16 THEN 1 WHEN day(ts) <= 24 THEN 2 ELSE 3 END AS part
        FROM events JOIN customer ON c_custkey = user_id),
    known AS (
        SELECT *, CASE segment WHEN 'MACHINERY' THEN greatest(part, 2) ELSE part END AS visible,
               CASE WHEN kind = 'purchase' AND part < 3 THEN part + 1 END AS corrected, value * 2 + 1 AS better
        FROM base WHERE kind <> 'error' AND segment <> 'HOUSEHOLD'),
    final AS (
        SELECT *, CASE WHEN corrected IS NOT NULL THEN better ELSE value END AS v FROM known)
"""

_runs: dict = {}


def live_run(spark, sf_dir):
    """The stream's tables, run once a session and folder of tables."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.envelope import file_topic_source, write_file_topic
    from sensorflow.sources.keyed_table import KeyedTable
    from sensorflow.sources.publish import append_end_marker
    from sensorflow.sources.quarantine import QuarantineStore
    from sensorflow.streaming.runner import MeasurementUpsert, await_and_stop, start_measurement_stream
    from sensorflow.streaming.progress import ProgressStore
    from sensorflow.streaming.views import LatestView, SketchView, hourly
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _runs:
        return _runs[key]
    root = scratch_path(spark, "live")
    locations = KeyedTable(spark, f"{root}/locations", "location_id", buckets=2)
    sensors = KeyedTable(spark, f"{root}/sensors", "sensor_id", buckets=2)
    fact = KeyedTable(spark, f"{root}/fact", "latest_id", spec=MEASUREMENT_TABLE, order=MSG_ORDER, changes_path=f"{root}/changes",
                      partition_by={"day": F.to_date(instant_to_utc_ntz(F.col("timestamp_utc"))),
                                    "_bucket": F.pmod(F.xxhash64("latest_id"), F.lit(2))})
    views = {"hourly": hourly(spark, f"{root}/hourly", 2),
             "latest": LatestView(spark, f"{root}/latest", "sensor_id", ["timestamp_utc", "latest_id"], 2),
             "sketches": SketchView(spark, f"{root}/sketches", ["country_name", "parameter_name"], lambda df: measurement_star(
                 df, catalog._fixture_locations(spark, sf_dir), catalog._fixture_countries(spark, sf_dir),
                 catalog._fixture_sensors(spark, sf_dir), catalog._fixture_parameters(spark, sf_dir)))}
    store = QuarantineStore(spark, f"{root}/held", buckets=2)
    sink = MeasurementUpsert(spark, fact, metrics_path=f"{root}/metrics", rejects_path=f"{root}/rejects", partitions=3,
                             parents={"location_table": locations, "sensor": sensors}, views=list(views.values()), store=store)
    customers = catalog._fixture_locations(spark, sf_dir)

    def arrive(condition):
        rows = customers.filter(condition)
        locations.upsert(rows)
        sensors.upsert(rows.select(F.col("location_id").alias("sensor_id"), "name", F.lit(None).cast("bigint").alias("parameter_id"), "location_id"))

    segment, kind, day = F.col("locality"), F.col("event_type"), F.dayofmonth("ts")
    events = table(spark, sf_dir, "events").withColumn(
        "part", F.when(day <= 8, 0).when(day <= 16, 1).when(day <= 24, 2).otherwise(3))

    def messages(rows, value, shift):
        env = feeds.measurement_messages(rows.withColumn("value", value), nan_value=kind == "error")
        return env.withColumn("offset", F.col("offset") + F.lit(shift))

    progress = ProgressStore(spark, f"{root}/progress")
    spark.streams.addListener(progress)
    arrive(~segment.isin("MACHINERY", "HOUSEHOLD"))
    for k in range(4):
        env = messages(events.filter(F.col("part") == k), F.col("value"), 0)
        env = env.unionByName(messages(events.filter((F.col("part") == k - 1) & (kind == "purchase")), F.col("value") * 2 + 1, LATER))
        env = env.unionByName(messages(events.filter((F.col("part") == k - 2) & (kind == "click")), F.lit(-1.0), -LATER))
        if k == 2:
            arrive(segment == "MACHINERY")
        write_file_topic(append_end_marker(env) if k == 3 else env, f"{root}/topic")
        query = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink,
                                         f"{root}/checkpoint", available_now=True, schemas=W)
        await_and_stop(query, sink)
    progress.settled()
    spark.streams.removeListener(progress)
    progress.flush()
    _runs[key] = {"fact": fact, "store": store, "metrics": f"{root}/metrics", "rejects": f"{root}/rejects",
                  "topic": f"{root}/topic", "progress": progress, **views}
    return _runs[key]


@register("live_measurements", _LIVE_SQL + """
    SELECT latest_id, user_id AS sensor_id, v AS value, ts AS timestamp_utc FROM final
""")
def q_live_measurements(spark, sf_dir):
    """Whatever the order of delivery, the table holds the newest message of each key."""
    rows = live_run(spark, sf_dir)["fact"].read()
    return rows.select("latest_id", "sensor_id", "value", utc("timestamp_utc").alias("timestamp_utc"))


@register("upsert_changes", _LIVE_SQL + """,
    batches AS (SELECT unnest([0, 1, 2, 3]) AS b),
    state AS (
        SELECT b, latest_id, CASE WHEN corrected <= b THEN better ELSE value END AS v FROM known, batches WHERE visible <= b)
    SELECT coalesce(n.b, o.b + 1)::BIGINT AS batch_id, CASE WHEN o.latest_id IS NULL THEN 'insert' ELSE 'update' END AS op,
           n.latest_id, o.v AS old_value, n.v AS new_value
    FROM state n FULL OUTER JOIN state o ON o.latest_id = n.latest_id AND o.b = n.b - 1
    WHERE n.b IS NOT NULL AND o.v IS DISTINCT FROM n.v
""")
def q_upsert_changes(spark, sf_dir):
    """What each batch changed, with the row before and after."""
    return live_run(spark, sf_dir)["fact"].changes().select(
        "batch_id", "op", "new.latest_id", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))


@register("live_stats", _LIVE_SQL + """
    SELECT n_name AS country_name, r_name AS parameter_name, count(*) AS n, min(v) AS min_value,
           round(avg(v), 6) AS avg_value, max(v) AS max_value, round(sum(v), 3) AS sum_value
    FROM final JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    GROUP BY 1, 2
""")
def q_live_stats(spark, sf_dir):
    """J2 from the view that the stream has kept."""
    view = live_run(spark, sf_dir)["hourly"]
    star = measurement_star(view.partials(), catalog._fixture_locations(spark, sf_dir), catalog._fixture_countries(spark, sf_dir),
                            catalog._fixture_sensors(spark, sf_dir), catalog._fixture_parameters(spark, sf_dir))
    stats = view.rolled_up(["country_name", "parameter_name"], star)
    return stats.withColumns({"avg_value": F.round("avg_value", 6), "sum_value": F.round("sum_value", 3)})


@register("live_series", _LIVE_SQL + """
    SELECT user_id AS sensor_id, date_trunc('hour', ts) AS bucket, count(*) AS n, min(v) AS min_value,
           round(avg(v), 6) AS avg_value, max(v) AS max_value
    FROM final GROUP BY 1, 2
""")
def q_live_series(spark, sf_dir):
    """J3 from the view that the stream has kept."""
    view = live_run(spark, sf_dir)["hourly"].read()
    return view.select("sensor_id", "bucket", "n", "min_value", F.round("avg_value", 6).alias("avg_value"), "max_value")


@register("live_current", _LIVE_SQL + """
    SELECT user_id AS sensor_id, latest_id, v AS value, ts AS timestamp_utc FROM final
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, latest_id DESC) = 1
""")
def q_live_current(spark, sf_dir):
    """J4 from the view that the stream has kept."""
    return live_run(spark, sf_dir)["latest"].read().select(
        "sensor_id", "latest_id", "value", utc("timestamp_utc").alias("timestamp_utc"))


@register("live_batch_counts", _LIVE_SQL + """,
    sent AS (
        SELECT part AS batch_id, 'first' AS what, base.* FROM base
        UNION ALL SELECT part + 1, 'better', base.* FROM base WHERE kind = 'purchase' AND part < 3
        UNION ALL SELECT part + 2, 'old', base.* FROM base WHERE kind = 'click' AND part < 2),
    fate AS (
        SELECT *, kind = 'error' AS bad, segment = 'HOUSEHOLD' OR segment = 'MACHINERY' AND batch_id < 2 AS orphan,
               segment = 'MACHINERY' AND batch_id = 2 AND part < 2 AS held FROM sent),
    back AS (
        SELECT count(*) AS released, count(DISTINCT event_id) AS fresh FROM fate WHERE segment = 'MACHINERY' AND batch_id < 2 AND NOT bad)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) FILTER (NOT bad) AS rows,
           count(*) FILTER (NOT bad AND NOT orphan AND what = 'first')
               + CASE WHEN batch_id = 2 THEN (SELECT fresh FROM back) ELSE 0 END AS inserts,
           count(*) FILTER (NOT bad AND NOT orphan AND what = 'better' AND NOT held) AS updates,
           count(*) FILTER (NOT bad AND NOT orphan AND what = 'old' AND NOT held) AS stale,
           count(*) FILTER (NOT bad AND orphan) AS quarantined,
           CASE WHEN batch_id = 2 THEN (SELECT released FROM back) ELSE 0 END AS released,
           count(*) FILTER (bad) AS rejected, batch_id = 3 AS end_seen
    FROM fate GROUP BY batch_id
""")
def q_live_batch_counts(spark, sf_dir):
    metrics = spark.read.parquet(live_run(spark, sf_dir)["metrics"])
    return metrics.select(F.col("batch_id").cast("bigint").alias("batch_id"), "rows", "inserts", "updates", "stale",
                          "quarantined", "released", "rejected", "end_seen")


@register("quarantine_held", _LIVE_SQL + """,
    sent AS (
        SELECT user_id FROM base WHERE kind <> 'error' AND segment = 'HOUSEHOLD'
        UNION ALL SELECT user_id FROM base WHERE kind = 'purchase' AND part < 3 AND segment = 'HOUSEHOLD'
        UNION ALL SELECT user_id FROM base WHERE kind = 'click' AND part < 2 AND segment = 'HOUSEHOLD')
    SELECT parent, CAST(user_id AS VARCHAR) AS missing_key, count(*) AS n
    FROM sent, (SELECT unnest(['location_table', 'sensor']) AS parent) GROUP BY ALL
""")
def q_quarantine_held(spark, sf_dir):
    """What the stream still holds, by the parent that is missing."""
    held = live_run(spark, sf_dir)["store"].read("latest_measurements")
    return (held.select(F.explode("missing").alias("m"), "copies")
            .groupBy(F.col("m.parent").alias("parent"), F.col("m.key").alias("missing_key")).agg(F.sum("copies").alias("n")))


@register("quarantine_release", """
    WITH l AS (SELECT c_custkey, n_regionkey >= 3 AS late FROM customer JOIN nation ON n_nationkey = c_nationkey),
    s AS (SELECT o_orderkey, late FROM orders JOIN l ON c_custkey = o_custkey)
    SELECT 1::BIGINT AS job, 'country' AS table_name, count(*) AS stored, 0::BIGINT AS quarantined, 0::BIGINT AS released
    FROM nation WHERE n_regionkey < 3
    UNION ALL SELECT 1, 'location_table', count(*) FILTER (NOT late), count(*) FILTER (late), 0 FROM l
    UNION ALL SELECT 1, 'sensor', count(*) FILTER (NOT late), count(*) FILTER (late), 0 FROM s
    UNION ALL SELECT 2, 'country', count(*), 0, 0 FROM nation
    UNION ALL SELECT 2, 'location_table', count(*), 0, count(*) FILTER (late) FROM l
    UNION ALL SELECT 2, 'sensor', count(*), 0, count(*) FILTER (late) FROM s
""")
def q_quarantine_release(spark, sf_dir):
    """Locations of countries that are not stored, and with them their sensors,
    are held; the job that writes the countries brings both levels back."""
    from sensorflow.plans.jobs import write_in_order
    from sensorflow.schemas import TABLES
    from sensorflow.session import scratch_path
    from sensorflow.sources.keyed_table import KeyedTable
    from sensorflow.sources.quarantine import QuarantineStore
    root, names = scratch_path(spark, "release"), ("country", "location_table", "sensor")
    tables = {n: KeyedTable(spark, f"{root}/{n}", list(TABLES[n].key), buckets=2, spec=TABLES[n]) for n in names}
    store = QuarantineStore(spark, f"{root}/held", buckets=4)

    def typed(df, name):
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in TABLES[name].columns])

    nation = table(spark, sf_dir, "nation")
    country = typed(nation.select("n_regionkey", F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), "n_nationkey").alias("code"),
                                  F.col("n_name").alias("name")), "country")
    late = nation.filter("n_regionkey >= 3").select(F.col("n_nationkey").cast("bigint").alias("id"))
    sensors = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sensor_id"), F.col("o_orderpriority").alias("name"),
                                                    F.col("o_custkey").alias("location_id"))
    unique = frozenset(names)
    jobs = [write_in_order(spark, {"country": country.join(late, "id", "left_anti").select(*country.columns),
                                   "location_table": typed(catalog._fixture_locations(spark, sf_dir), "location_table"),
                                   "sensor": typed(sensors, "sensor")}, tables, store=store, unique=unique)]
    counts = [{n: tables[n].read().count() for n in names}]
    jobs.append(write_in_order(spark, {"country": country}, tables, store=store, unique=unique))
    counts.append({n: tables[n].read().count() for n in names})
    rows = [(j + 1, n, counts[j][n], job.get(n, {}).get("quarantined", 0), job.get(n, {}).get("released", 0))
            for j, job in enumerate(jobs) for n in names]
    return spark.createDataFrame(rows, "job bigint, table_name string, stored bigint, quarantined bigint, released bigint")


@register("missing_ranges", """
    WITH pages AS (
        SELECT DISTINCT c_nationkey AS k, page, ceil(found / 25)::BIGINT AS last FROM (""" + catalog._GAPS_SQL + """)),
    want AS (SELECT k, unnest(generate_series(1, max(last))) AS v FROM pages GROUP BY k),
    gone AS (
        SELECT 'page' AS what, k, v FROM want WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.k = want.k AND p.page = want.v)
        UNION ALL
        SELECT 'offset', user_id % 3, event_id // 3 FROM events WHERE event_type = 'error'),
    there AS (
        SELECT 'offset' AS what, user_id % 3 AS k, event_id // 3 AS v FROM events WHERE event_type <> 'error'),
    space AS (
        SELECT what, k, v FROM gone WHERE what = 'page'
        UNION ALL
        SELECT 'offset', k, s FROM (SELECT k, unnest(generate_series(0, (SELECT max(event_id) // 3 FROM events))) AS s
                                    FROM (SELECT DISTINCT k FROM there)) x
        WHERE NOT EXISTS (SELECT 1 FROM there t WHERE t.k = x.k AND t.v = x.s)),
    runs AS (SELECT *, v - row_number() OVER (PARTITION BY what, k ORDER BY v) AS run FROM space)
    SELECT what, CAST(k AS BIGINT) AS k, min(v) AS first_missing, max(v) AS last_missing FROM runs GROUP BY what, k, run
""")
def q_missing_ranges(spark, sf_dir):
    """Pages that were not landed, by country, and offsets that are not in the
    topic, by partition: messages lie at a third of their event's number, and
    those of errors are lost."""
    from sensorflow.operators.gaps import missing_ranges
    from sensorflow.sources.pages import missing_pages
    pages = feeds.location_pages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                 last_missing_region=1, second_missing_region=2)
    events = table(spark, sf_dir, "events")
    env = feeds.measurement_messages(events.filter("event_type <> 'error'")).withColumn(
        "offset", F.call_function("div", F.col("offset"), F.lit(3)))
    high = events.agg(F.call_function("div", F.max("event_id"), F.lit(3))).first()[0]
    bounds = env.select("partition").distinct().select("partition", F.lit(0).alias("low"), F.lit(high).alias("high"))
    offsets = missing_ranges(env, ["partition"], "offset", bounds, width=1000)

    def named(df, what, key):
        return df.select(F.lit(what).alias("what"), F.col(key).cast("bigint").alias("k"), "first_missing", "last_missing")

    return named(missing_pages(pages), "page", "entity_id").unionByName(named(offsets, "offset", "partition"))


_MAP_SQL = """
    WITH f AS (
        SELECT value, ts::DATE AS day, event_type,
               CASE event_type WHEN 'signup' THEN NULL ELSE user_id / 100.0 END AS lat, user_id / -50.0 * 7 AS lon
        FROM events),
    g AS (SELECT *, ((lon + 180.0) % 360 + 360) % 360 AS turned FROM f WHERE lat BETWEEN -90 AND 90),
    p AS (SELECT g.*, level, least(floor(turned / 360 * (1 << level)), (1 << level) - 1)::BIGINT AS x,
                 least(floor((lat + 90) / 180 * (1 << level)), (1 << level) - 1)::BIGINT AS y
          FROM g, (SELECT unnest([2, 5, 9, 14]) AS level)),
    z AS (SELECT level, day, value, list_sum([((x >> i) & 1) * (1::BIGINT << (2 * i)) + ((y >> i) & 1) * (1::BIGINT << (2 * i + 1))
                                              for i in generate_series(0, 13)])::BIGINT AS cell FROM p)
    SELECT level, cell, day, count(*) AS n, round(avg(value), 6) AS avg_value FROM z GROUP BY ALL
"""


@register("heat_map", _MAP_SQL)
def q_heat_map(spark, sf_dir):
    """Counts and averages per cell and day at four levels; signups have no place,
    and longitudes run several times around."""
    from sensorflow.plans.marts import heat_map
    events = table(spark, sf_dir, "events")
    places = events.select(
        F.when(F.col("event_type") != "signup", F.col("user_id") / 100.0).alias("latitude"),
        (F.col("user_id") / -50.0 * 7).alias("longitude"), "value", F.col("ts").cast("timestamp").alias("timestamp_utc"))
    return heat_map(places, [2, 5, 9, 14]).withColumn("avg_value", F.round("avg_value", 6))


@register("value_distributions", _LIVE_SQL + """
    SELECT n_name AS country_name, r_name AS parameter_name, count(*) AS n, count(DISTINCT user_id) AS sensors,
           min(v) AS least, max(v) AS greatest, true AS quartiles_hold
    FROM final JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    GROUP BY 1, 2
""")
def q_value_distributions(spark, sf_dir):
    """Sketches that the stream has kept by day, merged over all days; whether the
    ranks of the quartiles among the stored values are within the bound."""
    from sensorflow.plans.distributions import RANK_ERROR, described
    run, by = live_run(spark, sf_dir), ["country_name", "parameter_name"]
    found = described(run["sketches"].read(by), {"least": 0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "greatest": 1})
    star = measurement_star(run["fact"].read(), catalog._fixture_locations(spark, sf_dir), catalog._fixture_countries(spark, sf_dir),
                            catalog._fixture_sensors(spark, sf_dir), catalog._fixture_parameters(spark, sf_dir))
    joined = star.select(*by, "value").join(found.select(*by, "q1", "q2", "q3"), by)
    ranks, holds = [], F.lit(True)
    for k, name in enumerate(("q1", "q2", "q3"), 1):
        ranks += [F.count_if(F.col("value") < F.col(name)).alias(f"below{k}"), F.count_if(F.col("value") <= F.col(name)).alias(f"to{k}")]
        slack = F.col("rows") * RANK_ERROR + 1
        holds = holds & (F.col(f"below{k}") <= F.col("rows") * k / 4 + slack) & (F.col(f"to{k}") >= F.col("rows") * k / 4 - slack)
    checked = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *ranks).select(*by, holds.alias("quartiles_hold"))
    return found.join(checked, by).select(*by, "n", "sensors", "least", "greatest", "quartiles_hold")


@register("stream_lag", _LIVE_SQL + """,
    sent AS (
        SELECT part AS b, event_id AS o, user_id % 3 AS p FROM base
        UNION ALL SELECT part + 1, event_id + 1000000000000, user_id % 3 FROM base WHERE kind = 'purchase' AND part < 3
        UNION ALL SELECT part + 2, event_id - 1000000000000, user_id % 3 FROM base WHERE kind = 'click' AND part < 2),
    high AS (SELECT p, max(o) + 1 AS high, min(o) AS low FROM sent GROUP BY p),
    marked AS (SELECT p, greatest(max(o) FILTER (b = 3) + 2, high) AS high, low
               FROM sent JOIN high USING (p) GROUP BY p, high, low),
    done AS (SELECT batch_id, p, max(o) AS last FROM sent, (SELECT unnest([0, 1, 2, 3]) AS batch_id) WHERE b <= batch_id GROUP BY ALL),
    grid AS (SELECT batch_id, p, high, low FROM marked, (SELECT unnest([0, 1, 2, 3]) AS batch_id))
    SELECT batch_id::BIGINT AS batch_id, p::INT AS "partition",
           CASE WHEN batch_id = 3 THEN greatest(last + 1, high) ELSE coalesce(last + 1, low) END AS read_to,
           high - CASE WHEN batch_id = 3 THEN greatest(last + 1, high) ELSE coalesce(last + 1, low) END AS behind
    FROM grid LEFT JOIN done USING (batch_id, p)
""")
def q_stream_lag(spark, sf_dir):
    """After each batch, how far each partition was behind the topic as it is at the end."""
    from sensorflow.operators.aggregates import offset_bounds
    from sensorflow.sources.envelope import file_topic_source
    from sensorflow.streaming.progress import lag
    run = live_run(spark, sf_dir)
    bounds = offset_bounds(file_topic_source(spark, run["topic"]))
    return lag(spark.read.parquet(run["metrics"]).withColumn("batch_id", F.col("batch_id").cast("bigint")), bounds)


@register("schema_drift", """
    WITH e AS (SELECT *, ts::DATE AS day FROM events),
    days AS (SELECT day, count(*) AS n FROM e GROUP BY day)
    SELECT 'measurements' AS topic, day, 'quality' AS path, 'added' AS change, 'OBJECT' AS types, count(*) AS messages
    FROM e WHERE event_type = 'click' GROUP BY day
    UNION ALL SELECT 'measurements', day, 'quality.flag', 'added', 'BOOLEAN', count(*) FROM e WHERE event_type = 'click' GROUP BY day
    UNION ALL SELECT 'measurements', day, 'value', 'retyped', 'STRING', count(*) FROM e WHERE event_type = 'signup' GROUP BY day
    UNION ALL SELECT 'measurements', day, 'end', 'missing', '', n FROM days
    UNION ALL SELECT 'measurements', day, 'coordinates.longitude', 'missing', '', n FROM days WHERE day(day) > 20
    UNION ALL SELECT 'measurements', day, '', 'retyped', 'MALFORMED', count(*) FROM e WHERE event_type = 'error' GROUP BY day
""")
def q_schema_drift(spark, sf_dir):
    """A feed in which clicks bring a new object, signups their value as text,
    errors are cut short, and longitudes end with day 20."""
    from sensorflow.plans.drift import schema_drift
    events = feeds.spread(table(spark, sf_dir, "events"))
    kind, late = F.col("event_type"), F.dayofmonth("ts") > 20
    place = F.when(late, F.to_json(F.struct((F.col("user_id") / 100.0).alias("latitude")))).otherwise(
        F.to_json(F.struct((F.col("user_id") / 100.0).alias("latitude"), (F.col("user_id") / -50.0).alias("longitude"))))
    value = F.when(kind == "signup", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(F.col("value").cast("string"))
    more = F.when(kind == "click", F.lit(', "quality": {"flag": true}')).otherwise("")
    text = F.format_string('{"datetime": {"utc": "%s", "local": "%s"}, "value": %s, "coordinates": %s, "sensorsId": %d, "locationsId": %d%s}',
                           F.col("ts").cast("string"), F.col("ts").cast("string"), value, place, "user_id", "user_id", more)
    text = F.when(kind == "error", F.lit('{"value": ')).otherwise(text)
    messages = events.select(F.lit("measurements").alias("topic"), F.to_date("ts").alias("day"), text.alias("value"))
    return schema_drift(messages, W.measurement, ["topic", "day"])


@register("co_located_star", """
    SELECT concat_ws('_', user_id, user_id, CAST(ts AS VARCHAR)) AS latest_id, user_id AS sensor_id, value,
           ts AS timestamp_utc, c_name AS location_name, n_name AS country_name, r_name AS parameter_name
    FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
""")
def q_co_located_star(spark, sf_dir):
    """E1 and J1 over a fact table bucketed by sensor, with every view delivered
    twice: neither the dedupe nor the join moves the fact."""
    import uuid

    from sensorflow.session import scratch_path
    from sensorflow.sources.bucketed import BucketedTable
    events = table(spark, sf_dir, "events")
    rows = events.select(F.concat_ws("_", "user_id", "user_id", F.col("ts").cast("string")).alias("latest_id"),
                         F.col("user_id").alias("sensor_id"), "value", F.col("ts").alias("timestamp_utc"), F.col("event_id").alias("_offset"),
                         "event_type")
    again = rows.filter("event_type = 'view'").withColumns({"value": F.lit(-1.0), "_offset": F.col("_offset") - LATER})
    facts = BucketedTable(spark, f"facts_{uuid.uuid4().hex}", scratch_path(spark, "bucketed"), ["sensor_id"], 8)
    facts.write(rows.unionByName(again).drop("event_type"))
    newest = facts.newest(["sensor_id", "latest_id"], ["timestamp_utc", "_offset"]).drop("_offset")
    dims = measurement_star(
        catalog._fixture_sensors(spark, sf_dir).select("sensor_id", "location_id"), catalog._fixture_locations(spark, sf_dir),
        catalog._fixture_countries(spark, sf_dir), catalog._fixture_sensors(spark, sf_dir).drop("location_id"),
        catalog._fixture_parameters(spark, sf_dir)).select("sensor_id", "location_name", "country_name", "parameter_name")
    return newest.join(dims.hint("merge"), "sensor_id").select(
        "latest_id", "sensor_id", "value", "timestamp_utc", "location_name", "country_name", "parameter_name")
