"""Driver query catalog: one Spark query per operator / composition of the
survey inventory, each with an independent DuckDB SQL oracle computed straight
from the base tables.

Output conventions (so both sides compare): every computed column is aliased
the same on both sides; instants are returned as their UTC wall clock
(TIMESTAMP_NTZ); counts are BIGINT; sums of doubles go through DECIMAL per row;
averages are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.casts import instant_to_utc_ntz
from sensorflow.plans import feeds
from sensorflow.plans.feeds import table
from sensorflow.plans.marts import current_reading, dimension_stats_of, measurement_star, time_series
from sensorflow.plans.measurements import latest_measurements, measurement_rows, parse_measurements
from sensorflow.schemas import TABLES as TABLES_SPEC
from sensorflow.schemas import WIDE_MESSAGES as W
from sensorflow.session import materialize
from sensorflow.sources.envelope import decode_value

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def utc(col: str):
    return instant_to_utc_ntz(F.col(col))


def _measurement_fact(spark, sf_dir, **inject) -> DataFrame:
    events = table(spark, sf_dir, "events")
    parsed = parse_measurements(decode_value(feeds.measurement_messages(events, **inject)), W)
    return latest_measurements(parsed)


def _fixture_locations(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("location_id"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("locality"), F.col("c_nationkey").alias("country_id"))


def _fixture_sensors(spark, sf_dir) -> DataFrame:
    """Sensor = the customer's device; its parameter = the region of its nation."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return c.join(n, "c_nationkey").select(
        F.col("c_custkey").alias("sensor_id"), F.col("c_name").alias("name"),
        F.col("n_regionkey").alias("parameter_id"), F.col("c_custkey").alias("location_id"))


def _fixture_parameters(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").alias("parameter_id"), F.col("r_name").alias("name"),
                    F.lit("ppm").alias("unit"))


def _star(spark, sf_dir) -> DataFrame:
    return measurement_star(_measurement_fact(spark, sf_dir), _fixture_locations(spark, sf_dir),
                            _fixture_countries(spark, sf_dir), _fixture_sensors(spark, sf_dir),
                            _fixture_parameters(spark, sf_dir))


def _fixture_countries(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def landed(spark, envelope: DataFrame, name: str) -> DataFrame:
    """Decoded messages as a consumer sees them: the feed is written to a file
    topic (under the checkpoint folder) and read back, so the parser gets
    opaque bytes, as from Kafka -- Catalyst cannot fold a same-plan
    ``to_json`` -> ``from_json`` pair away."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.envelope import file_topic_source, write_file_topic
    path = scratch_path(spark, f"topic-{name}")
    write_file_topic(envelope, path)
    return decode_value(file_topic_source(spark, path))


# SQL fragments shared by the oracles --------------------------------------
_FACT_SQL = """
    SELECT concat_ws('_', user_id, user_id, CAST(ts AS VARCHAR)) AS latest_id,
           user_id AS location_id, user_id AS sensor_id,
           value, ts AS timestamp_utc, ts + INTERVAL 1 HOUR AS timestamp_local,
           user_id / 100.0 AS latitude, user_id / -50.0 AS longitude, event_type
    FROM events
"""


# -- B1 / A3 ----------------------------------------------------------------
@register("parse_struct_props", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_parse_struct_props(spark, sf_dir):
    from sensorflow.functions.json import parse_struct
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", parse_struct("props", "k int").alias("p")).select("event_id", "p.k")


@register("decode_value", "SELECT event_id, props AS value FROM events")
def q_decode_value(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    from sensorflow.sources.envelope import to_envelope
    env = to_envelope(ev, F.col("props"), "props", offset=F.col("event_id"))
    return decode_value(env, keep=("offset",)).select(F.col("offset").alias("event_id"), "value")


# -- S1/S2 casts, C1-C3, composite key ----------------------------------------
@register("cast_timestamps", """
    SELECT user_id AS sensor_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS timestamp_utc,
           ts + INTERVAL 1 HOUR AS timestamp_local,
           ts AS timestamp_local_instant
    FROM events
""")
def q_cast_timestamps(spark, sf_dir):
    from sensorflow.functions.casts import cast_timestamps
    ev = table(spark, sf_dir, "events")
    parsed = parse_measurements(decode_value(
        feeds.measurement_messages(ev, bad_utc=F.col("event_type") == "error")), W)
    u, loc = cast_timestamps("data.datetime.utc", "data.datetime.local")
    _, loc_instant = cast_timestamps("data.datetime.utc", "data.datetime.local", local_mode="instant")
    return parsed.select(F.col("data.sensorsId").alias("sensor_id"),
                         instant_to_utc_ntz(u).alias("timestamp_utc"), loc.alias("timestamp_local"),
                         instant_to_utc_ntz(loc_instant).alias("timestamp_local_instant"))


@register("drop_incomplete", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc, timestamp_local, latitude, longitude
    FROM (""" + _FACT_SQL + """) f
    WHERE event_type NOT IN ('view', 'signup', 'purchase', 'error')
""")
def q_drop_incomplete(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    parsed = parse_measurements(decode_value(feeds.measurement_messages(
        ev, null_latitude=et == "view", nan_value=et == "signup", bad_utc=et == "error",
        missing_local=et == "purchase")), W)
    rows = measurement_rows(parsed, keep_order=False)
    return rows.withColumn("timestamp_utc", utc("timestamp_utc"))


@register("composite_key", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc, timestamp_local, latitude, longitude
    FROM (""" + _FACT_SQL + """) f
""")
def q_composite_key(spark, sf_dir):
    fact = _measurement_fact(spark, sf_dir)
    return fact.withColumn("timestamp_utc", utc("timestamp_utc"))


@register("data_rows", """
    SELECT user_id AS sensor_id, value, CAST(user_id % 3 AS INTEGER) AS partition,
           event_id AS "offset"
    FROM events
""")
def q_data_rows(spark, sf_dir):
    from sensorflow.operators.filters import data_rows
    from sensorflow.sources.publish import append_end_marker
    ev = table(spark, sf_dir, "events")
    env = append_end_marker(feeds.measurement_messages(ev))
    parsed = parse_measurements(decode_value(env), W)
    return data_rows(parsed).select(F.col("data.sensorsId").alias("sensor_id"),
                                    F.col("data.value").alias("value"),
                                    F.col("_partition").alias("partition"),
                                    F.col("_offset").alias("offset"))


@register("control_rows", """
    SELECT CAST(user_id % 3 AS INTEGER) AS partition, max(event_id) + 1 AS "offset", 'true' AS end_flag
    FROM events GROUP BY 1
""")
def q_control_rows(spark, sf_dir):
    from sensorflow.plans.measurements import end_signals
    from sensorflow.sources.publish import append_end_marker
    ev = table(spark, sf_dir, "events")
    parsed = parse_measurements(decode_value(append_end_marker(feeds.measurement_messages(ev))), W)
    return end_signals(parsed).select(F.col("_partition").alias("partition"),
                                      F.col("_offset").alias("offset"),
                                      F.col("data.end").alias("end_flag"))


# -- J1-J4 (flagship: measurements -> star -> stats) --------------------------
_STAR_SQL = """
    SELECT f.*, c.c_name AS location_name, c.c_mktsegment AS locality,
           c.c_nationkey AS country_id, n.n_name AS country_name,
           c.c_name AS sensor_name, r.r_regionkey AS parameter_id, r.r_name AS parameter_name,
           'ppm' AS unit
    FROM (""" + _FACT_SQL + """) f
    JOIN customer c ON c.c_custkey = f.location_id
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN region r ON r.r_regionkey = n.n_regionkey
"""


@register("measurement_star", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc, location_name, locality,
           country_id, country_name, sensor_name, parameter_id, parameter_name, unit
    FROM (""" + _STAR_SQL + """) s
""")
def q_measurement_star(spark, sf_dir):
    return _star(spark, sf_dir).select(
        "latest_id", "location_id", "sensor_id", "value", utc("timestamp_utc").alias("timestamp_utc"),
        "location_name", "locality", "country_id", "country_name", "sensor_name", "parameter_id",
        "parameter_name", "unit")


def dimension_stats_query(spark, sf_dir):
    """Values with more decimals than the table has, so that no rounding in
    the mart could pass; averages and sums are rounded for the comparison only."""
    fact = _measurement_fact(spark, sf_dir).withColumn("value", F.col("value") * F.lit(0.0137))
    stats = dimension_stats_of(fact, _fixture_locations(spark, sf_dir), _fixture_countries(spark, sf_dir),
                               _fixture_sensors(spark, sf_dir), _fixture_parameters(spark, sf_dir),
                               ["country_name", "parameter_name"])
    return stats.withColumns({"avg_value": F.round("avg_value", 6), "sum_value": F.round("sum_value", 4)})


register("dimension_stats", """
    SELECT country_name, parameter_name, count(*) AS n, min(v) AS min_value,
           round(avg(v), 6) AS avg_value, max(v) AS max_value, round(sum(v), 4) AS sum_value
    FROM (SELECT *, value * CAST(0.0137 AS DOUBLE) AS v FROM (""" + _STAR_SQL + """)) s
    GROUP BY country_name, parameter_name
""")(dimension_stats_query)


@register("time_series", """
    SELECT sensor_id, date_trunc('hour', timestamp_utc) AS bucket, count(*) AS n,
           round(avg(value), 6) AS avg_value
    FROM (""" + _FACT_SQL + """) f
    GROUP BY 1, 2
""")
def q_time_series(spark, sf_dir):
    series = time_series(_measurement_fact(spark, sf_dir), ["sensor_id"], "hour")
    return series.withColumn("avg_value", F.round("avg_value", 6))


@register("current_reading", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc, timestamp_local, latitude, longitude
    FROM (""" + _FACT_SQL + """) f
    QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp_utc DESC, latest_id DESC) = 1
""")
def q_current_reading(spark, sf_dir):
    cur = current_reading(_measurement_fact(spark, sf_dir))
    return cur.withColumn("timestamp_utc", utc("timestamp_utc"))


# -- B2-B8, B11: parsing and projections -------------------------------------
@register("explode_order_items", """
    SELECT o_orderkey AS country_id, o_orderstatus AS code,
           l_partkey AS parameter_id, 'parameter-' || l_partkey AS parameter_name,
           'ppm' AS parameter_units
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def q_explode_order_items(spark, sf_dir):
    return _country_parameter_rows(spark, sf_dir, keep_empty=False)


@register("explode_order_items_outer", """
    SELECT o_orderkey AS country_id, o_orderstatus AS code,
           l_partkey AS parameter_id,
           CASE WHEN l_partkey IS NULL THEN NULL ELSE 'parameter-' || l_partkey END AS parameter_name,
           CASE WHEN l_partkey IS NULL THEN NULL ELSE 'ppm' END AS parameter_units
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def q_explode_order_items_outer(spark, sf_dir):
    return _country_parameter_rows(spark, sf_dir, keep_empty=True)


def _country_parameter_rows(spark, sf_dir, keep_empty):
    from sensorflow.operators.explode import explode_array
    from sensorflow.plans.common import parse_object_messages
    env = feeds.country_messages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    c = parse_object_messages(landed(spark, env, "country"), W.country, "c")
    rows = explode_array(c, F.col("c.parameters"), "p", keep_empty=keep_empty)
    return rows.select(F.col("c.id").alias("country_id"), F.col("c.code").alias("code"),
                       F.col("p.id").alias("parameter_id"), F.col("p.name").alias("parameter_name"),
                       F.col("p.units").alias("parameter_units"))


@register("parse_array_items", """
    SELECT p_partkey AS id, p_name AS name, 'ppm' AS units,
           upper(p_name) AS displayName, p_type AS description
    FROM part
""")
def q_parse_array_items(spark, sf_dir):
    from sensorflow.operators.explode import explode_array
    from sensorflow.plans.common import parse_array_messages
    env = feeds.parameter_messages(table(spark, sf_dir, "part"), copies=1, without_type=None)
    arr = parse_array_messages(landed(spark, env, "parameter"), W.parameter, "params")
    return explode_array(arr, "params", "p").select("p.*")


_LOC_SQL = """
    SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal, min(o_orderdate) AS first_ts,
           max(o_orderdate) AS last_ts, count(o_orderkey) AS n_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY ALL
"""


@register("two_level_explode", """
    SELECT c_custkey AS location_id, CAST(c_nationkey AS BIGINT) AS country_id,
           o_orderkey AS sensor_id, o_orderpriority AS sensor_name,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS parameter_id
    FROM customer JOIN orders ON o_custkey = c_custkey
""")
def q_two_level_explode(spark, sf_dir):
    from sensorflow.operators.explode import explode_array
    from sensorflow.plans.dims import location_rows
    env = feeds.location_messages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))
    locs = location_rows(landed(spark, env, "locations"), schemas=W)
    return explode_array(locs, "sensors", "s").select(
        "location_id", "country_id", F.col("s.id").alias("sensor_id"),
        F.col("s.name").alias("sensor_name"), F.col("s.parameter.id").alias("parameter_id"))


@register("map_lookup_cast", """
    SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price,
           CAST(NULL AS DOUBLE) AS weight
    FROM part
""")
def q_map_lookup_cast(spark, sf_dir):
    from pyspark.sql import types as T

    from sensorflow.functions.casts import cast_double
    from sensorflow.functions.json import map_lookup, parse_struct
    part = table(spark, sf_dir, "part")
    doc = F.to_json(F.struct(F.col("p_partkey").alias("id"),
                             F.create_map(F.lit("size"), F.col("p_size").cast("double"),
                                          F.lit("price"), F.col("p_retailprice")).alias("attrs")))
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))])
    parsed = part.select(parse_struct(doc, schema).alias("d"))
    return parsed.select(F.col("d.id").alias("id"),
                         cast_double(map_lookup("d.attrs", "size")).alias("size"),
                         cast_double(map_lookup("d.attrs", "price")).alias("price"),
                         cast_double(map_lookup("d.attrs", "weight")).alias("weight"))


@register("conform_casts", """
    SELECT event_id, CAST(user_id AS INTEGER) AS user_id, CAST(ts AS DATE) AS ts,
           CAST(event_id AS VARCHAR) AS event_key, event_type
    FROM events
""")
def q_conform_casts(spark, sf_dir):
    from sensorflow.functions.casts import conform_casts
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type",
                                               F.col("event_id").alias("event_key"))
    return conform_casts(ev, {"user_id": "int", "ts": "date", "event_key": "string",
                              "not_a_column": "int"})


# -- C4, C5 ------------------------------------------------------------------
_PAGE_SQL = """
    SELECT c.*, n.n_regionkey,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos,
           count(*) OVER (PARTITION BY c_nationkey) AS found
    FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
"""
_LANDED_SQL = """
    SELECT *, CAST(floor((pos - 1) / 25) AS INTEGER) + 1 AS page,
           CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN NULL
                ELSE c_custkey END AS rid
    FROM (""" + _PAGE_SQL + """) p
"""
# region 1: the last page was not landed; region 2: page 2 was not
_GAPS_SQL = """
    SELECT * FROM (""" + _LANDED_SQL + """) g
    WHERE NOT (n_regionkey = 1 AND page = CAST(ceil(found / 25) AS INTEGER)) AND NOT (n_regionkey = 2 AND page = 2)
"""


def _page_results(spark, sf_dir):
    from sensorflow.sources.pages import flatten_pages
    pages = feeds.location_pages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    flat = flatten_pages(pages, W.location)
    return flat.select("entity_id", "page", F.col("result.id").alias("id"),
                       F.col("result.name").alias("name"), F.col("result.country.id").alias("country_id"))


@register("flatten_pages", """
    SELECT c_nationkey AS entity_id, page, rid AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS country_id
    FROM (""" + _LANDED_SQL + """) l
""")
def q_flatten_pages(spark, sf_dir):
    return _page_results(spark, sf_dir)


@register("page_coverage", """
    SELECT c_nationkey AS entity_id, count(DISTINCT page) AS pages, max(page) AS max_page,
           max(found) AS found, CAST(25 AS BIGINT) AS page_limit,
           max(found) <= 25 * max(page) AND count(DISTINCT page) = max(page) AS complete
    FROM (""" + _GAPS_SQL + """) l
    GROUP BY c_nationkey
""")
def q_page_coverage(spark, sf_dir):
    from sensorflow.sources.pages import page_coverage
    pages = feeds.location_pages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                 last_missing_region=1, second_missing_region=2)
    return page_coverage(pages)


@register("skip_missing_id", """
    SELECT c_nationkey AS entity_id, page, rid AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS country_id
    FROM (""" + _LANDED_SQL + """) l
    WHERE rid IS NOT NULL AND rid <> 0
""")
def q_skip_missing_id(spark, sf_dir):
    from sensorflow.operators.filters import skip_missing_id
    return skip_missing_id(_page_results(spark, sf_dir), "id")


@register("select_country", """
    SELECT c_nationkey AS entity_id, page, rid AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS country_id
    FROM (""" + _LANDED_SQL + """) l
    WHERE c_nationkey = 22
""")
def q_select_country(spark, sf_dir):
    from sensorflow.operators.filters import select_country
    return select_country(_page_results(spark, sf_dir), "country_id", 22)


@register("first_result", """
    SELECT p_partkey AS entity_id, p_partkey AS id, p_name AS name
    FROM part WHERE p_size >= 8
""")
def q_first_result(spark, sf_dir):
    from pyspark.sql import types as T

    from sensorflow.sources.pages import first_result
    result = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    res = first_result(feeds.part_responses(table(spark, sf_dir, "part")), result)
    return res.select("entity_id", "result.id", "result.name")


@register("landed_to_messages", """
    WITH l AS (SELECT * FROM (""" + _LANDED_SQL + """) x WHERE c_nationkey = 22)
    SELECT 'country' AS topic, n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey = 22
    UNION ALL SELECT 'parameter', r_regionkey, r_name FROM region
    WHERE r_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey = 22)
    UNION ALL SELECT 'locations', rid, c_name FROM l
    UNION ALL SELECT 'measurements', user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events WHERE user_id IN (SELECT rid FROM l)
    UNION ALL SELECT 'end', NULL, NULL FROM (SELECT DISTINCT user_id % 3 FROM events WHERE user_id IN (SELECT rid FROM l))
""")
def q_landed_to_messages(spark, sf_dir):
    """All topics of country 22, published to file topics and read back."""
    from sensorflow.functions.json import parse_array, parse_struct
    from sensorflow.operators.explode import explode_array
    from sensorflow.plans.ingest import ingest_topics, publish_topics
    from sensorflow.session import scratch_path
    from sensorflow.sources.envelope import file_topic_source, write_file_topic
    pages = feeds.location_pages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    topics = ingest_topics(
        22, feeds.country_responses(table(spark, sf_dir, "nation")), W.country,
        feeds.parameter_pages(table(spark, sf_dir, "region")), W.parameter, pages, W.location,
        feeds.measurement_pages(table(spark, sf_dir, "events")), W.measurement, stage=materialize)
    root = scratch_path(spark, "ingest")

    def write(topic, messages):
        write_file_topic(messages, f"{root}/{topic}")

    def read(topic):
        return file_topic_source(spark, f"{root}/{topic}")

    for topic in topics:
        write(topic, topics[topic].limit(0))  # topics are there, and empty
    if not all(publish_topics(topics, read, write).values()):
        raise AssertionError("not published")
    if publish_topics({**topics, "measurements": topics["measurements"].limit(0)}, read, write)["locations"]:
        raise AssertionError("published twice")

    def arrays(topic, element):
        arr = decode_value(read(topic)).select(parse_array("value", element).alias("a"))
        return explode_array(arr, "a", "r").select(F.lit(topic).alias("topic"), "r.id", "r.name")

    country = decode_value(read("country")).select(parse_struct("value", W.country).alias("r"))
    measured = decode_value(read("measurements")).select(parse_struct("value", W.measurement).alias("r"))
    return (country.select(F.lit("country").alias("topic"), "r.id", "r.name")
            .unionByName(arrays("parameter", W.parameter)).unionByName(arrays("locations", W.location))
            .unionByName(measured.select(
                F.when(F.col("r.end").isNull(), "measurements").otherwise("end").alias("topic"),
                F.col("r.locationsId").alias("id"),
                F.translate(F.substring("r.datetime.utc", 1, 19), "T", " ").alias("name"))))


# -- S4, S10: quarantine of raw messages, re-drive ----------------------------
@register("quarantine_raw", """
    SELECT user_id AS partition_user, event_id, CASE
        WHEN event_type = 'error' THEN 'unparsable'
        WHEN event_type = 'signup' THEN 'incomplete:timestamp_utc'
        WHEN event_type = 'purchase' THEN 'incomplete:value'
        ELSE 'accepted' END AS outcome
    FROM events
""")
def q_quarantine_raw(spark, sf_dir):
    """Every message is accounted for: accepted, or kept with its text and the
    reason.  ``error`` events arrive cut short, ``signup`` with a bad time,
    ``purchase`` with NaN."""
    from sensorflow.plans.measurements import rejected_messages, typed_measurements
    kind = F.col("event_type")
    env = feeds.measurement_messages(table(spark, sf_dir, "events"), bad_utc=kind == "signup",
                                     nan_value=kind == "purchase")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), "user_id",
                                                   (kind == "error").alias("cut"))
    env = env.join(events, "offset").withColumn(
        "value", F.when(F.col("cut"), F.lit('{"value": ').cast("binary")).otherwise(F.col("value")))
    typed = typed_measurements(parse_measurements(landed(spark, env, "raw"), W, keep_raw=True))
    bad = rejected_messages(typed).filter(F.col("raw").isNotNull()).select("_offset", F.col("reason").alias("outcome"))
    good = typed.filter(F.col("_reject").isNull()).select("_offset", F.lit("accepted").alias("outcome"))
    return (bad.unionByName(good).withColumnRenamed("_offset", "offset").join(events, "offset")
            .select(F.col("user_id").alias("partition_user"), F.col("offset").alias("event_id"), "outcome"))


@register("redrive", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc + INTERVAL 123456 MICROSECOND AS timestamp_utc,
           timestamp_local + INTERVAL 654321 MICROSECOND AS timestamp_local, latitude, longitude,
           'late' AS stage
    FROM (""" + _FACT_SQL + """) f JOIN customer ON c_custkey = location_id WHERE c_mktsegment = 'MACHINERY'
    UNION ALL
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc + INTERVAL 123456 MICROSECOND,
           timestamp_local + INTERVAL 654321 MICROSECOND, latitude, longitude, 'first'
    FROM (""" + _FACT_SQL + """) f JOIN customer ON c_custkey = location_id WHERE c_mktsegment <> 'MACHINERY'
""")
def q_redrive(spark, sf_dir):
    """Measurements whose location is not stored yet (segment MACHINERY) are
    quarantined; once it is, re-driving gives back exactly those rows."""
    from sensorflow.operators.constraints import redrive, validate
    from sensorflow.schemas import MEASUREMENT_TABLE
    fact = _measurement_fact(spark, sf_dir).withColumns({
        "timestamp_utc": F.timestamp_add("MICROSECOND", F.lit(123456), F.col("timestamp_utc")),
        "timestamp_local": F.timestamp_add("MICROSECOND", F.lit(654321), F.col("timestamp_local"))})
    fact = materialize(fact)
    locations = _fixture_locations(spark, sf_dir)
    known = locations.filter(F.col("locality") != "MACHINERY")
    first, quarantined = validate(fact, MEASUREMENT_TABLE, {"location_table": known}, unique_key=True)
    late, still = validate(redrive(quarantined, MEASUREMENT_TABLE), MEASUREMENT_TABLE,
                           {"location_table": locations}, unique_key=True)
    if not still.isEmpty():
        raise AssertionError("rows with a parent were quarantined again")
    out = late.withColumn("stage", F.lit("late")).unionByName(first.withColumn("stage", F.lit("first")))
    return out.withColumn("timestamp_utc", utc("timestamp_utc"))


# -- D1-D5, E1-E5 -------------------------------------------------------------
@register("enrich_left", """
    SELECT l_orderkey AS country_id, l_partkey AS parameter_id,
           'parameter-' || l_partkey AS name,
           CASE WHEN p_type <> 'PROMO' THEN upper(p_name) END AS display_name,
           CASE WHEN p_type <> 'PROMO' THEN p_type END AS description
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
""")
def q_enrich_left(spark, sf_dir):
    from sensorflow.operators.explode import explode_array
    from sensorflow.operators.joins import enrich_left
    from sensorflow.plans.common import parse_object_messages
    from sensorflow.plans.dims import parameter_dimension
    env = feeds.country_messages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    c = parse_object_messages(landed(spark, env, "country"), W.country, "c")
    rows = explode_array(c, F.col("c.parameters"), "p").select(
        F.col("c.id").alias("country_id"), F.col("p.id").alias("parameter_id"),
        F.col("p.name").alias("name"), F.col("p.displayName").alias("display_name"))
    dim = parameter_dimension(landed(spark, feeds.parameter_messages(table(spark, sf_dir, "part")), "parameter"), W)
    return enrich_left(rows, dim, "parameter_id", "id",
                       {"display_name": "displayName", "description": "description"})


@register("referenced_dim_rows", """
    SELECT * FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)
""")
def q_referenced_dim_rows(spark, sf_dir):
    from sensorflow.operators.aggregates import collect_ids
    from sensorflow.operators.joins import referenced_dim_rows
    from sensorflow.plans.common import parse_object_messages
    env = feeds.country_messages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    c = parse_object_messages(landed(spark, env, "country"), W.country, "c")
    ids = collect_ids(c.select(F.col("c.parameters").alias("parameters")), "parameters")
    return referenced_dim_rows(table(spark, sf_dir, "part"), ids, "p_partkey", "id")


@register("dedupe_by_key", """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def q_dedupe_by_key(spark, sf_dir):
    from sensorflow.operators.dedupe import dedupe_by_key
    return dedupe_by_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


_UPSERT_CTE = """
    WITH t AS (SELECT event_id, ts, user_id, event_type, value FROM events
               WHERE ts < TIMESTAMP '2024-01-19 00:00:00'),
         s AS (SELECT event_id, ts, user_id, event_type,
                      CASE WHEN event_type = 'error' THEN NULL ELSE value + 1 END AS value
               FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00')
"""


def _upsert_inputs(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    target = ev.filter(F.col("ts") < F.lit("2024-01-19 00:00:00").cast("timestamp_ntz"))
    source = ev.filter(F.col("ts") >= F.lit("2024-01-13 00:00:00").cast("timestamp_ntz")).withColumn(
        "value", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value") + 1))
    return target, source


@register("upsert_merge", _UPSERT_CTE + """
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = t.event_id)
    UNION ALL SELECT * FROM s
""")
def q_upsert_merge(spark, sf_dir):
    from sensorflow.operators.upsert import upsert
    target, source = _upsert_inputs(spark, sf_dir)
    return upsert(target, source, "event_id")


@register("upsert_counts", _UPSERT_CTE + """
    SELECT count(*) FILTER (WHERE t.event_id IS NULL) AS inserts,
           count(*) FILTER (WHERE t.event_id IS NOT NULL) AS updates
    FROM s LEFT JOIN t ON t.event_id = s.event_id
""")
def q_upsert_counts(spark, sf_dir):
    from sensorflow.operators.upsert import upsert_counts
    target, source = _upsert_inputs(spark, sf_dir)
    return upsert_counts(target, source, "event_id")


@register("keyed_table_upsert", _UPSERT_CTE + """
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = t.event_id)
    UNION ALL SELECT * FROM s
""")
def q_keyed_table_upsert(spark, sf_dir):
    from sensorflow.session import scratch_path
    from sensorflow.sources.keyed_table import KeyedTable
    target, source = _upsert_inputs(spark, sf_dir)
    kt = KeyedTable(spark, scratch_path(spark, "keyed-events"), "event_id", buckets=16)
    kt.upsert(target)
    kt.upsert(source)
    return kt.read()


@register("versioned_table_upsert", _UPSERT_CTE + """
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = t.event_id)
    UNION ALL SELECT * FROM s
""")
def q_versioned_table_upsert(spark, sf_dir):
    """Snapshot sink: batch 0 = target, batch 1 = source, then batch 1 replayed
    (must report the same counts and leave the same snapshot)."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.keyed_table import VersionedTable
    target, source = _upsert_inputs(spark, sf_dir)
    vt = VersionedTable(spark, scratch_path(spark, "versioned-events"), "event_id")
    vt.upsert(target, batch_id=0)
    first = vt.upsert(source, batch_id=1)
    again = vt.upsert(source, batch_id=1)
    if first != again:
        raise AssertionError(f"replayed batch reported {again}, first run {first}")
    return vt.read()


@register("offset_bounds", """
    SELECT 'measurements' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
           min(event_id) AS low, max(event_id) + 1 AS high
    FROM events GROUP BY 2
""")
def q_offset_bounds(spark, sf_dir):
    from sensorflow.operators.aggregates import offset_bounds
    return offset_bounds(feeds.measurement_messages(table(spark, sf_dir, "events")))


# -- F1-F5: constraints -----------------------------------------------------
@register("fk_orphans", """
    SELECT event_id, user_id FROM events
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)
""")
def q_fk_orphans(spark, sf_dir):
    from sensorflow.operators.constraints import check_foreign_key
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    return check_foreign_key(ev, "user_id", table(spark, sf_dir, "supplier"), "s_suppkey")


@register("check_primary_key", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def q_check_primary_key(spark, sf_dir):
    from sensorflow.operators.constraints import check_primary_key
    return check_primary_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_not_null", """
    SELECT 'location_table' AS "table", 'not_null:name' AS rule, c_custkey AS location_id
    FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def q_check_not_null(spark, sf_dir):
    from sensorflow.operators.constraints import validate
    from sensorflow.schemas import LOCATION_TABLE
    loc = _fixture_locations(spark, sf_dir).withColumn(
        "name", F.when(F.col("locality") == "BUILDING", F.lit(None)).otherwise(F.col("name")))
    _, quarantine = validate(loc, LOCATION_TABLE, {"country": _fixture_countries(spark, sf_dir)},
                             with_columns=True)
    return quarantine.select("table", "rule", "location_id")


@register("check_max_length", """
    SELECT 'country' AS "table", 'max_length:code' AS rule, p_partkey AS id
    FROM part WHERE length(p_name) > 10
""")
def q_check_max_length(spark, sf_dir):
    from sensorflow.operators.constraints import validate
    from sensorflow.schemas import COUNTRY_TABLE
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("code"),
                                              F.col("p_brand").alias("name"))
    valid, quarantine = validate(rows, COUNTRY_TABLE, with_columns=True)
    return quarantine.select("table", "rule", "id")


@register("check_valid_rows", """
    SELECT p_partkey AS id, p_name AS code, p_brand AS name FROM part WHERE length(p_name) <= 10
""")
def q_check_valid_rows(spark, sf_dir):
    from sensorflow.operators.constraints import validate
    from sensorflow.schemas import COUNTRY_TABLE
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("code"),
                                              F.col("p_brand").alias("name"))
    valid, _ = validate(rows, COUNTRY_TABLE)
    return valid


# -- A8-A11: publishing -----------------------------------------------------
@register("publish_rows", "SELECT * FROM orders")
def q_publish_rows(spark, sf_dir):
    from sensorflow.functions.json import parse_struct
    from sensorflow.sources.publish import publish_rows
    orders = table(spark, sf_dir, "orders")
    env = publish_rows(orders, "orders", offset="o_orderkey", key="o_custkey", partitions=3)
    return decode_value(env).select(parse_struct("value", orders.schema).alias("o")).select("o.*")


@register("publish_array", "SELECT * FROM lineitem")
def q_publish_array(spark, sf_dir):
    from pyspark.sql import types as T

    from sensorflow.operators.explode import explode_array
    from sensorflow.plans.common import parse_array_messages
    from sensorflow.sources.publish import bounded_chunks, publish_array
    li = table(spark, sf_dir, "lineitem")
    chunked = bounded_chunks(li, ["l_orderkey"], 64, alias="chunk").withColumn("published_by", F.lit("bench"))
    env = publish_array(chunked, "lineitem", group=["l_orderkey"], chunk=F.col("chunk"),
                        offset="l_orderkey", payload=li.columns + ["published_by"])
    arr = parse_array_messages(landed(spark, env, "lineitem"), T.StructType(li.schema.fields), "items")
    return explode_array(arr, "items", "i").select("i.*")


@register("publish_if_empty", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_publish_if_empty(spark, sf_dir):
    from sensorflow.functions.json import parse_struct
    from sensorflow.session import scratch_path
    from sensorflow.sources.envelope import file_topic_source
    from sensorflow.sources.publish import publish_if_empty, publish_rows
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "topic-orders")
    first = publish_if_empty(spark, publish_rows(orders, "orders", offset="o_orderkey"), path)
    second = publish_if_empty(spark, publish_rows(orders.filter(F.col("o_orderstatus") == "F"), "orders",
                                                  offset="o_orderkey"), path)
    if not first or second:
        raise AssertionError(f"publish_if_empty: first={first} second={second}")
    env = file_topic_source(spark, path)
    return decode_value(env).select(parse_struct("value", orders.schema).alias("o")).select("o.*")


# -- I1, I2: dimension jobs ---------------------------------------------------
@register("country_parameter_dims", """
    SELECT 'country' AS table_name, o_orderkey AS "key", o_orderpriority AS name, o_orderstatus AS code,
           CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS display_name,
           CAST(NULL AS VARCHAR) AS description, o_orderdate AS datetime_first,
           o_orderdate + INTERVAL 1 DAY AS datetime_last
    FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL
    SELECT 'parameter', l_partkey, 'parameter-' || l_partkey, NULL, 'ppm',
           CASE WHEN p_type <> 'PROMO' THEN upper(p_name) END,
           CASE WHEN p_type <> 'PROMO' THEN p_type END, NULL, NULL
    FROM (SELECT DISTINCT l_partkey FROM lineitem) l LEFT JOIN part ON p_partkey = l_partkey
""")
def q_country_parameter_dims(spark, sf_dir):
    from sensorflow.plans.dims import country_parameter_dims
    country_env = feeds.country_messages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    param_env = feeds.parameter_messages(table(spark, sf_dir, "part"))
    country, parameter = country_parameter_dims(landed(spark, country_env, "country"),
                                                landed(spark, param_env, "parameter"),
                                                stage=materialize, schemas=W)
    nul = F.lit(None).cast("string")
    c = country.select(F.lit("country").alias("table_name"), F.col("id").cast("bigint").alias("key"),
                       "name", "code", nul.alias("unit"), nul.alias("display_name"), nul.alias("description"),
                       utc("datetimeFirst").alias("datetime_first"), utc("datetimeLast").alias("datetime_last"))
    p = parameter.select(F.lit("parameter").alias("table_name"), F.col("parameter_id").cast("bigint").alias("key"),
                         "name", nul.alias("code"), "unit", "display_name", "description",
                         F.lit(None).cast("timestamp_ntz").alias("datetime_first"),
                         F.lit(None).cast("timestamp_ntz").alias("datetime_last"))
    return c.unionByName(p)


@register("location_sensor_dims", """
    SELECT 'location_table' AS table_name, c_custkey AS "key", c_name AS name,
           c_mktsegment AS locality, CAST(c_nationkey AS BIGINT) AS country_id, c_acctbal / 100.0 AS latitude,
           CAST(c_nationkey * 1.5 AS DOUBLE) AS longitude, 'Europe/Paris' AS timezone,
           first_ts AS datetime_first_utc, first_ts + INTERVAL 1 HOUR AS datetime_first_local,
           last_ts AS datetime_last_utc, last_ts + INTERVAL 1 HOUR AS datetime_last_local,
           CAST(NULL AS BIGINT) AS parameter_id, CAST(NULL AS BIGINT) AS location_id
    FROM (""" + _LOC_SQL + """) l WHERE n_orders > 0
    UNION ALL
    SELECT 'sensor', o_orderkey, o_orderpriority, NULL, NULL, NULL, NULL, NULL,
           NULL, NULL, NULL, NULL, CAST(substr(o_orderpriority, 1, 1) AS BIGINT), o_custkey
    FROM orders
""")
def q_location_sensor_dims(spark, sf_dir):
    from sensorflow.operators.constraints import validate
    from sensorflow.plans.dims import location_sensor_dims
    from sensorflow.schemas import LOCATION_TABLE, SENSOR_TABLE
    env = feeds.location_messages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))
    location, sensor = location_sensor_dims(landed(spark, env, "locations"), stage=materialize, schemas=W)
    # parents first -- country, then location, then sensor
    # both frames come out of dedupe_by_key: keys are unique (NULL keys still caught)
    location, _ = validate(location, LOCATION_TABLE, {"country": _fixture_countries(spark, sf_dir)},
                           unique_key=True)
    location = materialize(location)  # output and parent of the sensor check: validate once
    sensor, _ = validate(sensor, SENSOR_TABLE, {"location_table": location}, unique_key=True)
    nul_i, nul_s, nul_d = (F.lit(None).cast(t) for t in ("bigint", "string", "double"))
    nul_t = F.lit(None).cast("timestamp_ntz")
    loc = location.select(
        F.lit("location_table").alias("table_name"), F.col("location_id").alias("key"), "name", "locality",
        "country_id", "latitude", "longitude", "timezone",
        utc("datetime_first_utc").alias("datetime_first_utc"), "datetime_first_local",
        utc("datetime_last_utc").alias("datetime_last_utc"), "datetime_last_local",
        nul_i.alias("parameter_id"), nul_i.alias("location_id"))
    sen = sensor.select(
        F.lit("sensor").alias("table_name"), F.col("sensor_id").alias("key"), "name", nul_s.alias("locality"),
        nul_i.alias("country_id"), nul_d.alias("latitude"), nul_d.alias("longitude"), nul_s.alias("timezone"),
        nul_t.alias("datetime_first_utc"), nul_t.alias("datetime_first_local"),
        nul_t.alias("datetime_last_utc"), nul_t.alias("datetime_last_local"), "parameter_id", "location_id")
    return loc.unionByName(sen)


# -- I3, H1-H8: the measurement stream -----------------------------------------
_CHUNK_SQL = """
    WITH e AS (SELECT *, CASE WHEN day(ts) <= 8 THEN 0 WHEN day(ts) <= 16 THEN 1
                              WHEN day(ts) <= 24 THEN 2 ELSE 3 END AS chunk FROM events)
"""


def run_measurement_stream(spark, sf_dir):
    """Four file batches (by day of month) through the streaming upsert; each
    batch after the first re-delivers the previous batch's purchase events;
    the last one ends with ``{"end": true}``.  Returns ``(table, metrics)``."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.envelope import file_topic_source, write_file_topic
    from sensorflow.sources.keyed_table import KeyedTable
    from sensorflow.sources.publish import append_end_marker
    from sensorflow.streaming.runner import MeasurementUpsert, await_and_stop, start_measurement_stream
    events = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    ev = events.withColumn("_chunk", F.when(day <= 8, 0).when(day <= 16, 1).when(day <= 24, 2).otherwise(3))
    root = scratch_path(spark, "measurement-stream")
    kt = KeyedTable(spark, f"{root}/table", "latest_id", partition_by={
        "day": F.to_date(instant_to_utc_ntz(F.col("timestamp_utc"))),
        "_bucket": F.pmod(F.xxhash64("latest_id"), F.lit(4))})
    locations = _fixture_locations(spark, sf_dir)
    sensors = locations.select(F.col("location_id").alias("sensor_id"))
    sink = MeasurementUpsert(spark, kt, metrics_path=f"{root}/metrics", quarantine_path=f"{root}/quarantine",
                             parents={"location_table": locations, "sensor": sensors}, partitions=3)
    for k in range(4):
        env = feeds.measurement_messages(ev.filter(F.col("_chunk") == k).drop("_chunk"))
        if k > 0:
            again = ev.filter((F.col("_chunk") == k - 1) & (F.col("event_type") == "purchase")).drop("_chunk")
            env = env.unionByName(feeds.measurement_messages(again)
                                  .withColumn("offset", F.col("offset") + F.lit(10**12)))
        if k == 3:
            env = append_end_marker(env)
        write_file_topic(env, f"{root}/topic")
        query = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink,
                                         f"{root}/checkpoint", available_now=True, schemas=W)
        await_and_stop(query, sink)
    if not sink.end_seen:
        raise AssertionError(f"partitions ended: {sorted(sink.ended)}")
    metrics = spark.read.parquet(f"{root}/metrics")
    return kt.read(), metrics.withColumn("batch_id", F.col("batch_id").cast("bigint"))


@register("measurement_stream", """
    SELECT latest_id, location_id, sensor_id, value, timestamp_utc, timestamp_local, latitude, longitude
    FROM (""" + _FACT_SQL + """) f
""")
def q_measurement_stream(spark, sf_dir):
    tbl, _ = run_measurement_stream(spark, sf_dir)
    return tbl.withColumn("timestamp_utc", utc("timestamp_utc"))


@register("batch_counts", _CHUNK_SQL + """,
    fresh AS (SELECT chunk, count(*) AS n FROM e GROUP BY chunk),
    redo AS (SELECT chunk + 1 AS chunk, count(*) AS n FROM e
             WHERE event_type = 'purchase' AND chunk < 3 GROUP BY chunk)
    SELECT CAST(f.chunk AS BIGINT) AS batch_id, f.n + coalesce(r.n, 0) AS rows, f.n AS inserts,
           coalesce(r.n, 0) AS updates, CAST(0 AS BIGINT) AS quarantined, f.chunk = 3 AS end_seen
    FROM fresh f LEFT JOIN redo r USING (chunk)
""")
def q_batch_counts(spark, sf_dir):
    _, metrics = run_measurement_stream(spark, sf_dir)
    return metrics.select("batch_id", "rows", "inserts", "updates", "quarantined", "end_seen")


# -- I1/I2 tails: validated parent-first writes into keyed tables -------------
@register("dimension_job", """
    WITH c AS (
        SELECT 'country' AS table_name, (SELECT count(*) FROM nation) AS n
        UNION ALL SELECT 'parameter', (SELECT count(DISTINCT o_orderpriority) FROM orders)
        UNION ALL SELECT 'location_table', (SELECT count(DISTINCT o_custkey) FROM orders)
        UNION ALL SELECT 'sensor', (SELECT count(*) FROM orders))
    SELECT table_name, CAST(n AS BIGINT) AS inserts, CAST(0 AS BIGINT) AS updates,
           CAST(0 AS BIGINT) AS quarantined, CAST(n AS BIGINT) AS stored_rows
    FROM c
""")
def q_dimension_job(spark, sf_dir):
    tables, first = run_dimension_job(spark, sf_dir)
    rows = [(n, r["inserts"], r["updates"], r["quarantined"], tables[n].read().count())
            for n, r in first.items()]
    return spark.createDataFrame(rows, "table_name string, inserts bigint, updates bigint, "
                                       "quarantined bigint, stored_rows bigint")


@register("dimension_rows", """
    SELECT 'country' AS table_name, CAST(n_nationkey AS BIGINT) AS "key", n_name AS name,
           CAST(NULL AS BIGINT) AS parent FROM nation
    UNION ALL SELECT DISTINCT 'parameter', CAST(substr(o_orderpriority, 1, 1) AS BIGINT), o_orderpriority, NULL FROM orders
    UNION ALL SELECT DISTINCT 'location_table', c_custkey, c_name, CAST(c_nationkey AS BIGINT)
    FROM customer JOIN orders ON o_custkey = c_custkey
    UNION ALL SELECT 'sensor', o_orderkey, o_orderpriority, o_custkey FROM orders
""")
def q_dimension_rows(spark, sf_dir):
    """What the job has stored after the replay."""
    tables, _ = run_dimension_job(spark, sf_dir)
    none = F.lit(None).cast("bigint")
    parts = [("country", "id", none), ("parameter", "parameter_id", none),
             ("location_table", "location_id", F.col("country_id")), ("sensor", "sensor_id", F.col("location_id"))]
    out = None
    for name, key, parent in parts:
        rows = tables[name].read().select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"),
                                          "name", parent.cast("bigint").alias("parent"))
        out = rows if out is None else out.unionByName(rows)
    return out


def run_dimension_job(spark, sf_dir):
    """Country rows from ``nation``, parameters from the order priorities the
    sensors reference, locations and sensors from the location topic; the
    job writes all four keyed tables, then a replay of the location topic
    reports only updates and changes nothing."""
    from pyspark.sql import types as T

    from sensorflow.plans.jobs import dimension_job
    from sensorflow.session import scratch_path
    from sensorflow.sources.keyed_table import KeyedTable
    root = scratch_path(spark, "dimension-job")
    tables = {n: KeyedTable(spark, f"{root}/{n}", list(TABLES_SPEC[n].key), buckets=4, spec=TABLES_SPEC[n])
              for n in ("country", "parameter", "location_table", "sensor")}
    nation = table(spark, sf_dir, "nation")
    country = nation.select(F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), "n_nationkey").alias("code"),
                            F.col("n_name").alias("name"), F.lit(None).cast("timestamp").alias("datetimeFirst"),
                            F.lit(None).cast("timestamp").alias("datetimeLast"))
    parameter = (table(spark, sf_dir, "orders")
                 .select(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("parameter_id"),
                         F.col("o_orderpriority").alias("name"))
                 .distinct()
                 .select("parameter_id", "name", F.lit("ppm").alias("unit"),
                         F.col("name").alias("display_name"), F.lit(None).cast(T.StringType()).alias("description")))
    env = landed(spark, feeds.location_messages(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")),
                 "locations")
    first = dimension_job(spark, tables, location_decoded=env,
                          extra={"country": country, "parameter": parameter}, schemas=W)
    replay = dimension_job(spark, tables, location_decoded=env, schemas=W)
    if any(r["inserts"] for r in replay.values()):
        raise AssertionError(f"replay inserted rows: {replay}")
    return tables, first


from sensorflow.plans import catalog_live  # noqa: E402,F401  registers its queries here
