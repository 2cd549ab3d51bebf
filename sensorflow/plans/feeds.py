"""Message feeds built from the read-only test tables.

The driver queries test the operators the way they run in production: base
table -> JSON messages in envelopes (what the producer side publishes) ->
our operators -> relation, compared with SQL computed straight from the base
tables.  Domain mapping:

* measurement  <- events   (sensor = location = user_id, value, utc = ts)
* country doc  <- orders + its lineitems as ``parameters[]``
* parameter    <- part     (the parameter topic; PROMO parts are not in it)
* location doc <- customer + its orders as ``sensors[]``
* country dim  <- nation;  API pages of locations <- customers per nation

Edge cases are injected from natural attributes of the rows (event type,
part type, size), never by sampling ids.  Every feed is chunked so that no
message grows with a hot key.  Ids keep the tables' 64-bit width; parse them
with ``WIDE_MESSAGES``.  Like real producers, feeds carry fields the parse
schemas do not know (ignored by the parser); this also keeps Catalyst from
folding a same-plan ``to_json`` -> ``from_json`` pair away, so the JSON text is
really parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.casts import iso_utc, iso_with_offset
from sensorflow.sources.envelope import to_envelope
from sensorflow.sources.publish import publish_array

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Model a multi-partition topic: when the input arrives in fewer
    partitions than the cluster runs tasks (a test table stored as one row
    group), round-robin it over that many partitions so JSON work runs in
    parallel.  Large inputs already have enough partitions and pass through
    without a shuffle."""
    spark = df.sparkSession
    try:
        target = spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect: no RDD view, leave the input as it is
        return df
    return df if have >= target else df.repartition(target)


def _when(cond: Column | None, bad, good):
    return good if cond is None else F.when(cond, bad).otherwise(good)


# -- measurements -----------------------------------------------------------
def measurement_struct(events: DataFrame, bad_utc: Column | None = None,
                       null_latitude: Column | None = None, nan_value: Column | None = None,
                       missing_local: Column | None = None) -> Column:
    ts = F.col("ts")
    utc = _when(bad_utc, F.lit("not-a-time"), iso_utc(ts))
    local = _when(missing_local, F.lit(None).cast("string"),
                  iso_with_offset(ts + F.expr("INTERVAL 1 HOUR"), "+01:00"))
    return F.struct(
        F.struct(utc.alias("utc"), local.alias("local")).alias("datetime"),
        _when(nan_value, F.lit(float("nan")), F.col("value")).alias("value"),
        F.struct(_when(null_latitude, F.lit(None).cast("double"), F.col("user_id") / 100.0).alias("latitude"),
                 (F.col("user_id") / -50.0).alias("longitude")).alias("coordinates"),
        F.col("user_id").alias("sensorsId"),
        F.col("user_id").alias("locationsId"))


def measurement_messages(events: DataFrame, partitions: int = 3, **inject) -> DataFrame:
    """One JSON object per event; partition = user_id mod partitions, offset = event_id."""
    events = spread(events)
    value = F.to_json(measurement_struct(events, **inject))
    return to_envelope(events, value, "measurements", key=F.col("user_id"),
                       partition=F.pmod(F.col("user_id"), F.lit(partitions)),
                       offset=F.col("event_id"), timestamp=F.col("ts").cast("timestamp"))


# -- countries and parameters ----------------------------------------------
def country_messages(orders: DataFrame, lineitem: DataFrame, chunk_lines: int = 64) -> DataFrame:
    """One country object per order (and per chunk of at most about
    ``chunk_lines`` lines); orders without lines carry ``parameters: []``."""
    from sensorflow.sources.publish import bounded_chunks
    orders = spread(orders)  # streamed side of the join; lineitem goes straight into a shuffle
    lines = bounded_chunks(lineitem.select("l_orderkey", "l_partkey", "l_linenumber"),
                           ["l_orderkey"], chunk_lines, alias="chunk")
    items = (lines.select(
        "l_orderkey", "chunk",
        F.struct(F.col("l_partkey").alias("id"),
                 F.concat(F.lit("parameter-"), F.col("l_partkey")).alias("name"),
                 F.lit("ppm").alias("units"),
                 F.lit("from-country").alias("displayName"),
                 F.lit(None).cast("string").alias("description")).alias("p"))
        .groupBy("l_orderkey", "chunk").agg(F.sort_array(F.collect_list("p")).alias("parameters")))
    docs = orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
    doc = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("code"),
        F.col("o_orderpriority").alias("name"),
        iso_utc(F.col("o_orderdate")).alias("datetimeFirst"),
        iso_utc(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("datetimeLast"),
        F.coalesce(F.col("parameters"), F.array()).alias("parameters"))
    chunk = F.coalesce(F.col("chunk"), F.lit(0))
    return to_envelope(docs, F.to_json(doc), "country", offset=F.col("o_orderkey") * 1_000_000 + chunk,
                       timestamp=F.col("o_orderdate").cast("timestamp"))


def parameter_messages(part: DataFrame, chunk_rows: int = 500, copies: int = 2,
                       without_type: str | None = "PROMO") -> DataFrame:
    """The parameter topic: arrays of parameter objects, every message
    delivered ``copies`` times (redelivery).  Parts of ``without_type`` are not
    in it, so that joins meet parameters the topic lacks."""
    part = spread(part)
    if without_type is not None:
        part = part.filter(F.col("p_type") != without_type)
    rows = part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.lit("ppm").alias("units"), F.upper("p_name").alias("displayName"),
        F.col("p_type").alias("description"), F.lit("api").alias("source"),
        F.col("p_partkey").alias("row_id"))
    env = publish_array(rows, "parameter", group=[], chunk=F.floor(F.col("row_id") / chunk_rows),
                        offset="row_id", payload=["id", "name", "units", "displayName", "description", "source"])
    env = env.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    out = env
    for k in range(1, copies):
        out = out.unionByName(env.withColumn("offset", F.col("offset") + F.lit(k * 10**12)))
    return out


# -- locations with sensors -------------------------------------------------
def location_docs(customer: DataFrame, orders: DataFrame, chunk_sensors: int = 1000) -> DataFrame:
    """One location object per customer and chunk of at most about
    ``chunk_sensors`` of its orders (sensors)."""
    from sensorflow.sources.publish import bounded_chunks
    customer = spread(customer)  # orders go straight into aggregations
    chunked = bounded_chunks(orders.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"],
                             chunk_sensors, alias="chunk")
    sensors = (chunked.select(
        "o_custkey", "chunk",
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
                 F.struct(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id")).alias("parameter")
                 ).alias("s"))
        .groupBy("o_custkey", "chunk").agg(F.sort_array(F.collect_list("s")).alias("sensors")))
    span = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"),
                                           F.max("o_orderdate").alias("last"))
    c = (customer.join(span, customer.c_custkey == span.o_custkey, "left").drop("o_custkey")
         .join(sensors, customer.c_custkey == sensors.o_custkey, "left"))

    def when(col):
        return F.struct(iso_utc(col).alias("utc"),
                        iso_with_offset(col + F.expr("INTERVAL 1 HOUR"), "+01:00").alias("local"))
    return c.select(
        "c_custkey", "c_nationkey", F.coalesce(F.col("chunk"), F.lit(0)).alias("chunk"),
        F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("locality"), F.lit("Europe/Paris").alias("timezone"),
            F.struct(F.col("c_nationkey").alias("id"), F.lit(None).cast("string").alias("code")).alias("country"),
            F.create_map(F.lit("latitude"), F.col("c_acctbal") / 100.0,
                         F.lit("longitude"), F.col("c_nationkey") * 1.5).alias("coordinates"),
            when(F.col("first")).alias("datetimeFirst"), when(F.col("last")).alias("datetimeLast"),
            F.coalesce(F.col("sensors"), F.array()).alias("sensors"),
            F.lit(False).alias("isMobile")).alias("loc"))


def location_messages(customer: DataFrame, orders: DataFrame, per_message: int = 100) -> DataFrame:
    """Arrays of location objects, grouped by nation and customer-key range."""
    docs = location_docs(customer, orders)
    docs = docs.select("c_nationkey", "c_custkey", "chunk", F.to_json("loc").alias("loc_json"))
    grouped = (docs.groupBy("c_nationkey", F.floor(F.col("c_custkey") / per_message).alias("grp"), "chunk")
               .agg(F.sort_array(F.collect_list(F.struct("c_custkey", "loc_json"))).alias("items"),
                    F.min("c_custkey").alias("first_key")))
    value = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["loc_json"]), ","), F.lit("]"))
    return to_envelope(grouped, value, "locations",
                       offset=F.col("first_key") * 1000 + F.col("chunk"),
                       timestamp=F.lit("2024-01-01 00:00:00").cast("timestamp"))


# -- landed API pages -------------------------------------------------------
def position_within(df: DataFrame, group: str, key: str, width: int = 100_000) -> DataFrame:
    """1-based position ``_pos`` of ``key`` (unique within ``group``) in key order.

    Skew-safe: rows are counted per key range of ``width``, prefix sums run
    over those small per-range counts, and the final ``row_number`` only sees
    one key range of one group -- no task ever holds a whole hot group.
    """
    from pyspark.sql import Window
    rng = F.floor(F.col(key) / width).alias("_rng")
    counts = df.groupBy(group, rng).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_rng", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(group, "_rng").orderBy(key)
    return (df.withColumn("_rng", rng).join(offsets, [group, "_rng"])
            .withColumn("_pos", F.col("_before") + F.row_number().over(inner))
            .drop("_rng", "_before"))


def location_pages(customer: DataFrame, nation: DataFrame, limit: int = 25,
                   last_missing_region: int | None = None,
                   second_missing_region: int | None = None) -> DataFrame:
    """Landed pages ``(entity_id, page, body)`` of the locations endpoint per
    country (nation): ``limit`` results per page in key order.  Every page is
    landed unless a region is named whose countries lack the last (or the
    second) page.  Customers of segment BUILDING with a negative balance come
    without an id."""
    from sensorflow.operators.joins import bounded_broadcast
    pos = position_within(customer, "c_nationkey", "c_custkey")
    pos = pos.withColumn("page", F.floor((F.col("_pos") - 1) / limit).cast("int") + 1)
    found = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("found"))
    nat = bounded_broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), 10_000)
    no_id = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)
    result = F.struct(
        F.when(no_id, F.lit(None)).otherwise(F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.col("c_nationkey").alias("id"), F.lit(None).cast("string").alias("code")).alias("country"))
    pages = (pos.groupBy("c_nationkey", "page")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("c_custkey").alias("k"), result.alias("r"))))
                  .alias("items"))
             .join(found, "c_nationkey").join(nat, "c_nationkey"))
    last = F.ceil(F.col("found") / limit)
    if last_missing_region is not None:
        pages = pages.filter(~((F.col("n_regionkey") == last_missing_region) & (F.col("page") == last)))
    if second_missing_region is not None:
        pages = pages.filter(~((F.col("n_regionkey") == second_missing_region) & (F.col("page") == 2)))
    body = F.to_json(F.struct(
        F.struct(F.col("found").cast("long").alias("found"), F.lit(limit).cast("long").alias("limit")).alias("meta"),
        F.transform("items", lambda x: x["r"]).alias("results")), {"ignoreNullFields": "false"})
    return pages.select(F.col("c_nationkey").alias("entity_id"), "page", body.alias("body"))


def part_responses(part: DataFrame) -> DataFrame:
    """Single-entity responses per part: size < 5 -> ``results: []``; size 5..7
    -> failed response without ``results``; otherwise one result."""
    one = F.to_json(F.struct(
        F.struct(F.lit(1).cast("long").alias("found"), F.lit(100).cast("long").alias("limit")).alias("meta"),
        F.array(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))).alias("results")))
    body = (F.when(F.col("p_size") < 5, F.lit('{"meta":{"found":0,"limit":100},"results":[]}'))
            .when(F.col("p_size") < 8, F.lit('{"error":"not found"}'))
            .otherwise(one))
    return part.select(F.col("p_partkey").alias("entity_id"), body.alias("body"))


def country_responses(nation: DataFrame) -> DataFrame:
    """Single-entity responses: the country object with its parameter (region)."""
    result = F.struct(
        F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), "n_nationkey").alias("code"),
        F.col("n_name").alias("name"),
        F.array(F.struct(F.col("n_regionkey").alias("id"))).alias("parameters"))
    body = F.to_json(F.struct(F.array(result).alias("results")))
    return nation.select(F.col("n_nationkey").alias("entity_id"), body.alias("body"))


def parameter_pages(region: DataFrame) -> DataFrame:
    """The parameters endpoint, one result a page."""
    result = F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit("ppm").alias("units"))
    body = F.to_json(F.struct(F.array(result).alias("results")))
    return region.select(F.lit(0).cast("bigint").alias("entity_id"),
                         (F.col("r_regionkey") + 1).cast("int").alias("page"), body.alias("body"))


def measurement_pages(events: DataFrame, limit: int = 100) -> DataFrame:
    """Landed pages of the measurements of each location (user)."""
    pos = position_within(spread(events), "user_id", "event_id")
    pos = pos.withColumn("page", F.floor((F.col("_pos") - 1) / limit).cast("int") + 1)
    pages = pos.groupBy("user_id", "page").agg(F.sort_array(F.collect_list(
        F.struct("event_id", measurement_struct(events).alias("r")))).alias("items"))
    body = F.to_json(F.struct(F.transform("items", lambda x: x["r"]).alias("results")))
    return pages.select(F.col("user_id").alias("entity_id"), "page", body.alias("body"))
