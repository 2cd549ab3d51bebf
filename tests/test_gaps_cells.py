"""Missing ranges and grid cells against plain loops; the heat map's edges."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.cells import cell, coarser
from sensorflow.operators.gaps import missing_ranges
from sensorflow.plans.marts import heat_map
from sensorflow.sources.pages import missing_pages


def plain_gaps(values, low=None, high=None):
    there = sorted({v for v in values if v is not None and (low is None or low <= v <= high)})
    lo, hi = (low, high) if low is not None else (there[0], there[-1]) if there else (0, -1)
    out, start = [], None
    for v in range(lo, hi + 2):
        gone = v <= hi and v not in there
        if gone and start is None:
            start = v
        if not gone and start is not None:
            out.append((start, v - 1))
            start = None
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_gaps_equal_a_loop(spark, width):
    rng = random.Random(width)
    data = {g: [rng.randrange(-20, 90) for _ in range(rng.choice([1, 5, 40]))] + [None] for g in ("a", "b", "c", None)}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs * 2], "g string, v int")
    got = {g: [] for g in data}
    for r in missing_ranges(df, ["g"], "v", width=width).collect():
        got[r["g"]].append((r["first_missing"], r["last_missing"]))
    assert {g: sorted(x) for g, x in got.items()} == {g: plain_gaps(vs) for g, vs in data.items()}
    limits = {"a": (-30, 95), "b": (0, 50), "c": (200, 210), None: (5, 5), "none": (1, 3), "nothing": (1, 0)}
    bounds = spark.createDataFrame([(g, *lh) for g, lh in limits.items()], "g string, low long, high long")
    got = {g: [] for g in limits}
    for r in missing_ranges(df, ["g"], "v", bounds, width=width).collect():
        got[r["g"]].append((r["first_missing"], r["last_missing"]))
    assert {g: sorted(x) for g, x in got.items()} == {g: plain_gaps(data.get(g, []), *lh) for g, lh in limits.items()}


def test_a_hot_group_meets_in_no_window_and_a_gap_over_blocks_is_one(spark):
    df = spark.range(0, 50_000).filter("id < 10 OR id > 40000").withColumn("g", F.lit(1))
    gaps = missing_ranges(df, ["g"], "id", width=100)
    assert [tuple(r) for r in gaps.collect()] == [(1, 10, 40_000)]
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "__block" in plan


def test_missing_pages(spark):
    def body(found, limit, n=1):
        meta = f'"meta":{{"found":{found},"limit":{limit}}},' if found is not None else ""
        return f'{{{meta}"results":[{",".join(["{}"] * n)}]}}'

    rows = [(1, 1, body(250, 100)), (1, 3, body(250, 100)), (2, 1, body(250, 100)), (3, 1, body(0, 100, 0)), (4, 2, body(None, None)),
            (5, 1, body(7, 0)), (6, 1, "not json"), (7, 1, body(3000, None).replace("None", "null")), (10**10, 1, body(101, 100))]
    pages = spark.createDataFrame(rows, "entity_id long, page int, body string")
    got = sorted(tuple(r) for r in missing_pages(pages).collect())
    assert got == [(1, 2, 2), (2, 2, 3), (4, 1, 1), (5, 2, 7), (7, 2, 3), (10**10, 2, 2)]


def plain_cell(lat, lon, level):
    if lat is None or lon is None or not -90 <= lat <= 90 or math.isnan(lon) or math.isinf(lon):
        return None
    size = 2 ** level
    x = min(math.floor((lon + 180.0) % 360.0 / 360.0 * size), size - 1)
    y = min(math.floor((lat + 90.0) / 180.0 * size), size - 1)
    return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(level))


NAN, INF = float("nan"), float("inf")
PLACES = [(90.0, 0.0), (-90.0, 180.0), (90.0, -180.0), (0.0, 180.0), (0.0, -180.0), (0.0, 190.0), (0.0, -170.0), (48.85, 2.35),
          (None, 1.0), (1.0, None), (NAN, 1.0), (1.0, NAN), (INF, 0.0), (0.0, INF), (0.0, -INF), (90.0001, 0.0), (0.0, 720.5),
          (-1e-300, -1e-300), (89.999999999, 179.999999999)]


@pytest.mark.parametrize("level", [0, 1, 5, 28])
def test_cells_equal_a_loop(spark, level):
    rng = random.Random(level)
    places = PLACES + [(rng.uniform(-95, 95), rng.uniform(-400, 400)) for _ in range(200)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, lat double, lon double")
    got = {r["i"]: r["c"] for r in df.select("i", cell("lat", "lon", level).alias("c")).collect()}
    assert [got[i] for i in range(len(places))] == [plain_cell(*p, level) for p in places]
    up = {r["i"]: r["c"] for r in df.select("i", coarser(cell("lat", "lon", 28), 28 - level).alias("c")).collect()}
    assert [up[i] for i in range(len(PLACES))] == [plain_cell(*p, level) for p in PLACES]


def test_levels_out_of_range_are_refused():
    with pytest.raises(ValueError):
        cell("a", "b", 29)


def test_heat_map_of_poles_date_line_and_odd_values(spark):
    at = dt.datetime(2024, 1, 1, 23, 59, 59)
    rows = [(*p, v, at) for p in PLACES for v in (1.0, None)] + [(10.0, 10.0, NAN, at), (0.0, 180.0, 5.0, at + dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "latitude double, longitude double, value double, timestamp_utc timestamp")
    want = {}
    for lat, lon, v, t in rows:
        for level in (0, 3, 12):
            c = plain_cell(lat, lon, level)
            if c is not None:
                want.setdefault((level, c, t.date()), []).append(v)
    got = {(r["level"], r["cell"], r["day"]): (r["n"], r["avg_value"]) for r in heat_map(df, [0, 3, 12]).collect()}
    assert got.keys() == want.keys()
    for k, values in want.items():
        some = [v for v in values if v is not None]
        assert got[k][0] == len(values)
        assert str(got[k][1]) == str(sum(some) / len(some) if some else None) or got[k][1] == pytest.approx(sum(some) / len(some))
    assert heat_map(df.limit(0), [2]).count() == 0
    assert heat_map(df, [3], by_day=False).agg(F.sum("n")).first()[0] == sum(len(v) for k, v in want.items() if k[0] == 3)
