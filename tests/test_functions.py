"""Column functions against plain Python, and exact nearest neighbours against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from courierflow.functions import clock, geo, scoring
from courierflow.operators.knn import nearest_k
from courierflow.operators.skew import SkewPolicy
from courierflow.operators.stats import mean_of_histogram, percentiles, stddev_of_histogram
from courierflow.states import LEGAL_MOVES, ORDER_STATES, PARTNER_STATES, legal_pairs

POINTS = [(17.385, 78.4867, 17.44, 78.39), (0.0, 0.0, 0.0, 180.0), (89.9, 10.0, -89.9, -170.0), (12.0, 77.0, 12.0, 77.0), (-33.9, 151.2, 51.5, -0.1)]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def haversine(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("p", POINTS)
def test_distance_and_bearing(spark, p):
    km, degrees = one(spark, geo.haversine_km(*map(F.lit, p)), geo.bearing_degrees(*map(F.lit, p)))
    assert km == pytest.approx(haversine(*p), abs=1e-6)
    la, lo, lb, lob = map(math.radians, p)
    x = math.sin(lob - lo) * math.cos(lb)
    y = math.cos(la) * math.sin(lb) - math.sin(la) * math.cos(lb) * math.cos(lob - lo)
    assert degrees == pytest.approx((math.degrees(math.atan2(x, y)) + 360) % 360, abs=1e-9) and 0 <= degrees < 360


def test_distance_to_nowhere_is_null(spark):
    none = F.lit(None).cast("double")
    assert one(spark, geo.haversine_km(none, none, F.lit(1.0), F.lit(1.0)))[0] is None


def test_cells(spark):
    row, col = geo.grid_cell(F.lit(17.385), F.lit(-0.001), 0.01)
    assert tuple(one(spark, row, col)) == (1738, -1)


@pytest.mark.parametrize("f,expected", [(0.0, 1.0), (0.25, 1.5), (1.0, 3.0), (-4.0, 1.0), (9.0, 3.0)])
def test_route(spark, f, expected):
    assert one(spark, geo.along_route(F.lit(1.0), F.lit(3.0), F.lit(f)))[0] == pytest.approx(expected)


@pytest.mark.parametrize(
    "hms,label,multiplier",
    [((12, 0, 0), "lunch", 2.8), ((14, 30, 0), "lunch", 2.8), ((14, 30, 1), "off_peak", 1.0), ((11, 59, 59), "off_peak", 1.0),
     ((22, 30, 0), "dinner", 3.2), ((0, 0, 0), "off_peak", 1.0)],
)
def test_peak_windows(spark, hms, label, multiplier):
    h, m, s = hms
    hour = clock.hour_of_day(F.lit(1704067200 + h * 3600 + m * 60 + s))
    got = one(spark, hour, clock.peak_label(hour), clock.peak_multiplier(hour))
    assert got[0] == pytest.approx(h + m / 60 + s / 3600) and got[1:] == (label, multiplier)


def test_event_time_text(spark):
    text = "2024-05-01T10:15:30.123Z"
    assert one(spark, clock.iso_millis(clock.parse_event_time(F.lit(text))))[0] == text
    assert one(spark, clock.parse_event_time(F.lit("soon")))[0] is None


def test_formulas(spark):
    got = one(
        spark,
        scoring.dispatch_score(F.lit(2.345), F.lit(4.5)),
        scoring.dispatch_score(F.lit(25.0), F.lit(4.5)),
        scoring.queue_prep_minutes(F.lit(10.0), F.lit(4)),
        scoring.queue_prep_minutes(F.lit(10.0), F.lit(0)),
        scoring.restaurant_weight(F.lit(3.0), F.lit(9)),
        scoring.restaurant_weight(F.lit(4.0), F.lit(2)),
        scoring.supply_target(F.lit(50), F.lit(0.55)),
        scoring.supply_target(F.lit(25), F.lit(0.5)),
        scoring.is_over_capacity(F.lit(3), F.lit(3)),
    )
    assert list(got) == pytest.approx([12.16, 4.5, 12.4, 10.0, 0.05, 3.0, 28, 12, True], abs=0.011)
    assert got[7] == 12  # 12.5 goes to the even number


def test_planned_distance_forms(spark):
    plan = lambda batched, *d: one(spark, scoring.planned_distance_km(*map(F.lit, d), F.lit(batched)))[0]
    assert plan(False, 1.0, 2.0, 9.0) == 3.0 and plan(True, 1.0, 2.0, 9.0) == 9.0 and plan(True, 1.0, 2.0, 0.0) is None


def test_state_tables():
    assert set(LEGAL_MOVES["order"]) == set(ORDER_STATES) - {"REJECTED", "DELIVERED", "CANCELLED"}
    assert set(LEGAL_MOVES["dp"]) == set(PARTNER_STATES)
    assert len(legal_pairs("order", "dp", "dp_observed")) == 24


@pytest.mark.parametrize("k,finest", [(1, 0.001), (5, 0.001), (5, 0.2), (60, 0.001)])
def test_nearest_equals_brute_force(spark, k, finest):
    rng = random.Random(k)
    places = [(f"Z{rng.randint(1, 3)}", i, 17 + rng.random() * rng.choice([0.01, 1]), 78 + rng.random() * rng.choice([0.01, 2])) for i in range(150)]
    places += [("Z1", 200 + i, 17.5, 78.5) for i in range(80)] + [("Z9", 999, 40.0, 8.0)]  # one crowded spot, one lone place
    origins = [(i, f"Z{rng.randint(1, 3)}", 17 + rng.random(), 78 + rng.random()) for i in range(25)] + [(90, "Z9", 17.0, 78.0), (91, "Z8", 1.0, 1.0)]
    got = nearest_k(
        spark.createDataFrame(origins, "oid long, zone_id string, lat double, lon double"),
        spark.createDataFrame(places, "zone_id string, pid long, lat double, lon double"),
        k, "oid", "pid", finest=finest,
    )
    want = set()
    for oid, zone, lat, lon in origins:
        near = sorted((round(haversine(lat, lon, p[2], p[3]), 6), p[1]) for p in places if p[0] == zone)[:k]
        want |= {(oid, pid, n + 1) for n, (_, pid) in enumerate(near)}
    assert {(r.oid, r.pid, r["rank"]) for r in got.collect()} == want


def test_nearest_from_far_away_and_around_the_globe(spark):
    """Origins on the other side of the globe, beside a pole and across the 180th meridian; one crowded spot of many positions."""
    rng = random.Random(9)
    places = [("Z", i, 17.4 + rng.random() * 1e-4, 78.4 + rng.random() * 1e-4) for i in range(400)]
    places += [("Z", 1000 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [("Z", 2000, None, 1.0), ("Z", 2001, 5.0, None)]
    origins = [(0, "Z", -17.4, -101.6), (1, "Z", 89.99, 10.0), (2, "Z", -89.9, -170.0), (3, "Z", 0.0, 179.9), (4, "Z", 0.0, -179.9), (5, "Z", 17.40005, 78.40005), (6, "Z", None, 1.0)]
    got = nearest_k(
        spark.createDataFrame(origins, "oid long, zone_id string, lat double, lon double"),
        spark.createDataFrame(places, "zone_id string, pid long, lat double, lon double"), 7, "oid", "pid")
    want = set()
    for oid, _, lat, lon in origins[:-1]:
        near = sorted((round(haversine(lat, lon, p[2], p[3]), 6), p[1]) for p in places[:-2])[:7]
        want |= {(oid, pid, n + 1) for n, (_, pid) in enumerate(near)}
    assert {(r.oid, r.pid, r["rank"]) for r in got.collect()} == want


def test_percentiles_are_exact(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, None]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7)], "g string, v long")
    out = percentiles(df, ["g"], F.col("v"), {"p50": 0.5, "p95": 0.95}, F.sum("_n").alias("n"), mean_of_histogram().alias("mean"), stddev_of_histogram().alias("sd"))
    rows = {r.g: r for r in out.collect()}
    assert (rows["a"].p50, rows["a"].n, rows["a"]["mean"]) == (3.5, 8, 3.875) and rows["a"].p95 == pytest.approx(7.95)
    assert rows["a"].sd == pytest.approx(2.748376, abs=1e-5) and rows["b"].p95 == 7 and rows["b"].sd is None


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(max_rows=7)])
@pytest.mark.parametrize("by", [["g"], []])
def test_percentiles_by_selection(spark, by, policy):
    """As the engine's own percentile, for groups that are cut and for a global one; NULL is a group."""
    rows = spark.range(3000).selectExpr("if(id % 7 = 0, NULL, least(id % 5, 2)) AS g", "if(id % 11 = 0, NULL, (id * 7919) % 431) AS x")
    points = {"p0": 0.0, "p33": 0.33, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    exact = [F.round(F.percentile("x", p), 6).alias(n) for n, p in points.items()]
    want = rows.where("x IS NOT NULL").groupBy(*by).agg(F.count("*").alias("n"), *exact)
    got = percentiles(rows, by, F.col("x"), points, F.sum("_n").alias("n"), policy=policy)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "percentile(" not in got._jdf.queryExecution().toString()
    assert percentiles(rows.where("false"), by, F.col("x"), points, policy=policy).count() == 0
