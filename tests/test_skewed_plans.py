"""Every plan must give the same rows when almost every key counts as hot."""

import pytest
from pyspark.sql import functions as F

from courierflow.operators import quality
from courierflow.operators.skew import SkewPolicy
from courierflow.plans import dispatch, kitchen, orders, payments, supply, trips
from courierflow.registry import AS_OF_S, MAX_KMPH, STILL_KM, STILL_STEPS

TINY = SkewPolicy(max_rows=6, salts=3)

PLANS = {
    "utilization": lambda v, p: supply.utilization(v.dp_status, p),
    "utilization_hourly": lambda v, p: supply.utilization_hourly(v.dp_status, policy=p),
    "zone_ratio": lambda v, p: supply.supply_demand_ratio(v.dp_status, v.order_lifecycle, policy=p),
    "illegal_dp": lambda v, p: supply.illegal_partner_moves(v.dp_status, policy=p),
    "illegal_order": lambda v, p: orders.illegal_order_moves(v.order_lifecycle, p),
    "cancellations": lambda v, p: orders.cancellations(v.order_lifecycle, p),
    "eta_estimate": lambda v, p: orders.eta_estimate(v.order_lifecycle, v.restaurants, v.zones, policy=p),
    "backlog_running": lambda v, p: kitchen.backlog_running(v.order_lifecycle, p),
    "uptime": lambda v, p: kitchen.uptime(v.restaurant_status, p),
    "weight_rank": lambda v, p: kitchen.weight_rank(v.restaurants, p),
    "leg_profile": lambda v, p: trips.leg_profile(v.trip_gps, policy=p),
    "gaps": lambda v, p: trips.gaps(v.gps, 86400, 1.0, p),
    "teleports": lambda v, p: trips.teleports(v.gps, MAX_KMPH, p),
    "standstills": lambda v, p: trips.standstills(v.trip_gps.withColumn("order_id", F.lit(1)), STILL_KM, STILL_STEPS, p),
    "anomalies": lambda v, p: trips.anomalies(v.gps, MAX_KMPH, v.trip_gps, STILL_KM, STILL_STEPS, p),
    "wait_time": lambda v, p: trips.wait_time(v.dp_status, v.order_lifecycle, p),
    "wait_gps": lambda v, p: trips.wait_time_gps(v.trip_gps, v.order_lifecycle, p),
    "detour": lambda v, p: trips.detour(v.trip_gps, v.dispatch, p),
    "gps_orphans": lambda v, p: trips.orphans(v.trip_gps, v.order_lifecycle, p),
    "top_partners": lambda v, p: dispatch.top_partners(v.order_lifecycle, v.restaurants, v.partners, policy=p),
    "orders_per_trip": lambda v, p: dispatch.orders_per_trip(v.dispatch, p),
    "drop_sequence": lambda v, p: dispatch.drop_sequence(
        v.dispatch, v.order_lifecycle, v.restaurants, trips.drop_points(v.trip_gps), p),
    "planned_distance": lambda v, p: dispatch.planned_distance(
        v.dispatch, v.order_lifecycle, v.partners, v.restaurants, trips.drop_points(v.trip_gps), p),
    "batch_events": lambda v, p: dispatch.batch_events(v.dispatch, p),
    "batch_candidates": lambda v, p: dispatch.batch_candidates(crowded(v), waiting(v), p),
    "outages": lambda v, p: payments.outages(v.payment, policy=p),
    "outages_by": lambda v, p: payments.outages(v.payment, ["gateway"], p),
    "payment_orphans": lambda v, p: payments.orphans(v.payment.where("payment_id % 10 <> 1 OR order_id % 5 > 0"), v.order_lifecycle, p),
    "lateness": lambda v, p: quality.lateness_profile(v.arrivals, "event_type", (0, 600, 3600, 7200), p),
    "out_of_order": lambda v, p: quality.out_of_order(v.arrivals, policy=p),
}


def crowded(v):
    """Orders of few restaurants and partners, all on one day, so that candidates are many."""
    return v.order_lifecycle.withColumns(
        {"restaurant_id": F.col("restaurant_id") % 3, "dp_id": F.col("dp_id") % 40, "event_s": F.col("event_s") % 86400 + 1704067200}
    )


def waiting(v):
    return v.dp_status.withColumns(
        {"dp_id": F.col("event_id") % 40, "event_s": F.col("event_s") % 86400 + 1704067200}
    )


def rows_of(df):
    fields = df.schema.fields
    cols = [F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in fields]
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


@pytest.mark.parametrize("name", PLANS)
def test_hot_keys_change_nothing(views, name):
    plain, sliced = rows_of(PLANS[name](views, SkewPolicy())), rows_of(PLANS[name](views, TINY))
    assert len(plain) > 0
    assert plain == sliced


def test_invariants(views):
    share = supply.utilization(views.dp_status).where("utilization NOT BETWEEN 0 AND 1 OR busy_s > online_s")
    assert share.count() == 0
    assert kitchen.backlog_running(views.order_lifecycle).where("backlog < 0").count() == 0
    assert trips.detour(views.trip_gps, views.dispatch).where("avg_detour_ratio < 0").count() == 0
    once = quality.dedup(views.arrivals)
    assert sorted(map(tuple, quality.dedup(once).collect())) == sorted(map(tuple, once.collect()))


def test_batch_candidates_brute_force(views):
    """Against a loop over all pairs of READY orders and other orders."""
    o, s = crowded(views), waiting(views)
    times = [r.asDict() for r in orders.order_times(o).collect()]
    marks = {}
    for r in s.collect():
        marks.setdefault(r.dp_id, []).append((r.event_s, r.event_id, r.status))
    for line in marks.values():
        line.sort()
    loads = {}
    for t in times:
        if t["assigned_s"] is not None and t["dp_id"] is not None:
            end = min([x for x in (t["delivered_s"], t["cancelled_s"]) if x is not None], default=2**62)
            loads.setdefault(t["dp_id"], []).append((t["assigned_s"], end, t["order_id"], t["restaurant_id"]))
    expected = set()
    for t in times:
        at = t["ready_s"]
        if at is None:
            continue
        for dp, carried in loads.items():
            active = [c for c in carried if c[0] <= at < c[1]]
            status = [m[2] for m in marks.get(dp, []) if m[0] <= at]
            if len(active) == 1 and status and status[-1] == "WAITING_AT_RESTAURANT":
                if active[0][3] == t["restaurant_id"] and active[0][2] != t["order_id"]:
                    expected.add((t["order_id"], active[0][2], dp))
    found = {(r.order_id, r.with_order_id, r.dp_id) for r in dispatch.batch_candidates(o, s).collect()}
    assert found <= expected
    assert {f[0] for f in found} == {e[0] for e in expected} and len(found) == len({f[0] for f in found}) > 20


def test_batch_candidates_with_text_ids(views):
    o, s = crowded(views), waiting(views)
    text = o.withColumns({c: F.concat(F.lit("ID-"), F.col(c).cast("string")) for c in ("order_id", "restaurant_id")})
    got = {(r.order_id, r.restaurant_id) for r in dispatch.batch_candidates(text, s).collect()}
    want = {(f"ID-{r.order_id}", f"ID-{r.restaurant_id}") for r in dispatch.batch_candidates(o, s).collect()}
    assert got == want


def test_as_of_views_agree(views):
    """The idle count at a window's end equals the as-of pool at that moment."""
    ratio = supply.supply_demand_ratio(views.dp_status, views.order_lifecycle)
    start = AS_OF_S - AS_OF_S % 3600
    got = {r.zone_id: r.idle_partners for r in ratio.where(F.col("window_s") == start).collect()}
    want = {r.zone_id: r.idle for r in supply.idle_pool(views.dp_status, start + 3600).collect()}
    assert {z: n for z, n in got.items() if n} == {z: n for z, n in want.items() if n} and got


def test_enrichment(views):
    customers = views.table("customer").selectExpr("c_custkey AS customer_id", "c_mktsegment AS segment")
    go = lambda p: rows_of(orders.enriched(views.order_lifecycle, views.zones, views.restaurants, customers, p))
    assert go(SkewPolicy()) == go(TINY)
