"""What the planner must not do at scale, checked on the physical plans."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from courierflow import session
from courierflow.operators.quality import dedup
from courierflow.operators.skew import SkewPolicy, dimension_join
from courierflow.plans import kitchen, orders, payments, supply
from courierflow.registry import QUERIES

BATCH = [n for n, q in QUERIES.items() if not n.startswith("stream_") and n not in {
    "table_health_report", "sink_replay_idempotent", "schema_evolution_union", "partition_pruned_read",
    "clustered_layout_lookup", "ingest_observed_metrics"}]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda v: orders.order_times(v.order_lifecycle.drop("dp_id").withColumn("dp_id", F.lit(1).cast("long"))),
        lambda v: payments.failure_rate(v.payment),
        lambda v: kitchen.backlog_windowed(v.restaurant_status, 3600),
    ],
)
def test_hash_aggregates_combine_on_the_map_side(views, build):
    plan = plan_of(build(views))
    assert "partial_" in plan and "SortAggregate" not in plan


def test_top_one_is_limited_before_the_shuffle(spark, views):
    arrivals, status, events = (df.repartition(3) for df in (views.arrivals, views.dp_status, views.order_lifecycle))
    for df in (dedup(arrivals), supply.partner_state(status), orders.current_orders(events)):
        assert plan_of(df).count("WindowGroupLimit") == 2  # once before, once after the exchange


def test_the_optimizer_decides_on_broadcasts(spark, views):
    facts, path = views.order_lifecycle.select("order_id", "restaurant_id"), session.scratch(spark, "dimension")
    views.restaurants.write.parquet(path)
    known = spark.read.parquet(path)
    small = plan_of(dimension_join(facts, known, ["restaurant_id"]))
    assert "BroadcastHashJoin [restaurant_id" in small and "Exchange hashpartitioning(restaurant_id" not in small
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = dimension_join(facts, known, ["restaurant_id"], policy=SkewPolicy(salts=4))
        assert "SortMergeJoin" in plan_of(large) and "_salt" in plan_of(large) and large.count() == facts.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_columns_and_filters_reach_the_scan(spark, views, tmp_path_factory):
    path = session.scratch(spark, "scan")
    views.payment.write.parquet(path)
    plan = plan_of(payments.failure_rate(spark.read.parquet(path)))
    assert "ReadSchema: struct<attempt_number:bigint,gateway:string,status:string,event_s:bigint>" in plan
    state = session.scratch(spark, "scan")
    views.order_lifecycle.write.parquet(state)
    plan = plan_of(orders.top_zones(spark.read.parquet(state)))
    assert "PushedFilters: [IsNotNull(state), EqualTo(state,PLACED)]" in plan and "struct<zone_id:string,state:string>" in plan


def test_scratch_tables_lie_in_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        def __init__(self, conf):
            self.conf = conf

        def getConf(self):
            return Conf(self.conf)

    class Session:
        def __init__(self, **conf):
            self.sparkContext, self.conf = Context(conf), Conf({"spark.sql.warehouse.dir": "hdfs://warehouse"})

    assert session.shared_root(Session()) == "hdfs://warehouse/scratch"
    there = Session(**{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert session.shared_root(there) == "hdfs://shared/tmp"
    assert session.scratch(there, "x").startswith("hdfs://shared/tmp/x-")


def test_permanent_failures_group_the_payments_once(views):
    """Gateways travel with the chains, instead of a second pass over all payment events and its join."""
    plan = plan_of(payments.permanent_failures(views.payment))
    assert "gateway" in plan and "retry_of_payment_id" not in plan
