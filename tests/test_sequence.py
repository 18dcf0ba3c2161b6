"""Sliced windows must equal plain windows, however small the slices are."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courierflow.operators.sequence import asof_join, latest, running, sweep, windowed
from courierflow.operators.skew import SLICE, SkewPolicy, cut_levels, lookup_join, slice_cuts, sliced

POLICIES = [SkewPolicy(max_rows=5), SkewPolicy(max_rows=40), SkewPolicy(max_rows=40, samples=10), SkewPolicy(max_rows=10**9)]


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows, NULL is a key, times repeat and leave holes."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = 1 if i % 3 == 0 else None if i % 11 == 0 else rng.randint(2, 40)
        t = rng.choice([rng.randint(0, 50), rng.randint(5000, 5100), rng.randint(0, 100_000)])
        data.append((i, key, t, rng.choice([None, rng.randint(-9, 9)]), rng.choice("abc")))
    return spark.createDataFrame(data, "id long, k long, t long, x long, s string").repartition(5).cache()


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    pick = lambda df: sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
    assert pick(a) == pick(b)


@pytest.mark.parametrize("policy", POLICIES)
def test_windowed_neighbours(rows, policy):
    def stage(w):
        return {"p1": F.lag("x").over(w), "p3": F.lag("s", 3).over(w), "n1": F.lead("t").over(w), "n2": F.lead("id", 2).over(w)}

    got = windowed(rows, ["k"], ["t", "id"], stage, before=3, after=2, policy=policy)
    w = Window.partitionBy("k").orderBy("t", "id")
    same(got, rows.withColumns(stage(w)))


@pytest.mark.parametrize("policy", POLICIES)
def test_windowed_two_stages(rows, policy):
    first = lambda w: {"d": F.col("t") - F.lag("t").over(w)}
    second = lambda w: {"r": F.sum(F.when(F.col("d") > 10, 1)).over(w.rowsBetween(-1, 0)), "nd": F.lead("d").over(w)}
    got = windowed(rows, ["k"], ["t", "id"], first, second, before=2, after=1, policy=policy)
    w = Window.partitionBy("k").orderBy("t", "id")
    same(got, rows.withColumns(first(w)).withColumns(second(w)))


@pytest.mark.parametrize("policy", POLICIES)
def test_running_totals(rows, policy):
    totals = {
        "n": ("sum", F.lit(1)),
        "sx": ("sum", F.col("x")),
        "mx": ("max", F.col("x")),
        "mn": ("min", F.col("x")),
        "lx": ("last", F.col("x")),
        "ls": ("last", F.when(F.col("x") > 0, F.col("s"))),
    }
    got = running(rows, ["k"], ["t", "id"], totals, policy)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumns(
        {
            "n": F.count("*").over(w),
            "sx": F.sum("x").over(w),
            "mx": F.max("x").over(w),
            "mn": F.min("x").over(w),
            "lx": F.last("x", True).over(w),
            "ls": F.last(F.when(F.col("x") > 0, F.col("s")), True).over(w),
        }
    )
    same(got, want)


@pytest.mark.parametrize("policy", POLICIES)
def test_asof(spark, rows, policy):
    probes = rows.select("k", "t", "id").where("id % 2 = 0")
    states = rows.select("k", "t", F.col("id").alias("state_id"), "s").where("id % 2 = 1")
    got = asof_join(probes, states, ["k"], "t", ["state_id", "s"], policy)
    by_key = {}
    for r in states.collect():
        by_key.setdefault(r.k, []).append((r.t, r.state_id, r.s))
    want = []
    for p in probes.collect():
        best = max((x for x in by_key.get(p.k, []) if x[0] <= p.t), default=(None, None, None))
        want.append((p.k, p.t, p.id, *best))
    assert sorted(map(str, (tuple(r) for r in got.select("k", "t", "id", "asof_t", "state_id", "s").collect()))) == sorted(
        map(str, want)
    )


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_join(spark, rows, policy, how):
    lookup = spark.createDataFrame([(1, "one"), (2, "two"), (5, "five"), (5, "five again")], "k long, name string")
    same(lookup_join(rows, lookup, ["k"], how, ["id"], policy), rows.join(lookup, "k", how))


def test_slices_are_bounded(spark):
    """Rows that bunch together in time, or share one time, still end up in small slices."""
    policy = SkewPolicy(max_rows=20)
    bunched = [(1, 1000 + i // 40, i) for i in range(400)]  # ten seconds of a long span
    spread = [(1, 10_000 * i, 1000 + i) for i in range(100)]
    frozen = [(2, 7, i) for i in range(300)]  # one single time
    cold = [(3, i, i) for i in range(20)]
    rows = spark.createDataFrame(bunched + spread + frozen + cold, "k long, t long, id long")
    hot = slice_cuts(rows, ["k"], ["t", "id"], policy)
    assert sorted(r.k for r in hot.collect()) == [1, 2]
    cut = sliced(rows, ["k"], ["t", "id"], hot)
    sizes = cut.groupBy("k", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    assert cut.where(F.col(SLICE).isNull()).count() == 20
    # slices follow the order of the rows
    w = Window.partitionBy("k").orderBy("t", "id")
    turns = cut.withColumn("p", F.lag(SLICE).over(w)).where(F.col("p") > F.col(SLICE))
    assert turns.count() == 0
    same(
        running(rows, ["k"], ["t", "id"], {"n": ("sum", F.lit(1))}, policy),
        rows.withColumn("n", F.row_number().over(w).cast("long")),
    )
    assert slice_cuts(rows, ["k"], ["t", "id"], SkewPolicy(max_rows=10**6)).isEmpty()


def test_latest(rows):
    got = {r.k: r.id for r in latest(rows, ["k"], ["t", "id"]).collect()}
    want = {}
    for r in rows.collect():
        want[r.k] = max(want.get(r.k, (-1, -1)), (r.t, r.id))
    assert got == {k: v[1] for k, v in want.items()}
    assert "WindowGroupLimit" in latest(rows, ["k"], ["t", "id"])._jdf.queryExecution().toString()


@pytest.mark.parametrize("policy", POLICIES)
def test_sweep_mixes_totals_and_neighbours(rows, policy):
    pair = F.struct("x", "id")
    got = sweep(
        rows,
        ["k"],
        ["t", "id"],
        {"best": ("max", pair), "was_best": ("max_before", pair), "n_before": ("sum_before", F.lit(1))},
        [lambda w: {"next_t": F.lead("t").over(w), "prev_x": F.lag("x").over(w)}],
        before=1,
        after=1,
        policy=policy,
    )
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumns(
        {
            "best": F.max(pair).over(upto),
            "was_best": F.max(pair).over(earlier),
            "n_before": F.sum(F.lit(1)).over(earlier),
            "next_t": F.lead("t").over(w),
            "prev_x": F.lag("x").over(w),
        }
    )
    same(got, want)


def test_every_hot_key_is_found(rows):
    """No bound on the number of hot keys leaves one unsplit."""
    policy = SkewPolicy(max_rows=5)
    hot = slice_cuts(rows, ["k"], ["t", "id"], policy)
    assert {r.k for r in hot.collect()} == {r.k for r in rows.groupBy("k").count().where("count > 5").collect()}
    got = running(rows, ["k"], ["t", "id"], {"n": ("sum", F.lit(1))}, policy)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(got, rows.withColumn("n", F.count(F.lit(1)).over(w)))


@pytest.mark.parametrize("policy", POLICIES)
def test_a_text_order_is_cut_too(rows, policy):
    named = rows.withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    w = Window.partitionBy("k").orderBy("name")
    same(running(named, ["k"], ["name"], {"n": ("sum", F.lit(1))}, policy), named.withColumn("n", F.row_number().over(w).cast("long")))


def test_a_sample_cuts_large_keys_evenly(spark):
    """A key with a third of all rows, half of them at one second: slices by the sample stay near their size."""
    rows = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, -1, id % 500) AS k", "if(id % 2 = 0, 7, id) AS t")
    policy = SkewPolicy(max_rows=1000, samples=100)
    hot = slice_cuts(rows, ["k"], ["t", "id"], policy)
    sizes = sliced(rows, ["k"], ["t", "id"], hot).where("k = -1").groupBy(SLICE).count().collect()
    assert [r.k for r in hot.collect()] == [-1] and len(sizes) >= 8 and max(r["count"] for r in sizes) <= 1500


def test_no_job_runs_while_planning(spark, rows):
    """The plan is built without a job, hot keys or not."""
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for policy in POLICIES:
            sweep(rows, ["k"], ["t", "id"], {"n": ("sum", F.lit(1))}, [lambda w: {"p": F.lag("x").over(w)}], 1, 1, policy)
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_row_meets_few_cuts_of_its_key(spark):
    """A key with a thousand cuts is searched in arrays of ten, and rows get the slices they had."""
    rows = spark.range(1001).select((F.col("id") * 0).alias("k"), (F.col("id") * 3).alias("t"), "id")
    hot = slice_cuts(rows, ["k"], ["t", "id"], SkewPolicy(max_rows=1, samples=1))
    assert hot.select(F.size("_cuts")).first()[0] == 1000
    for level in cut_levels(hot):
        assert level.agg(F.max(F.size("_some"))).first()[0] <= 11
    got = {r.id: r[SLICE] for r in sliced(rows, ["k"], ["t", "id"], hot).collect()}
    assert got == {i: i for i in range(1001)}
