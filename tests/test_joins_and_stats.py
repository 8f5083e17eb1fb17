import glob
import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.operators import joins, stats
from tidegauge.sources import files
from tidegauge.sources.clustered import drop_clustered, only_keys, open_clustered, write_clustered


def frames(spark, hot):
    """A third of the rows of each side share one key; some keys are on one side only."""
    alerts = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "HOT" if hot else F.concat(F.lit("R"), "id"))
        .otherwise(F.concat(F.lit("R"), (F.col("id") % 50).cast("string"))).alias("resid"),
        F.lit("d").alias("date"), F.lit(1.0).alias("psi"))
    pump = spark.range(60).select(
        F.when(F.col("id") == 0, "HOT").otherwise(F.concat(F.lit("R"), "id")).alias("resid"),
        *[F.lit(c).alias(c) for c in ("pumpType", "purchaseDate", "serviceDate", "vendor")])
    maint = spark.range(240).select(
        F.when(F.col("id") % 3 == 0, "HOT")
        .otherwise(F.concat(F.lit("R"), (F.col("id") % 40).cast("string"))).alias("resid"),
        F.col("id").cast("string").alias("eventDate"), F.lit("t").alias("technician"),
        F.lit("x").alias("description"))
    return alerts, pump, maint


def by_hand(alerts, pump, maint):
    a, p, m = (df.collect() for df in (alerts, pump, maint))
    return sorted(
        (x["resid"], x["date"], x["psi"], y["pumpType"], y["purchaseDate"], y["serviceDate"],
         y["vendor"], z["eventDate"], z["technician"], z["description"])
        for x, y, z in itertools.product(a, p, m) if x["resid"] == y["resid"] == z["resid"])


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("how", ["broadcast", "spread"])
def test_alert_maintenance(spark, hot, how):
    sides = frames(spark, hot)
    got = joins.alert_maintenance_view(*sides, {"pump": how, "maint": how})
    assert got.columns == joins.VIEW
    assert sorted(tuple(r) for r in got.collect()) == by_hand(*sides)


def test_hot_key_is_spread(spark):
    alerts, _, maint = frames(spark, True)
    counts = [joins.key_counts(df, "resid") for df in (alerts, maint)]
    found = {k: (ls, rs) for k, ls, rs in joins.hot_keys(*counts, "resid", 64)[1]}
    assert found["HOT"][0] * found["HOT"][1] >= 64 / 3 and len(found) <= 3 * 64
    assert min(found["HOT"]) > 1  # hot on both sides, so both are dealt
    copies = joins.spread_join(alerts, maint, "resid", 64).groupBy("resid").count()
    expected = alerts.join(maint, "resid").groupBy("resid").count()
    assert sorted(map(tuple, copies.collect())) == sorted(map(tuple, expected.collect()))


def test_null_and_empty_sides(spark):
    alerts, _, maint = frames(spark, True)
    nulls = alerts.withColumn("resid", F.lit(None).cast("string"))
    assert joins.spread_join(nulls, maint, "resid").count() == 0
    assert joins.spread_join(alerts, maint.limit(0), "resid").count() == 0


def test_broadcast_only_below_the_limit(spark):
    _, pump, maint = frames(spark, False)
    assert joins.fits_broadcast(maint) and not joins.fits_broadcast(maint, 1000)
    assert joins.join_strategy(pump, maint, 10000) == {"pump": "broadcast", "maint": "spread"}
    big = spark.range(10 ** 6).select(F.expr("repeat('x', 200)").alias("resid"))
    assert not joins.fits_broadcast(big)


def test_small_device_tables_leave_alerts_unshuffled(spark):
    view = joins.alert_maintenance_view(*frames(spark, False))
    view.collect()
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The executed plan without the one that adaptive execution began with."""
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture
def devices(spark):
    made = []

    def make(pump, maint, buckets=8):
        made.append(joins.DeviceTables(pump, maint, buckets))
        return made[-1]

    yield make
    for tables in made:
        tables.drop()


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("most,limit", [(joins.KEYS, joins.BROADCAST_BYTES), (10, 10), (1000, 10)])
def test_device_tables_give_the_same_view(spark, devices, hot, most, limit):
    sides = frames(spark, hot)
    got = devices(*sides[1:]).view(sides[0], most, limit)
    assert got.columns == joins.VIEW
    assert sorted(tuple(r) for r in got.collect()) == by_hand(*sides)


def test_a_batch_of_few_devices_reads_their_buckets(spark, devices):
    alerts, pump, maint = frames(spark, False)
    some = alerts.filter("resid in ('R1', 'R2')")
    plan = final_plan(devices(pump, maint).view(some))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    empty = devices(pump, maint).view(alerts.filter("resid is null"))
    assert empty.count() == 0


def test_files_of_other_buckets_are_not_opened(spark, tmp_path):
    _, _, maint = frames(spark, False)
    path = str(tmp_path / "maint")
    name = write_clustered(maint, "resid", 16, path=path)
    table = spark.table(name)
    some = only_keys(table, "resid", ["R1", "R2"])
    rows = sorted(map(tuple, some.collect()))
    own = {r[0] for r in some.select("_metadata.file_name").distinct().collect()}
    others = [f for f in glob.glob(f"{path}/*.parquet") if f.rsplit("/", 1)[1] not in own]
    assert others
    for f in others:
        with open(f, "r+b") as out:  # whoever opens it fails
            out.write(bytes(8))
            out.seek(-8, 2)
            out.write(bytes(8))
    assert sorted(map(tuple, only_keys(spark.table(name), "resid", ["R1", "R2"]).collect())) == rows
    with pytest.raises(Exception):
        table.count()
    drop_clustered(spark, name)


def test_a_batch_of_many_devices_does_not_shuffle_the_tables(spark, devices):
    _, pump, maint = frames(spark, False)
    alerts = spark.range(400).select(F.concat(F.lit("R"), F.col("id") % 60).alias("resid"),
                                     F.lit("d").alias("date"), F.lit(1.0).alias("psi"))
    tables = devices(pump, maint)
    plan = final_plan(tables._joined(alerts, *tables.tables(spark)[:2]))
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 1  # the alerts
    assert plan.count("Bucketed: true") == 2


def test_tables_are_registered_again(spark, tmp_path):
    _, pump, _ = frames(spark, False)
    path = str(tmp_path / "pump")
    name = write_clustered(pump, "resid", 4, path=path)
    rows = sorted(map(tuple, spark.table(name).collect()))
    spark.sql(f"DROP TABLE {name}")
    name = open_clustered(spark, pump.schema, "resid", 4, path)
    assert sorted(map(tuple, spark.table(name).collect())) == rows
    assert "Exchange" not in final_plan(spark.table(name).groupBy("resid").count())
    drop_clustered(spark, name)
    assert not files.exists(spark, path)


def test_counts_leave_no_scratch_tables(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    view = joins.alert_maintenance_view(*frames(spark, True), {"pump": "spread", "maint": "spread"})
    assert view.count() and set(os.listdir(folder)) == before


@pytest.fixture
def rows(spark):
    data = [("R1", "2024-01-01", f"00:00:0{s}", 1.0, 2.0, 3.0, 4.0, float(s), 6.0)
            for s in (0, 1, 5)]
    return spark.createDataFrame(data, schemas.SENSOR)


def test_stats(rows):
    df = stats.sensor_stats(rows)
    assert df.columns == ["resid", "date"] + [
        p + m for m in schemas.METRICS for p in ("max", "min", "avg")]
    row = df.first()
    assert (row["maxpsi"], row["minpsi"], row["avgpsi"], row["avghz"]) == (5.0, 0.0, 2.0, 1.0)


def test_counts_leave_out_null(spark, rows):
    null = rows.withColumn("resid", F.lit(None).cast("string")).select(*rows.columns)
    got = {r["resid"]: r["total"] for r in stats.sensor_counts(rows.unionByName(null)).collect()}
    assert got == {"R1": 3, None: 0}


def test_windows(rows):
    got = {str(r["w_start"])[11:]: (r["total"], r["maxpsi"])
           for r in stats.windowed_report(rows).collect()}
    assert got == {"23:59:56": (2, 1.0), "23:59:58": (2, 1.0), "00:00:00": (3, 5.0),
                   "00:00:02": (1, 5.0), "00:00:04": (1, 5.0)}
    apart = stats.windowed_counts(rows).join(stats.windowed_stats(rows), ["w_start", *stats.BY])
    assert sorted(map(tuple, apart.collect())) == \
        sorted(map(tuple, stats.windowed_report(rows).collect()))


def test_processing_time_windows(rows):
    got = stats.windowed_counts(rows, time="processing").collect()
    assert len(got) == 3 and {r["total"] for r in got} == {3}


def test_windows_are_made_of_panes(spark, rows):
    report = stats.windowed_report(rows, length="7 seconds", slide="2 seconds")
    lines = [x.strip(" :+-*()0123456789") for x in final_plan(report).splitlines()]
    kinds = [x.split(" ")[0].split("(")[0] for x in lines]
    assert "HashAggregate" in kinds[kinds.index("Expand"):]  # below the Expand: it sees panes
    assert stats.pane_length("7 seconds", "2 seconds") == "1000 milliseconds"
    plain = rows.withColumn("_at", stats.event_time()).groupBy(
        F.window("_at", "7 seconds", "2 seconds").alias("w"), *stats.BY).agg(
        F.count("resid"), F.max("psi"), F.min("psi"), F.avg("psi"))
    assert sorted(map(tuple, report.collect())) == sorted(
        (r["w"]["start"], *r[1:]) for r in plain.collect())


def test_windows_of_null_metrics(spark, rows):
    null = rows.withColumn("psi", F.lit(None).cast("double")).select(*rows.columns)
    assert {(r["total"], r["avgpsi"]) for r in stats.windowed_report(null).collect()} == {
        (1, None), (2, None), (3, None)}
