"""What Spark makes of the operators: scans, shuffles, and no Python in between."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from orderlens import schemas, session
from orderlens.operators import cleaning, drift, kpis, model, queue, silver as ops
from orderlens.plans import retraining, scoring
from orderlens.registry.inputs import SETTINGS, Inputs
from orderlens.registry.queries import QUICK
from orderlens.sources import incremental, lake, landing


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df) -> str:
    """The detailed plan, whose scan filters and columns are not cut short."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^,]+)#", plan_of(df))


@pytest.fixture(scope="module")
def bronze(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bronze"))
    lake.write_bronze(inputs.tables, folder)
    return folder


@pytest.fixture
def stored(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return {name: lake.read_bronze(spark, bronze, name) for name in schemas.SOURCES}


def test_filters_and_columns_reach_the_scan(stored):
    plan = scans_of(cleaning.clean_orders(stored["orders"]).select("order_id", "is_late"))
    assert "EqualTo(order_status,delivered)" in plan
    assert "customer_id" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    items = scans_of(cleaning.items_by_order(cleaning.clean_items(stored["order_items"])))
    assert "GreaterThan(price,0.0)" in items and "LessThanOrEqual(price,7000.0)" in items


def test_silver_shuffles_each_input_once_per_key(stored):
    """Without any broadcast: one exchange on the order per input, two for the items whose
    distinct sellers need one more, and one per dimension join and side."""
    found = exchanges(ops.build_silver(stored, SETTINGS))
    assert found.count("order_id") == 5
    for key in ("customer_id", "main_seller_id", "main_product_id", "product_category_name"):
        assert found.count(key) == 2, found


def test_unused_inputs_are_not_aggregated(stored):
    """A KPI that shows neither sellers nor amounts does not count distinct sellers."""
    plan = plan_of(kpis.weekday_pattern(ops.build_silver(stored, SETTINGS)))
    assert "distinct" not in plan and "payment_value" not in plan


def test_small_dimensions_are_broadcast_by_size(spark, bronze):
    tables = {name: lake.read_bronze(spark, bronze, name) for name in schemas.SOURCES}
    plan = plan_of(ops.with_sellers(cleaning.items_by_order(tables["order_items"]), tables["sellers"]))
    assert "BroadcastHashJoin [main_seller_id" in plan


def test_no_python_anywhere(stored, scored):
    for df in (
        ops.build_silver(stored, SETTINGS),
        queue.describe_risk(scored),
        queue.priority_policy(scored.selectExpr("order_id", "probability AS risk", "0.5D AS value", "0.5D AS urgency")),
        drift.distances(drift.value_counts(drift.with_period(scored, SETTINGS), SETTINGS.watched)),
    ):
        plan = plan_of(df)
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan


def test_periods_prune_partitions(spark, silver, tmp_path):
    lake.write_silver(silver, f"{tmp_path}/silver")
    rows = lake.read_silver(spark, f"{tmp_path}/silver")
    narrow = SETTINGS.but(reference_years=(1995, 1995), current_years=(1996, 1996))
    plan = plan_of(drift.with_period(rows, narrow).select("nb_items", "period"))
    assert re.search(r"PartitionFilters: \[[^\]]*purchase_year", plan)
    assert re.search(r"ReadSchema: struct<nb_items:bigint>", plan)


def test_rank_window_sees_only_the_top_levels(spark):
    sellers = spark.range(100_000).selectExpr("id AS seller", "id % 977 AS total_orders")
    plan = plan_of(kpis.rank_topn(sellers, "total_orders", 50, "r"))
    assert "TakeOrderedAndProject(limit=50" in plan and "BroadcastHashJoin" in plan


def test_drift_counts_before_the_shuffle(scored):
    plan = plan_of(drift.value_counts(drift.with_period(scored, SETTINGS), SETTINGS.watched))
    assert re.search(r"HashAggregate\(keys=\[column_name#\d+, [^\n]*value#\d+[^\n]*\], functions=\[partial_sum", plan)
    assert len(re.findall("Exchange", plan)) == 1


def test_drift_windows_are_split_by_block(spark):
    counts = spark.range(10).selectExpr("CAST(id % 2 AS string) AS column_name", "id AS value", "1L AS n_ref", "1L AS n_cur")
    plan = plan_of(drift.distances(counts))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert windows and all("column_name" in w for w in windows)


def test_new_rows_push_the_mark_into_the_scan(stored):
    source = stored["orders"]
    plan = plan_of(incremental.new_rows(source, source))
    assert re.search(r"DataFilters: \[[^\n]*order_purchase_timestamp#\d+ >= ", plan)


def test_pruned_read(spark, bronze):
    plan = plan_of(landing.read_pruned(spark, f"{bronze}/payments", ["order_id", "payment_value"]))
    assert "ReadSchema: struct<order_id:string,payment_value:double>" in plan


def test_hot_month_is_split_on_write(spark, tmp_path):
    """A month holding most rows is spread over several files once it outgrows the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    rows = spark.range(60_000).selectExpr(
        "uuid() AS order_id",
        "CASE WHEN id % 10 < 8 THEN 2018 ELSE 2017 END AS purchase_year",
        "CASE WHEN id % 10 < 8 THEN 11 ELSE int(id % 12) + 1 END AS purchase_month",
    )
    lake.write_silver(rows, f"{tmp_path}/s")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list((tmp_path / "s").glob("v*/purchase_year=2018/purchase_month=11/*.parquet"))
    assert len(hot) > 4
    assert lake.read_table(spark, f"{tmp_path}/s").count() == 60_000


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the facts on one key: AQE reads its partition in pieces, and loses nothing."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    small = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 200_000, 1, 16).selectExpr(
            "CAST(id AS string) AS order_id",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 5000 AS string) END AS main_seller_id",
        )
        sellers = spark.range(5000).selectExpr(
            "CASE WHEN id = 0 THEN 'hot' ELSE CAST(id AS string) END AS seller_id", "'SP' AS seller_state", "'x' AS seller_city"
        )
        joined = ops.with_sellers(facts, sellers).groupBy("seller_state").agg(F.count("*").alias("n"))
        assert {r.seller_state: r.n for r in joined.collect()}["SP"] > 199_900 - 40
        assert "skew=true" in plan_of(joined)
    finally:
        for key in small:
            spark.conf.unset(key)


def test_shuffles_start_with_enough_partitions(spark, bronze):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.size_shuffles(spark, bronze)
    assert spark.conf.get(key, None) is None
    session.size_shuffles(spark, bronze, bytes_each=1000)
    assert int(spark.conf.get(key)) > 77
    # What a large input asked for does not stay for a small one.
    session.size_shuffles(spark, f"{bronze}/sellers")
    assert spark.conf.get(key, None) is None


def test_a_weighted_preset_finds_late_orders(spark):
    """The gate's own code, weight and cut-off of the preset: recall is above zero on a small base rate."""
    small = dataclasses.replace(model.MONTHLY, trees=5)
    larger = Inputs(spark, "/root/testdata/sf0.01").silver
    report = retraining.train_and_evaluate(larger, small, SETTINGS).report.first()
    assert report.recall > 0 and report.decision_threshold == 0.5


def test_monthly_job_writes_every_layer(spark, inputs, tmp_path):
    home = str(tmp_path)
    lake.write_bronze(inputs.tables, f"{home}/bronze")
    run = retraining.monthly_job(spark, home, QUICK, SETTINGS.but(min_precision=0.0, min_recall=0.0))
    assert run.quality.first().total_orders == 262
    assert set(run.gold) == set(schemas.CONTRACTS)
    assert run.training.report.first().decision == "deploy_model"
    assert (tmp_path / "models/late_delivery/metadata").exists()
    summary = spark.read.json(f"{home}/reports/monitoring").first()
    assert summary.reference_period == "1995-1997" and summary.generated_at
    assert spark.read.json(f"{home}/reports/feature_importance").count() == 9
    # The queue is scored by the model the job saved, and monitoring sees only rows kept from the other one.
    saved = model.load(f"{home}/models/order_queue")
    assert scoring.order_queue(saved, inputs.tables, SETTINGS).count() == SETTINGS.queue_length
    tested = run.training.predicted_test.count()
    assert 0 < sum(r.n_rows for r in run.monitoring["by_period"].collect()) <= tested


def test_jobs_as_commands(spark, inputs, tmp_path, capsys):
    from orderlens import __main__ as commands

    home = str(tmp_path)
    lake.write_bronze(inputs.tables, f"{home}/bronze")
    commands.main(["refine", home])
    assert "total_orders" in capsys.readouterr().out
    commands.main(["publish", home])
    assert "monthly_trend" in capsys.readouterr().out
    given = commands.parser().parse_args(["export", home, "--width", "customer_state=25"])
    assert (given.database, given.width) == ("analytics", ["customer_state=25"])
