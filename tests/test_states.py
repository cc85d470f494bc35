"""KPI states by month, tables stored by order, calibration bands of equal count."""

import math

import pytest
from pyspark.sql import functions as F

from orderlens.operators import evaluation, kpis, silver as silver_step
from orderlens.plans import medallion
from orderlens.registry.inputs import SETTINGS
from orderlens.session import staged
from orderlens.sources import lake

SILVER = "silver/orders_consolidated"


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_states_after_a_late_correction(spark, silver, tmp_path):
    undated = silver.limit(7).withColumns({"purchase_year": F.lit(None).cast("int"), "purchase_month": F.lit(None).cast("int")})
    silver = staged(silver.withColumn("purchase_year", F.col("purchase_year").cast("int"))
                    .withColumn("purchase_month", F.col("purchase_month").cast("int")).unionByName(undated))
    late = (F.col("purchase_year") == 1996) & (F.col("purchase_month") == 3)
    lake.write_silver(silver.where(~late | (F.col("total_price") > 100) | late.isNull()), f"{tmp_path}/{SILVER}")
    medallion.publish_months(spark, str(tmp_path), settings=SETTINGS)
    lake.write_silver(silver, f"{tmp_path}/{SILVER}")
    by_months = medallion.publish_months(spark, str(tmp_path), [(1996, 3), (None, None)], SETTINGS)
    whole = kpis.gold_in_one_pass(lake.read_silver(spark, f"{tmp_path}/{SILVER}"), SETTINGS)
    assert by_months.keys() == whole.keys()
    for name, table in whole.items():
        assert rows_of(by_months[name]) == rows_of(table), name


def test_only_the_changed_month_is_read(spark, silver, tmp_path):
    lake.write_silver(silver, f"{tmp_path}/s")
    rows = lake.read_silver(spark, f"{tmp_path}/s").where(kpis.in_months([(1996, 3)], *medallion.SILVER_MONTH))
    month = tuple(rows.select(*medallion.SILVER_MONTH).distinct().collect())
    assert month == ((1996, 3),)
    read = {f.rsplit("/", 2)[0].split("/", 1)[1] for f in (r[0] for r in rows.select(F.input_file_name()).distinct().collect())}
    assert all(f.endswith("purchase_year=1996") for f in read)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters: [") :].split("PushedFilters")[0]
    assert "purchase_year" in pruned and "purchase_month" in pruned


def test_no_rows(silver):
    gold = kpis.gold_of_states(kpis.month_states(silver.limit(0), SETTINGS), SETTINGS)
    assert all(table.count() == 0 for table in gold.values())


def test_inputs_stored_by_order_are_not_shuffled(spark, inputs, tmp_path):
    tables = {name: inputs[name] for name in medallion.SOURCES}
    bucketed = dict(tables)
    for name in medallion.REPLACED:
        lake.write_bucketed(tables[name], f"{tmp_path}/{name}", "order_id", 4)
        bucketed[name] = lake.read_bucketed(spark, f"{tmp_path}/{name}", "order_id", 4)
    built = silver_step.build_silver(bucketed, SETTINGS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")

    def shuffles_of_inputs(df):
        joined = df._jdf.queryExecution().executedPlan().toString().splitlines()
        return sum("Exchange hashpartitioning(order_id" in line for line in joined)

    assert shuffles_of_inputs(built) <= 1  # the orders
    assert shuffles_of_inputs(silver_step.build_silver(tables, SETTINGS)) > 1
    assert rows_of(built) == rows_of(silver_step.build_silver(tables, SETTINGS))


def test_refine_from_arranged_tables(spark, inputs, tmp_path):
    lake.write_bronze({name: inputs[name] for name in medallion.SOURCES}, f"{tmp_path}/bronze")
    plain = medallion.refine(spark, str(tmp_path), SETTINGS).collect()
    before = rows_of(lake.read_silver(spark, f"{tmp_path}/{SILVER}"))
    medallion.arrange(spark, str(tmp_path), 3)
    medallion.arrange(spark, str(tmp_path), 3)  # replaced, not doubled
    assert medallion.refine(spark, str(tmp_path), SETTINGS, buckets=3).collect() == plain
    assert rows_of(lake.read_silver(spark, f"{tmp_path}/{SILVER}")) == before


def test_failed_bucketed_write_leaves_the_old_table(spark, table, tmp_path):
    lake.write_bucketed(table("k int, v int", (1, 1), (2, 2)), str(tmp_path), "k", 2)
    broken = table("k int, v int", (1, 5)).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        lake.write_bucketed(broken, str(tmp_path), "k", 2)
    assert rows_of(lake.read_bucketed(spark, str(tmp_path), "k", 2)) == ["Row(k=1, v=1)", "Row(k=2, v=2)"]


SCORES = "label int, probability double"


def test_bands_hold_as_many_rows(scored):
    bands = {r.band: r for r in evaluation.calibration_bands(scored).collect()}
    total = scored.count()
    assert sorted(bands) == list(range(10))
    assert sum(r.n_rows for r in bands.values()) == total
    # Equal scores stay together: a few rows more or less.
    assert all(abs(r.n_rows - total / 10) <= 0.01 * total + 1 for r in bands.values())
    ordered = [bands[i] for i in range(10)]
    assert all(a.highest < b.lowest for a, b in zip(ordered, ordered[1:]))


def test_sketched_bands_are_near(scored):
    total = scored.count()
    exact = {r.band: r for r in evaluation.calibration_bands(scored).collect()}
    near = {r.band: r for r in evaluation.sketched_bands(scored).collect()}
    assert exact.keys() == near.keys()
    for band, row in near.items():
        assert abs(row.n_rows - exact[band].n_rows) <= 0.005 * total + 1
        assert math.isclose(row.mean_predicted, exact[band].mean_predicted, abs_tol=0.01)
    assert sum(r.n_rows for r in near.values()) == total


def test_bands_of_ties_nulls_and_nothing(table):
    rows = table(SCORES, *[(i % 2, 0.5) for i in range(9)], (1, 0.9), (1, None))
    got = {r.band: (r.n_rows, r.mean_predicted, r.observed_rate, r.gap) for r in evaluation.calibration_bands(rows).collect()}
    assert got == {0: (9, 0.5, 0.444444, 0.055556), 9: (1, 0.9, 1.0, 0.1)}
    error = evaluation.expected_calibration_error(evaluation.calibration_bands(rows)).first()
    assert error.expected_error == pytest.approx((0.055556 * 9 + 0.1) / 10, abs=1e-6) and error.largest_gap == 0.1
    empty = table(SCORES)
    assert evaluation.calibration_bands(empty).count() == 0 and evaluation.sketched_bands(empty).count() == 0
    assert evaluation.expected_calibration_error(evaluation.calibration_bands(empty)).first().expected_error is None
