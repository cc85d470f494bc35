import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings as checks
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS
from orderlens.operators import blocks, drift, evaluation
from orderlens.plans import monitoring
from orderlens.registry.inputs import SETTINGS

SETTINGS_1 = DEFAULTS.but(watched=("x",))


def frame(spark, reference, current):
    rows = [("reference", float(v)) for v in reference] + [("current", float(v)) for v in current]
    return spark.createDataFrame(rows, "period string, x double")


def measured(spark, reference, current):
    return drift.distances(drift.value_counts(frame(spark, reference, current), ("x",))).first()


def by_hand(reference, current):
    """From the published definitions, on raw values."""
    ref, cur = np.sort(reference), np.sort(current)
    points = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(ref, points, "right") / len(ref)
    g = np.searchsorted(cur, points, "right") / len(cur)
    norm = max(ref.std(), 0.001)
    p = np.array([(ref == v).mean() for v in points])
    q = np.array([(cur == v).mean() for v in points])
    m = (p + q) / 2
    kl = lambda a: np.sum(a[a > 0] * np.log(a[a > 0] / m[a > 0]))
    return {
        "wasserstein": np.sum(np.abs(f - g)[:-1] * np.diff(points)) / norm,
        "ks": np.abs(f - g).max(),
        "jensen_shannon": np.sqrt(max((kl(p) + kl(q)) / 2, 0)),
    }


@checks(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 100_000_00), min_size=1, max_size=25),
    st.lists(st.integers(0, 100_000_00), min_size=1, max_size=25),
)
def test_distances_match_their_definitions(spark, reference, current):
    reference, current = np.array(reference) / 100, np.array(current) / 100
    got, want = measured(spark, reference, current), by_hand(reference, current)
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-5, abs=2e-6), name


def test_values_across_block_edges(spark):
    reference = [0.0, 99.99, 100.0, 100.01, 200.0, 5000.0]
    current = [99.99, 99.99, 300.0, 4999.99]
    got, want = measured(spark, reference, current), by_hand(reference, current)
    assert got.wasserstein == pytest.approx(want["wasserstein"], abs=1e-6)
    assert got.ks == pytest.approx(want["ks"], abs=1e-6)


def test_many_blocks_wherever_the_values_lie(spark):
    """Blocks hold about as many values each, also where nearly all values lie close together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = np.random.default_rng(4)
    reference, current = rng.random(3000) * 1e-5, np.append(rng.random(2990) * 1.1e-5, rng.random(10) * 1e6)
    got, want = measured(spark, reference, current), by_hand(reference, current)
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-5, abs=2e-6), name
    counts = drift.value_counts(frame(spark, reference, current), ("x",))
    sizes = [r["count"] for r in blocks.in_blocks(counts, "column_name", "value").groupBy("block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8


def sketched(spark, reference, current, **more):
    states = drift.sketches(frame(spark, reference, current), ("x",), **more)
    return drift.sketched_distances(states).first()


def test_sketched_distances_are_near_the_exact_ones(spark):
    rng = np.random.default_rng(6)
    reference, current = rng.normal(50, 10, 60_000), np.append(rng.normal(52, 11, 59_000), rng.random(1000) * 1000)
    got, want = sketched(spark, reference, current, k=2000), by_hand(reference, current)
    assert (got.total_ref, got.total_cur) == (60_000, 60_000)
    assert got.n_values == pytest.approx(120_000, rel=0.05)
    assert got.ks == pytest.approx(want["ks"], abs=0.004)
    assert got.wasserstein == pytest.approx(want["wasserstein"], abs=0.15 * want["wasserstein"])
    few = sketched(spark, [1, 2, 2, 3] * 500, [1, 2, 3, 3] * 500)
    assert few.n_values == 3
    assert few.jensen_shannon == pytest.approx(by_hand([1, 2, 2, 3], [1, 2, 3, 3])["jensen_shannon"], abs=1e-3)


def test_sketches_shuffle_a_bounded_state(spark):
    """A row a task for each column and period leaves the first stage, and no values."""
    rows = spark.range(0, 200_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'reference' WHEN id % 3 = 1 THEN 'current' END AS period", "rand(7) AS x", "CAST(id % 5 AS int) AS y"
    )
    states = drift.sketches(rows, ("x", "y"), k=200)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan
    assert {(r.column_name, r.period, r.n) for r in states.collect()} == {
        (c, p, 66_667) for c in ("x", "y") for p in ("reference", "current")
    }


def test_merged_months_are_the_whole(spark):
    rows = spark.range(3000).selectExpr("IF(id % 2 = 0, 'reference', 'current') AS period", "id % 12 AS month", "CAST(id * id % 1009 AS double) AS x")
    months = drift.sketches(rows, ("x",), by=("month",))
    assert months.count() == 12  # a month of this table has one period
    one = drift.sketched_distances(drift.merged_sketches(months)).first()
    whole = drift.distances(drift.value_counts(rows, ("x",))).first()
    assert (one.total_ref, one.total_cur) == (whole.total_ref, whole.total_cur)
    assert one.n_values == pytest.approx(whole.n_values, rel=0.05)
    assert one.ks == pytest.approx(whole.ks, abs=1e-3) and one.wasserstein == pytest.approx(whole.wasserstein, abs=1e-3)


def test_sketched_drift_of_one_period(spark):
    got = drift.sketched_drift(frame(spark, [1, 2, 3], []), SETTINGS_1).first()
    assert (got.total_ref, got.total_cur, got.ks, got.drifted) == (3, 0, None, False)


def test_same_distribution_is_no_drift(spark):
    got = measured(spark, [1, 2, 2, 3], [1, 2, 2, 3] * 5)
    assert (got.wasserstein, got.ks, got.jensen_shannon, got.psi) == (0.0, 0.0, 0.0, 0.0)


def test_psi_by_hand(spark):
    got = measured(spark, [0] * 8 + [9] * 2, [0] * 5 + [9] * 5)
    assert got.psi == pytest.approx((0.5 - 0.8) * np.log(0.5 / 0.8) + (0.5 - 0.2) * np.log(0.5 / 0.2), abs=1e-6)


def test_one_empty_period_is_unknown_not_drifted(spark):
    rows = frame(spark, [1, 2, 3], [])
    got = drift.column_drift(rows, SETTINGS_1).first()
    assert got.wasserstein is None and got.drifted is False


def test_nulls_are_left_out(spark):
    rows = spark.createDataFrame([("reference", 1.0), ("reference", None), ("current", 1.0)], "period string, x double")
    got = drift.value_counts(rows, ("x",)).collect()
    assert [(r.value, r.n_ref, r.n_cur) for r in got] == [(1.0, 1, 1)]


def test_few_values_are_compared_as_categories(spark):
    few = drift.column_drift(frame(spark, [1, 2, 3, 4, 5], [1, 1, 1, 1, 5]), SETTINGS_1).first()
    assert (few.method, few.score, few.drifted) == ("jensen_shannon", few.jensen_shannon, True)
    many = drift.column_drift(frame(spark, range(6), range(6)), SETTINGS_1).first()
    assert (many.method, many.drifted) == ("wasserstein", False)


JUDGED = "column_name string, drifted boolean"


@pytest.mark.parametrize(
    "drifted, columns, detected, passed",
    [(0, 7, False, [True, True, True]), (2, 7, False, [True, True, True]), (3, 7, False, [False, False, False]),
     (2, 4, True, [True, False, False]), (4, 7, True, [False, False, False])],
)
def test_dataset_and_tests(table, drifted, columns, detected, passed):
    judged = table(JUDGED, *[(str(i), i < drifted) for i in range(columns)])
    dataset = drift.dataset_drift(judged)
    assert dataset.first().drift_detected is detected
    assert [r.passed for r in drift.drift_tests(dataset).collect()] == passed


def test_no_columns(table):
    got = drift.dataset_drift(table(JUDGED, ("a", True)).limit(0)).first()
    assert (got.n_columns, got.share_drifted, got.drift_detected) == (0, 0.0, False)


@pytest.mark.parametrize("recall, act", [(0.64, True), (0.66, False)])
def test_summary(table, recall, act):
    dataset = drift.dataset_drift(table(JUDGED, ("a", False), ("b", False)))
    periods = table("period string, precision double, recall double", ("reference", 0.1, 0.1), ("current", 0.7, recall))
    got = drift.monitoring_summary(dataset, periods).first()
    assert (got.reference_period, got.current_period) == ("2016-2017", "2018")
    assert got.data_drift.status == "Stable" and got.tests.status == "OK"
    assert got.model_performance.recall == recall and got.action_required is act
    assert got.model_performance.status == ("DEGRADATION" if act else "Acceptable")


def test_summary_without_current_rows(table):
    dataset = drift.dataset_drift(table(JUDGED, ("a", False)))
    none = table("period string, precision double, recall double", ("reference", 0.1, 0.1))
    got = drift.monitoring_summary(dataset, none).first()
    assert got.model_performance.recall == 0.0 and got.action_required is True


def test_monitoring_counts_outcomes_like_the_rows(scored):
    reports = monitoring.run_monitoring(scored, SETTINGS)
    marked = drift.with_period(scored, SETTINGS).withColumn(
        "prediction", (F.col("probability") >= SETTINGS.decision_threshold).cast("int")
    )
    direct = evaluation.classification_by_period(marked)
    assert sorted(map(repr, reports["by_period"].collect())) == sorted(map(repr, direct.collect()))
    assert reports["columns"].count() == 7
    assert reports["columns"].exceptAll(drift.column_drift(marked, SETTINGS)).count() == 0


def test_periods_follow_the_settings(scored):
    got = {(r.period, r.purchase_year) for r in drift.with_period(scored, SETTINGS).collect()}
    assert {y for p, y in got if p == "reference"} == {1995, 1996, 1997}
    assert {y for p, y in got if p == "current"} <= {1998, 1999, 2000, 2001}
