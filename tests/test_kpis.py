import pytest
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS
from orderlens.operators import kpis, reporting, silver as silver_ops
from orderlens.registry.inputs import SETTINGS


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_rank_keeps_ties_at_the_boundary(table):
    sellers = table("seller string, total_orders bigint", ("a", 9), ("b", 5), ("c", 5), ("d", 5), ("e", 1))
    got = {r.seller: r.seller_rank for r in kpis.rank_topn(sellers, "total_orders", 2, "seller_rank").collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 2}


def test_rank_when_everyone_ties(spark):
    sellers = spark.range(5000).selectExpr("id AS seller", "1L AS total_orders")
    got = kpis.rank_topn(sellers, "total_orders", 50, "seller_rank")
    assert got.agg(F.count("*"), F.max("seller_rank")).first() == (5000, 1)


def test_rank_equals_spark_rank(spark):
    from pyspark.sql import Window

    sellers = spark.range(700).selectExpr("id AS seller", "id * id % 41 AS total_orders")
    mine = kpis.rank_topn(sellers, "total_orders", 50, "r")
    plain = sellers.withColumn("r", F.rank().over(Window.orderBy(F.desc("total_orders")))).where("r <= 50")
    assert as_set(mine) == as_set(plain)


def test_min_support_boundary(table):
    groups = table("g string, total_orders bigint", ("a", 29), ("b", 30))
    assert [r.g for r in kpis.min_support(groups, 30).collect()] == ["b"]


def test_percent_rounds_half_up_exactly(table):
    from orderlens.functions.measures import percent

    got = table("late bigint, total bigint", (1, 3), (1, 800), (201, 20000), (0, 5), (0, 0)).select(
        percent("late", "total")
    )
    assert [r[0] for r in got.collect()] == [33.33, 0.13, 1.01, 0.0, None]


def test_every_table_adds_up_to_silver(silver):
    n, late = silver.agg(F.count("*"), F.sum(F.col("is_late").cast("int"))).first()
    for spec in (kpis.BY_STATE, kpis.BY_CATEGORY, kpis.BY_SELLER, kpis.BY_CROSSING, kpis.BY_MONTH, kpis.BY_WEEKDAY):
        assert spec(silver).agg(F.sum("total_orders"), F.sum("late_orders")).first() == (n, late)


def test_dashboard_agrees_with_quality_report(silver):
    board = reporting.executive_dashboard(kpis.monthly_trend(silver)).first()
    report = silver_ops.quality_report(silver).first()
    assert board.total_orders == report.total_orders
    assert board.global_late_rate_pct == pytest.approx(report.late_share * 100, abs=0.01)


def test_dashboard_on_no_orders(silver):
    board = reporting.executive_dashboard(kpis.monthly_trend(silver.limit(0))).first()
    assert (board.total_orders, board.total_late_orders) == (0, 0)
    assert board.global_late_rate_pct is None and board.avg_review_score is None


def test_averages_ignore_nulls_and_null_keys_group(table):
    rows = table(
        "customer_state string, is_late boolean, delivery_days int, review_score int",
        ("SP", True, 10, None),
        ("SP", False, 20, 4),
        (None, False, 5, None),
    )
    got = {r.customer_state: tuple(r)[1:] for r in kpis.late_rate_by_state(rows).collect()}
    assert got == {"SP": (2, 1, 15.0, 4.0, 50.0), None: (1, 0, 5.0, None, 0.0)}


def test_bad_reviews_count_reviewed_orders_only(table):
    rows = table("is_late boolean, review_score int", (True, 1), (True, 3), (True, None), (False, 2))
    got = {r.is_late: (r.total_orders, r.avg_review_score, r.bad_reviews, r.bad_review_rate_pct)
           for r in kpis.delay_review_impact(rows).collect()}
    assert got == {True: (2, 2.0, 1, 50.0), False: (1, 2.0, 1, 100.0)}


def test_one_pass_equals_separate_tables(silver):
    separate, together = kpis.gold_tables(silver, SETTINGS), kpis.gold_in_one_pass(silver, SETTINGS)
    assert list(separate) == list(together)
    for name in separate:
        assert separate[name].columns == together[name].columns, name
        assert as_set(separate[name]) == as_set(together[name]), name


def test_presentation_order(silver):
    rates = [r.late_rate_pct for r in kpis.present(kpis.late_rate_by_state(silver), "late_rate_by_state").collect()]
    assert rates == sorted(rates, reverse=True)
    months = [(r.purchase_year, r.purchase_month) for r in kpis.present(kpis.monthly_trend(silver), "monthly_trend").collect()]
    assert months == sorted(months)


def test_reliable_sellers_need_volume(table):
    sellers = table(
        "main_seller_id string, seller_state string, total_orders bigint, late_rate_pct double, avg_review_score double",
        ("few", "SP", 49, 0.0, 5.0),
        ("good", "SP", 50, 1.0, 4.0),
        ("poor", "SP", 90, 9.0, 3.0),
    )
    assert [r.main_seller_id for r in reporting.reliable_sellers(sellers, DEFAULTS).collect()] == ["good", "poor"]


def test_views_answer_sql(spark, silver):
    reporting.register_views(kpis.gold_tables(silver, SETTINGS), SETTINGS)
    assert spark.sql("SELECT total_orders FROM v_executive_dashboard").first()[0] == silver.count()
    assert spark.sql("SELECT * FROM v_top_risk_states").count() == 10


def test_shift_without_reference_orders_is_null(inputs):
    from orderlens.operators.kpis import late_rate_shift

    got = late_rate_shift(inputs["orders"], SETTINGS.but(reference_years=(1900, 1901))).first()
    assert got.reference_rate_pct is None and got.shift_points is None and got.relative_change_pct is None
    assert got.current_rate_pct is not None
