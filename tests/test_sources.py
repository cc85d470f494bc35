import gzip
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens import schemas, session
from orderlens.operators import kpis
from orderlens.plans import medallion
from orderlens.registry.inputs import SETTINGS
from orderlens.sources import incremental, lake, landing, warehouse

REVIEWS = '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,ok,"two
lines, and a ""quote""",2018-01-01 00:00:00,2018-01-02 10:00:00
r2,o2,bad,,,2018-01-01 00:00:00,not a time
'''


def test_csv_with_line_breaks_and_bad_cells(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS)
    rows = landing.read_csv_typed(spark, f"{tmp_path}/reviews.csv", schemas.SOURCES["reviews"], multiline=True).collect()
    assert rows[0].review_comment_message == 'two\nlines, and a "quote"'
    assert rows[0].review_answer_timestamp == datetime(2018, 1, 2, 10)
    assert (rows[1].review_id, rows[1].review_score, rows[1].review_answer_timestamp) == ("r2", None, None)


def test_bad_rows_can_be_kept_aside(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS)
    rows = landing.read_csv_typed(
        spark, f"{tmp_path}/reviews.csv", schemas.SOURCES["reviews"], multiline=True, keep_bad=True
    ).collect()
    assert [r[landing.CORRUPT] is not None for r in rows] == [False, True]


def test_gzip_csv_keeps_leading_zeros(spark, tmp_path):
    with gzip.open(tmp_path / "sellers.csv.gz", "wt") as out:
        out.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,sao paulo,SP\n")
    row = landing.read_csv_typed(spark, f"{tmp_path}/*.csv.gz", schemas.SOURCES["sellers"]).first()
    assert row.seller_zip_code_prefix == "01037"


def test_inferred_lookup(spark, tmp_path):
    (tmp_path / "t.csv").write_text("product_category_name,product_category_name_english\nmoveis,furniture\n")
    df = landing.read_csv_inferred(spark, f"{tmp_path}/t.csv")
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]
    assert tuple(df.first()) == ("moveis", "furniture")


@pytest.fixture(scope="module")
def raw(inputs, tmp_path_factory):
    """The eight tables as CSV files, reviews and items gzipped."""
    folder = str(tmp_path_factory.mktemp("raw"))
    for name in schemas.SOURCES:
        writer = inputs[name].write.option("header", True)
        if name in ("reviews", "order_items"):
            writer = writer.option("compression", "gzip")
        writer.csv(f"{folder}/{name}")
    return folder


FILES = {name: name for name in schemas.SOURCES}


def test_ingest_all_with_lineage_and_counts(spark, inputs, raw):
    tables = landing.ingest_all(spark, raw, FILES)
    assert set(tables) == set(schemas.SOURCES)
    for name, df in tables.items():
        assert df.columns == [*schemas.SOURCES[name].names, *schemas.LINEAGE]
    row = tables["orders"].first()
    assert row.source_table == "orders" and row.source_file.endswith(".csv") and row.ingested_at
    counted = {r.table_name: r.n_rows for r in landing.ingest_counts(tables).collect()}
    assert counted.pop("total") == sum(counted.values())
    assert counted == {name: inputs[name].count() for name in schemas.SOURCES}


def test_missing_file_fails_before_anything_is_written(spark, raw):
    with pytest.raises(PySparkException):
        landing.ingest_all(spark, raw, {**FILES, "sellers": "nowhere"})


def test_medallion_from_csv_to_warehouse(spark, inputs, silver, raw, tmp_path):
    home = str(tmp_path)
    counts = medallion.land(spark, raw, home, FILES)
    assert counts["order_items"] == inputs["order_items"].count()
    bronze = lake.read_bronze(spark, f"{home}/bronze", "orders")
    assert bronze.where(F.col("purchase_ym") != F.date_format("order_purchase_timestamp", "yyyy-MM")).count() == 0

    report = medallion.refine(spark, home, SETTINGS).first()
    stored = lake.read_silver(spark, f"{home}/silver/orders_consolidated")
    assert report.total_orders == silver.count()
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, silver.collect()))

    gold = medallion.publish(spark, home, SETTINGS)
    gold = medallion.publish(spark, home, SETTINGS)  # a second run replaces
    direct = kpis.gold_tables(silver, SETTINGS)
    for name, df in gold.items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, direct[name].collect())), name

    for _run in range(2):
        medallion.export(spark, home, "analytics", f"{home}/warehouse", {"customer_state": 25, "seller_state": 25})
    for name, columns in schemas.CONTRACTS.items():
        exported = warehouse.read_warehouse(spark, name)
        assert exported.columns == [*columns, "inserted_at"]
        assert exported.count() == gold[name].count()
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED analytics.monthly_trend").collect()}
    assert described["late_rate_pct"] == "decimal(18,2)" and described["purchase_year"] == "smallint"
    assert "rows" in described["Statistics"]
    medallion.preview(gold["weekday_pattern"], 3)


def test_sync_appends_orders_and_replaces_their_details(spark, inputs, raw, tmp_path):
    home, part = f"{tmp_path}/lake", f"{tmp_path}/raw"
    for name in schemas.SOURCES:
        rows = inputs[name]
        if name == "orders":
            rows = rows.where("order_purchase_timestamp < timestamp '1998-03-05'")
        rows.limit(rows.count() // 2 if name == "payments" else 1 << 30).write.option("header", True).csv(f"{part}/{name}")
    first = medallion.land(spark, part, home, FILES)
    for _run in range(2):
        medallion.sync(spark, raw, home, FILES)
    bronze = lake.read_bronze(spark, f"{home}/bronze", "orders")
    assert first["orders"] < bronze.count() == bronze.select("order_id").distinct().count() == inputs["orders"].count()
    assert first["payments"] < lake.read_bronze(spark, f"{home}/bronze", "payments").count() == inputs["payments"].count()
    assert medallion.refine(spark, home, SETTINGS).first().total_orders == 262


BY_STATE = (
    "customer_state string, total_orders bigint, late_orders bigint, avg_delivery_days double, "
    "avg_review_score double, late_rate_pct double"
)


def test_contract_types_and_wide_numbers(table):
    rows = table(BY_STATE, ("SP", 3_000_000_000, 1, -12.345, 2_000_000.0, 33.33), (None, 1, 0, None, 4.0, 0.0))
    fitted = warehouse.apply_contract(rows, "late_rate_by_state", widths={"customer_state": 10})
    got = {r.customer_state: r for r in fitted.collect()}
    assert got["SP"].total_orders == 3_000_000_000
    assert got["SP"].avg_delivery_days == Decimal("-12.35")  # halves away from zero
    assert got["SP"].avg_review_score == Decimal("2000000.00")
    assert got["unknown"].avg_delivery_days is None and got["SP"].inserted_at is not None
    assert [f.dataType.simpleString() for f in fitted.schema] == [
        "string", "bigint", "bigint", "decimal(18,2)", "decimal(18,2)", "decimal(18,2)", "timestamp",
    ]


def test_contract_refuses_what_does_not_fit(table):
    wide = table(BY_STATE, ("ARGENTINA", 1, 0, 1.0, 1.0, 1.0))
    with pytest.raises(PySparkException, match="customer_state does not fit"):
        warehouse.apply_contract(wide, "late_rate_by_state").collect()
    huge = table(BY_STATE, ("SP", 1, 0, 1e17, 1.0, 1.0))
    with pytest.raises(PySparkException, match="avg_delivery_days does not fit"):
        warehouse.apply_contract(huge, "late_rate_by_state").collect()


def test_contract_refuses_missing_required_numbers(table):
    rows = table(
        "purchase_weekday int, total_orders bigint, late_orders bigint, avg_delivery_days double, late_rate_pct double",
        (1, None, 0, 1.0, 0.0),
    )
    with pytest.raises(PySparkException, match="total_orders does not fit bigint: null"):
        warehouse.apply_contract(rows, "weekday_pattern").collect()


def test_export_keeps_the_definition(spark, table, tmp_path):
    for n in (1, 2):
        rows = table(BY_STATE, *[(f"S{i}", i + 1, 0, 1.0, 1.0, 1.0) for i in range(n)])
        warehouse.export_table(rows, "late_rate_by_state", "kept", str(tmp_path))
        assert spark.table("kept.late_rate_by_state").count() == n
    ddl = spark.sql("SHOW CREATE TABLE kept.late_rate_by_state").first()[0]
    assert "VARCHAR(2)" in ddl and "BIGINT" in ddl
    spark.sql("DROP DATABASE kept CASCADE")


ORDERS = "order_id string, order_purchase_timestamp timestamp"


def test_incremental_append_is_idempotent_and_keeps_late_ties(spark, table, tmp_path):
    path = f"{tmp_path}/orders"
    first = [("a", "2018-01-01 00:00:00"), ("b", "2018-01-02 00:00:00")]
    incremental.append_new(spark, table(ORDERS, *first), path)
    later = [*first, ("c", "2018-01-02 00:00:00"), ("d", "2018-01-03 00:00:00"), ("old", "2017-01-01 00:00:00")]
    for _run in range(2):
        incremental.append_new(spark, table(ORDERS, *later), path)
    assert sorted(r.order_id for r in spark.read.parquet(path).collect()) == ["a", "b", "c", "d"]


def ids(spark, path):
    return sorted(r.order_id for r in spark.read.parquet(path).select("order_id").collect())


def test_orders_without_a_date_are_kept_and_kept_once(spark, table, tmp_path):
    path = f"{tmp_path}/orders"
    first = [("a", "2018-01-01 00:00:00"), ("x", None)]
    incremental.append_new(spark, table(ORDERS, *first), path)
    later = [*first, ("y", None), ("b", "2018-01-05 00:00:00")]
    for _run in range(3):
        incremental.append_new(spark, table(ORDERS, *later), path)
    assert ids(spark, path) == ["a", "b", "x", "y"]


def test_a_month_spelt_in_words_does_not_move_the_mark(spark, table, tmp_path):
    path = f"{tmp_path}/orders"
    table(f"{ORDERS}, purchase_ym string", ("a", "2018-01-01 00:00:00", "2018-01"), ("x", None, "unknown")).write.partitionBy(
        "purchase_ym"
    ).parquet(path)
    incremental.append_new(spark, table(ORDERS, ("old", "2017-01-01 00:00:00"), ("a", "2018-01-01 00:00:00"), ("x", None)), path)
    assert ids(spark, path) == ["a", "x"]


def test_missing_orders_come_in_whatever_their_date(spark, table, tmp_path):
    path = f"{tmp_path}/orders"
    incremental.append_new(spark, table(ORDERS, ("b", "2018-01-02 00:00:00")), path)
    for _run in range(2):
        incremental.append_missing(spark, table(ORDERS, ("a", "2017-01-01 00:00:00"), ("b", "2018-01-02 00:00:00"), ("n", None)), path)
    assert ids(spark, path) == ["a", "b", "n"]


def test_incremental_into_an_empty_target(table):
    source = table(ORDERS, ("a", "2018-01-01 00:00:00"))
    assert incremental.new_rows(source, source.limit(0)).count() == 1


def test_full_refresh_replaces(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    for n in (3, 2):
        lake.full_refresh(table("x int", *[(i,) for i in range(n)]), path)
    assert lake.read_table(spark, path).count() == 2


def test_json_artifact(table, tmp_path):
    lake.write_json(table("precision double, n int", (0.5, 3)), f"{tmp_path}/report")
    lines = [line for f in (tmp_path / "report").glob("*.json") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"precision": 0.5, "n": 3}]


def test_silver_can_be_kept_in_memory(spark, silver, tmp_path):
    lake.write_silver(silver, f"{tmp_path}/s")
    kept = lake.read_silver(spark, f"{tmp_path}/s", keep=True)
    assert kept.is_cached and kept.count() == silver.count()
    kept.unpersist()


def test_shared_folder_is_the_named_one(spark, tmp_path_factory):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.scratch_path(spark, "x").startswith(f"{named}/orderlens/{spark.sparkContext.applicationId}/x-")
    assert not session.path_exists(spark, session.scratch_path(spark, "x"))


def test_a_failed_write_leaves_the_old_table(spark, table, tmp_path):
    """Rows that fail halfway: readers go on seeing the version before, and the next write replaces it."""
    path = f"{tmp_path}/t"
    rows = spark.range(0, 1000, 1, 10).selectExpr("id AS x", "2018 AS purchase_year", "int(id % 3) AS purchase_month")
    failing = rows.withColumn("x", F.expr("IF(x = 990, raise_error('broken'), x)").cast("bigint"))
    for write in (lake.full_refresh, lake.write_silver):
        write(rows, path)
        with pytest.raises(PySparkException):
            write(failing, path)
        assert lake.read_table(spark, path).agg(F.sum("x")).first()[0] == 499_500
        write(rows.where("x < 10"), path)
        assert lake.read_table(spark, path).count() == 10


def test_readers_of_the_version_before_can_finish(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    for n in (1, 2):
        lake.full_refresh(spark.range(n), path)
    begun = lake.read_table(spark, path)
    lake.full_refresh(spark.range(3), path)
    assert (begun.count(), lake.read_table(spark, path).count()) == (2, 3)
    assert len(list((tmp_path / "t").glob("v*"))) == 2


BROKEN = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,a,SP\ns2,01038\ns3,1,b,RJ,extra\ns4,01039,c,SP\n"


def test_good_and_refused_add_up_to_what_was_read(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text(BROKEN)
    refused = {}
    tables = landing.ingest_all(spark, str(tmp_path), only=("sellers",), keep_bad=True)
    good = lake.write_bronze(tables, f"{tmp_path}/lake", refused=refused)
    assert (good, refused) == ({"sellers": 2}, {"sellers": 2})
    stored = lake.read_bronze(spark, f"{tmp_path}/lake", "sellers")
    assert stored.columns == [*schemas.SOURCES["sellers"].names, *schemas.LINEAGE]
    assert sorted(r.seller_id for r in stored.collect()) == ["s1", "s4"]
    aside = lake.read_refused(spark, f"{tmp_path}/lake/sellers").collect()
    assert sorted(r[lake.CORRUPT] for r in aside) == ["s2,01038", "s3,1,b,RJ,extra"]
    assert {r[lake.REASON] for r in aside} == {lake.UNREADABLE}


def test_orders_that_do_not_parse_are_kept_once_by_the_intake(spark, inputs, tmp_path):
    head = ",".join(schemas.SOURCES["orders"].names)
    width = len(schemas.SOURCES["orders"].names) - 3
    line = "{},c,delivered,2018-01-0{} 00:00:00" + "," * (width - 1)
    home = tmp_path / "lake"
    for n in (1, 2, 3):
        (tmp_path / "orders.csv").write_text("\n".join([head, *[line.format(f"o{i}", i) for i in range(1, n + 1)], "broken,line"]) + "\n")
        rows = landing.ingest_all(spark, str(tmp_path), only=("orders",), keep_bad=True)["orders"]
        if n == 1:
            lake.write_bronze({"orders": rows}, str(home))
        else:
            for _run in range(2):
                incremental.append_new(spark, rows, f"{home}/orders")
    assert sorted(r.order_id for r in lake.read_bronze(spark, str(home), "orders").collect()) == ["o1", "o2", "o3"]
    assert [r[lake.CORRUPT] for r in lake.read_refused(spark, f"{home}/orders").collect()] == ["broken,line"]
    plain = f"{tmp_path}/plain"
    incremental.append_new(spark, rows.drop(lake.CORRUPT), plain)
    with pytest.raises(ValueError, match="no place"):
        incremental.append_new(spark, rows, plain)
    incremental.append_new(spark, rows, f"{tmp_path}/first")
    assert lake.read_table(spark, f"{tmp_path}/first").count() == 3 and lake.read_refused(spark, f"{tmp_path}/first").count() == 1


def test_contract_keeps_aside_what_does_not_fit(spark, table, tmp_path):
    rows = table(BY_STATE, ("SP", 1, 0, 1.0, 1.0, 1.0), ("ARGENTINA", 1, 0, 1.0, 1.0, 1.0), ("RJ", 1, 0, 1e17, 1.0, 1.0), ("BA", None, 0, 1.0, 1.0, 1.0))
    counts = warehouse.split_by_contract(rows, "late_rate_by_state", f"{tmp_path}/split")
    assert counts == {"read": 4, "good": 1, "refused": 3}
    reasons = {r.customer_state: r[lake.REASON] for r in lake.read_refused(spark, f"{tmp_path}/split").collect()}
    assert reasons["ARGENTINA"] == "late_rate_by_state.customer_state does not fit varchar(2): ARGENTINA"
    assert "avg_delivery_days" in reasons["RJ"] and reasons["BA"].endswith("total_orders does not fit bigint: null")
    warehouse.export_table(rows, "late_rate_by_state", "aside", str(tmp_path), refused=f"{tmp_path}/aside")
    assert [r.customer_state for r in spark.table("aside.late_rate_by_state").collect()] == ["SP"]
    spark.sql("DROP DATABASE aside CASCADE")


@pytest.mark.parametrize("append", [incremental.append_new, incremental.append_missing])
def test_doubles_and_rows_without_an_id(spark, table, tmp_path, append):
    path = f"{tmp_path}/orders"
    rows = [("a", "2018-01-01 00:00:00"), ("a", "2018-01-01 00:00:00"), (None, None), (None, None), (None, "2018-01-03 00:00:00")]
    for _run in range(3):
        append(spark, table(ORDERS, *rows), path)
    stored = sorted((str(r.order_id), str(r.order_purchase_timestamp)) for r in spark.read.parquet(path).collect())
    assert stored == [("None", "2018-01-03 00:00:00"), ("None", "None"), ("a", "2018-01-01 00:00:00")]


def test_missing_orders_read_only_the_months_they_are_of(spark, table, tmp_path):
    path = f"{tmp_path}/orders"
    incremental.append_missing(spark, table(ORDERS, ("a", "2018-01-01 00:00:00"), ("b", "2018-02-01 00:00:00")), path)
    source = table(f"{ORDERS}, purchase_ym string", ("c", "2018-02-05 00:00:00", "2018-02"))
    plan = incremental.missing_rows(source, spark.read.parquet(path))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [purchase_ym" in plan.replace("isnotnull(purchase_ym", "purchase_ym") or "(purchase_ym" in plan
    assert "2018-02" in plan


def test_preview_is_the_same_whatever_the_partitions(spark):
    rows = spark.range(100).selectExpr("id * 37 % 100 AS x")
    for n in (1, 7):
        assert [r.x for r in medallion.sample(rows.repartition(n), 3).collect()] == [0, 1, 2]
