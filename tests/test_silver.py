from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens import schemas
from orderlens.config import DEFAULTS
from orderlens.operators import silver as ops
from orderlens.registry.inputs import SETTINGS


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_cross_state_rule(table):
    pairs = table("customer_state string, seller_state string", ("SP", None), ("SP", "BA"), ("SP", "SP"))
    got = [r[0] for r in pairs.select(ops.cross_state()).collect()]
    assert got == [False, True, False]
    variant = pairs.select(ops.cross_state(DEFAULTS.but(unknown_state_crosses=True)))
    assert [r[0] for r in variant.collect()] == [True, True, False]


def test_weight_of_main_product_keeps_null(table):
    got = table("product_weight_g double", (1234.0,), (1005.0,), (None,)).select(ops.weight_kg())
    assert [r[0] for r in got.collect()] == [1.23, 1.01, None]


def test_silver_columns(silver):
    assert tuple(silver.columns) == schemas.SILVER and len(silver.columns) == 27


def test_one_row_per_order(silver):
    assert silver.count() == silver.select("order_id").distinct().count() == 262


def test_unmatched_rows_survive_left_joins(table):
    facts = table("order_id string, product_category_name string", ("a", "moveis"), ("b", "nova"), ("c", None))
    names = table("product_category_name string, product_category_name_english string", ("moveis", "furniture"))
    got = {r.order_id: r.product_category_name_english for r in ops.with_category(facts, names).collect()}
    assert got == {"a": "furniture", "b": None, "c": None}


def test_lineage_columns_do_not_clash(inputs):
    stamped = {
        name: df.withColumns({c: F.lit("x") for c in schemas.LINEAGE}) for name, df in inputs.tables.items()
    }
    assert ops.build_silver(stamped, SETTINGS).columns == list(schemas.SILVER)


def test_row_order_and_partitions_change_nothing(spark, inputs, silver):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    shuffled = {name: df.orderBy(F.rand(7)).repartition(5) for name, df in inputs.tables.items()}
    assert as_set(ops.build_silver(shuffled, SETTINGS)) == as_set(silver)


def test_salted_joins_change_nothing(spark, inputs, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert as_set(ops.build_silver(inputs.tables, SETTINGS.but(join_salts=8))) == as_set(silver)


def test_empty_silver_quality(spark, silver):
    got = ops.quality_report(silver.limit(0)).first()
    assert (got.total_orders, got.late_share, got.missing_review_share) == (0, None, None)


def test_order_without_payment_or_review_stays(spark, inputs, silver):
    bare = {**inputs.tables, "payments": inputs["payments"].where("order_id % 2 = 0"), "reviews": inputs["reviews"].limit(0)}
    got = ops.build_silver(bare, SETTINGS)
    assert got.count() == silver.count()
    odd = got.where("order_id % 2 = 1")
    assert odd.where("max_installments IS NOT NULL OR total_payment_value IS NOT NULL").count() == 0
    assert got.where("review_score IS NOT NULL").count() == 0


def test_sources_fit_their_declared_schema(inputs):
    for name, declared in schemas.SOURCES.items():
        got = inputs[name].schema
        assert isinstance(declared, StructType)
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared], name
