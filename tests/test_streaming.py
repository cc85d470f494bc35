import pytest
from pyspark.sql import functions as F

from orderlens.operators import dataset, model, queue
from orderlens.registry import queries as registered
from orderlens.registry.inputs import SETTINGS
from orderlens.registry.queries import QUICK
from orderlens.sources import incremental, lake, landing
from orderlens.streaming.ingest import stream_ingest
from orderlens.streaming.scoring import stream_score


def test_each_file_is_taken_in_once(spark, inputs, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    halves = [inputs["orders"].where(f"order_id % 2 = {i}") for i in (0, 1)]

    def run() -> int:
        stream_ingest(spark, source, target, checkpoint).awaitTermination()
        return spark.read.parquet(target).count()

    halves[0].write.option("header", True).mode("append").csv(source)
    assert run() == halves[0].count()
    assert run() == halves[0].count()
    halves[1].write.option("header", True).mode("append").csv(source)
    assert run() == inputs["orders"].count()
    stored = spark.read.parquet(target)
    assert stored.select("order_id").distinct().count() == inputs["orders"].count()
    assert set(stored.columns) == {*inputs["orders"].columns, "ingested_at", "source_table", "source_file", "purchase_ym"}


def test_stream_and_intake_share_bronze(spark, inputs, tmp_path):
    """Batch, stream, batch again: every order is there once, those without a date too."""
    orders = inputs["orders"].withColumn(
        "order_purchase_timestamp", F.when(F.expr("order_id % 13 <> 0"), F.col("order_purchase_timestamp"))
    )
    n = orders.count()
    home = str(tmp_path)
    lake.write_bronze({"orders": landing.add_lineage(orders.where("order_id % 2 = 0"), "orders", "first")}, home)
    orders.write.option("header", True).csv(f"{home}/in")
    for _run in range(2):
        stream_ingest(spark, f"{home}/in", f"{home}/orders", f"{home}/ck").awaitTermination()
        incremental.append_new(spark, landing.add_lineage(orders, "orders", "again"), f"{home}/orders")
        stored = lake.read_bronze(spark, home, "orders")
        assert stored.count() == stored.select("order_id").distinct().count() == n
    stream_ingest(spark, f"{home}/in", f"{home}/fresh", f"{home}/ck2").awaitTermination()
    incremental.append_new(spark, landing.add_lineage(orders, "orders", "again"), f"{home}/fresh")
    assert spark.read.parquet(f"{home}/fresh").count() == n


def test_a_stream_refuses_files_of_another_writer(spark, inputs, tmp_path):
    inputs["sellers"].write.parquet(f"{tmp_path}/in")
    inputs["sellers"].write.parquet(f"{tmp_path}/out")
    with pytest.raises(ValueError, match="another writer"):
        stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", "sellers", "parquet")


def test_bodies_without_an_order_are_kept_aside(spark, inputs, silver, tmp_path):
    fitted = model.train(dataset.training_set(silver), QUICK)
    bodies = ['{"order_id": "a", "nb_items": 1}', '{"orders": [null, {"order_id": "b"}]}', '{"orders": [null]}', "not json", "{}",
              '{"order_id": "c", "nb_items": "many"}']
    spark.createDataFrame([(b,) for b in bodies], "value string").write.text(f"{tmp_path}/in")
    stream_score(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", fitted).awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{tmp_path}/out-rejected").count() == 4


def test_other_tables_stream_too(spark, inputs, tmp_path):
    inputs["sellers"].write.parquet(f"{tmp_path}/in")
    stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", "sellers", "parquet").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == inputs["sellers"].count()


def test_stream_scores_like_the_batch(spark, inputs, silver, tmp_path):
    fitted = model.train(dataset.training_set(silver), QUICK)
    payloads = queue.payloads(inputs["orders"], inputs.tables, SETTINGS)
    payloads.select(F.to_json(F.struct(*payloads.columns)).alias("value")).repartition(3).write.text(f"{tmp_path}/in")
    stream_score(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", fitted, files_per_batch=1).awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out").drop("batch", "run")
    batch = model.score_batch(fitted, landing.parse_order_json(spark.read.text(f"{tmp_path}/in")))
    assert streamed.count() == payloads.count()
    assert streamed.exceptAll(batch).count() == 0


def test_an_order_that_comes_twice_is_stored_once(spark, inputs, tmp_path):
    """Doubles in a batch, in later batches, with another purchase month, and rows without an id."""
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    orders = inputs["orders"].where("order_id % 5 < 4")
    later = orders.withColumn("order_purchase_timestamp", F.expr("order_purchase_timestamp + INTERVAL 45 DAYS"))
    nameless = orders.limit(1).withColumn("order_id", F.lit(None).cast("string"))
    n = orders.count()
    for rows in (orders.unionByName(orders).unionByName(nameless), later.unionByName(nameless), inputs["orders"]):
        rows.coalesce(1).write.option("header", True).mode("append").csv(source)
        stream_ingest(spark, source, target, checkpoint).awaitTermination()
        stored = spark.read.parquet(target)
        assert stored.where("order_id IS NULL").count() == 1
        assert stored.count() - 1 == stored.select("order_id").distinct().where("order_id IS NOT NULL").count() >= n
    assert stored.count() - 1 == inputs["orders"].count()


def test_a_new_checkpoint_replaces_no_scores(spark, silver, tmp_path):
    fitted = model.train(dataset.training_set(silver), QUICK)
    for run, name in enumerate(("a", "b")):
        spark.createDataFrame([(f'{{"order_id": "{name}"}}',)], "value string").write.text(f"{tmp_path}/in{run}")
        stream_score(spark, f"{tmp_path}/in{run}", f"{tmp_path}/out", f"{tmp_path}/ck{run}", fitted).awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_payloads_and_training_rows_from_one_pass(spark, inputs, monkeypatch):
    """The stream's query joins items once; rows and labels are those of the training set."""
    labelled = dataset.labelled_payloads(inputs.tables, SETTINGS)
    trained = dataset.training_set_of_payloads(labelled)
    expected = dataset.training_set_of_orders(inputs.tables, SETTINGS)
    assert trained.dtypes == expected.dtypes
    assert sorted(map(tuple, trained.collect())) == sorted(map(tuple, expected.collect()))
    assert labelled.count() == queue.payloads(inputs["orders"], inputs.tables, SETTINGS).count() > trained.count() > 0
    calls, build = [], queue.payloads
    monkeypatch.setattr(queue, "payloads", lambda *a, **b: calls.append(a) or build(*a, **b))
    assert registered.callables()["t02_stream_score"](spark, inputs.folder).count() == 1
    assert len(calls) == 1
