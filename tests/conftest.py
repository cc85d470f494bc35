import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from orderlens.registry.inputs import Inputs  # noqa: E402
from orderlens.session import build_session, staged, tune  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "orderlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def settled(request):
    """Undo what a test set on the session."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        session.conf.set("spark.sql.shuffle.partitions", "8")
        tune(session)


@pytest.fixture(scope="session")
def inputs(spark):
    return Inputs(spark, SMALL)


@pytest.fixture(scope="session")
def silver(inputs):
    return staged(inputs.silver)


@pytest.fixture(scope="session")
def scored(silver):
    from pyspark.sql import functions as F

    from orderlens.registry.inputs import bucket_score

    return staged(silver.withColumns({"probability": bucket_score(), "label": F.col("is_late").cast("int")}))


@pytest.fixture
def table(spark):
    """table("id string, n int", ("a", 1), ...) as a DataFrame; text is cast to timestamps."""

    def build(ddl: str, *rows):
        from pyspark.sql import functions as F

        names = [part.strip().split()[0] for part in ddl.split(",")]
        kinds = [part.strip().split()[1] for part in ddl.split(",")]
        loose = ", ".join(f"{n} {'string' if k == 'timestamp' else k}" for n, k in zip(names, kinds))
        df = spark.createDataFrame(list(rows), loose)
        return df.select(*[F.col(n).cast(k) for n, k in zip(names, kinds)])

    return build
