import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from boxlake.session import build_session

    session = build_session(
        "boxlake-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Literal rows as a DataFrame spread over several partitions."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def values(spark):
    """Evaluate one-argument expressions over literal texts."""

    def evaluate(expression, inputs, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [r.y for r in rows.select("i", expression.alias("y")).orderBy("i").collect()]

    return evaluate


@pytest.fixture(autouse=True)
def interpreted(request):
    """Tiny inputs are not worth compiling code for; the oracle tests run the generated code."""
    if "spark" not in request.fixturenames or "test_oracle" in request.node.nodeid:
        yield
        return
    session = request.getfixturevalue("spark")
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    session.conf.unset("spark.sql.codegen.wholeStage")
    session.conf.unset("spark.sql.codegen.factoryMode")
