from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from shelfmark.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = configure(SparkSession.builder.master("local[8]").appName("tests"))
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    def text(df) -> str:
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
