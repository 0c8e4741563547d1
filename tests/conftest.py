import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kerbside import configure  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "1")
        .config("spark.sql.codegen.wholeStage", os.environ.get("TEST_CODEGEN", "false"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def page(spark):
    """Build bronze rows from ``(provider, endpoint, content[, load_ts[, file_ts]])``."""

    def build(*rows):
        filled = []
        for i, row in enumerate(rows):
            provider, endpoint, content, *rest = row
            load_ts = rest[0] if rest else "2024-01-01 00:00:00"
            file_ts = rest[1] if len(rest) > 1 else "2024-01-01 00:00:00"
            filled.append((provider, endpoint, content, f"f{i}", file_ts, load_ts))
        raw = spark.createDataFrame(
            filled, "provider string, endpoint string, content string, filename string, file_ts string, load_ts string"
        )
        return raw.selectExpr(
            "provider", "endpoint", "content", "filename", "CAST(file_ts AS TIMESTAMP) AS file_ts",
            "CAST(NULL AS STRING) AS md5_hash", "CAST(load_ts AS TIMESTAMP) AS load_ts",
        )

    return build


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
