from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("llm-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoint')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def docs(spark):
    """documents rows as a DataFrame: (doc_id, text) pairs, plus clashing extra columns on demand."""

    def make(rows, extra: dict | None = None, parts: int = 3):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, schema).repartition(parts)
        for name, value in (extra or {}).items():
            df = df.selectExpr("*", f"{value} as `{name}`")
        return df

    return make
