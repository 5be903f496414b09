"""The oracle comparison on tables where one hospital holds over a third of all admissions."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle_check import difference

HOT = [
    "d5_gld_ocupacao_mensal",
    "d6_gld_features_hospital",
    "d8_reconciliation",
    "d10_top_critical",
    "d11_features_sample",
    "s13_monthly_on_tables",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    duck = duckdb.connect()
    for name in ("lineitem", "supplier"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            hot = F.when(F.col("l_partkey") % 5 < 2, F.lit(5).cast("bigint"))
            df = df.withColumn("l_suppkey", hot.otherwise(F.col("l_suppkey")))
        df.write.parquet(f"{folder}/{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return folder, duck


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("key", HOT)
def test_matches_oracle_with_a_hot_hospital(spark, skewed, no_broadcast, key):
    folder, duck = skewed
    assert difference(entry.queries()[key](spark, folder), duck, entry.oracle_sql()[key]) is None
