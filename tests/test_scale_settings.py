"""Session settings and the shared folder."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardlens.session import SETTINGS, cut_lineage, shared_path, shared_root
from wardlens.sources import tables
from wardlens.sources.delimited import read_delimited
from wardlens.sources.schemas import DISEASE_CHAPTERS


def test_settings_are_applied(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_shared_folder_is_one_per_session_and_paths_are_new(spark):
    assert shared_root(spark).rstrip("/") == shared_root(spark)
    assert shared_path(spark, "a") != shared_path(spark, "a")
    assert shared_path(spark, "a").startswith(shared_root(spark))


def test_checkpoint_keeps_rows_and_drops_the_plan(spark):
    df = spark.range(10).groupBy(F.col("id") % 3).count()
    stored = cut_lineage(df)
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))


def test_clusters_keep_every_hospital_with_missing_features(spark):
    from wardlens.plans import cluster

    data = [(f"{i:07d}", *[float((i * 7 + c) % 11) if (i + c) % 5 else None for c in range(12)]) for i in range(30)]
    columns = ", ".join(f"{c} double" for c in cluster.FEATURES)
    scaled = cluster.scaled_features(spark.createDataFrame(data, f"co_cnes string, {columns}"))
    assert cluster.assign_clusters(scaled, 4).select("co_cnes").distinct().count() == 30


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_loads_leave_nothing_in_the_shared_folder(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("numcap;catinic;catfim;descricao;descrabrev\nI;A00;B99;x;y\n")
    table = f"{tables.scratch_database(spark)}.chapters"
    tables.append_load(read_delimited(spark, str(path), DISEASE_CHAPTERS), table)
    root = Path(shared_root(spark).removeprefix("file:"))
    assert not list(root.glob("stage-*"))
