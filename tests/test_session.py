import pytest

from plantlake import session
from plantlake.config import PipelineConfig


def test_smoke(spark):
    assert spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "key int, value int").count() == 3


def test_shared_dir_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_write_through_keeps_rows(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    assert rows(session.write_through(df, "t")) == rows(df)


def test_config_from_settings(spark):
    names = ["bronze_schema", "silver_schema", "gold_schema", "machine_uploads_base", "metadata_base"]
    for name in names:
        spark.conf.set(f"plantlake.{name}", f"x_{name}")
    cfg = PipelineConfig.from_conf(spark)
    assert [getattr(cfg, n) for n in names] == [f"x_{n}" for n in names]
    assert cfg.tables_base is None
    assert (cfg.cluster_bronze, cfg.cluster_silver, cfg.max_files_per_trigger) == (False, True, None)
    for name, value in (("cluster_bronze", "true"), ("cluster_silver", "false"), ("max_files_per_trigger", "3")):
        spark.conf.set(f"plantlake.{name}", value)
    try:
        cfg = PipelineConfig.from_conf(spark)
        assert (cfg.cluster_bronze, cfg.cluster_silver, cfg.max_files_per_trigger) == (True, False, 3)
    finally:
        for name in ("cluster_bronze", "cluster_silver", "max_files_per_trigger"):
            spark.conf.unset(f"plantlake.{name}")
