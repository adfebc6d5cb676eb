from types import SimpleNamespace

import pytest

from meterline.session import release, run_dir, shared_root


def fake(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_root(fake("spark://host:7077", "hdfs://nn/tmp/")) == "hdfs://nn/tmp"


def test_without_a_setting(tmp_path):
    with pytest.raises(RuntimeError):
        shared_root(fake("spark://host:7077"))
    local = fake("local[2]")
    assert shared_root(local) == shared_root(local)


def test_run_folders_are_never_reused(spark):
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_released_folders_are_gone(spark):
    release(spark)
    path = run_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    run_dir(spark, "never-written")
    assert release(spark) == 1 and release(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
