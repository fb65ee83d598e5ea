"""Session helpers: the shared checkpoint folder and shipping the package."""

import os
import subprocess
import sys

import pytest

from barsmith import session


def test_checkpoint_dir_is_read_from_the_session(spark):
    path = session.ensure_checkpoint_dir(spark)
    assert path and spark.conf.get("spark.checkpoint.dir", path) == path
    assert session.ensure_checkpoint_dir(spark) == path          # stable, never replaced
    sp = session.scratch_path(spark, "x")
    assert sp.startswith(path.rstrip("/") + "/barsmith/x-") and sp != session.scratch_path(spark, "x")


def test_a_plain_local_session_works(tmp_path):
    """A session without any settings (an empty configuration folder): the library finds a local folder and computes."""
    code = """
import os, sys
sys.path.insert(0, os.getcwd())
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from barsmith import session
from barsmith.operators.ema import ema
path = session.ensure_checkpoint_dir(spark)
assert path == session.ensure_checkpoint_dir(spark)
spark.range(3).checkpoint().count()
df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0)], "symbol string, datetime long, close double")
assert [r.ema_3 for r in ema(df, "close", [3]).orderBy("datetime").collect()] == [1.0, 2.0]
print("works in", path)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, cwd=root, timeout=180)
    assert "works in" in done.stdout, done.stderr[-2000:]


class _FakeSession:
    """A session on a real cluster on which nobody set the shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "local-cluster[2,1,1024]"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_FakeSession)


def test_package_is_shipped_once_and_importable_in_workers(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED

    def where(it):
        import barsmith
        for _ in it:
            yield os.path.basename(os.path.dirname(barsmith.__file__))

    assert spark.sparkContext.parallelize([1], 1).mapPartitions(where).collect() == ["barsmith"]
