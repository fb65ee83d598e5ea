"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every barsmith job relies on; applied only by ``local_session``.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "barsmith", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench (never used by library code)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
#: Local folders of sessions without a shared one, by application.
_LOCAL_DIRS: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``barsmith`` importable in the Python workers (executors).

    Operators that run Python in tasks (the live state processor) are pickled by reference, so the workers must import this
    package.  Once per application it is zipped and added with
    ``addPyFile``, which distributes it to every executor; a cluster that
    installs the package anyway loses nothing.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="barsmith-pyfiles-"), "barsmith.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster sets it, with
    its scheme kept.  Only a local master (tests, a laptop) falls back to a
    folder of this machine, removed when the process ends; any other master
    without the setting is an error, because its executors would not see it.
    """
    sc = spark.sparkContext
    local = bool(re.match(r"local(\[|$)", sc.master))
    path = spark.conf.get("spark.checkpoint.dir", None) or (local and _LOCAL_DIRS.get(sc.applicationId)) or sc.getCheckpointDir()
    if not path:
        if not local:
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="barsmith-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _LOCAL_DIRS[sc.applicationId] = path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/barsmith/{name}-{uuid.uuid4().hex[:12]}"
