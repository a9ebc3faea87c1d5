"""Session helpers.

Library code never creates a session; it takes the one it is given. These
helpers are for tests, the bench and command-line jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the cluster: UTC, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fraudspark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture is a debugging aid; it costs ~1 ms per Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FRAUDSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster `spark.checkpoint.dir` names a shared (distributed) folder and
    is used as is. Otherwise the SparkContext's checkpoint folder, if one was
    set. Only when neither exists (local tests) is a folder created; it is
    registered with `setCheckpointDir` (the conf itself cannot be changed at
    runtime). On a cluster without either this raises: a local folder of one
    machine would not be seen by the others.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="fraudspark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `fraudspark` importable in Python workers (like --py-files).

    Needed by the operators that run Python inside tasks (mapInPandas,
    applyInPandasWithState). The zip is written to the shared checkpoint
    folder once per SparkContext and added with `addPyFile`.
    """
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = ensure_checkpoint_dir(spark)
    if "://" in folder and not folder.startswith("file:"):
        # addPyFile serves the file from the driver to every executor, so a
        # driver-side copy is enough when the shared folder is not a local path
        folder = tempfile.mkdtemp(prefix="fraudspark-pyfiles-")
    target = os.path.join(folder.replace("file:", ""), f"fraudspark-{os.getpid()}.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(id(sc))
