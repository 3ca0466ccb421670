"""Session helpers: one place for the confs every job relies on.

Nothing here overrides a setting the cluster already made.  The shared
checkpoint folder is read from ``spark.checkpoint.dir``; only when the
session has none (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Confs our operators need for correct results (not tuning knobs).
REQUIRED_CONF = {
    # every epoch-second <-> timestamp conversion assumes UTC wall clock
    "spark.sql.session.timeZone": "UTC",
}

# Confs we set only when the caller has not: sensible for batch + streaming.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB provider; it also spills state to disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sensorflow", extra: dict | None = None) -> SparkSession:
    """Session for tests / bench.  UI off: no web server is opened."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.python.unix.domain.socket.enabled", "true"))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sensorflow`` importable in every Python worker: zip the package
    once per application and hand it to ``addPyFile`` (what ``--py-files``
    does), so executors on any machine can run the Arrow UDFs and state
    processors."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="sensorflow-pyfiles-"), "sensorflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    # Python runners that do not read --py-files (the driver-side runner of
    # transformWithState) still get our functions: pickle them by value
    from pyspark import cloudpickle
    import sensorflow
    cloudpickle.register_pickle_by_value(sensorflow)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required confs to a session we did not build ourselves."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, staged streams and written tables.

    Cluster: whatever ``spark.checkpoint.dir`` names (must be shared storage).
    Unset (local tests only): a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        # SparkContext appends a per-application uuid folder; use its parent
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, wherever Spark keeps it; an absent one is nothing to do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
