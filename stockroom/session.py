"""SparkSession construction and the few session settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the jobs depend on for correct results (time zone) or for scale (AQE, skew
# handling, dynamic partition overwrite). Applied with ``setIfUnset`` semantics so a
# cluster's own configuration wins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Values that must be pinned regardless of the cluster default, because results depend on
# them (dates are derived in UTC everywhere).
PINNED = {"spark.sql.session.timeZone": "UTC"}


def build_session(
    master: str | None = None,
    app_name: str = "stockroom",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.streaming.stateStore.providerClass"] = (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``stockroom`` importable in Python workers (pandas-backed operators pickle
    references to its functions): zip the package on the driver and ``addPyFile`` it, once
    per application, the same way ``--py-files`` distributes code to a cluster."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="stockroom-pyfiles-"), "stockroom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Pin UTC, switch on AQE and ship the package for a session we did not build ourselves."""
    ship_package(spark)
    for k, v in PINNED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in SESSION_DEFAULTS.items():
        if k in PINNED:
            continue
        if spark.conf.get(k, None) is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session: leave the cluster's choice
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, since a folder of one machine is not seen by the others. Only a
    local session without it (as in tests) gets one under the system temp folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stockroom-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root for written intermediate tables; it is a URI
    of whatever file system the root is on, and its writer makes it."""
    return f"{checkpoint_root(spark).rstrip('/')}/stockroom-work/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as a Parquet table in the shared checkpoint folder
    and reading it back (one computation; survives executor loss, unlike local checkpoints)."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
