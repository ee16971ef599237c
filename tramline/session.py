"""Session set-up and the shared working folder.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``;
it is read from the session and only set here when it is unset (local runs
and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every tramline session wants. Shuffle width is left to the caller
# (cluster default, or a small number for local tests).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tramline",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or get) a session with tramline's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC.

    Driver tables store wall-clock timestamps without a zone; every
    timestamp expression in tramline reads them as UTC, and the window
    alignment of streaming aggregates is defined against UTC epoch.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, staged files and stream sinks.

    Uses the session's checkpoint directory (``spark.checkpoint.dir`` or a
    directory set with ``setCheckpointDir``). Where none is configured, a
    fresh local folder is set if the master runs in this process, as in local
    tests; on a cluster, whose machines do not share it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            require_local(sc.master)
            configured = tempfile.mkdtemp(prefix="tramline-ckpt-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def require_local(master: str) -> None:
    """Raise unless the master runs in this process (local, local[8], ...)."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it must name a folder "
                           "that the driver and all executors share")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tramline`` importable in the Python workers (once per app).

    Only operators that run Python inside tasks need it (the keyed state of
    the streaming path length). The package is zipped on the driver and
    handed to ``SparkContext.addPyFile``, which distributes it to every
    executor, as ``spark-submit --py-files`` would.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="tramline-code-"), "tramline.zip")
    with zipfile.ZipFile(path, "w") as zf:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
