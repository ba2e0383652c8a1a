"""SparkSession helpers shared by tests, bench and the driver entry points."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one with sane analytics defaults.

    On a cluster the session already exists (spark-submit) and only the missing
    settings below are applied; nothing here overrides a value the cluster set.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("roadrisk")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset and the master is
    local (tests) a fresh scratch folder is created and registered; on a cluster
    a folder of one machine would hide each executor's files from the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share.")
        configured = tempfile.mkdtemp(prefix="roadrisk-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def send_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as ``--py-files`` would.

    Functions that run in Python workers and use modules of this package need it there.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = Path(tempfile.mkdtemp(prefix="roadrisk-code-")) / "roadrisk_code.zip"
    path.write_bytes(held.getvalue())
    sc.addPyFile(str(path))
    _SENT.add(sc.applicationId)
