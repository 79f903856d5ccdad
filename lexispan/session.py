"""SparkSession helper used by tests, the bench and the examples."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "lexispan") -> SparkSession:
    """Return a session with AQE on and the UI off.

    A cluster supplies ``spark.checkpoint.dir`` (a shared folder); only
    when it is unset (tests, local runs) a scratch folder is chosen.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEXISPAN_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        # A cluster brings its own setting, sized for its data.
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lexispan`` importable in the Python workers (pandas UDFs
    and ``mapInPandas`` functions live in it): zip the package once per
    Spark application and hand it to ``addPyFile``, which distributes it
    to every executor."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="lexispan-pkg-"), "lexispan.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, choosing a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and
    is used as it is; a machine-local folder is picked only where the
    setting is absent and the master is local, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lexispan-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
