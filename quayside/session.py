"""Session helpers: a local session for tests and a shared scratch folder.

Scratch output (landing trees, tables, schema logs made by the registered queries)
goes below the folder the cluster names in ``spark.checkpoint.dir``, so every
executor sees it. Only when that setting is absent (a bare local test session) is a
temporary folder created and used instead.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None
_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quayside") -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, UTC, Arrow enabled.

    In local mode file listing stays on the driver: Spark's parallel listing job
    (used above 32 folders) costs far more than it saves on one machine. On a
    cluster over object storage keep Spark's default.

    ``file:`` paths use Hadoop's raw local file system (no ``.crc`` side files):
    without the native Hadoop library every local file or folder created costs a
    forked ``chmod``, and the checksum files double that; landing writes one file per
    member. Cluster file systems are not affected.
    """
    n = (os.cpu_count() or 8) if str(cores) == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", str(max(100_000, n)))
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``quayside`` importable in the Python workers of this application.

    Executor-side code (``mapInPandas``, ``applyInPandas``) refers to functions of the
    package, so the workers must import it whatever folder the driver was started
    from. The package is zipped once per application and added with ``addPyFile``
    (Spark's own way to ship Python code; no shared folder needed). An installed
    package makes this unnecessary but harmless.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    with _SHIP_LOCK:  # queries may start from several driver threads
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="quayside-pkg-"), "quayside.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, dirs, files in os.walk(pkg):
                dirs[:] = [d for d in dirs if d != "__pycache__"]
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        sc.addPyFile(out)
        _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``. Where neither is
    set, a local session gets a temp folder; on a cluster this raises."""
    global _LOCAL_FALLBACK
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="quayside-ckpt-")
            spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK)
        root = _LOCAL_FALLBACK
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/quayside-scratch/{name}-{uuid.uuid4().hex[:12]}"
