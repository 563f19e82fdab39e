"""Session construction and shared scratch-space helpers."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

#: Settings every wattspark job relies on.  UTC is required for the
#: timestamp semantics (the telemetry is UTC); AQE supplies runtime
#: re-planning (size-checked broadcast, partition coalescing, skew-join
#: splitting of hot keys).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # times in the default INT96 have no row-group statistics to skip by
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "wattspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the wattspark defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL-level defaults to a session someone else created, and
    make the package importable by the Python workers."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled":
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors (``addPyFile`` of a zip),
    once per SparkContext, so pandas UDFs and ``mapInPandas`` functions that
    reference it unpickle on any worker, whatever its working directory.

    The zip is built in memory and written into the shared checkpoint folder
    through the Hadoop FileSystem API, so no machine-local folder is used.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for root, _dirs, files in os.walk(pkg_dir):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
        data = buf.getvalue()
        digest = hashlib.sha1(data).hexdigest()[:16]
        target = f"{checkpoint_dir(spark).rstrip('/')}/pyfiles/wattspark-{digest}.zip"
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(path):
            out = fs.create(path, True)
            out.write(bytearray(data))
            out.close()
        sc.addPyFile(target)
        _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster setting ``spark.checkpoint.dir`` wins.  Where it is unset, a
    private folder is created in local mode; on a cluster, whose machines
    would not share it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in Spark Connect
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        configured = tempfile.mkdtemp(prefix="wattspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side code can look at a local path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, through the file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(str(f.getPath()) for f in found) if found else []


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def tune_shuffle(spark: SparkSession, paths: list[str], *,
                 target_partition_bytes: int = 128 * 1024 ** 2,
                 expansion: float = 1.0, max_partitions: int = 200_000) -> int:
    """Size shuffles for the data at ``paths`` on a cluster.

    Sets the shuffle partition count (and AQE's initial count) to about
    ``input size * expansion / target_partition_bytes``, at least twice the
    cluster's parallelism, and lets AQE coalesce towards the target size
    instead of towards maximum parallelism, so every shuffle partition fits
    an executor's memory at 100 TB and small stages are not over-split.
    ``expansion`` accounts for plans whose shuffles are larger than their
    input (e.g. a long -> wide explode).  Returns the partition count.
    """
    size = input_bytes(spark, paths) * expansion
    floor_n = 2 * spark.sparkContext.defaultParallelism
    n = int(min(max(size // target_partition_bytes + 1, floor_n), max_partitions))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    return n
