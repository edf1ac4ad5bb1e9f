"""Session settings and the shared scratch folder.

All file-producing operators write below the folder the cluster names in
``spark.checkpoint.dir`` (shared storage on a real cluster).  A local
folder is only chosen when the session has none, which is the test case.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the contracts depend on: UTC wall clock for the
# ``...'Z'`` pattern, dynamic partition overwrite for the keyed upsert,
# and adaptive execution for runtime join / skew / coalescing decisions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def cluster_settings(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4) -> dict:
    """Settings for a large cluster, sized from the bytes a job reads.

    Initial shuffle partitions aim at ~256 MB per reduce task (AQE coalesces
    down when a stage turns out smaller and splits skewed partitions), never
    fewer than two waves of the cluster's cores; scan splits are 256 MB; the
    broadcast threshold is the checked bound for the customer dimension.
    """
    target = 256 * 1024 * 1024
    cores = executors * cores_per_executor
    partitions = max(2 * cores, -(-int(input_bytes) // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.files.maxRecordsPerFile": "20000000",
        # a day of transactions against a much larger customer table: prune the
        # customer scan with a bloom filter of that day's account keys at runtime
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # dedupe / window state of the streams lives in RocksDB, not the JVM heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session we did not build ourselves and make
    the package importable by its Python workers."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors once per SparkContext (``addPyFile``),
    as ``--py-files`` would: Arrow UDF closures reference its modules by name."""
    sc = spark.sparkContext
    ident = sc.applicationId
    if ident in _SHIPPED:
        return
    import os
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    _SHIPPED.add(ident)


def build_session(master: str = "local[8]", app: str = "ledgerline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.  Where it is unset a local
    one is made for a local master only; a cluster must name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None)
        if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path in the shared folder (nothing is created yet)."""
    return f"{shared_dir(spark)}/ledgerline/{tag}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop file system of the path."""
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True))


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of change in seconds) of what a folder holds; nothing where it does not exist."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(hpath)]


def claim_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist; False where it does."""
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath.getParent())
    return bool(fs.createNewFile(hpath))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: written beside its place, then moved there."""
    fs, hpath = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(hpath, False)
    if not fs.rename(part, hpath):
        raise OSError(f"rename failed: {part} -> {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None where there is none."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as executors have to name it."""
    fs, hpath = _fs(spark, path)
    text = fs.makeQualified(hpath).toString()
    return "file://" + text[len("file:"):] if text.startswith("file:/") and not text.startswith("file://") else text


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, hpath = _fs(spark, path)
    fs.createNewFile(hpath)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    """Move a file or directory (parent folders created); raises when the move fails."""
    fs, hsrc = _fs(spark, src)
    _, hdst = _fs(spark, dst)
    fs.mkdirs(hdst.getParent())
    if not fs.rename(hsrc, hdst):
        raise OSError(f"rename failed: {src} -> {dst}")
