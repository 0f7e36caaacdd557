"""Session construction and the shared scratch location.

Jobs that cut lineage or stage intermediate tables write under the folder the
cluster names in ``spark.checkpoint.dir``. Only a local session (tests, one
machine) may leave it unset and gets a temporary one; on a cluster its absence
is an error, because executors cannot see a folder of the driver's machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every session of this library relies on. Timestamps in the vault are
# zone-less; the session time zone only matters for the streaming watermark
# cast and must be fixed so results do not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[8]", app: str = "vaultline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, loopback driver)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         # one JVM: listing thousands of day folders on the driver beats a
         # distributed listing job (cluster sessions keep Spark's default)
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime SQL settings to an existing session."""
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException as ex:  # static settings stay as the cluster set them
            if "CANNOT_MODIFY" not in (ex.getCondition() or ""):
                raise
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created only for a local master."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: only the conf is visible
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster session needs a shared "
                               "folder for intermediate tables")
        current = tempfile.mkdtemp(prefix="vaultline-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one job's outputs."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote (through the file system it lies on)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block a query's shuffle files are deleted when it ends. Spark else keeps them until the driver happens to
    collect garbage, and a job of many steps holds the files of all of them on disk at once. For jobs that write each
    step's result and read that: a DataFrame that is run twice would have to compute its shuffles again. The session's
    own setting is restored afterwards."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


UNKNOWN_SIZE = 1 << 60  # Spark's default for leaves it knows nothing about is larger


def estimated_bytes(df) -> int | None:
    """Input size of a DataFrame: the sum of Spark's size statistics of the leaves
    of its optimized plan (file sizes for scans). Leaves, not the root: without
    cost-based statistics Spark estimates a join as the product of its inputs."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            size = int(str(leaves.next().stats().sizeInBytes()))
            if size >= UNKNOWN_SIZE:
                return None
            total += size
        return total
    except Exception:
        return None


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(spark: SparkSession, df, target_bytes: int = TARGET_PARTITION_BYTES) -> Iterator[int]:
    """Within the block, AQE starts with about one shuffle partition per ``target_bytes`` of
    estimated input (never fewer than configured) and coalesces small ones at runtime. The
    session's own setting is restored afterwards. Yields the number in effect."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    current = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    wanted = max(current, -(-size // target_bytes) if size is not None else 0)
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
