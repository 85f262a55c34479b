"""Session helpers: a sane local session for tests and a shared scratch root."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins at run time (broadcast
# conversion after measuring the real size of a side, skew-join splitting of hot
# partitions, coalescing of small shuffle partitions).
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files (stored intermediates) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakeshift", extra_conf: dict | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**JOB_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; it is only invented here
    when unset (local tests), never overridden.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lakeshift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Stream checkpoints and hand-over tables of registered queries live here, so
    on a cluster they sit on the shared file system the cluster names, never on
    an executor's local disk.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    # Spark's writers and stream checkpoints create the folder on whatever file
    # system the root names; nothing is created on the driver's local disk.
    return f"{root}/lakeshift/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` of input on ``cores`` executor cores.

    * scan splits of ``partition_bytes`` (256 MiB);
    * initial shuffle partitions ~ one per ``partition_bytes`` of input, at least
      2 per core and at most 20 per core; AQE then coalesces small partitions
      towards the same advisory size, so a stage never runs with a partition
      far above what a task's memory share holds without heavy spilling;
    * skew-join splitting of partitions over 2x the advisory size;
    * broadcast only below 64 MiB of *measured* size (AQE runtime statistics).

    E.g. 100 TB on 1000 executors x 8 cores -> 160,000 initial partitions.
    Pass the result to ``spark-submit --conf`` or the session builder.
    """
    wanted = math.ceil(input_bytes / partition_bytes)
    parts = max(2 * cores, min(wanted, 20 * cores))
    size = f"{partition_bytes >> 20}m"
    return {
        **JOB_CONF,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{(2 * partition_bytes) >> 20}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeshift`` importable in the executors' Python workers.

    Code that runs on executors (the API source's reader, the CSV header reader)
    is shipped by module reference.  When the package is not installed on the
    workers, a zip of it is added with ``addPyFile`` (what ``--py-files`` does),
    once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lakeshift-pyfiles-"), "lakeshift.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
