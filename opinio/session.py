"""Session helpers and the shared scratch location.

The library never picks a machine-local folder on a cluster:
``spark.checkpoint.dir`` (or the context's checkpoint directory) is read from
the running session, and without it only a local master gets a fresh folder
under the system temp directory; any other master is refused.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "opinio",
                input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Session for tests and local runs; a cluster job passes its own session.

    With ``input_bytes`` and ``total_cores`` the shuffles and scans are sized
    by :func:`recommended_conf`.
    """
    sized = recommended_conf(input_bytes, total_cores) if input_bytes and total_cores else {}
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config(map=sized)
        .getOrCreate()
    )


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    The initial shuffle width is high enough that every shuffle partition
    fits in executor memory with room to spare (about ``target_partition_bytes``
    each, or two waves of tasks, whichever is more); AQE then coalesces small
    partitions and splits skewed ones at run time.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="opinio-ckpt-")
    sc.setCheckpointDir(configured)
    # setCheckpointDir appends a per-application subfolder; report that one.
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the cluster's shared checkpoint location."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/opinio/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so Python tasks import it by name there."""
    sc = spark.sparkContext
    if getattr(sc, "_opinio_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="opinio-pkg-"), "opinio.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("opinio", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._opinio_shipped = True


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application; call it when a job's results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_checkpoint_root(spark).rstrip('/')}/opinio")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
