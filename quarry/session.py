"""Session helpers: a configured local session for tests/bench, and the
shared work folder every job writes intermediate state to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at any scale. Shuffle partition count is left to the
# caller (cluster jobs size it from the input); AQE coalesces small
# partitions and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app_name: str = "quarry",
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared file system path set by the operator (an
    error if missing); only a local-mode session without one gets a
    temporary folder (tests).
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf key absent
            base = None
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                               "checkpoints and stream state must survive executor loss")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")  # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry/{name}-{uuid.uuid4().hex[:12]}"


_ROOT = Path(__file__).resolve().parents[1]
_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Give the Python workers of a local session this package, unless they
    start where they find it. A cluster gets it by deployment (--py-files)."""
    sc = spark.sparkContext
    if not sc.master.startswith("local[") or sc.applicationId in _sent:
        return
    _sent.add(sc.applicationId)
    java = sc._jvm.java.lang.System
    known = (java.getenv("PYTHONPATH") or "").split(os.pathsep) + [java.getProperty("user.dir")]
    if any(k and Path(k).resolve() == _ROOT for k in known):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-code-"), "quarry_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((_ROOT / "quarry").rglob("*.py")):
            z.write(f, f.relative_to(_ROOT))
    sc.addPyFile(path)


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
