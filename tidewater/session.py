"""Session construction and the shared scratch area.

Everything that must outlive a task (staged writes, stream checkpoints,
window control tables, lineage cuts) goes under the folder named by
``spark.checkpoint.dir``. That folder is shared by the whole cluster; a
machine-local temporary folder is only created when the setting is unset,
which is the case in tests and small local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job here relies on. Session time zone is pinned because
# window bounds are wall-clock text and must not move with the JVM zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "tidewater",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable scratch data.

    Read from the session; only when nothing is configured do we create a
    local folder and register it as the checkpoint dir (tests, laptops).
    """
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.conf.get(CHECKPOINT_KEY)
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            root = None
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on {sc.master}")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the checkpoint root (never reused)."""
    name = "-".join(p for p in parts if p) or "run"
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
