"""Session set-up (S14, S5) and shared scratch locations.

Scratch data that must outlive a task (round-trip files, staged tables,
stream checkpoints) lives under the cluster's shared checkpoint folder,
``spark.checkpoint.dir``.  A local folder is created only when the session
has none configured (tests and single-machine runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults every session gets: adaptive execution re-plans joins, coalesces
# small shuffle partitions and splits skewed ones at run time; staged
# checkpoint files are removed from the shared folder once unreferenced.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# The three read settings for Parquet written by older
# writers (INT96 timestamps, pre-Gregorian dates, nanosecond timestamps).
LEGACY_PARQUET_CONF = {
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def session(
    app: str = "tidewater",
    master: str | None = None,
    hive: bool = False,
    legacy_parquet: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with AQE on and UTC as the session zone.

    ``hive=True`` attaches the metastore catalog (S14); ``legacy_parquet``
    applies :data:`LEGACY_PARQUET_CONF` (S5).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if legacy_parquet:
        settings.update(LEGACY_PARQUET_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def legacy_parquet_conf(spark: SparkSession) -> None:
    """Switch an existing session to the legacy Parquet datetime rules."""
    for key, value in LEGACY_PARQUET_CONF.items():
        spark.conf.set(key, value)


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001 - Spark Connect: the server side decides
        return False


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data: the session's checkpoint folder.

    When none is configured and the master is local (tests, single-machine
    runs), a fresh local folder is made and registered as the checkpoint
    folder, so ``DataFrame.checkpoint`` and this function agree.  On a
    cluster a machine-local folder would be invisible to the executors, so
    an unset ``spark.checkpoint.dir`` is an error there.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage for intermediate data")
    root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    except Exception:  # noqa: BLE001 - Spark Connect: keep the local folder
        return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under :func:`scratch_root` for one run of one step."""
    return f"{scratch_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"
