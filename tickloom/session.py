"""Session settings shared by every entry point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the models rely on: UTC days, ANSI errors (the code uses the
# try_ functions where NULL is wanted) and adaptive re-planning with skew splitting.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

ROCKSDB_STATE_STORE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str = "tickloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session; cluster sizing stays with the deployment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **SQL_SETTINGS,
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE_STORE,
        # Recording the Python line of every Column costs more than planning a small query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Checkpoint files go when the frame that made them is collected.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(key, None) != SQL_SETTINGS[key]:
            spark.conf.set(key, SQL_SETTINGS[key])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoint() and stored tables, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent, a folder under the warehouse serves, which all executors
    of a cluster share as well.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
