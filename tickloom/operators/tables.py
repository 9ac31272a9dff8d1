"""Partitioned, clustered tables as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

LAYERS = ("raw", "staging", "intermediate", "marts", "seeds", "quality")


def table_path(root: str, layer: str, name: str) -> str:
    """Where a table of a layer lives below ``root``."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    replace: str = "all",
    layout: str = "range",
) -> int:
    """Write ``df`` as a table, return its row count (observed during the write).

    ``layout`` decides how rows reach the writing tasks. Either way a day or key that
    holds much of the table is cut into many tasks, and rows are sorted in the files.

    - ``range``: by ranges of (day, cluster columns, spread columns), so that each file
      covers a narrow key range. Spark samples the input first, which costs a second
      pass over a plan that does not end in a shuffle.
    - ``rebalance``: by day, with adaptive execution splitting large days into parts of
      the advisory size. One pass; files follow the order of the input.

    ``replace``: ``all`` for a full refresh, ``partitions`` to replace only the days
    present in ``df``, ``nothing`` to append.
    """
    keys = [c for c in (partition_by, *cluster_by, *spread_by) if c]
    rows = df
    if layout == "rebalance" and partition_by:
        rows = rows.hint("rebalance", partition_by)
    elif keys:
        rows = rows.repartitionByRange(*keys)
    if keys:
        rows = rows.sortWithinPartitions(*keys)
    # Counted behind the exchange: a sampling pass would count the input twice.
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("append" if replace == "nothing" else "overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    overwrite = "dynamic" if replace == "partitions" else "static"
    writer.option("partitionOverwriteMode", overwrite).parquet(path)
    return seen.get["rows"]


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partition_by: str | None = None,
    clustered_on: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Register an empty table unless it exists; calling it again changes nothing.

    ``clustered_on`` is kept as a table property, by which ``write_to_table`` sorts. Tables
    with the same number of ``buckets`` on a key join on it without an exchange. A bucket is
    read by one task: for a key that holds much of a table, a counted and broadcast dimension
    (see ``joins``) is the better plan.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioning = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    bucketing = f"CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {int(buckets)} BUCKETS" if bucket_by else ""
    clustering = ", ".join(clustered_on)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioning} {bucketing} "
        f"LOCATION '{path}' TBLPROPERTIES ('cluster.columns' = '{clustering}')"
    )


def write_to_table(df: DataFrame, name: str, replace: str = "all", days: Sequence = ()) -> None:
    """Write ``df`` into a table of the catalog, which then shows exactly these rows.

    ``replace``: ``all``; ``partitions`` for the partitions present in ``df`` and those in
    ``days``, which are empty afterwards if ``df`` has no row for them; ``nothing`` to append.
    The catalog keeps the partitions: readers list no folders.
    """
    spark = df.sparkSession
    columns = spark.catalog.listColumns(name)
    partition = next((c.name for c in columns if c.isPartition), None)
    bucket = next((c.name for c in columns if c.isBucket), None)
    stated = spark.sql(f"SHOW TBLPROPERTIES {name} ('cluster.columns')").first()["value"]
    cluster = [c.strip() for c in stated.split(",") if c.strip()]
    order = list(dict.fromkeys(c for c in (partition, bucket, *cluster) if c))
    rows = df.select(*[c.name for c in columns])
    if order:
        dealt = [c for c in (partition, bucket) if c]
        rows = (rows.hint("rebalance", *dealt) if dealt else rows.repartitionByRange(*order)).sortWithinPartitions(*order)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic" if replace == "partitions" else "static")
    try:
        gone = []
        if replace == "partitions" and partition:
            present = {row[0] for row in df.select(partition).distinct().collect()}  # one row per partition
            gone = [day for day in days if day not in present]
        rows.write.insertInto(name, overwrite=replace != "nothing")
        for day in gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{partition}` = '{day}')")
    finally:
        spark.conf.set(setting, before)
