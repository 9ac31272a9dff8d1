"""Full and incremental refresh of the model tables below one root folder.

Tables are published by version (see ``operators.versions``), so a refresh that dies leaves
every table as it was, and any subset of the models can run from what is stored.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.asof import AsOf
from tickloom.operators import versions
from tickloom.operators.keys import extend_keys
from tickloom.operators.tables import table_path, write_table
from tickloom.plans import extensions, models, quality

STATUS_SCHEMA = "model STRING, status STRING, row_count BIGINT, message STRING"
# Models that may run at the same time.
TOGETHER = 4


@dataclass(frozen=True)
class Model:
    """A table: how to build it from the tables it needs, and how it is laid out."""

    name: str
    layer: str
    build: Callable[["Built"], DataFrame]
    needs: tuple[str, ...] = ()
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    spread_by: tuple[str, ...] = ()
    layout: str = "range"
    # The days an incremental run replaces, where they are not those of the input.
    days: Callable[["Built"], list[datetime.date]] | None = None


@dataclass
class Built:
    """What a model is built from: the input ticks and the published tables.

    ``days`` are those of the input in an incremental run, ``None`` in a full one.
    """

    ticks: DataFrame
    as_of: AsOf
    root: str
    days: list[datetime.date] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.ticks.sparkSession

    def whole(self, name: str) -> DataFrame:
        model = BY_NAME[name]
        return versions.current(self.spark, table_path(self.root, model.layer, name), model.partition_by)

    def earlier(self, name: str) -> DataFrame | None:
        """The table as published before, if it was."""
        try:
            return self.whole(name)
        except FileNotFoundError:
            return None

    def __getitem__(self, name: str) -> DataFrame:
        """The table; in an incremental run only the days of the input."""
        table = self.whole(name)
        by = BY_NAME[name].partition_by
        return table if self.days is None or by is None else table.filter(F.col(by).isin(self.days))


def _ticker_keys(built: Built) -> DataFrame:
    seen = built.ticks.select("ticker", "sector").distinct()
    return extend_keys(built.earlier("keys_ticker"), seen, "ticker_sk", ["ticker", "sector"])


def _sector_keys(built: Built) -> DataFrame:
    seen = built["keys_ticker"].select("sector").distinct()
    return extend_keys(built.earlier("keys_sector"), seen, "sector_sk", ["sector"])


def _dim_ticker(built: Built) -> DataFrame:
    """Spans of the input, widened by the stored ones in an incremental run."""
    spans = models.ticker_spans(built.ticks)
    stored = built.earlier("dim_ticker") if built.days is not None else None
    if stored is not None:
        before = stored.select(F.col("ticker_code").alias("ticker"), "sector", "first_seen_date", "last_seen_date")
        spans = spans.unionByName(before).groupBy("ticker", "sector").agg(
            F.min("first_seen_date").alias("first_seen_date"), F.max("last_seen_date").alias("last_seen_date")
        )
    return models.dim_ticker(built.ticks, built.as_of, spans, built["keys_ticker"])


def _fact(built: Built) -> DataFrame:
    fact = models.fct_intraday_ticks(built.ticks, built["dim_ticker"], built["dim_sector"])
    return fact.selectExpr("*", "to_date(timestamp) AS date_id")


def _hourly(built: Built) -> DataFrame:
    hourly = extensions.sector_hourly(models.staged_ticks(built.ticks, built.as_of))
    return hourly.withColumn("date_id", F.to_date("hour_bucket"))


def _yesterday(built: Built) -> list[datetime.date]:
    return [built.spark.range(1).select(built.as_of.days_before_today(1)).first()[0]]


# In an order in which every model comes after those it needs. Each table is read back from
# storage by the ones after it, so the daily statistics are computed once for their readers.
MODELS = [
    Model("keys_ticker", "intermediate", _ticker_keys, cluster_by=("ticker",)),
    Model("keys_sector", "intermediate", _sector_keys, ("keys_ticker",)),
    Model("dim_ticker", "intermediate", _dim_ticker, ("keys_ticker",), cluster_by=("ticker_code",)),
    Model("dim_sector", "intermediate", lambda b: models.dim_sector(b["dim_ticker"], keys=b["keys_sector"]), ("dim_ticker", "keys_sector")),
    # As large as the ticks themselves: written in one pass.
    Model("fct_intraday_ticks", "marts", _fact, ("dim_ticker", "dim_sector"), "date_id", ("ticker_sk", "sector_sk"), ("timestamp",), "rebalance"),
    Model("agg_sector_hourly", "marts", _hourly, (), "date_id", ("sector",)),
    Model(
        "int_daily_stock_stats",
        "intermediate",
        lambda b: models.daily_stock_stats(models.staged_ticks(b.ticks, b.as_of)),
        (),
        "date_id",
        ("ticker",),
        ("sector",),
    ),
    Model("int_sector_daily_summary", "intermediate", lambda b: models.sector_daily_summary(b["int_daily_stock_stats"]), ("int_daily_stock_stats",), "date_id", ("sector",)),
    Model("int_ticker_rankings", "intermediate", lambda b: models.ticker_rankings(b["int_daily_stock_stats"]), ("int_daily_stock_stats",), "date_id", ("sector", "volume_rank")),
    Model("mrt_top5_sector_daily", "marts", lambda b: models.top5_sector_daily(b["int_ticker_rankings"], ordered=False), ("int_ticker_rankings",), "date_id", ("sector", "volume_rank")),
    Model("mrt_sector_performance", "marts", lambda b: models.sector_performance(b["int_sector_daily_summary"], ordered=False), ("int_sector_daily_summary",), "date_id", ("sector_performance_rank",)),
    Model("mrt_market_breadth", "marts", lambda b: models.market_breadth(b["int_daily_stock_stats"], ordered=False), ("int_daily_stock_stats",), "date_id"),
    # Compares yesterday with its week, whatever days the input has.
    Model("mrt_volume_anomalies", "marts", lambda b: models.volume_anomalies(b.whole("int_daily_stock_stats"), b.as_of, ordered=False), ("int_daily_stock_stats",), "date_id", ("ticker",), days=_yesterday),
]
BY_NAME = {model.name: model for model in MODELS}


def refresh(
    ticks: DataFrame, root: str, as_of: AsOf = AsOf(), only: set[str] | None = None, replace: str = "all"
) -> DataFrame:
    """Build and publish the models; one status row per model, in the order of ``MODELS``.

    A model runs as soon as those it needs are done, some at the same time. A failing model is
    reported, its table stays as it was, and models that need it are skipped and reported.
    ``only`` runs some models; tables that they need beyond these are read as published.

    ``replace="all"`` replaces whole tables. ``replace="partitions"`` replaces the days that
    occur in ``ticks``, also where a model has no row for one of them. Surrogate keys once given
    are kept either way; new tickers and sectors are numbered above them.
    """
    spark = ticks.sparkSession
    days = None
    if replace == "partitions":
        day = F.to_date("timestamp").alias("day")
        days = sorted(row["day"] for row in ticks.select(day).filter("day IS NOT NULL").distinct().collect())
    built = Built(ticks, as_of, root, days)
    staged = models.staged_ticks(ticks, as_of)
    staged.createOrReplaceTempView("stg_sector_ticks")
    wanted = [m for m in MODELS if only is None or m.name in only]
    waiting, done = {m.name: m for m in wanted}, {}
    while waiting:
        ready = [m for m in waiting.values() if not any(n in waiting for n in m.needs)]
        with ThreadPoolExecutor(TOGETHER) as pool:
            task = inheritable_thread_target(spark)(lambda m: _refresh_one(m, built, done))
            for model, row in zip(ready, list(pool.map(task, ready))):
                done[model.name] = row
                del waiting[model.name]
    status = [("stg_sector_ticks", "ok", None, "view"), *[done[m.name] for m in wanted]]
    return spark.createDataFrame(status, STATUS_SCHEMA)


def _refresh_one(model: Model, built: Built, done: dict[str, tuple]) -> tuple:
    path = table_path(built.root, model.layer, model.name)
    broken = [n for n in model.needs if n in done and done[n][1] != "ok"]
    if broken:
        return (model.name, "skipped", None, f"needs {', '.join(broken)}")
    try:
        frame = model.build(built)
        days = None
        if built.days is not None and model.partition_by:
            days = built.days if model.days is None else model.days(built)
        rows = versions.publish(frame, path, model.partition_by, model.cluster_by, model.spread_by, model.layout, days)
        return (model.name, "ok", rows, path)
    except Exception as error:
        return (model.name, "failed", None, f"{type(error).__name__}: {error}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model table as last published."""
    model = BY_NAME[name]
    return versions.current(spark, table_path(root, model.layer, name), model.partition_by)


def append_quality_log(ticks: DataFrame, root: str, as_of: AsOf = AsOf(), batch_id: str = "manual") -> DataFrame:
    """Evaluate the tick checks and append their rows to the quality log."""
    path = table_path(root, "quality", "dq_check_results")
    checks = [*quality.tick_checks(as_of), quality.missing_keys(), *quality.expression_checks(), quality.accepted_sector_check()]
    log = quality.result_log(quality.evaluate(ticks, checks), as_of, batch_id)
    dated = log.selectExpr("*", "to_date(execution_ts) AS execution_date")
    write_table(dated, path, "execution_date", ("check_name",), replace="nothing")
    return ticks.sparkSession.read.schema(dated.schema).parquet(path)
