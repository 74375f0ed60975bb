"""Dense entity-by-time series, calendar features, lags and time splits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import almanac, clock, rules
from kerbside.session import broadcast_if_small
from kerbside.sources.tables import require_columns

ZONE, HOUR, COUNT = "pickup_zone_id", "pickup_hour", "trip_count"
WEATHER = ("temperature_c", "precipitation_mm")
GRID_ROWS_PER_TASK = 500_000  # rows of the dense grid that one task generates


@dataclass(frozen=True)
class SeriesShape:
    """Time step and look-back of a series; the defaults describe hourly demand."""

    # Step, lags and rolling windows of the hourly model.
    step: str = "1 HOUR"
    unit: str = "hour"
    lags: tuple[int, ...] = (1, 2, 24, 168)
    windows: tuple[int, ...] = (3, 6, 24)
    week: int = 168  # steps of the baseline, the same time a week before
    airports: tuple[int, ...] = field(default=rules.AIRPORT_ZONE_IDS)

    @property
    def lag_columns(self) -> list[str]:
        return [f"lag_{n}" for n in self.lags]

    @property
    def rolling_columns(self) -> list[str]:
        return [f"rolling_mean_{n}" for n in self.windows]

    @property
    def feature_columns(self) -> list[str]:
        return [
            ZONE,
            "hour",
            "day_of_week",
            "month",
            "is_weekend",
            "is_us_holiday",
            *almanac.EVENT_COLUMNS,
            "is_airport_zone",
            *WEATHER,
            "weather_missing",
            "hour_sin",
            "hour_cos",
            "dow_sin",
            "dow_cos",
            *self.lag_columns,
            *self.rolling_columns,
        ]


HOURLY = SeriesShape()


def presum(demand: DataFrame) -> DataFrame:
    """One row per zone and time, duplicates added up."""
    require_columns(demand, {ZONE, HOUR, COUNT})
    return demand.groupBy(ZONE, HOUR).agg(F.sum(COUNT).alias(COUNT))


def time_grid(demand: DataFrame, shape: SeriesShape = HOURLY) -> DataFrame:
    """Every zone at every step between the first and last observed time.

    Each zone generates its own times, so nothing is cross joined and the zones stay hash
    partitioned for the windows that follow. There are as many partitions as the grid's size needs.
    """
    at = clock.trunc(shape.unit, HOUR)
    ends = demand.agg(F.min(at).alias("first"), F.max(at).alias("last"))
    times = F.sequence(
        ends.select("first").scalar(), ends.select("last").scalar(), F.expr(f"INTERVAL {shape.step}")
    )
    steps = F.size(F.sequence(F.min(at), F.max(at), F.expr(f"INTERVAL {shape.step}")))
    cells = demand.agg((F.approx_count_distinct(ZONE) * steps).alias("cells")).first().cells or 0
    # More partitions than a shuffle would have by itself: else adaptive execution merges them by the size of the bare zones.
    parts = int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    parts = max(parts, -(-cells // GRID_ROWS_PER_TASK))
    zones = demand.filter(F.col(ZONE).isNotNull()).select(ZONE).distinct().repartition(parts, ZONE)
    return zones.select(ZONE, F.explode(times).alias(HOUR))


def dense_series(demand: DataFrame, shape: SeriesShape = HOURLY) -> DataFrame:
    """Grid left-joined with the observed counts, absent counts 0."""
    observed = presum(demand)
    return (
        time_grid(demand, shape)
        .join(observed, [ZONE, HOUR], "left")
        .withColumn(COUNT, F.coalesce(F.col(COUNT).cast("double"), F.lit(0.0)))
    )


def grid_calendar(demand: DataFrame, shape: SeriesShape = HOURLY) -> DataFrame:
    """Calendar and events of every step between the first and last observed time, one row each."""
    observed = clock.trunc(shape.unit, HOUR)
    ends = demand.agg(F.min(observed).alias("first"), F.max(observed).alias("last"))
    steps = ends.select(F.explode(F.sequence("first", "last", F.expr(f"INTERVAL {shape.step}"))).alias(HOUR))
    at = F.col(HOUR)
    return steps.select(
        HOUR, *[c.alias(n) for n, c in {**almanac.calendar_columns(at), **almanac.event_columns(at)}.items()]
    )


def join_calendar(series: DataFrame, calendar: DataFrame) -> DataFrame:
    return series.join(broadcast_if_small(calendar), HOUR, "left")


def join_weather(series: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Hourly weather, 0 where absent, with a flag for absent temperature."""
    if weather is None:
        series = series.withColumns({name: F.lit(None).cast("double") for name in WEATHER})
    else:
        require_columns(weather, {HOUR, *WEATHER}, "weather columns")
        hourly = weather.select(clock.trunc("hour", HOUR).alias(HOUR), *WEATHER)
        series = series.join(broadcast_if_small(hourly), HOUR, "left")
    return series.withColumns(
        {
            "weather_missing": F.col("temperature_c").isNull().cast("int"),
            **{name: F.coalesce(F.col(name), F.lit(0.0)) for name in WEATHER},
        }
    )


def _zone_order():
    return Window.partitionBy(ZONE).orderBy(HOUR)


def lag_columns(shape: SeriesShape = HOURLY) -> dict[str, Column]:
    return {f"lag_{n}": F.lag(COUNT, n).over(_zone_order()) for n in shape.lags}


def with_rolling(series: DataFrame, shape: SeriesShape = HOURLY) -> DataFrame:
    """Mean of the preceding rows, current excluded, NULL until the window is full.

    A window sum is the difference of two running totals, so its cost does not depend on its length.
    """
    order = _zone_order()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    running = series.withColumns(
        {"_before": F.coalesce(F.sum(COUNT).over(before), F.lit(0.0)), "_row": F.row_number().over(order)}
    )
    means = {
        f"rolling_mean_{n}": F.when(
            F.col("_row") > n, (F.col("_before") - F.lag("_before", n).over(order)) / F.lit(float(n))
        )
        for n in shape.windows
    }
    return running.withColumns(means).drop("_before", "_row")


def with_history(series: DataFrame, shape: SeriesShape = HOURLY) -> DataFrame:
    """Lags and rolling means; all share one partitioning and one sort."""
    return with_rolling(series.withColumns(lag_columns(shape)), shape)


def feature_table(
    demand: DataFrame, weather: DataFrame | None = None, shape: SeriesShape = HOURLY
) -> DataFrame:
    """Dense series with calendar, event, weather and history features; incomplete rows dropped.

    History is computed before the wide joins, on three columns, and warm-up rows leave early.
    """
    history = with_history(dense_series(demand, shape), shape).na.drop(
        subset=[*shape.lag_columns, *shape.rolling_columns]
    )
    known = join_weather(join_calendar(history, grid_calendar(demand, shape)), weather)
    return known.withColumn("is_airport_zone", F.col(ZONE).isin(*shape.airports).cast("int")).select(
        *shape.feature_columns, HOUR, COUNT
    )


@dataclass(frozen=True)
class TimeSplit:
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    months: tuple[str, str, str]


def split_roles(frame: DataFrame) -> DataFrame:
    """Add ``split``: the last month tests, the one before validates, the rest trains."""
    months = frame.select(clock.month_label(HOUR).alias("period")).distinct()
    order = Window.partitionBy().orderBy(F.desc("period"))
    ranked = months.withColumn("_rank", F.dense_rank().over(order))
    role = F.when(F.col("_rank") == 1, "test").when(F.col("_rank") == 2, "validation").otherwise("train")
    roles = ranked.select("period", role.alias("split"))
    return frame.withColumn("period", clock.month_label(HOUR)).join(broadcast_if_small(roles, store="split-roles"), "period")


def time_split(frame: DataFrame) -> TimeSplit:
    """Chronological split by calendar month; needs at least three months."""
    months = [
        row.period
        for row in frame.select(clock.month_label(HOUR).alias("period")).distinct().orderBy("period").tail(3)
    ]
    if len(months) < 3:
        raise ValueError("At least three calendar months are required for a chronological split")
    before, validation, test = months
    bounds = [F.to_timestamp_ntz(F.lit(f"{month}-01 00:00:00")) for month in (validation, test)]
    at = F.col(HOUR)
    return TimeSplit(
        train=frame.filter(at < bounds[0]),
        validation=frame.filter((at >= bounds[0]) & (at < bounds[1])),
        test=frame.filter(at >= bounds[1]),
        months=(before, validation, test),
    )
