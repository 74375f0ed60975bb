"""Recursive multi-step forecasts and their daily shadow evaluation.

The state is one row per (origin, zone) holding the recent history as an array. All zones and all
origins advance together, so the number of rounds is the horizon, whatever the number of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import almanac, clock, errors, rules
from kerbside.operators import gates, scoring, series
from kerbside.operators.scoring import BASELINE, FORECAST_HOUR, PREDICTED
from kerbside.operators.series import COUNT, HOUR, ZONE, SeriesShape
from kerbside.plans.demand_models import RoutedModel
from kerbside.session import cut_lineage, stored

ROUNDS_PER_CHECKPOINT = 6

# Calendar features carried per step ahead, with the time they belong to.
CALENDAR_FIELDS = (
    FORECAST_HOUR,
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_us_holiday",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    *almanac.EVENT_COLUMNS,
)


def memory_steps(shape: SeriesShape) -> int:
    return max(*shape.lags, *shape.windows)


def zone_histories(demand: DataFrame, origins: Column, shape: SeriesShape = series.HOURLY) -> DataFrame:
    """(zone, origin, history): the last observed steps before each origin, absent steps 0.

    ``origins`` is an array of wall-clock times. A zone takes part from its first observation on.
    Each group collects exactly the fixed number of history steps.
    """
    steps = memory_steps(shape)
    step = F.expr(f"INTERVAL {shape.step}")
    zones = demand.filter(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(F.min(HOUR).alias("_first"))
    parts = int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        zones.repartition(parts, ZONE)
        .select(ZONE, "_first", F.explode(origins).alias("origin"))
        .filter(F.col("_first") < F.col("origin"))
    )
    back = F.expr(f"INTERVAL {shape.step}") * F.lit(steps)
    needed = pairs.select(
        ZONE, "origin", F.explode(F.sequence(F.col("origin") - back, F.col("origin") - step, step)).alias(HOUR)
    )
    observed = series.presum(demand)
    filled = needed.join(observed, [ZONE, HOUR], "left").select(
        ZONE, "origin", HOUR, F.coalesce(F.col(COUNT).cast("double"), F.lit(0.0)).alias(COUNT)
    )
    past = F.array_sort(F.collect_list(F.struct(HOUR, COUNT)))
    return filled.groupBy(ZONE, "origin").agg(
        F.transform(past, lambda item: item[COUNT]).alias("history")
    )


def with_calendar(state: DataFrame, horizon: int, shape: SeriesShape = series.HOURLY) -> DataFrame:
    """Add the calendar of every step ahead as one array, so that rounds only look it up."""
    step = F.expr(f"INTERVAL {shape.step}")

    def entry(at: Column) -> Column:
        columns = {**almanac.calendar_columns(at), **almanac.event_columns(at)}
        return F.struct(at.alias(FORECAST_HOUR), *[value.alias(name) for name, value in columns.items()])

    times = F.sequence(F.col("origin"), F.col("origin") + step * F.lit(horizon - 1), step)
    return state.withColumn("calendar", F.transform(times, entry))


def step_features(state: DataFrame, shape: SeriesShape, ahead: int) -> DataFrame:
    """Model features of the step ``ahead`` from the history and calendar arrays."""
    past = F.col("history")
    today = F.element_at("calendar", ahead)
    columns = {name: today[name] for name in CALENDAR_FIELDS}
    columns["is_airport_zone"] = F.col(ZONE).isin(*shape.airports).cast("int")
    columns.update({name: F.lit(0.0) for name in series.WEATHER})
    columns["weather_missing"] = F.lit(1)
    columns.update({f"lag_{n}": F.element_at(past, -n) for n in shape.lags})
    for n in shape.windows:
        total = F.aggregate(F.slice(past, -n, n), F.lit(0.0), lambda acc, x: acc + x)
        columns[f"rolling_mean_{n}"] = total / n
    return state.withColumns(columns)


def advance(state: DataFrame, model: RoutedModel, shape: SeriesShape, ahead: int) -> DataFrame:
    """One round: forecast the next step of every row and append it to the history."""
    steps = memory_steps(shape)
    predicted = model.predict(step_features(state, shape, ahead), PREDICTED)
    entry = F.struct(
        F.lit(ahead).alias("horizon_hour"),
        F.col(FORECAST_HOUR),
        F.col(PREDICTED),
        F.col("model_type"),
        F.col("event_code"),
        F.col("is_event_window"),
        F.col("is_us_holiday"),
    )
    return predicted.select(
        ZONE,
        "origin",
        "calendar",
        F.slice(F.concat("history", F.array(PREDICTED)), -steps, steps).alias("history"),
        F.concat("path", F.array(entry)).alias("path") if "path" in state.columns else F.array(entry).alias("path"),
    )


def recursive_forecast(
    demand: DataFrame,
    model: RoutedModel,
    origins: Column,
    horizon: int = 24,
    shape: SeriesShape = series.HOURLY,
) -> DataFrame:
    """Forecast ``horizon`` steps from every origin, feeding predictions back as history."""
    state = cut_lineage(with_calendar(zone_histories(demand, origins, shape), horizon, shape))
    for ahead in range(1, horizon + 1):
        state = advance(state, model, shape, ahead)
        if ahead % ROUNDS_PER_CHECKPOINT == 0 or ahead == horizon:
            state = cut_lineage(state)
    return state.select(ZONE, "origin", F.inline("path"))


def next_origin(demand: DataFrame, shape: SeriesShape = series.HOURLY) -> Column:
    """Array holding the first step after the last observation."""
    last = demand.agg((F.max(clock.trunc(shape.unit, HOUR)) + F.expr(f"INTERVAL {shape.step}")).alias("o"))
    return F.array(last.scalar())


def publishable_forecast(
    demand: DataFrame,
    model: RoutedModel,
    horizon: int = 24,
    shape: SeriesShape = series.HOURLY,
    version: str = "unversioned",
) -> DataFrame:
    """The next ``horizon`` steps in output form; fails when a forecast check fails."""
    rows = recursive_forecast(demand, model, next_origin(demand, shape), horizon, shape)
    checks = gates.forecast_checks(rows, demand.select(ZONE), horizon, shape.airports)
    failed = [row.check for row in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"Forecast failed validation: {', '.join(failed)}")
    return rows.select(
        F.current_timestamp().alias("forecast_generated_at"),
        FORECAST_HOUR,
        ZONE,
        PREDICTED,
        "model_type",
        F.lit(version).alias("model_version"),
        "event_code",
        "is_event_window",
    )


def zones_at(demand: DataFrame, origins: Column) -> DataFrame:
    """(zone, origin): the zones that have been observed before each origin."""
    zones = demand.filter(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(F.min(HOUR).alias("_first"))
    return zones.select(ZONE, "_first", F.explode(origins).alias("origin")).filter("_first < origin").select(ZONE, "origin")


def daily_origins(first_day: str, last_day: str) -> Column:
    start, end = (F.to_timestamp_ntz(F.lit(f"{day} 00:00:00")) for day in (first_day, last_day))
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def shadow_forecast(
    demand: DataFrame,
    model: RoutedModel,
    first_day: str,
    last_day: str,
    horizon: int = 24,
    shape: SeriesShape = series.HOURLY,
) -> DataFrame:
    """Forecast each day of a range from earlier data only, with actuals and baseline joined.

    A day none of whose hours has actuals is an error, and so are a model whose training reaches into the first day's month
    and a day whose forecast fails a check; hours after the last actual aren't scored.
    """
    if model.trained and model.trained[1][:7] >= first_day[:7]:
        raise ValueError(f"Model training until {model.trained[1]} must end before the month of the first day, {first_day}")
    origins = demand.sparkSession.range(1).select(F.explode(daily_origins(first_day, last_day)).alias("origin"))
    hours = memory_steps(shape) * (24 if shape.unit == "day" else 1)
    if not gates.short_history(demand, origins, hours).isEmpty():
        raise ValueError(f"At least {hours} hours of history are required before the first day")
    missing = gates.days_without_actuals(demand, origins)
    if days := [str(row.day) for row in missing.orderBy("day").limit(10).collect()]:
        raise ValueError(f"No actuals for {', '.join(days)}")
    forecast = recursive_forecast(demand, model, daily_origins(first_day, last_day), horizon, shape)
    zones = zones_at(demand, daily_origins(first_day, last_day))
    failed = gates.forecast_checks_by(forecast, zones, horizon, shape.airports, "origin").filter(~F.col("passed"))
    if broken := [f"{row.check} on {row.day}" for row in failed.select("check", F.to_date("origin").alias("day")).take(10)]:
        raise ValueError(f"Forecast failed validation: {', '.join(sorted(broken))}")
    forecast = scoring.matured(forecast, demand)
    joined = scoring.join_previous_week(scoring.join_actuals(forecast, demand), demand)
    return joined.withColumns(
        {
            "hour": F.hour(FORECAST_HOUR),
            "market": rules.market(ZONE, shape.airports),
            "calendar_segment": rules.calendar_segment(
                F.col("is_event_window"),
                F.col("is_us_holiday"),
                clock.monday_first_weekday(FORECAST_HOUR),
            ),
        }
    )


def daily_scores(scored: DataFrame) -> DataFrame:
    """Per origin: candidate and baseline measures, improvement, win and drift verdict.

    High demand is defined by each day's own 0.9 quantile.
    """
    truth = F.col(COUNT)
    limits = scored.groupBy("origin").agg(
        F.percentile(COUNT, F.lit(scoring.HIGH_DEMAND_QUANTILE)).alias("_threshold")
    )
    limit = F.col("_threshold")
    candidate = errors.measures(truth, F.col(PREDICTED), limit)
    baseline = errors.measures(truth, F.col(BASELINE), limit)
    daily = (
        scored.join(limits, "origin")
        .groupBy(F.to_date("origin").alias("day"))
        .agg(
            *[value.alias(name) for name, value in candidate.items()],
            errors.bias(truth, F.col(PREDICTED)).alias("bias"),
            baseline["wape"].alias("baseline_wape"),
        )
        .withColumns(
            {
                "relative_wape_improvement": errors.relative_improvement(
                    F.col("baseline_wape"), F.col("wape")
                ),
                "candidate_won": F.col("wape") < F.col("baseline_wape"),
            }
        )
    )
    return scoring.with_drift(daily)


def shadow_evaluation(
    demand: DataFrame,
    model: RoutedModel,
    first_day: str,
    last_day: str,
    shape: SeriesShape = series.HOURLY,
) -> dict[str, DataFrame]:
    """Scored rows, daily record, overall report and segments of a shadow period."""
    scored = stored(shadow_forecast(demand, model, first_day, last_day, 24, shape), "shadow")
    return {
        "scored": scored,
        "daily": daily_scores(scored),
        "overall": scoring.overall_report(scored),
        "segments": scoring.shadow_segments(scored),
    }
