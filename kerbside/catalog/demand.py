"""Dense series, calendars, features, scoring, gates and loss-day analyses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbside.catalog.registry import query
from kerbside.catalog.support import dates_as_text, rounded
from kerbside.catalog.tables import DAILY, Tables, with_views
from kerbside.functions import almanac, clock, errors, rules
from kerbside.operators import gates, loss_days, scoring, series
from kerbside.operators.series import COUNT, HOUR, ZONE
from kerbside.plans import backtest, recursion
from kerbside.session import stored
from kerbside.sources import tables


def _chain(body: str, *names: str, **ctes: str) -> str:
    """Views first, then further CTEs in order, then the body."""
    head = with_views("", *names).rstrip()
    return head + "".join(f", {name} AS ({text})" for name, text in ctes.items()) + " " + body


# Calendar. The oracles list event days by scanning real days, not by the rules of the library.

_DAYS = """SELECT CAST(unnest(generate_series(TIMESTAMP '1993-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS d"""
_EVENT_DAYS = """SELECT d, CASE WHEN month(d) = 1 THEN 1 WHEN month(d) = 7 THEN 2 WHEN month(d) = 11 THEN 3
    WHEN month(d) = 12 THEN 4 ELSE 5 END AS code FROM days
  WHERE (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25)
    OR (month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28) OR (month(d) = 5 AND isodow(d) = 1 AND day(d) >= 25)"""
_TIMES = "SELECT DISTINCT date_trunc('hour', ts) AS tick FROM events UNION SELECT l_shipdate FROM lineitem UNION SELECT o_orderdate + INTERVAL 20 HOUR FROM orders"
_EVENT_SQL = """SELECT t.tick AS pickup_hour, coalesce(c.code, 0) AS event_code,
    CASE WHEN c.code IS NOT NULL OR n.code = 5 OR ny THEN 1 ELSE 0 END AS is_event_window,
    CASE WHEN n.code IS NOT NULL THEN 1 ELSE 0 END AS is_event_eve,
    CASE WHEN month(t.tick) = 1 AND day(t.tick) = 1 AND hour(t.tick) <= 5 THEN 1 ELSE 0 END AS is_event_overnight,
    CASE WHEN ny THEN 1 ELSE 0 END AS is_new_year_window,
    round(least(168e0, (SELECT min(epoch(CAST(d AS TIMESTAMP)) - epoch(t.tick)) / 3600e0 FROM event_days WHERE CAST(d AS TIMESTAMP) >= t.tick)), 6)
      AS hours_to_major_event,
    round(least(168e0, (SELECT min(epoch(t.tick) - epoch(CAST(d AS TIMESTAMP))) / 3600e0 FROM event_days WHERE CAST(d AS TIMESTAMP) <= t.tick)), 6)
      AS hours_since_major_event
  FROM (SELECT tick, (month(tick) = 12 AND day(tick) = 31 AND hour(tick) >= 18) OR (month(tick) = 1 AND day(tick) = 1 AND hour(tick) <= 6) AS ny
    FROM times) t
  LEFT JOIN event_days c ON c.d = CAST(t.tick AS DATE) LEFT JOIN event_days n ON n.d = CAST(t.tick AS DATE) + 1"""
_HOLIDAY = """CASE WHEN strftime({at}, '%m-%d') IN ('01-01', '06-19', '07-04', '11-11', '12-25')
    OR (month({at}) IN (1, 2) AND isodow({at}) = 1 AND day({at}) BETWEEN 15 AND 21)
    OR (month({at}) = 5 AND isodow({at}) = 1 AND day({at}) BETWEEN 22 AND 28)
    OR (month({at}) = 9 AND isodow({at}) = 1 AND day({at}) <= 7)
    OR (month({at}) = 11 AND isodow({at}) = 4 AND day({at}) BETWEEN 22 AND 28) THEN 1 ELSE 0 END"""


def _times(t: Tables) -> DataFrame:
    hours = t.base("events").select(clock.trunc("hour", "ts").alias(HOUR))
    days = t.base("lineitem").select(F.col("l_shipdate").alias(HOUR))
    evenings = t.base("orders").select(clock.shift("o_orderdate", hours=20).alias(HOUR))
    return hours.unionByName(days).unionByName(evenings).distinct()


@query("us_holiday", f"WITH times AS ({_TIMES}) SELECT tick AS pickup_hour, {_HOLIDAY.format(at='tick')} AS is_us_holiday FROM times")
def us_holiday(t: Tables) -> DataFrame:
    return _times(t).select(HOUR, almanac.is_us_holiday(F.col(HOUR)).alias("is_us_holiday"))


@query(
    "event_dates",
    f"""WITH days AS ({_DAYS}), event_days AS ({_EVENT_DAYS}) SELECT CAST(d AS VARCHAR) AS event_date, code AS event_code
    FROM event_days WHERE year(d) IN (SELECT year(o_orderdate) FROM orders)""",
)
def event_dates(t: Tables) -> DataFrame:
    years = t.base("orders").select(F.year("o_orderdate").alias("year")).distinct()
    dates = [
        F.struct(date.cast("string").alias("event_date"), F.lit(almanac.EVENT_CODES[name]).alias("event_code"))
        for name, date in almanac.events_of_year(F.col("year"))
    ]
    return years.select(F.inline(F.array(*dates)))


@query("event_features", f"WITH days AS ({_DAYS}), event_days AS ({_EVENT_DAYS}), times AS ({_TIMES}) {_EVENT_SQL}")
def event_features(t: Tables) -> DataFrame:
    columns = almanac.event_columns(F.col(HOUR))
    return rounded(_times(t).select(HOUR, *[c.alias(n) for n, c in columns.items()]))


@query(
    "calendar_features",
    f"""WITH times AS ({_TIMES}) SELECT tick AS pickup_hour, hour(tick) AS hour, isodow(tick) - 1 AS day_of_week, month(tick) AS month,
      CASE WHEN isodow(tick) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM times""",
)
def calendar_features(t: Tables) -> DataFrame:
    columns = almanac.calendar_columns(F.col(HOUR))
    wanted = ("hour", "day_of_week", "month", "is_weekend")
    return _times(t).select(HOUR, *[columns[n].alias(n) for n in wanted])


@query(
    "cyclic_features",
    f"""WITH times AS ({_TIMES}) SELECT tick AS pickup_hour, round(sin(2 * pi() * hour(tick) / 24), 6) + 0e0 AS hour_sin,
      round(cos(2 * pi() * hour(tick) / 24), 6) + 0e0 AS hour_cos, round(sin(2 * pi() * (isodow(tick) - 1) / 7), 6) + 0e0 AS dow_sin,
      round(cos(2 * pi() * (isodow(tick) - 1) / 7), 6) + 0e0 AS dow_cos FROM times""",
)
def cyclic_features(t: Tables) -> DataFrame:
    columns = almanac.calendar_columns(F.col(HOUR))
    wanted = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return rounded(_times(t).select(HOUR, *[columns[n].alias(n) for n in wanted]))


# Dense series.


@query(
    "period_presum",
    """SELECT l_suppkey % 25 + 120 AS pickup_zone_id, l_shipdate AS pickup_hour, CAST(sum(l_linenumber) AS BIGINT) AS trip_count
    FROM lineitem GROUP BY 1, 2""",
)
def period_presum(t: Tables) -> DataFrame:
    rows = t.base("lineitem").select(
        (F.col("l_suppkey") % 25 + 120).alias(ZONE), F.col("l_shipdate").alias(HOUR), F.col("l_linenumber").alias(COUNT)
    )
    return series.presum(rows)


@query("grid_cross_join", with_views("SELECT pickup_zone_id, pickup_hour FROM grid", "grid"))
def grid_cross_join(t: Tables) -> DataFrame:
    return series.time_grid(t.hourly)


@query("join_grid_left", with_views("SELECT * FROM grid", "grid"))
def join_grid_left(t: Tables) -> DataFrame:
    return series.dense_series(t.hourly)


@query("distinct_zones", with_views("SELECT DISTINCT pickup_zone_id FROM hourly", "hourly"))
def distinct_zones(t: Tables) -> DataFrame:
    return t.hourly.select(ZONE).distinct()


@query("distinct_hours", with_views("SELECT DISTINCT pickup_hour FROM hourly", "hourly"))
def distinct_hours(t: Tables) -> DataFrame:
    return t.hourly.select(HOUR).distinct()


@query(
    "join_calendar",
    with_views(
        f"""SELECT pickup_zone_id, pickup_hour, trip_count, hour(pickup_hour) AS hour, {_HOLIDAY.format(at='pickup_hour')} AS is_us_holiday,
        CASE WHEN isodow(pickup_hour) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM grid""",
        "grid",
    ),
)
def join_calendar(t: Tables) -> DataFrame:
    joined = series.join_calendar(series.dense_series(t.hourly), series.grid_calendar(t.hourly))
    return joined.select(ZONE, HOUR, COUNT, "hour", "is_us_holiday", "is_weekend")


def weather(t: Tables) -> DataFrame:
    at = clock.trunc("hour", "ts")
    return (
        t.base("events")
        .filter(F.hour("ts") % 5 != 0)
        .groupBy(at.alias(HOUR))
        .agg((F.max("value") / 20).alias("temperature_c"), (F.count("*") % 7).cast("double").alias("precipitation_mm"))
    )


_WEATHER = """SELECT date_trunc('hour', ts) AS pickup_hour, max(value) / 20 AS temperature_c,
    CAST(count(*) % 7 AS DOUBLE) AS precipitation_mm FROM events WHERE hour(ts) % 5 <> 0 GROUP BY 1"""


@query(
    "join_weather",
    _chain(
        """SELECT g.pickup_zone_id, g.pickup_hour, coalesce(temperature_c, 0) AS temperature_c,
        coalesce(precipitation_mm, 0) AS precipitation_mm, CASE WHEN temperature_c IS NULL THEN 1 ELSE 0 END AS weather_missing
        FROM grid g LEFT JOIN weather w USING (pickup_hour)""",
        "grid",
        weather=_WEATHER,
    ),
)
def join_weather(t: Tables) -> DataFrame:
    joined = series.join_weather(series.time_grid(t.hourly), weather(t))
    return joined.select(ZONE, HOUR, "temperature_c", "precipitation_mm", "weather_missing")


def _window_sql(lags, windows) -> str:
    over = "PARTITION BY pickup_zone_id ORDER BY pickup_hour"
    parts = [f"lag(trip_count, {n}) OVER ({over}) AS lag_{n}" for n in lags]
    for n in windows:
        frame = f"({over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        parts.append(
            f"CASE WHEN count(trip_count) OVER {frame} = {n} THEN avg(trip_count) OVER {frame} END AS rolling_mean_{n}"
        )
    return ", ".join(parts)


@query(
    "lag_features",
    with_views(f"SELECT pickup_zone_id, pickup_hour, {_window_sql(series.HOURLY.lags, ())} FROM grid", "grid"),
)
def lag_features(t: Tables) -> DataFrame:
    lagged = series.dense_series(t.hourly).withColumns(series.lag_columns())
    return lagged.select(ZONE, HOUR, *series.HOURLY.lag_columns)


_ROLLED = ", ".join(f"round(rolling_mean_{n}, 6) AS rolling_mean_{n}" for n in series.HOURLY.windows)


@query(
    "rolling_mean_features",
    with_views(
        f"SELECT pickup_zone_id, pickup_hour, {_ROLLED} FROM (SELECT *, {_window_sql((), series.HOURLY.windows)} FROM grid)",
        "grid",
    ),
)
def rolling_mean_features(t: Tables) -> DataFrame:
    rolled = series.with_rolling(series.dense_series(t.hourly))
    return rounded(rolled.select(ZONE, HOUR, *series.HOURLY.rolling_columns))


_HIST = f"SELECT *, {_window_sql(series.HOURLY.lags, series.HOURLY.windows)} FROM grid"
_FEATURES = f"""SELECT h.pickup_zone_id, h.pickup_hour, h.trip_count, hour(h.pickup_hour) AS hour, isodow(h.pickup_hour) - 1 AS day_of_week,
    month(h.pickup_hour) AS month, CASE WHEN isodow(h.pickup_hour) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    {_HOLIDAY.format(at='h.pickup_hour')} AS is_us_holiday, e.event_code, e.is_event_window, e.is_event_eve, e.is_event_overnight,
    e.is_new_year_window, e.hours_to_major_event, e.hours_since_major_event,
    CASE WHEN h.pickup_zone_id IN (132, 138) THEN 1 ELSE 0 END AS is_airport_zone,
    coalesce(w.temperature_c, 0) AS temperature_c, coalesce(w.precipitation_mm, 0) AS precipitation_mm,
    CASE WHEN w.temperature_c IS NULL THEN 1 ELSE 0 END AS weather_missing,
    round(sin(2 * pi() * hour(h.pickup_hour) / 24), 6) + 0e0 AS hour_sin, round(cos(2 * pi() * hour(h.pickup_hour) / 24), 6) + 0e0 AS hour_cos,
    round(sin(2 * pi() * (isodow(h.pickup_hour) - 1) / 7), 6) + 0e0 AS dow_sin,
    round(cos(2 * pi() * (isodow(h.pickup_hour) - 1) / 7), 6) + 0e0 AS dow_cos,
    {", ".join(f"h.lag_{n}" for n in series.HOURLY.lags)}, {", ".join(f"round(h.rolling_mean_{n}, 6) AS rolling_mean_{n}" for n in series.HOURLY.windows)}
  FROM hist h JOIN ev e ON e.pickup_hour = h.pickup_hour LEFT JOIN weather w ON w.pickup_hour = h.pickup_hour
  WHERE h.lag_168 IS NOT NULL AND h.rolling_mean_24 IS NOT NULL"""


@query(
    "feature_table",
    _chain(
        _FEATURES,
        "grid",
        days=_DAYS,
        event_days=_EVENT_DAYS,
        times="SELECT DISTINCT pickup_hour AS tick FROM grid",
        ev=_EVENT_SQL,
        weather=_WEATHER,
        hist=_HIST,
    ),
)
def feature_table(t: Tables) -> DataFrame:
    inexact = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", *series.HOURLY.rolling_columns)
    return rounded(series.feature_table(t.hourly, weather(t)), only=inexact)


_DAY_HIST = f"SELECT *, {_window_sql(DAILY.lags, DAILY.windows)} FROM day_grid"
_SPLIT = """SELECT *, strftime(pickup_hour, '%Y-%m') AS period FROM hist WHERE lag_28 IS NOT NULL"""
_ROLES = """SELECT period, CASE dense_rank() OVER (ORDER BY period DESC) WHEN 1 THEN 'test' WHEN 2 THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT DISTINCT period FROM f)"""


def day_history(t: Tables) -> DataFrame:
    """The daily series with its lags, warm-up rows dropped; written once, read several times."""
    if "day-history" not in t.kept:
        history = series.with_history(series.dense_series(t.daily, DAILY), DAILY)
        t.kept["day-history"] = stored(history.na.drop(subset=DAILY.lag_columns), "day-history")
    return t.kept["day-history"]


@query(
    "time_split",
    _chain(
        "SELECT split, count(*) AS rows, min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour FROM f JOIN roles USING (period) GROUP BY 1",
        "day_grid",
        hist=_DAY_HIST,
        f=_SPLIT,
        roles=_ROLES,
    ),
)
def time_split(t: Tables) -> DataFrame:
    return (
        series.split_roles(day_history(t))
        .groupBy("split")
        .agg(F.count("*").alias("rows"), F.min(HOUR).alias("first_hour"), F.max(HOUR).alias("last_hour"))
    )


@query(
    "concat_train_validation",
    _chain(
        "SELECT pickup_zone_id, pickup_hour, trip_count FROM f JOIN roles USING (period) WHERE split <> 'test'",
        "day_grid",
        hist=_DAY_HIST,
        f=_SPLIT,
        roles=_ROLES,
    ),
)
def concat_train_validation(t: Tables) -> DataFrame:
    split = series.time_split(day_history(t))
    return split.train.unionByName(split.validation).select(ZONE, HOUR, COUNT)


_MEASURES = """avg(abs(y - greatest(p, 0))) AS mae, sqrt(avg(pow(y - greatest(p, 0), 2))) AS rmse,
    sum(abs(y - greatest(p, 0))) / greatest(sum(y), 1) AS wape,
    count(*) FILTER (WHERE y >= q AND greatest(p, 0) >= q) / greatest(count(*) FILTER (WHERE greatest(p, 0) >= q), 1) AS high_demand_precision,
    count(*) FILTER (WHERE y >= q AND greatest(p, 0) >= q) / greatest(count(*) FILTER (WHERE y >= q), 1) AS high_demand_recall"""
_METRICS = ("mae", "rmse", "wape", "high_demand_precision", "high_demand_recall")


def _melted(source: str, key: str) -> str:
    return " UNION ALL ".join(f"SELECT {key}, '{m}' AS metric, round({m}, 6) AS value FROM {source}" for m in _METRICS)


@query(
    "baselines",
    _chain(
        _melted("m", "scope"),
        "day_grid",
        hist=_DAY_HIST,
        f="SELECT * FROM hist WHERE lag_28 IS NOT NULL",
        t="SELECT quantile_cont(trip_count, 0.9) AS q FROM f",
        s=" UNION ALL ".join(f"SELECT 'lag_{n}' AS scope, trip_count AS y, lag_{n} AS p FROM f" for n in (1, 7, 28)),
        m=f"SELECT scope, {_MEASURES} FROM s, t GROUP BY scope",
    ),
)
def baselines(t: Tables) -> DataFrame:
    frame = day_history(t)
    lags = {f"lag_{n}": f"lag_{n}" for n in (1, 7, 28)}
    return rounded(scoring.metric_rows(frame, COUNT, lags, scoring.high_demand_threshold(frame)))


# Routing and scoring of the forecast frame.


def _scored(name: str, sql: str):
    return query(name, with_views(sql, "scored"))


@query(
    "market_segment",
    with_views(
        "SELECT pickup_zone_id, pickup_hour, CASE WHEN pickup_zone_id IN (132, 138) THEN 'airport' ELSE 'non_airport' END AS market FROM demand",
        "demand",
    ),
)
def market_segment(t: Tables) -> DataFrame:
    return t.demand.select(ZONE, HOUR, rules.market(ZONE).alias("market"))


_EV_DAILY = {"days": _DAYS, "event_days": _EVENT_DAYS, "times": "SELECT DISTINCT pickup_hour AS tick FROM daily", "ev": _EVENT_SQL}


@query(
    "route_model",
    _chain(
        """SELECT d.pickup_zone_id, d.pickup_hour, CASE WHEN pickup_zone_id IN (132, 138) THEN 'airport_specialist'
        WHEN is_event_window = 1 THEN 'event_specialist' ELSE 'global' END AS model_type FROM daily d JOIN ev USING (pickup_hour)""",
        "daily",
        **_EV_DAILY,
    ),
)
def route_model(t: Tables) -> DataFrame:
    window = almanac.event_columns(F.col(HOUR))["is_event_window"]
    return t.daily.select(ZONE, HOUR, rules.model_route(F.col(ZONE), window).alias("model_type"))


@query(
    "calendar_segment",
    _chain(
        f"""SELECT d.pickup_zone_id, d.pickup_hour, CASE WHEN is_event_window = 1 THEN 'event_window'
        WHEN {_HOLIDAY.format(at='d.pickup_hour')} = 1 THEN 'holiday' WHEN isodow(d.pickup_hour) >= 6 THEN 'weekend'
        ELSE 'ordinary_weekday' END AS calendar_segment FROM daily d JOIN ev USING (pickup_hour)""",
        "daily",
        **_EV_DAILY,
    ),
)
def calendar_segment(t: Tables) -> DataFrame:
    at = F.col(HOUR)
    segment = rules.calendar_segment(
        almanac.event_columns(at)["is_event_window"], almanac.is_us_holiday(at), clock.monday_first_weekday(at)
    )
    return t.daily.select(ZONE, HOUR, segment.alias("calendar_segment"))


@query(
    "clip_nonnegative",
    with_views("SELECT pickup_zone_id, forecast_hour, greatest(predicted_trip_count - 0.5e0, 0) AS clipped FROM forecast", "forecast"),
)
def clip_nonnegative(t: Tables) -> DataFrame:
    clipped = errors.clip(F.col("predicted_trip_count") - 0.5)
    return t.forecast.select(ZONE, "forecast_hour", clipped.alias("clipped"))


_SHIFTS = {"current": 0, "partly": 3, "future": 60}


@query(
    "maturity_filter",
    with_views(
        f"""SELECT variant, CASE WHEN count(*) FILTER (WHERE ready) = 0 THEN 'waiting_for_actuals' ELSE 'scored' END AS status,
          count(*) FILTER (WHERE ready) AS scored_rows
        FROM (SELECT variant, forecast_hour + to_days(days) <= (SELECT max(pickup_hour) FROM demand) AS ready
          FROM forecast, (VALUES {", ".join(f"('{name}', {days})" for name, days in _SHIFTS.items())}) shifts(variant, days))
        GROUP BY 1""",
        "forecast",
        "demand",
    ),
)
def maturity_filter(t: Tables) -> DataFrame:
    """Forecasts of the past days, and the same ones some days and many days later."""
    parts = []
    for variant, days in _SHIFTS.items():
        later = t.forecast.withColumn("forecast_hour", clock.shift("forecast_hour", days=days))
        parts.append(scoring.maturity_status(later, t.demand).withColumn("variant", F.lit(variant)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("variant", "status", "scored_rows")


@_scored("join_actuals", "SELECT pickup_zone_id, forecast_hour, trip_count FROM scored")
def join_actuals(t: Tables) -> DataFrame:
    matured = scoring.matured(t.forecast, t.demand)
    return scoring.join_actuals(matured, t.demand).select(ZONE, "forecast_hour", COUNT)


@_scored("join_previous_week", "SELECT pickup_zone_id, forecast_hour, previous_week FROM scored")
def join_previous_week(t: Tables) -> DataFrame:
    matured = scoring.matured(t.forecast, t.demand)
    return scoring.join_previous_week(matured, t.demand).select(ZONE, "forecast_hour", "previous_week")


@query(
    "join_previous_year",
    with_views(
        """SELECT d.pickup_zone_id, d.pickup_hour, CAST(coalesce(p.trip_count, 0) AS DOUBLE) AS previous_year
        FROM daily d LEFT JOIN daily p ON p.pickup_zone_id = d.pickup_zone_id AND p.pickup_hour = d.pickup_hour - INTERVAL 1 YEAR""",
        "daily",
    ),
)
def join_previous_year(t: Tables) -> DataFrame:
    return scoring.join_previous_year(t.daily, t.daily).select(ZONE, HOUR, "previous_year")


@_scored("high_demand_threshold", "SELECT quantile_cont(trip_count, 0.9) AS threshold FROM scored")
def high_demand_threshold(t: Tables) -> DataFrame:
    scored = scoring.scored_frame(t.forecast, t.demand)
    return scored.agg(F.percentile(COUNT, F.lit(scoring.HIGH_DEMAND_QUANTILE)).alias("threshold"))


_TWO_SCOPES = """SELECT 'candidate' AS scope, trip_count AS y, predicted_trip_count AS p FROM scored
    UNION ALL SELECT 'previous_week', trip_count, previous_week FROM scored"""


@query(
    "forecast_metrics",
    _chain(
        _melted("m", "scope"),
        "scored",
        t="SELECT quantile_cont(trip_count, 0.9) AS q FROM scored",
        s=_TWO_SCOPES,
        m=f"SELECT scope, {_MEASURES} FROM s, t GROUP BY scope",
    ),
)
def forecast_metrics(t: Tables) -> DataFrame:
    scored = scoring.scored_frame(t.forecast, t.demand)
    scopes = {"candidate": scoring.PREDICTED, "previous_week": scoring.BASELINE}
    return rounded(scoring.metric_rows(scored, COUNT, scopes, scoring.high_demand_threshold(scored)))


@_scored(
    "forecast_bias",
    "SELECT round(sum(predicted_trip_count - trip_count) / greatest(sum(trip_count), 1), 6) AS bias FROM scored",
)
def forecast_bias(t: Tables) -> DataFrame:
    scored = scoring.scored_frame(t.forecast, t.demand)
    return rounded(scored.agg(errors.bias(F.col(COUNT), F.col(scoring.PREDICTED)).alias("bias")))


_REPORT = {
    "t": "SELECT quantile_cont(trip_count, 0.9) AS q FROM scored",
    "s": _TWO_SCOPES,
    "m": f"SELECT scope, {_MEASURES} FROM s, t GROUP BY scope",
    "r": """SELECT (SELECT count(*) FROM scored) AS scored_rows, a.mae, a.rmse, a.wape, a.high_demand_precision, a.high_demand_recall,
      (SELECT sum(predicted_trip_count - trip_count) / greatest(sum(trip_count), 1) FROM scored) AS bias,
      b.mae AS baseline_mae, b.rmse AS baseline_rmse, b.wape AS baseline_wape,
      b.high_demand_precision AS baseline_high_demand_precision, b.high_demand_recall AS baseline_high_demand_recall,
      (b.wape - a.wape) / nullif(b.wape, 0) AS relative_wape_improvement
    FROM m a, m b WHERE a.scope = 'candidate' AND b.scope = 'previous_week'""",
}
_REPORTED = (
    "mae rmse wape high_demand_precision high_demand_recall bias baseline_mae baseline_rmse baseline_wape "
    "baseline_high_demand_precision baseline_high_demand_recall relative_wape_improvement"
).split()


@query(
    "score_forecast",
    _chain(
        f"""SELECT scored_rows, {", ".join(f"round({c}, 6) AS {c}" for c in _REPORTED)}, wape < 0.25 AS wape_below_25pct,
        abs(bias) < 0.1 AS absolute_bias_below_10pct, high_demand_recall >= 0.9 AS high_demand_recall_above_90pct,
        wape < 0.25 AND abs(bias) < 0.1 AND high_demand_recall >= 0.9 AS drift_passed FROM r""",
        "scored",
        **_REPORT,
    ),
)
def score_forecast(t: Tables) -> DataFrame:
    return rounded(scoring.overall_report(scoring.scored_frame(t.forecast, t.demand)))


def _segment_sql(scope: str, column: str, source: str = "scored") -> str:
    return f"""SELECT '{scope}' AS scope, CAST({column} AS VARCHAR) AS segment, count(*) AS rows, sum(trip_count) AS actual,
      avg(abs(trip_count - predicted_trip_count)) AS mae,
      sum(abs(trip_count - predicted_trip_count)) / greatest(sum(trip_count), 1) AS wape,
      sum(predicted_trip_count - trip_count) / greatest(sum(trip_count), 1) AS bias,
      sum(abs(trip_count - previous_week)) / greatest(sum(trip_count), 1) AS baseline_wape FROM {source} GROUP BY 2"""


def _ranked_sql(min_actual: float) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY scope ORDER BY wape DESC, segment) AS position FROM seg
      WHERE scope <> 'zone' OR actual >= {min_actual}"""


@query(
    "segments_monitor",
    _chain(
        """SELECT scope, position, segment, rows, round(mae, 6) AS mae, round(wape, 6) AS wape, round(bias, 6) AS bias
        FROM ranked WHERE scope <> 'zone' OR position <= 15""",
        "scored",
        seg=" UNION ALL ".join(
            _segment_sql(s, c)
            for s, c in {"month": "month", "hour": "hour", "market": "market", "zone": "pickup_zone_id"}.items()
        ),
        ranked=_ranked_sql(50),
    ),
)
def segments_monitor(t: Tables) -> DataFrame:
    return rounded(scoring.monitoring_segments(scoring.scored_frame(t.forecast, t.demand), 15, 50.0))


@query(
    "segment_rank",
    _chain(
        "SELECT position, segment, round(wape, 6) AS wape FROM ranked",
        "scored",
        seg=_segment_sql("zone", "pickup_zone_id"),
        ranked=_ranked_sql(0),
    ),
)
def segment_rank(t: Tables) -> DataFrame:
    zones = t.demand.select(ZONE).distinct().count()
    ranked = scoring.monitoring_segments(scoring.scored_frame(t.forecast, t.demand), zones, 0.0)
    return rounded(ranked.filter("scope = 'zone'").select("position", "segment", "wape"))


@query(
    "segment_errors",
    _chain(
        """SELECT scope, segment, rows, round(mae, 6) AS mae, round(wape, 6) AS wape FROM
        (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY mae DESC, segment) AS p FROM seg) WHERE scope = 'hour' OR p <= 10""",
        "day_grid",
        hist=_DAY_HIST,
        scored="""SELECT pickup_zone_id, pickup_hour, trip_count, lag_1 AS predicted_trip_count, lag_7 AS previous_week
          FROM hist WHERE lag_28 IS NOT NULL""",
        seg=_segment_sql("hour", "hour(pickup_hour)") + " UNION ALL " + _segment_sql("zone", "pickup_zone_id"),
    ),
)
def segment_errors(t: Tables) -> DataFrame:
    return rounded(scoring.test_segments(day_history(t), "lag_1"))


@query(
    "set_equality_grid",
    with_views(
        """SELECT pickup_zone_id, pickup_hour, 'missing' AS side FROM grid g WHERE NOT EXISTS
        (SELECT 1 FROM hourly h WHERE h.pickup_zone_id = g.pickup_zone_id AND h.pickup_hour = g.pickup_hour)""",
        "grid",
    ),
)
def set_equality_grid(t: Tables) -> DataFrame:
    return gates.grid_difference(t.hourly, series.time_grid(t.hourly), ZONE, HOUR)


_ROUTED = """SELECT *, CASE WHEN hour(forecast_hour) IN (4, 5) THEN 1 ELSE 0 END AS is_event_window,
    CASE WHEN pickup_zone_id IN (132, 138) THEN 'airport_specialist' WHEN hour(forecast_hour) IN (4, 5) THEN 'event_specialist'
      ELSE 'global' END AS model_type FROM forecast"""
_BROKEN = """SELECT pickup_zone_id, forecast_hour, CASE WHEN pickup_zone_id = 121 THEN NULL WHEN pickup_zone_id = 122 THEN -1.0e0
    ELSE predicted_trip_count END AS predicted_trip_count, is_event_window,
    CASE WHEN pickup_zone_id = 132 THEN 'global' ELSE model_type END AS model_type
  FROM routed WHERE pickup_zone_id <> 140 OR hour(forecast_hour) <> 3"""


def _check_sql(variant: str, source: str) -> str:
    size = "(SELECT count(DISTINCT pickup_zone_id) FROM demand)"
    tests = {
        "expected_row_count": f"(SELECT count(*) FROM {source}) = {size} * 180",
        "complete_zone_hour_grid": f"(SELECT count(DISTINCT forecast_hour) FROM {source}) = 180 AND NOT EXISTS "
        f"(SELECT pickup_zone_id, forecast_hour FROM forecast EXCEPT SELECT pickup_zone_id, forecast_hour FROM {source})",
        "unique_zone_hour": f"NOT EXISTS (SELECT 1 FROM {source} GROUP BY pickup_zone_id, forecast_hour HAVING count(*) > 1)",
        "no_null_predictions": f"NOT EXISTS (SELECT 1 FROM {source} WHERE predicted_trip_count IS NULL)",
        "no_negative_predictions": f"NOT EXISTS (SELECT 1 FROM {source} WHERE predicted_trip_count IS NULL OR predicted_trip_count < 0)",
        "airport_model_routing": f"EXISTS (SELECT 1 FROM {source} WHERE pickup_zone_id IN (132, 138)) AND NOT EXISTS "
        f"(SELECT 1 FROM {source} WHERE pickup_zone_id IN (132, 138) AND model_type <> 'airport_specialist')",
        "event_model_routing": f"NOT EXISTS (SELECT 1 FROM {source} WHERE pickup_zone_id NOT IN (132, 138) AND is_event_window = 1 "
        "AND model_type <> 'event_specialist')",
        "global_model_routing": f"NOT EXISTS (SELECT 1 FROM {source} WHERE pickup_zone_id NOT IN (132, 138) AND is_event_window = 0 "
        "AND model_type <> 'global')",
    }
    return " UNION ALL ".join(f"SELECT '{variant}' AS variant, '{n}' AS \"check\", {sql} AS passed" for n, sql in tests.items())


@query(
    "forecast_validation",
    _chain(_check_sql("complete", "routed") + " UNION ALL " + _check_sql("broken", "broken"), "forecast", routed=_ROUTED, broken=_BROKEN),
)
def forecast_validation(t: Tables) -> DataFrame:
    window = F.hour("forecast_hour").isin(4, 5).cast("int")
    routed = t.forecast.withColumn("is_event_window", window).withColumn(
        "model_type", rules.model_route(F.col(ZONE), F.col("is_event_window"))
    )
    guess = F.when(F.col(ZONE) == 121, None).when(F.col(ZONE) == 122, -1.0).otherwise(F.col("predicted_trip_count"))
    broken = routed.filter((F.col(ZONE) != 140) | (F.hour("forecast_hour") != 3)).withColumns(
        {
            "predicted_trip_count": guess,
            "model_type": F.when(F.col(ZONE) == 132, "global").otherwise(F.col("model_type")),
        }
    )
    checked = [
        gates.forecast_checks(frame, t.demand, 180, rules.AIRPORT_ZONE_IDS).withColumn("variant", F.lit(name))
        for name, frame in {"complete": routed, "broken": broken}.items()
    ]
    return reduce(DataFrame.unionByName, checked).select("variant", "check", "passed")


# Folds built from the daily series: monthly tests of simple predictors.


def fold_rows(t: Tables) -> DataFrame:
    frame = day_history(t)
    flags = almanac.event_columns(F.col(HOUR))
    return frame.withColumns(
        {
            "test_month": clock.month_label(HOUR),
            "_threshold": scoring.high_demand_threshold(frame),
            "is_airport": F.col(ZONE).isin(*rules.AIRPORT_ZONE_IDS),
            "is_event_window": flags["is_event_window"],
            "is_new_year_window": flags["is_new_year_window"],
            "baseline_prediction": F.col("lag_7"),
            "global_prediction": F.col("lag_1"),
            "candidate_prediction": F.col("rolling_mean_28"),
        }
    )


_FOLD_CTES = {
    "hist": _DAY_HIST,
    "f": "SELECT * FROM hist WHERE lag_28 IS NOT NULL",
    "t": "SELECT quantile_cont(trip_count, 0.9) AS q FROM f",
    "days": _DAYS,
    "event_days": _EVENT_DAYS,
    "times": "SELECT DISTINCT pickup_hour AS tick FROM f",
    "ev": _EVENT_SQL,
    "p": """SELECT strftime(f.pickup_hour, '%Y-%m') AS test_month, f.trip_count AS y, f.lag_7 AS b, f.lag_1 AS g, f.rolling_mean_28 AS c,
      coalesce(o.trip_count, 0) AS py, f.pickup_zone_id IN (132, 138) AS air, ev.is_event_window = 1 AS evw, ev.is_new_year_window = 1 AS ny
      FROM f JOIN ev USING (pickup_hour) LEFT JOIN f o ON o.pickup_zone_id = f.pickup_zone_id AND o.pickup_hour = f.pickup_hour - INTERVAL 1 YEAR""",
    "s": " UNION ALL ".join(
        f"SELECT test_month, '{name}' AS scope, y, {column} AS p FROM p WHERE {mask}"
        for name, column, mask in (
            ("baseline", "b", "TRUE"),
            ("candidate", "c", "TRUE"),
            ("ordinary_baseline", "b", "NOT evw"),
            ("ordinary_candidate", "c", "NOT evw"),
            ("airport_global_model", "g", "air"),
            ("airport_specialist", "c", "air"),
            ("event_previous_week", "b", "evw"),
            ("event_previous_year", "py", "evw"),
            ("event_candidate", "c", "evw"),
            ("new_year_previous_week", "b", "ny"),
            ("new_year_previous_year", "py", "ny"),
            ("new_year_candidate", "c", "ny"),
        )
    ),
    "m": f"SELECT test_month, scope, count(*) AS rows, {_MEASURES} FROM s, t GROUP BY 1, 2",
    "w": "SELECT test_month, "
    + ", ".join(
        f"max(CASE WHEN scope = '{s}' THEN wape END) AS {s}"
        for s in (
            "baseline candidate ordinary_baseline ordinary_candidate airport_global_model airport_specialist event_previous_year "
            "event_candidate new_year_previous_week new_year_candidate"
        ).split()
    )
    + ", max(CASE WHEN scope = 'new_year_candidate' THEN high_demand_recall END) AS ny_recall FROM m GROUP BY 1",
    "gains": """SELECT test_month, (baseline - candidate) / nullif(baseline, 0) AS overall,
      (airport_global_model - airport_specialist) / nullif(airport_global_model, 0) AS airport,
      (event_previous_year - event_candidate) / nullif(event_previous_year, 0) AS event,
      (ordinary_baseline - ordinary_candidate) / nullif(ordinary_baseline, 0) AS ordinary,
      event_candidate IS NOT NULL AS has_event, new_year_candidate IS NOT NULL AS has_ny,
      new_year_candidate < new_year_previous_week AS ny_better, ny_recall >= 0.8 AS ny_recall FROM w""",
}


@query(
    "relative_improvement",
    _chain(
        """SELECT test_month, round(overall, 6) AS overall, round(airport, 6) AS airport, round(event, 6) AS event,
        round(ordinary, 6) AS ordinary FROM gains""",
        "day_grid",
        **_FOLD_CTES,
    ),
)
def relative_improvement(t: Tables) -> DataFrame:
    gains = gates.fold_improvements(backtest.fold_metrics(fold_rows(t), day_history(t)))
    return rounded(gains.select("test_month", "overall", "airport", "event", "ordinary"))


_RELEASE = {
    "minimum_four_folds": "count(*) >= 4",
    "overall_win_rate_at_least_75pct": "avg(CASE WHEN overall > 0 THEN 1 ELSE 0 END) >= 0.75",
    "median_wape_improvement_at_least_5pct": "median(overall) >= 0.05",
    "worst_fold_degradation_no_more_than_2pct": "bool_and(coalesce(overall >= -0.02, FALSE))",
    "airport_win_rate_at_least_two_thirds": "avg(CASE WHEN airport > 0 THEN 1 ELSE 0 END) >= 2e0 / 3",
    "at_least_three_major_event_folds": "count(*) FILTER (WHERE has_event) >= 3",
    "event_median_improves_previous_year": "median(event) FILTER (WHERE has_event) > 0",
    "ordinary_days_never_degrade_over_2pct": "bool_and(coalesce(ordinary >= -0.02, FALSE))",
    "new_year_window_improves_previous_week": "bool_and(coalesce(ny_better, FALSE)) FILTER (WHERE has_ny)",
    "new_year_high_demand_recall_at_least_80pct": "bool_and(coalesce(ny_recall, FALSE)) FILTER (WHERE has_ny)",
}


@query(
    "release_decision",
    _chain(
        " UNION ALL ".join(f"SELECT '{n}' AS \"check\", coalesce({sql}, FALSE) AS passed FROM gains" for n, sql in _RELEASE.items()),
        "day_grid",
        **_FOLD_CTES,
    ),
)
def release_decision(t: Tables) -> DataFrame:
    return gates.release_checks(backtest.fold_metrics(fold_rows(t), day_history(t)))


# The decision on a backtest's own folds, with the predictors of closed form of ``rolling_backtest_lags``: a fold's threshold
# comes from the rows before its month.
BACKTEST_RELEASE = _chain(
    "SELECT bool_and(passed) AS passed, coalesce(string_agg(CASE WHEN NOT passed THEN name END, ',' ORDER BY name), '') AS failed,"
    " CASE WHEN bool_and(passed) THEN 'awaiting_human_approval' ELSE 'blocked' END AS status,"
    " CASE WHEN NOT bool_and(passed) THEN 'release_gate_failed' END AS reason FROM checks",
    "day_grid",
    **_FOLD_CTES
    | {
        "t": """SELECT a.test_month AS month, quantile_cont(b.trip_count, 0.9) AS q
          FROM (SELECT DISTINCT strftime(pickup_hour, '%Y-%m') AS test_month FROM f) a
          JOIN f b ON strftime(b.pickup_hour, '%Y-%m') < a.test_month GROUP BY 1""",
        "p": """SELECT strftime(f.pickup_hour, '%Y-%m') AS test_month, f.trip_count AS y, f.lag_7 AS b, f.lag_1 AS g,
          CASE WHEN f.pickup_zone_id IN (132, 138) THEN f.lag_7 ELSE f.lag_1 END AS c, coalesce(o.trip_count, 0) AS py,
          f.pickup_zone_id IN (132, 138) AS air, ev.is_event_window = 1 AS evw, ev.is_new_year_window = 1 AS ny
          FROM f JOIN ev USING (pickup_hour)
          LEFT JOIN f o ON o.pickup_zone_id = f.pickup_zone_id AND o.pickup_hour = f.pickup_hour - INTERVAL 1 YEAR""",
        "m": f"SELECT test_month, scope, count(*) AS rows, {_MEASURES} FROM s JOIN t ON month = test_month GROUP BY 1, 2",
        "checks": " UNION ALL ".join(f"SELECT '{n}' AS name, coalesce({sql}, FALSE) AS passed FROM gains" for n, sql in _RELEASE.items()),
    },
)


@query(
    "leakage_guard",
    with_views(
        """SELECT 'lag_168' AS rule, 0 AS violations
        UNION ALL SELECT 'short_history', count(DISTINCT date_trunc('day', pickup_hour)) FROM demand
          WHERE date_trunc('day', pickup_hour) - INTERVAL 168 HOUR < (SELECT min(pickup_hour) FROM demand)
        UNION ALL SELECT 'training_overlap', count(DISTINCT date_trunc('month', pickup_hour)) - 1 FROM daily""",
        "daily",
        "demand",
    ),
)
def leakage_guard(t: Tables) -> DataFrame:
    """Violations of three rules: wrong lags, too little history, training that reaches the test month."""
    features = series.dense_series(t.hourly).withColumns(series.lag_columns()).na.drop(subset=["lag_168"])
    leaks = gates.leaking_rows(features, t.hourly, 168)
    days = t.demand.select(clock.trunc("day", HOUR).alias("origin")).distinct()
    early = gates.short_history(t.demand, days, 168)
    months = t.daily.select(clock.trunc("month", HOUR).alias("test_start")).distinct()
    first = t.daily.agg(F.min(HOUR)).scalar()
    folds = months.withColumn("train_end", F.when(F.col("test_start") > first, F.col("test_start")).otherwise(
        F.col("test_start") - F.expr("INTERVAL 1 DAY")))
    rows = {"lag_168": leaks, "short_history": early, "training_overlap": gates.training_overlap(folds)}
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("rule"), "violations") for n, df in rows.items()],
    )


@query(
    "required_columns_check",
    with_views(
        """SELECT 'demand' AS table_name, '' AS missing, count(*) AS rows FROM demand
        UNION ALL SELECT 'events', 'pickup_hour, pickup_zone_id, trip_count', count(*) FROM events
        UNION ALL SELECT 'lineitem', 'pickup_hour, pickup_zone_id, trip_count', count(*) FROM lineitem""",
        "demand",
    ),
)
def required_columns_check(t: Tables) -> DataFrame:
    """Columns the feature builder needs that each table lacks, with the table's row count."""
    frames = {"demand": t.demand, "events": t.base("events"), "lineitem": t.base("lineitem")}
    rows = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(", ".join(tables.missing_columns(df, {ZONE, HOUR, COUNT}))).alias("missing"),
            "rows",
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "pivot_history",
    with_views(
        """SELECT pickup_zone_id, CAST(row_number() OVER (PARTITION BY pickup_zone_id ORDER BY pickup_hour) AS INTEGER) - 1 AS position, trip_count
        FROM grid WHERE pickup_hour > (SELECT max(pickup_hour) FROM grid) - INTERVAL 168 HOUR""",
        "grid",
    ),
)
def pivot_history(t: Tables) -> DataFrame:
    histories = recursion.zone_histories(t.hourly, recursion.next_origin(t.hourly))
    return histories.select(ZONE, F.posexplode("history").alias("position", COUNT))


# Loss days: the daily series with yesterday as candidate and last week as baseline.


def day_scored(t: Tables) -> DataFrame:
    at = F.col("forecast_hour")
    return (
        day_history(t)
        .withColumnsRenamed({HOUR: "forecast_hour", "lag_1": scoring.PREDICTED, "lag_7": scoring.BASELINE})
        .withColumns(
            {
                "horizon_hour": F.weekday(at) + 1,
                "market": rules.market(ZONE),
                "calendar_segment": rules.calendar_segment(
                    almanac.event_columns(at)["is_event_window"], almanac.is_us_holiday(at), F.weekday(at)
                ),
            }
        )
        .select(
            ZONE, "forecast_hour", COUNT, scoring.PREDICTED, scoring.BASELINE, "horizon_hour", "market", "calendar_segment"
        )
    )


_DAY_CTES = {
    "hist": _DAY_HIST,
    "days": _DAYS,
    "event_days": _EVENT_DAYS,
    "times": "SELECT DISTINCT pickup_hour AS tick FROM hist",
    "ev": _EVENT_SQL,
    "scored": f"""SELECT h.pickup_zone_id, h.pickup_hour AS forecast_hour, CAST(h.pickup_hour AS DATE) AS day, h.trip_count,
      h.lag_1 AS predicted_trip_count, h.lag_7 AS previous_week, isodow(h.pickup_hour) AS horizon_hour,
      CASE WHEN h.pickup_zone_id IN (132, 138) THEN 'airport' ELSE 'non_airport' END AS market,
      CASE WHEN ev.is_event_window = 1 THEN 'event_window' WHEN {_HOLIDAY.format(at='h.pickup_hour')} = 1 THEN 'holiday'
        WHEN isodow(h.pickup_hour) >= 6 THEN 'weekend' ELSE 'ordinary_weekday' END AS calendar_segment
      FROM hist h JOIN ev USING (pickup_hour) WHERE h.lag_28 IS NOT NULL""",
    "outcome": """SELECT day, sum(abs(trip_count - predicted_trip_count)) / greatest(sum(trip_count), 1) AS candidate_wape,
      sum(abs(trip_count - previous_week)) / greatest(sum(trip_count), 1) AS baseline_wape,
      sum(predicted_trip_count - trip_count) / greatest(sum(trip_count), 1) AS bias,
      sum(abs(trip_count - predicted_trip_count)) < sum(abs(trip_count - previous_week)) AS won FROM scored GROUP BY 1""",
}
_PROFILE_CTES = {
    "totals": """SELECT CAST(pickup_hour AS DATE) AS day, sum(trip_count) AS trips,
      sum(CASE WHEN pickup_zone_id IN (132, 138) THEN trip_count ELSE 0 END) AS airport FROM day_grid GROUP BY 1""",
    "prof": """SELECT day, trips, CASE WHEN n = 7 THEN prev END AS previous_day_demand, CASE WHEN n = 7 THEN prev7 END AS previous_week_same_day,
      CASE WHEN n = 7 THEN mean END AS prior_week_mean, CASE WHEN n = 7 THEN sd / mean END AS prior_week_cv,
      CASE WHEN n = 7 THEN recent / mean - 1 END AS recent_trend, CASE WHEN n = 7 THEN air / total END AS airport_share
      FROM (SELECT day, trips, lag(trips, 1) OVER (ORDER BY day) AS prev, lag(trips, 7) OVER (ORDER BY day) AS prev7,
        count(trips) OVER w AS n, avg(trips) OVER w AS mean, stddev_pop(trips) OVER w AS sd, sum(airport) OVER w AS air, sum(trips) OVER w AS total,
        avg(trips) OVER (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent
        FROM totals WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
}
_FIELDS = loss_days.PROFILE_FIELDS


@query(
    "segments_shadow",
    _chain(
        """SELECT scope, position, segment, rows, round(wape, 6) AS wape, round(bias, 6) + 0e0 AS bias, round(baseline_wape, 6) AS baseline_wape
        FROM ranked WHERE scope <> 'zone' OR position <= 15""",
        "day_grid",
        **_DAY_CTES,
        seg=" UNION ALL ".join(
            _segment_sql(s, c)
            for s, c in {
                "horizon": "horizon_hour",
                "calendar": "calendar_segment",
                "market": "market",
                "zone": "pickup_zone_id",
            }.items()
        ),
        ranked=_ranked_sql(100),
    ),
)
def segments_shadow(t: Tables) -> DataFrame:
    return rounded(scoring.shadow_segments(day_scored(t)))


@query(
    "preforecast_day_profile",
    _chain(
        f"SELECT CAST(day AS VARCHAR) AS day, trips, {', '.join(f'round({f}, 6) + 0e0 AS {f}' for f in _FIELDS)} FROM prof",
        "day_grid",
        **_PROFILE_CTES,
    ),
)
def preforecast_day_profile(t: Tables) -> DataFrame:
    return rounded(dates_as_text(loss_days.day_profile(t.daily)))


@query(
    "win_loss_medians",
    _chain(
        f"SELECT won, count(*) AS days, {', '.join(f'round(median({f}), 6) + 0e0 AS {f}' for f in _FIELDS)} FROM prof JOIN outcome USING (day) GROUP BY 1",
        "day_grid",
        **_DAY_CTES,
        **_PROFILE_CTES,
    ),
)
def win_loss_medians(t: Tables) -> DataFrame:
    outcome = loss_days.daily_outcome(day_scored(t))
    return rounded(loss_days.win_loss_medians(loss_days.day_profile(t.daily), outcome))


@query(
    "loss_clusters",
    _chain(
        """SELECT CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days
        FROM (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island FROM outcome WHERE NOT won) GROUP BY island""",
        "day_grid",
        **_DAY_CTES,
    ),
)
def loss_clusters(t: Tables) -> DataFrame:
    return dates_as_text(loss_days.loss_clusters(loss_days.daily_outcome(day_scored(t))))


_CELL = "sum(trip_count) AS actual, sum(abs(trip_count - predicted_trip_count) - abs(trip_count - previous_week)) AS excess"


@query(
    "excess_error",
    _chain(
        """SELECT scope, segment, position, actual, excess, round(excess / nullif((SELECT excess FROM g WHERE scope = 'all'), 0), 6) + 0e0 AS share
        FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY excess DESC, segment) AS position FROM g)
        WHERE scope <> 'zone' OR position <= 10""",
        "day_grid",
        **_DAY_CTES,
        lost="SELECT * FROM scored WHERE day IN (SELECT day FROM outcome WHERE NOT won)",
        g=f"""SELECT 'all' AS scope, 'all' AS segment, {_CELL} FROM lost UNION ALL SELECT 'market', market, {_CELL} FROM lost GROUP BY market
          UNION ALL SELECT 'hour', CAST(hour(forecast_hour) AS VARCHAR), {_CELL} FROM lost GROUP BY 2
          UNION ALL SELECT 'zone', CAST(pickup_zone_id AS VARCHAR), {_CELL} FROM lost GROUP BY 2""",
    ),
)
def excess_error(t: Tables) -> DataFrame:
    scored = day_scored(t)
    return rounded(loss_days.excess_error(scored, loss_days.daily_outcome(scored)))


def _rank_sql(column: str) -> str:
    return f"rank() OVER (PARTITION BY field ORDER BY {column}) + (count(*) OVER (PARTITION BY field, {column}) - 1) / 2e0"


@query(
    "spearman_association",
    _chain(
        f"""SELECT field, count(*) AS days, CASE WHEN stddev_pop(x) * stddev_pop(y) > 0 THEN round(corr(x, y), 6) END AS rho FROM
        (SELECT field, {_rank_sql('value')} AS x, {_rank_sql('improvement')} AS y FROM long) GROUP BY 1""",
        "day_grid",
        **_DAY_CTES,
        **_PROFILE_CTES,
        long=" UNION ALL ".join(
            f"""SELECT '{f}' AS field, round({f}, 9) AS value, round((baseline_wape - candidate_wape) / nullif(baseline_wape, 0), 9) AS improvement
            FROM prof JOIN outcome USING (day) WHERE baseline_wape <> 0 AND {f} IS NOT NULL"""
            for f in _FIELDS
        ),
    ),
)
def spearman_association(t: Tables) -> DataFrame:
    outcome = loss_days.daily_outcome(day_scored(t))
    found = loss_days.spearman(loss_days.day_profile(t.daily), outcome)
    return rounded(found)


_DRIFT = "SELECT day, candidate_wape < 0.25 AND abs(bias) < 0.1 AS drift_passed FROM outcome"


@query(
    "stability_summary",
    _chain(
        """SELECT count(*) AS days, count(*) FILTER (WHERE won) AS wins, round(avg(CASE WHEN won THEN 1 ELSE 0 END), 6) AS win_rate,
        round(max(-(baseline_wape - candidate_wape) / nullif(baseline_wape, 0)), 6) AS worst_relative_degradation,
        round(avg(CASE WHEN drift_passed THEN 1 ELSE 0 END), 6) AS drift_pass_rate,
        (SELECT count(*) FROM (SELECT 1 FROM scored GROUP BY horizon_hour HAVING sum(abs(trip_count - predicted_trip_count)) < sum(abs(trip_count - previous_week)))) AS horizon_wins
        FROM outcome JOIN drift USING (day)""",
        "day_grid",
        **_DAY_CTES,
        drift=_DRIFT,
    ),
)
def stability_summary(t: Tables) -> DataFrame:
    scored = day_scored(t)
    outcome = loss_days.daily_outcome(scored)
    passed = (F.col("candidate_wape") < scoring.DRIFT_WAPE) & (F.abs("bias") < scoring.DRIFT_BIAS)
    horizons = scored.groupBy("horizon_hour").agg(
        errors.wape(F.col(COUNT), F.col(scoring.PREDICTED)).alias("wape"),
        errors.wape(F.col(COUNT), F.col(scoring.BASELINE)).alias("baseline_wape"),
    )
    return rounded(loss_days.stability(outcome, outcome.select("day", passed.alias("drift_passed")), horizons))


@query(
    "drift_gate",
    _chain(
        """SELECT strftime(forecast_hour, '%Y-%m') AS period, round(wape, 6) AS wape, round(bias, 6) + 0e0 AS bias,
        round(high_demand_recall, 6) AS high_demand_recall, wape < 0.25 AS wape_below_25pct, abs(bias) < 0.1 AS absolute_bias_below_10pct,
        high_demand_recall >= 0.9 AS high_demand_recall_above_90pct,
        wape < 0.25 AND abs(bias) < 0.1 AND high_demand_recall >= 0.9 AS drift_passed
        FROM (SELECT min(forecast_hour) AS forecast_hour, sum(predicted_trip_count - trip_count) / greatest(sum(trip_count), 1) AS bias,
          sum(abs(trip_count - predicted_trip_count)) / greatest(sum(trip_count), 1) AS wape,
          count(*) FILTER (WHERE trip_count >= q AND predicted_trip_count >= q) / greatest(count(*) FILTER (WHERE trip_count >= q), 1) AS high_demand_recall
          FROM scored, t GROUP BY strftime(forecast_hour, '%Y-%m'))""",
        "day_grid",
        **_DAY_CTES,
        t="SELECT quantile_cont(trip_count, 0.9) AS q FROM scored",
    ),
)
def drift_gate(t: Tables) -> DataFrame:
    scored = day_scored(t)
    truth, guess = F.col(COUNT), F.col(scoring.PREDICTED)
    measured = errors.measures(truth, guess, F.col("_threshold"))
    monthly = (
        scored.withColumn("_threshold", scoring.high_demand_threshold(scored))
        .groupBy(clock.month_label("forecast_hour").alias("period"))
        .agg(
            measured["wape"].alias("wape"),
            errors.bias(truth, guess).alias("bias"),
            measured["high_demand_recall"].alias("high_demand_recall"),
        )
    )
    return rounded(scoring.with_drift(monthly))
