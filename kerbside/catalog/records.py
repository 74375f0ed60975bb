"""Historical trip records: cleaning, rectangles, earnings, drivers and distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbside.catalog.registry import query
from kerbside.catalog.support import dates_as_text, rounded
from kerbside.catalog.tables import Tables, with_views
from kerbside.functions import errors, parsing, rules
from kerbside.operators import drivers, legacy, profile, sampling
from kerbside.operators.legacy import COORDINATES
from kerbside.plans import money_models


def _legacy(name: str, sql: str):
    return query(name, with_views(sql, "legacy"))


def _featured(name: str, sql: str):
    return query(name, with_views(sql, "featured"))


def featured(t: Tables) -> DataFrame:
    return legacy.add_trip_features(t.legacy)


def _inside(box: rules.Box, end: str) -> str:
    return (
        f"{end}_latitude BETWEEN {box.min_lat} AND {box.max_lat} AND {end}_longitude BETWEEN {box.min_lng} AND {box.max_lng}"
    )


_SECONDS = "(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 1e6"
_DIFFER = "(pickup_longitude <> dropoff_longitude OR pickup_latitude <> dropoff_latitude)"


@_legacy(
    "clean_trips",
    f"""SELECT trip_id, {_SECONDS} AS trip_time_in_secs, trip_distance / ({_SECONDS} / 3600) AS drive_speed_mph,
      fare_amount / ({_SECONDS} / 60) AS fare_amount_per_minute
    FROM legacy WHERE trip_distance > 0 AND {_SECONDS} > 0 AND fare_amount >= 0
      AND {_inside(legacy.CleaningLimits().box, "pickup")} AND {_inside(legacy.CleaningLimits().box, "dropoff")} AND {_DIFFER}
      AND trip_distance / ({_SECONDS} / 3600) <= 100 AND fare_amount / ({_SECONDS} / 60) <= 3""",
)
def clean_trips(t: Tables) -> DataFrame:
    text = t.legacy.withColumns(
        {c: F.col(c).cast("string") for c in ("pickup_datetime", "dropoff_datetime", "fare_amount")}
    )
    cleaned = legacy.clean_trips(text)
    return cleaned.select("trip_id", "trip_time_in_secs", "drive_speed_mph", "fare_amount_per_minute")


_EARN = "(fare_amount + surcharge + tip_amount)"
_RULES = [
    ("passenger_count", "passenger_count BETWEEN 1 AND 6"),
    ("rate_code", "rate_code BETWEEN 1 AND 5"),
    ("distance", "trip_distance > 0"),
    (
        "trip_time",
        """trip_time_in_secs > 0 AND trip_time_in_secs < (SELECT max(trip_time_in_secs) FROM legacy
        WHERE passenger_count BETWEEN 1 AND 6 AND rate_code BETWEEN 1 AND 5)""",
    ),
    ("speed", "trip_distance / nullif(trip_time_in_secs / 3600e0, 0) <= 30"),
    ("endpoints_differ", _DIFFER),
    ("city_box", f"{_inside(rules.CITY_BOX, 'pickup')} AND {_inside(rules.CITY_BOX, 'dropoff')}"),
    ("fare_per_minute", "fare_amount / nullif(trip_time_in_secs / 60e0, 0) <= 3"),
    ("earning_per_minute_30", f"{_EARN} / nullif(trip_time_in_secs / 60e0, 0) <= 30"),
    ("earning_per_minute_22", f"{_EARN} / nullif(trip_time_in_secs / 60e0, 0) <= 22"),
    ("earning_per_minute_15", f"{_EARN} / nullif(trip_time_in_secs / 60e0, 0) <= 15"),
    ("fare_per_mile", "fare_amount / nullif(trip_distance, 0) <= 1000"),
]
_FIRST_FAILED = "CASE " + " ".join(f"WHEN NOT coalesce({sql}, FALSE) THEN {i}" for i, (_, sql) in enumerate(_RULES)) + " END"
_RULE_ROWS = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(_RULES))


@_legacy(
    "legacy_validity_filters",
    f"""SELECT r.rule_order, r.rule, count(f.failed) AS removed_rows
    FROM (VALUES {_RULE_ROWS}) r(rule_order, rule) LEFT JOIN (SELECT {_FIRST_FAILED} AS failed FROM legacy) f
      ON f.failed = r.rule_order GROUP BY 1, 2""",
)
def legacy_validity_filters(t: Tables) -> DataFrame:
    return legacy.validity_report(t.legacy)


_MONEY = ("fare_amount", "tip_amount", "total_amount", "mta_tax", "tolls_amount", "surcharge")


@_legacy(
    "negative_money_counts",
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} < 0) AS negative_{c}" for c in _MONEY) + " FROM legacy",
)
def negative_money_counts(t: Tables) -> DataFrame:
    return legacy.negative_money(t.legacy)


@_legacy(
    "time_value_checks",
    """SELECT count(*) FILTER (WHERE s < 0) AS stated_negative, count(*) FILTER (WHERE s = 0) AS stated_zero,
      count(*) FILTER (WHERE d < 0) AS derived_negative, count(*) FILTER (WHERE d = 0) AS derived_zero,
      count(*) FILTER (WHERE d IS DISTINCT FROM s) AS disagreements,
      count(*) FILTER (WHERE ((d % 86400) + 86400) % 86400 IS DISTINCT FROM s) AS clock_disagreements
    FROM (SELECT trip_time_in_secs AS s, date_diff('second', pickup_datetime, dropoff_datetime) AS d FROM legacy)""",
)
def time_value_checks(t: Tables) -> DataFrame:
    return legacy.time_checks(t.legacy)


@_legacy(
    "zero_coordinate_count",
    "SELECT count(*) FILTER (WHERE " + " OR ".join(f"{c} = 0" for c in COORDINATES) + ") AS zero_coordinate_rows FROM legacy",
)
def zero_coordinate_count(t: Tables) -> DataFrame:
    return legacy.zero_coordinates(t.legacy)


_FLAG_SQL = {
    f"is_{end}_{name}": f"CASE WHEN {_inside(box, end)} THEN 1 ELSE 0 END"
    for name, box in rules.AIRPORT_BOXES.items()
    for end in rules.ENDS
}


@_legacy("airport_bbox_flags", "SELECT trip_id, " + ", ".join(f"{v} AS {k}" for k, v in _FLAG_SQL.items()) + " FROM legacy")
def airport_bbox_flags(t: Tables) -> DataFrame:
    return legacy.with_airport_flags(t.legacy).select("trip_id", *_FLAG_SQL)


@_legacy(
    "fare_per_mile_outlier",
    """SELECT trip_id, fare_amount / nullif(trip_distance, 0) AS fare_amount_per_mile, 0 AS is_outlier_fare_per_mile
    FROM legacy WHERE NOT coalesce(fare_amount / nullif(trip_distance, 0) >= 30, FALSE)""",
)
def fare_per_mile_outlier(t: Tables) -> DataFrame:
    kept = legacy.with_fare_outlier(t.legacy).filter("is_outlier_fare_per_mile = 0")
    return kept.select("trip_id", "fare_amount_per_mile", "is_outlier_fare_per_mile")


def _borough_sql(end: str) -> str:
    branches = " ".join(f"WHEN {_inside(box, end)} THEN '{name}'" for name, box in rules.BOROUGH_BOXES.items())
    return f"CASE {branches} ELSE 'others' END"


@_legacy(
    "borough_bbox",
    f"SELECT trip_id, {_borough_sql('pickup')} AS pickup_borough, {_borough_sql('dropoff')} AS dropoff_borough FROM legacy",
)
def borough_bbox(t: Tables) -> DataFrame:
    return legacy.with_boroughs(t.legacy).select("trip_id", "pickup_borough", "dropoff_borough")


@_legacy(
    "lower_manhattan_flag",
    "SELECT trip_id, "
    + ", ".join(
        f"CASE WHEN {_inside(rules.LOWER_MANHATTAN, end)} THEN 1 ELSE 0 END AS is_{end}_lower_manhattan" for end in rules.ENDS
    )
    + " FROM legacy",
)
def lower_manhattan_flag(t: Tables) -> DataFrame:
    return legacy.with_lower_manhattan(t.legacy).select(
        "trip_id", "is_pickup_lower_manhattan", "is_dropoff_lower_manhattan"
    )


_NOT_AIRPORT = " AND ".join(f"({v}) = 0" for v in _FLAG_SQL.values())


@_legacy("non_airport_subset", f"SELECT trip_id, fare_amount FROM legacy WHERE {_NOT_AIRPORT}")
def non_airport_subset(t: Tables) -> DataFrame:
    return legacy.non_airport(t.legacy).select("trip_id", "fare_amount")


@_legacy(
    "airport_pickup_subset",
    f"SELECT trip_id, fare_amount FROM legacy WHERE {_inside(rules.AIRPORT_BOXES['jfk'], 'pickup')}",
)
def airport_pickup_subset(t: Tables) -> DataFrame:
    return legacy.airport_trips(t.legacy, "jfk").select("trip_id", "fare_amount")


@_featured(
    "night_shift_flag",
    "SELECT trip_id, CASE WHEN pickup_hour BETWEEN 5 AND 16 THEN 0 WHEN pickup_hour IS NOT NULL THEN 1 END AS is_night_shift FROM featured",
)
def night_shift_flag(t: Tables) -> DataFrame:
    return legacy.with_night_shift(featured(t)).select("trip_id", "is_night_shift")


@query(
    "weekday_weekend_flags",
    with_views(
        """SELECT trip_id, CASE WHEN isodow(tpep_pickup_datetime) >= 6 THEN 1 ELSE 0 END AS is_weekend,
          CASE WHEN isodow(tpep_pickup_datetime) < 6 THEN 1 ELSE 0 END AS is_weekday FROM trips""",
        "trips",
    ),
)
def weekday_weekend_flags(t: Tables) -> DataFrame:
    day = F.date_format("tpep_pickup_datetime", "EEEE")
    weekend = F.coalesce(day.isin("Saturday", "Sunday"), F.lit(False))
    weekday = F.coalesce(~day.isin("Saturday", "Sunday"), F.lit(False))
    return t.trips.select("trip_id", weekend.cast("int").alias("is_weekend"), weekday.cast("int").alias("is_weekday"))


NIGHT_HOURS = (21, 22, 23, 0, 1, 2, 3, 4, 5)


@_legacy(
    "hour_subset_points",
    f"""SELECT floor(pickup_latitude / 0.01e0) AS lat_cell, floor(pickup_longitude / 0.01e0) AS lng_cell, count(*) AS rows
    FROM legacy WHERE hour(pickup_datetime) IN {NIGHT_HOURS} AND pickup_longitude IS NOT NULL GROUP BY 1, 2""",
)
def hour_subset_points(t: Tables) -> DataFrame:
    night = t.legacy.filter(F.hour("pickup_datetime").isin(*NIGHT_HOURS))
    return _cells_as_double(profile.point_grid(night, "pickup_latitude", "pickup_longitude"))


def _cells_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c != "rows"})


@_legacy(
    "point_density_grid",
    f"""SELECT floor(dropoff_latitude / 0.01e0) AS lat_cell, floor(dropoff_longitude / 0.01e0) AS lng_cell, count(*) AS rows
    FROM legacy WHERE {_borough_sql('dropoff')} = 'manhattan' GROUP BY 1, 2""",
)
def point_density_grid(t: Tables) -> DataFrame:
    inner = legacy.with_boroughs(t.legacy).filter("dropoff_borough = 'manhattan'")
    return _cells_as_double(profile.point_grid(inner, "dropoff_latitude", "dropoff_longitude"))


@_featured(
    "add_trip_features",
    """SELECT trip_id, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour, day(pickup_datetime) AS pickup_day,
      dayname(pickup_datetime) AS pickup_day_of_week, month(pickup_datetime) AS pickup_month, year(pickup_datetime) AS pickup_year,
      isodow(pickup_datetime) >= 6 AS is_weekend, earning,
      earning / nullif(trip_time_in_secs / 60e0, 0) AS earning_per_minute,
      earning / nullif(trip_distance, 0) AS earning_per_mile FROM featured""",
)
def add_trip_features(t: Tables) -> DataFrame:
    added = featured(t).select(
        "trip_id", "pickup_date", "pickup_hour", "pickup_day", "pickup_day_of_week", "pickup_month", "pickup_year",
        "is_weekend", "earning", "earning_per_minute", "earning_per_mile",
    )
    return dates_as_text(added)


@_legacy(
    "coerce_timestamp",
    """SELECT trip_id, CASE WHEN trip_id % 17 = 0 THEN NULL ELSE pickup_datetime END AS pickup_datetime FROM legacy""",
)
def coerce_timestamp(t: Tables) -> DataFrame:
    broken = F.when(F.col("trip_id") % 17 == 0, "not a time").otherwise(F.col("pickup_datetime").cast("string"))
    return legacy.coerce(t.legacy.select("trip_id", broken.alias("pickup_datetime")), ("pickup_datetime",))


@_legacy(
    "coerce_number",
    """SELECT trip_id, CASE WHEN trip_id % 19 = 0 THEN NULL ELSE fare_amount END AS fare_amount FROM legacy""",
)
def coerce_number(t: Tables) -> DataFrame:
    broken = F.when(F.col("trip_id") % 19 == 0, "unknown").otherwise(F.col("fare_amount").cast("string"))
    return legacy.coerce(t.legacy.select("trip_id", broken.alias("fare_amount")), (), ("fare_amount",))


@_legacy(
    "log_transform",
    "SELECT trip_id, round(ln(CASE WHEN tip_amount > 0 THEN tip_amount END), 6) AS log_tip FROM legacy",
)
def log_transform(t: Tables) -> DataFrame:
    tip = F.col("tip_amount")
    return rounded(t.legacy.select("trip_id", F.ln(F.when(tip > 0, tip)).alias("log_tip")))


# Joins of the two halves of a historical record.

_TRIP_SIDE = ["medallion", "hack_license", "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance"]
_FARE_SIDE = ["medallion", "hack_license", "vendor_id", "pickup_datetime", "fare_amount", "tip_amount"]
_JOINED = """SELECT a.medallion, a.hack_license, a.vendor_id, a.pickup_datetime, a.dropoff_datetime, a.trip_distance,
      b.fare_amount, b.tip_amount FROM legacy a JOIN legacy b ON a.medallion = b.medallion AND a.hack_license = b.hack_license
      AND a.vendor_id = b.vendor_id AND a.pickup_datetime = b.pickup_datetime"""


@_legacy("join_trip_fare_1to1", f"{_JOINED} WHERE b.trip_id % 9 <> 0")
def join_trip_fare_1to1(t: Tables) -> DataFrame:
    fares = t.legacy.filter("trip_id % 9 <> 0").select(*_FARE_SIDE)
    return legacy.join_one_to_one(t.legacy.select(*_TRIP_SIDE), fares)


@query(
    "join_trip_fare_natural",
    """SELECT a.l_orderkey, a.l_linenumber, a.l_quantity, b.l_extendedprice FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""",
)
def join_trip_fare_natural(t: Tables) -> DataFrame:
    items = t.base("lineitem")
    left = items.select("l_orderkey", "l_linenumber", "l_quantity")
    return legacy.join_shared_columns(left, items.select("l_orderkey", "l_linenumber", "l_extendedprice"))


# Drivers.


@query(
    "driver_daily_income",
    with_views("SELECT hack_license, round(average_daily_income, 6) AS average_daily_income FROM sums", "sums"),
)
def driver_daily_income(t: Tables) -> DataFrame:
    return rounded(drivers.daily_income(featured(t)))


@query(
    "driver_daily_hours",
    with_views("SELECT hack_license, round(average_daily_hours, 6) AS average_daily_hours FROM sums", "sums"),
)
def driver_daily_hours(t: Tables) -> DataFrame:
    return rounded(drivers.daily_hours(featured(t)))


@query(
    "driver_income_hours",
    with_views(
        """SELECT hack_license, round(average_daily_income, 6) AS average_daily_income,
          round(average_daily_hours, 6) AS average_daily_hours FROM sums""",
        "sums",
    ),
)
def driver_income_hours(t: Tables) -> DataFrame:
    return rounded(drivers.income_and_hours(featured(t)))


_NIGHT = "CASE WHEN pickup_hour BETWEEN 5 AND 16 THEN 0 ELSE 1 END"


@_featured(
    "night_trip_ratio",
    f"""SELECT hack_license, CAST(sum({_NIGHT}) AS BIGINT) AS night_trips, count(*) AS trips,
      round(avg({_NIGHT}), 6) AS night_trip_ratio FROM featured GROUP BY 1""",
)
def night_trip_ratio(t: Tables) -> DataFrame:
    return rounded(drivers.night_ratio(featured(t)))


def _top_sql(weekend: bool) -> str:
    test = ">=" if weekend else "<"
    return f"""SELECT hack_license, sum(earning) / count(DISTINCT pickup_date) AS average_daily_income FROM featured
      WHERE isodow(pickup_datetime) {test} 6 GROUP BY 1 ORDER BY average_daily_income DESC, hack_license LIMIT 50"""


def _top(t: Tables, weekend: bool) -> DataFrame:
    kind = F.col("is_weekend") if weekend else ~F.col("is_weekend")
    return drivers.top_drivers(featured(t).filter(kind))


@_featured(
    "top_k_drivers",
    f"""SELECT 'weekday' AS day_type, hack_license, round(average_daily_income, 6) AS average_daily_income FROM ({_top_sql(False)})
    UNION ALL SELECT 'weekend', hack_license, round(average_daily_income, 6) FROM ({_top_sql(True)})""",
)
def top_k_drivers(t: Tables) -> DataFrame:
    weekday = _top(t, False).withColumn("day_type", F.lit("weekday"))
    weekend = _top(t, True).withColumn("day_type", F.lit("weekend"))
    return rounded(weekday.unionByName(weekend)).select("day_type", "hack_license", "average_daily_income")


@_featured(
    "semi_top_drivers",
    f"SELECT trip_id, hack_license FROM featured WHERE hack_license IN (SELECT hack_license FROM ({_top_sql(False)}))",
)
def semi_top_drivers(t: Tables) -> DataFrame:
    return drivers.trips_of(featured(t), _top(t, False)).select("trip_id", "hack_license")


@_featured(
    "group_night_share",
    f"""SELECT CAST(sum({_NIGHT}) AS BIGINT) AS night_trips, count(*) AS trips, round(sum({_NIGHT}) / count(*), 6) AS night_share
    FROM featured WHERE hack_license IN (SELECT hack_license FROM ({_top_sql(True)}))""",
)
def group_night_share(t: Tables) -> DataFrame:
    return rounded(drivers.group_night_share(drivers.trips_of(featured(t), _top(t, True))))


# Distributions.


@query("value_counts", "SELECT l_returnflag, count(*) AS rows FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.base("lineitem"), "l_returnflag")


_PROFILED = ("payment_type", "vendor_id", "medallion", "hack_license", "surcharge")


@_legacy(
    "distinct_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + CAST(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_values FROM legacy"
        for c in _PROFILED
    ),
)
def distinct_profile(t: Tables) -> DataFrame:
    return profile.distinct_profile(t.legacy, *_PROFILED)


_DESCRIBED = ("fare_amount", "tip_amount", "surcharge", "trip_time_in_secs", "trip_distance")


@_legacy(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std,
        round(CAST(min({c}) AS DOUBLE), 2) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS q75,
        round(CAST(max({c}) AS DOUBLE), 2) AS max FROM legacy"""
        for c in _DESCRIBED
    ),
)
def describe_numeric(t: Tables) -> DataFrame:
    return profile.describe(t.legacy, *_DESCRIBED)


@_legacy(
    "min_max_range",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(min({c}), 6) AS minimum, round(max({c}), 6) AS maximum FROM legacy" for c in COORDINATES
    ),
)
def min_max_range(t: Tables) -> DataFrame:
    return rounded(profile.min_max(t.legacy, *COORDINATES))


@_legacy(
    "share_of_total",
    f"""SELECT b AS pickup_borough, count(surcharge) AS trips,
      round(count(surcharge) / (SELECT count(*) FROM legacy) * 100, 2) AS percentage
    FROM (SELECT surcharge, {_borough_sql('pickup')} AS b FROM legacy) GROUP BY 1""",
)
def share_of_total(t: Tables) -> DataFrame:
    return profile.share_of_total(legacy.with_boroughs(t.legacy), "pickup_borough", "surcharge")


@query(
    "share_over_total",
    """SELECT l_returnflag, count(*) AS trips, round(count(*) / (SELECT count(*) FROM lineitem) * 100, 2) AS percentage
    FROM lineitem GROUP BY 1""",
)
def share_over_total(t: Tables) -> DataFrame:
    counts = t.base("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("trips"))
    return profile.share_over_total(counts, "trips")


@_featured("trips_by_hour", "SELECT pickup_hour, count(passenger_count) AS trips FROM featured GROUP BY 1")
def trips_by_hour(t: Tables) -> DataFrame:
    return featured(t).groupBy("pickup_hour").agg(F.count("passenger_count").alias("trips"))


@_featured(
    "passengers_by_hour", "SELECT pickup_hour, CAST(sum(passenger_count) AS BIGINT) AS passengers FROM featured GROUP BY 1"
)
def passengers_by_hour(t: Tables) -> DataFrame:
    return featured(t).groupBy("pickup_hour").agg(F.sum("passenger_count").alias("passengers"))


@_legacy(
    "trips_by_borough",
    f"""SELECT 'pickup' AS trip_end, {_borough_sql('pickup')} AS borough, count(passenger_count) AS trips FROM legacy GROUP BY 1, 2
    UNION ALL SELECT 'dropoff', {_borough_sql('dropoff')}, count(passenger_count) FROM legacy GROUP BY 1, 2""",
)
def trips_by_borough(t: Tables) -> DataFrame:
    """Both ends from one scan: each trip contributes to its pickup and its dropoff borough."""
    named = legacy.with_boroughs(t.legacy).groupBy("pickup_borough", "dropoff_borough").agg(
        F.count("passenger_count").alias("trips")
    )
    ends = F.array(
        *[F.struct(F.lit(end).alias("trip_end"), F.col(f"{end}_borough").alias("borough")) for end in rules.ENDS]
    )
    return named.select(F.inline(ends), "trips").groupBy("trip_end", "borough").agg(F.sum("trips").alias("trips"))


@_featured(
    "median_by_hour",
    """SELECT pickup_hour, round(median(earning / nullif(trip_time_in_secs / 60e0, 0)), 6) AS median_earning_per_minute,
      round(median(earning), 6) AS median_earning FROM featured GROUP BY 1""",
)
def median_by_hour(t: Tables) -> DataFrame:
    return rounded(drivers.median_earnings(featured(t)))


_COV = " UNION ALL ".join(
    f"SELECT '{{part}}' AS part, '{a}{b}' AS cell, round(covar_samp({a}, {b}), 4) AS covariance FROM {{source}}"
    for a in "xy"
    for b in "xy"
)
_XY = "(SELECT fare_amount AS x, trip_time_in_secs / 60e0 AS y FROM legacy WHERE {where})"


@_legacy(
    "covariance_matrix",
    _COV.format(part="all", source=_XY.format(where="TRUE"))
    + " UNION ALL "
    + _COV.format(part="non_airport", source=_XY.format(where=_NOT_AIRPORT)),
)
def covariance_matrix(t: Tables) -> DataFrame:
    x, y = F.col("fare_amount"), F.col("trip_time_in_secs") / 60
    parts = {"all": t.legacy, "non_airport": legacy.non_airport(t.legacy)}
    return rounded(
        reduce(
            DataFrame.unionByName,
            [profile.covariance(df, x, y).withColumn("part", F.lit(part)) for part, df in parts.items()],
        ),
        4,
    ).select("part", "cell", "covariance")


@_legacy(
    "pearson_corr",
    f"""SELECT round(corr(fare_amount, trip_time_in_secs), 6) AS all_trips,
      round(corr(CASE WHEN {_NOT_AIRPORT} THEN fare_amount END, CASE WHEN {_NOT_AIRPORT} THEN trip_time_in_secs END), 6) AS non_airport
    FROM legacy""",
)
def pearson_corr(t: Tables) -> DataFrame:
    fare, seconds = F.col("fare_amount"), F.col("trip_time_in_secs").cast("double")
    ground = ~rules.touches_airport()
    return rounded(
        t.legacy.agg(
            errors.correlation(fare, seconds).alias("all_trips"),
            errors.correlation(F.when(ground, fare), F.when(ground, seconds)).alias("non_airport"),
        )
    )


_BOX = """SELECT vendor_id, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75 FROM src GROUP BY 1"""


@query(
    "box_stats",
    with_views("", "featured").rstrip()
    + f""", src AS (SELECT vendor_id, earning / nullif(trip_time_in_secs / 60e0, 0) AS v FROM featured), q AS ({_BOX})
    SELECT vendor_id, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
      round(q25 - 1.5 * (q75 - q25), 6) AS lower_fence, round(q75 + 1.5 * (q75 - q25), 6) AS upper_fence,
      count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25)) AS below, count(*) FILTER (WHERE v > q75 + 1.5 * (q75 - q25)) AS above
    FROM src JOIN q USING (vendor_id) GROUP BY vendor_id, q25, q50, q75""",
)
def box_stats(t: Tables) -> DataFrame:
    return rounded(profile.box_stats(featured(t), "earning_per_minute", "vendor_id"))


@_legacy(
    "density_histogram",
    f"""SELECT b AS pickup_borough, CAST(CASE WHEN v < -2 THEN 0 WHEN v >= 6 THEN 41 ELSE floor((v + 2) / 8e0 * 40) + 1 END AS BIGINT) AS bin,
      count(*) AS rows FROM (SELECT {_borough_sql('pickup')} AS b, ln(CASE WHEN fare_amount > 0 THEN fare_amount END) AS v FROM legacy)
    WHERE v IS NOT NULL GROUP BY 1, 2""",
)
def density_histogram(t: Tables) -> DataFrame:
    return profile.histogram(
        legacy.with_boroughs(t.legacy), "fare_amount", -2.0, 6.0, 40, "pickup_borough", log=True
    )


@_legacy(
    "scatter_bins",
    f"""SELECT floor(trip_distance / 0.5e0) AS x_bin, floor(fare_amount / 2e0) AS y_bin, count(*) AS rows FROM legacy
    WHERE {_NOT_AIRPORT} AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL GROUP BY 1, 2""",
)
def scatter_bins(t: Tables) -> DataFrame:
    ground = legacy.non_airport(t.legacy)
    return _cells_as_double(profile.scatter_bins(ground, F.col("trip_distance"), F.col("fare_amount"), 0.5, 2.0))


@_legacy(
    "top_fares",
    "SELECT trip_id, round(total_amount, 6) AS total_amount, round(fare_amount, 6) AS fare_amount FROM legacy ORDER BY legacy.total_amount DESC, trip_id LIMIT 10",
)
def top_fares(t: Tables) -> DataFrame:
    best = t.legacy.orderBy(F.desc("total_amount"), "trip_id").limit(10)
    return rounded(best.select("trip_id", "total_amount", "fare_amount"))


@query("head_slice", "SELECT event_id, value FROM events ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 500")
def head_slice(t: Tables) -> DataFrame:
    return sampling.head_slice(t.base("events").select("event_id", "value"), 500, "event_id")


_CATEGORIES = {"pickup_day_of_week": "dayname(pickup_datetime)"} | {f"{end}_borough": _borough_sql(end) for end in rules.ENDS}


@_featured(
    "one_hot",
    "SELECT trip_id, "
    + ", ".join(
        f"coalesce({_CATEGORIES[column]} = '{level}', FALSE)::INT AS \"{column}_{level}\""
        for column, levels in money_models.ENCODED.items()
        for level in levels
    )
    + " FROM featured",
)
def one_hot(t: Tables) -> DataFrame:
    """The three encoded categories of the fare and tip models, in the columns that these see."""
    encoded = legacy.with_boroughs(featured(t)).select("trip_id", *money_models.ENCODED)
    for column, levels in money_models.ENCODED.items():
        encoded = profile.one_hot(encoded, column, levels)
    return encoded


_BUCKET = "CAST(('0x' || substr(md5(CAST(trip_id AS VARCHAR)), 1, 7)) AS BIGINT) % 100"


@_legacy("hash_split", f"SELECT trip_id, CASE WHEN {_BUCKET} < 70 THEN 'train' ELSE 'test' END AS part FROM legacy")
def hash_split(t: Tables) -> DataFrame:
    train, test = sampling.hash_split(t.legacy.select("trip_id"), "trip_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@_legacy(
    "mean_baseline_rmse",
    f"""SELECT round(sqrt(avg(pow(fare_amount - (SELECT avg(fare_amount) FROM legacy WHERE {_BUCKET} < 70), 2))), 6) AS rmse
    FROM legacy WHERE {_BUCKET} >= 70""",
)
def mean_baseline_rmse(t: Tables) -> DataFrame:
    train, test = sampling.hash_split(t.legacy, "trip_id")
    return rounded(money_models.mean_baseline_rmse(train, test, "fare_amount"))


# Rank-feed scalars.


@query(
    "missing_token",
    with_views("SELECT event_id, CASE WHEN rank_id = 'N/A' THEN NULL ELSE rank_id END AS rank_id FROM rank_rows", "rank_rows"),
)
def missing_token(t: Tables) -> DataFrame:
    return t.rank_rows.select("event_id", parsing.missing_to_null(F.col("rank_id")).alias("rank_id"))


@query(
    "safe_number",
    with_views("SELECT event_id, TRY_CAST(total AS DOUBLE) AS total FROM rank_rows", "rank_rows"),
)
def safe_number(t: Tables) -> DataFrame:
    return t.rank_rows.select("event_id", parsing.to_number(F.col("total")).alias("total"))
