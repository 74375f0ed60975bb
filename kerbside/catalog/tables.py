"""The test tables seen as mobility data.

Each view is one SQL text used twice: by Spark as a query and by the oracles as a CTE. Missing
values, negative amounts, duplicates and out-of-month trips are derived from the row id, so that
every rule has rows on both sides.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.operators.series import SeriesShape

# The daily series steps by day and looks back four weeks.
DAILY = SeriesShape(step="1 DAY", unit="day", lags=(1, 2, 7, 28), windows=(3, 7, 28), week=7)

# {add} stands for the dialect's "timestamp plus whole seconds".
_VIEWS = {
    "raw_events": """
        SELECT * FROM {events} UNION ALL SELECT * FROM {events} WHERE event_id % 500 = 0""",
    "trips": """
        SELECT event_id AS trip_id,
          CAST(event_id % 2 + 1 AS INT) AS VendorID,
          CASE WHEN event_id % 211 = 5 THEN NULL
               WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 YEAR ELSE ts END AS tpep_pickup_datetime,
          CASE WHEN event_id % 223 = 7 THEN NULL
               WHEN event_id % 41 = 0 THEN ts - INTERVAL 60 SECOND
               ELSE {add_duration} END AS tpep_dropoff_datetime,
          CAST(event_id % 7 AS INT) AS passenger_count,
          CASE WHEN event_id % 229 = 9 THEN NULL
               WHEN event_id % 61 = 0 THEN -value / 20
               WHEN event_id % 43 = 0 THEN value * 2 ELSE value / 20 END AS trip_distance,
          CAST(event_id % 6 + 1 AS INT) AS RatecodeID,
          user_id AS PULocationID,
          (user_id * 7 + event_id) % 160 AS DOLocationID,
          CAST(event_id % 5 + 1 AS INT) AS payment_type,
          CASE WHEN event_id % 227 = 3 THEN NULL
               WHEN event_id % 53 = 0 THEN -(2.5 + value / 4) ELSE 2.5 + value / 4 END AS fare_amount,
          value / 40 AS tip_amount,
          CASE WHEN event_id % 10 = 0 THEN 5.5e0 ELSE 0e0 END AS tolls_amount,
          CASE WHEN event_id % 59 = 0 THEN -(2.5 + value / 3) ELSE 2.5 + value / 3 END AS total_amount,
          CAST(year(ts) AS INT) AS year,
          CAST(month(ts) AS INT) AS month
        FROM {raw_events}""",
    "zones": """
        SELECT s_suppkey AS LocationID, r_name AS Borough, s_name AS Zone, n_name AS service_zone
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
          JOIN {region} ON n_regionkey = r_regionkey""",
    "hourly": """
        SELECT user_id AS pickup_zone_id, {hour_of_ts} AS pickup_hour, count(*) AS trip_count
        FROM {events} GROUP BY 1, 2""",
    "demand": """
        SELECT user_id % 25 + 120 AS pickup_zone_id, {hour_of_ts} AS pickup_hour, count(*) AS trip_count
        FROM {events} GROUP BY 1, 2""",
    "daily": """
        SELECT l_suppkey % 25 + 120 AS pickup_zone_id, l_shipdate AS pickup_hour, count(*) AS trip_count
        FROM {lineitem} GROUP BY 1, 2""",
    "legacy": """
        SELECT event_id AS trip_id,
          'M' || CAST(user_id % 50 AS STRING) AS medallion,
          'H' || CAST(user_id AS STRING) AS hack_license,
          CASE WHEN event_id % 2 = 0 THEN 'CMT' ELSE 'VTS' END AS vendor_id,
          CAST(event_id % 7 AS INT) AS rate_code,
          ts AS pickup_datetime,
          CASE WHEN event_id % 41 = 0 THEN ts - INTERVAL 60 SECOND ELSE {add_duration} END AS dropoff_datetime,
          CAST(event_id % 8 AS INT) AS passenger_count,
          CAST(floor(value * 10) AS BIGINT) + CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS trip_time_in_secs,
          value * (event_id % 100) / 1000 AS trip_distance,
          CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 0e0
               ELSE -74.3e0 + ((user_id * 131 + event_id * 17) % 1000) * 7e-4 END AS pickup_longitude,
          40.45e0 + ((event_id * 37) % 1000) * 5e-4 AS pickup_latitude,
          CASE WHEN event_id % 107 = 0 THEN -74.3e0 + ((user_id * 131 + event_id * 17) % 1000) * 7e-4
               ELSE -74.3e0 + ((user_id * 57 + event_id * 29) % 1000) * 7e-4 END AS dropoff_longitude,
          CASE WHEN event_id % 107 = 0 THEN 40.45e0 + ((event_id * 37) % 1000) * 5e-4
               ELSE 40.45e0 + ((event_id * 53) % 1000) * 5e-4 END AS dropoff_latitude,
          CASE event_type WHEN 'click' THEN 'CRD' WHEN 'view' THEN 'CSH' WHEN 'error' THEN 'DIS' ELSE 'NOC' END
            AS payment_type,
          2.5 + value * (event_id % 13) / 30 AS fare_amount,
          CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 0.5e0 ELSE 0e0 END AS surcharge,
          CASE WHEN event_id % 127 = 0 THEN -0.5e0 ELSE 0.5e0 END AS mta_tax,
          value * (event_id % 5) / 50 AS tip_amount,
          CASE WHEN event_id % 10 = 0 THEN 5.5e0 ELSE 0e0 END AS tolls_amount,
          3.0 + value * (event_id % 13) / 30 + value * (event_id % 5) / 50 AS total_amount
        FROM {events}""",
    "rank_rows": """
        SELECT event_id, ts,
          CASE WHEN event_id % 71 = 0 THEN 'N/A' ELSE 'R' || CAST(user_id AS STRING) END AS rank_id,
          CASE WHEN event_id % 3 = 0 THEN 'Passenger' WHEN event_id % 3 = 1 THEN 'taxi'
               WHEN event_id % 19 = 0 THEN 'bus' ELSE 'WAT' END AS class,
          CASE WHEN event_id % 3 = 0
               THEN CASE event_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'None' END
               ELSE CASE WHEN event_id % 37 = 0 THEN 'many' ELSE CAST(event_id % 23 AS STRING) END END AS total,
          CASE WHEN event_id % 83 = 0 THEN 'soon' ELSE {iso_start} END AS start_time,
          CASE WHEN event_id % 67 = 0 THEN {iso_late} ELSE {iso_end} END AS end_time,
          CASE WHEN event_id % 29 = 0 THEN '-1' WHEN event_id % 31 = 0 THEN '' ELSE CAST(event_id % 600 AS STRING) END
            AS average_wait,
          CASE WHEN event_id % 17 = 0 THEN 'N/A' ELSE CAST(1000 + event_id % 50 AS STRING) END AS tsn,
          CASE WHEN event_id % 5 = 0 THEN 'lane closed' ELSE 'None' END AS comments,
          CASE WHEN event_id % 43 = 0 THEN 'few' ELSE CAST(4 + event_id % 9 AS STRING) END AS total_bays,
          CASE WHEN event_id % 3 = 0 THEN CASE event_id % 5 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' WHEN 2 THEN '' ELSE 'Medium' END
               ELSE CAST(event_id % 19 AS STRING) END AS from_previous_count,
          CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 7 = 0 THEN 'Medium' ELSE 'Low' END
               WHEN event_id % 53 = 0 THEN 'N/A' ELSE CAST(event_id % 29 AS STRING) END AS new_arrivals
        FROM {events}""",
}

# Base tables and views each view reads.
_READS = {
    "raw_events": ("events",),
    "trips": ("events", "raw_events"),
    "zones": ("supplier", "nation", "region"),
    "hourly": ("events",),
    "demand": ("events",),
    "daily": ("lineitem",),
    "legacy": ("events",),
    "rank_rows": ("events",),
}
_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_DUCK = {
    "add_duration": "ts + to_seconds(CAST(floor(value * 10) AS BIGINT))",
    "hour_of_ts": "date_trunc('hour', ts)",
    "iso_start": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
    "iso_end": "strftime(ts + INTERVAL 900 SECOND, '%Y-%m-%dT%H:%M:%SZ')",
    "iso_late": "strftime(ts + INTERVAL 600 SECOND, '%Y-%m-%dT%H:%M:%SZ')",
}
_SPARK = {
    "add_duration": "timestampadd(SECOND, CAST(floor(value * 10) AS BIGINT), ts)",
    "hour_of_ts": "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)",
    "iso_start": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "iso_end": "date_format(ts + INTERVAL 900 SECOND, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "iso_late": "date_format(ts + INTERVAL 600 SECOND, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
}


class Tables:
    """Spark side of the views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.kept: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        reads = {n: self.base(n) if n in _BASE else self.view(n) for n in _READS[name]}
        text = _VIEWS[name].format(**_SPARK, **{n: "{" + n + "}" for n in reads})
        used = {n: frame for n, frame in reads.items() if "{" + n + "}" in text}
        return self.spark.sql(text, **used)

    trips = cached_property(lambda self: self.view("trips"))
    zones = cached_property(lambda self: self.view("zones"))
    hourly = cached_property(lambda self: self.view("hourly"))
    demand = cached_property(lambda self: self.view("demand"))
    daily = cached_property(lambda self: self.view("daily"))
    legacy = cached_property(lambda self: self.view("legacy"))
    rank_rows = cached_property(lambda self: self.view("rank_rows"))

    @cached_property
    def forecast(self) -> DataFrame:
        """Per zone: the last week of hours and twelve hours beyond the actuals."""
        last = self.demand.agg(F.max("pickup_hour")).scalar()
        hours = F.sequence(
            last - F.expr("INTERVAL 167 HOUR"), last + F.expr("INTERVAL 12 HOUR"), F.expr("INTERVAL 1 HOUR")
        )
        zones = self.demand.select("pickup_zone_id").distinct()
        pairs = zones.select("pickup_zone_id", F.explode(hours).alias("forecast_hour"))
        guess = ((F.col("pickup_zone_id") * 7 + F.hour("forecast_hour") * 3) % 11) / F.lit(8.0)
        return pairs.withColumn("predicted_trip_count", guess)


def _cte(name: str) -> str:
    names = {n: n for n in (*_BASE, *_VIEWS)}
    return f"{name} AS ({_VIEWS[name].format(**_DUCK, **names)})"


# One condition a flag; unknown where it reads a missing value. ``seconds`` is the whole length of a trip.
_CONDITIONS = {
    "missing_pickup_datetime": "tpep_pickup_datetime IS NULL",
    "missing_dropoff_datetime": "tpep_dropoff_datetime IS NULL",
    "pickup_outside_partition": "12 * year(tpep_pickup_datetime) + month(tpep_pickup_datetime) <> 12 * year + month",
    "unknown_pickup_zone": "NOT coalesce(PULocationID IN (SELECT LocationID FROM zones), FALSE)",
    "unknown_dropoff_zone": "NOT coalesce(DOLocationID IN (SELECT LocationID FROM zones), FALSE)",
    "nonpositive_duration": "sign(seconds) < 1",
    "negative_distance": "sign(trip_distance) = -1",
    "negative_fare": "sign(fare_amount) = -1",
    "negative_total": "sign(total_amount) = -1",
    "implausible_speed": "CASE WHEN seconds > 0 THEN mph > 100 END",
    "candidate_duplicate": "identity IN (SELECT identity FROM numbered GROUP BY identity HAVING count(*) > 1)",
}
_FOR_DEMAND = ("missing_pickup_datetime", "pickup_outside_partition", "unknown_pickup_zone")
_FOR_FARE = (*_FOR_DEMAND, "missing_dropoff_datetime", "nonpositive_duration", "negative_distance", "negative_fare", "negative_total")
_IDENTITY = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "fare_amount",
    "total_amount",
)


def _eligible(flags: tuple[str, ...]) -> str:
    """True with none of the flags raised, unknown with none raised but some unknown."""
    own = f"FILTER (WHERE flag IN ({', '.join(repr(f) for f in flags)}))"
    return f"CASE WHEN count_if(raised) {own} > 0 THEN FALSE WHEN count(raised) {own} = {len(flags)} THEN TRUE END"


_DERIVED = {
    "numbered": (
        ("raw_events", "trips", "zones"),
        f"""SELECT *, CASE WHEN seconds > 0 THEN trip_distance / (seconds / 3600e0) END AS mph,
          md5(concat_ws('/', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '?')" for c in _IDENTITY)})) AS identity
        FROM (SELECT row_number() OVER (ORDER BY trip_id) AS place, *,
          CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT) AS seconds
          FROM trips)""",
    ),
    "raised_flags": (
        ("numbered",),
        " UNION ALL ".join(f"SELECT place, '{flag}' AS flag, {test} AS raised FROM numbered" for flag, test in _CONDITIONS.items()),
    ),
    "judged": (
        ("raised_flags",),
        f"""SELECT place, {_eligible(_FOR_DEMAND)} AS dq_valid_for_demand, {_eligible(_FOR_FARE)} AS dq_valid_for_fare,
          {", ".join(f"bool_or(raised) FILTER (WHERE flag = '{flag}') AS dq_{flag}" for flag in _CONDITIONS)}
        FROM raised_flags GROUP BY place""",
    ),
    "silver": (
        ("judged",),
        """SELECT t.* EXCLUDE (place, seconds, mph, identity), seconds AS derived_duration_seconds, mph AS derived_speed_mph,
          up.Borough AS pickup_borough, up.Zone AS pickup_zone, up.service_zone AS pickup_service_zone,
          off.Borough AS dropoff_borough, off.Zone AS dropoff_zone, off.service_zone AS dropoff_service_zone, j.* EXCLUDE (place)
        FROM judged j JOIN numbered t USING (place) LEFT JOIN zones off ON off.LocationID = t.DOLocationID
          LEFT JOIN zones up ON up.LocationID = t.PULocationID""",
    ),
    "gold": (
        ("silver",),
        """SELECT CAST(LocationID AS INTEGER) AS pickup_zone_id, Borough AS pickup_borough, Zone AS pickup_zone, pickup_hour, trip_count
        FROM zones JOIN (
          SELECT PULocationID AS LocationID, time_bucket(INTERVAL 1 HOUR, tpep_pickup_datetime) AS pickup_hour, count(*) AS trip_count
          FROM silver WHERE dq_valid_for_demand GROUP BY ALL) USING (LocationID)""",
    ),
    "grid": (
        ("hourly",),
        """SELECT z.pickup_zone_id, h.pickup_hour, CAST(coalesce(o.trip_count, 0) AS DOUBLE) AS trip_count
        FROM (SELECT DISTINCT pickup_zone_id FROM hourly) z
        CROSS JOIN (SELECT unnest(generate_series(min(pickup_hour), max(pickup_hour), INTERVAL 1 HOUR)) AS pickup_hour
          FROM hourly) h
        LEFT JOIN hourly o ON o.pickup_zone_id = z.pickup_zone_id AND o.pickup_hour = h.pickup_hour""",
    ),
    "day_grid": (
        ("daily",),
        """SELECT z.pickup_zone_id, h.pickup_hour, CAST(coalesce(o.trip_count, 0) AS DOUBLE) AS trip_count
        FROM (SELECT DISTINCT pickup_zone_id FROM daily) z
        CROSS JOIN (SELECT unnest(generate_series(min(pickup_hour), max(pickup_hour), INTERVAL 1 DAY)) AS pickup_hour
          FROM daily) h
        LEFT JOIN daily o ON o.pickup_zone_id = z.pickup_zone_id AND o.pickup_hour = h.pickup_hour""",
    ),
    "forecast_hours": (
        ("demand",),
        """SELECT unnest(generate_series(max(pickup_hour) - INTERVAL 167 HOUR, max(pickup_hour) + INTERVAL 12 HOUR,
        INTERVAL 1 HOUR)) AS forecast_hour FROM demand""",
    ),
    "forecast": (
        ("forecast_hours",),
        """SELECT z.pickup_zone_id, h.forecast_hour,
          ((z.pickup_zone_id * 7 + hour(h.forecast_hour) * 3) % 11) / 8e0 AS predicted_trip_count
        FROM (SELECT DISTINCT pickup_zone_id FROM demand) z, forecast_hours h""",
    ),
    "scored": (
        ("forecast",),
        """SELECT f.*, coalesce(CAST(a.trip_count AS DOUBLE), 0) AS trip_count,
          coalesce(CAST(b.trip_count AS DOUBLE), 0) AS previous_week, hour(f.forecast_hour) AS hour,
          strftime(f.forecast_hour, '%Y-%m') AS month,
          CASE WHEN f.pickup_zone_id IN (132, 138) THEN 'airport' ELSE 'non_airport' END AS market
        FROM forecast f
        LEFT JOIN demand a ON a.pickup_zone_id = f.pickup_zone_id AND a.pickup_hour = f.forecast_hour
        LEFT JOIN demand b ON b.pickup_zone_id = f.pickup_zone_id
          AND b.pickup_hour + INTERVAL 7 DAY = f.forecast_hour
        WHERE f.forecast_hour <= (SELECT max(pickup_hour) FROM demand)""",
    ),
    "featured": (
        ("legacy",),
        """SELECT *, CAST(pickup_datetime AS DATE) AS pickup_date, hour(pickup_datetime) AS pickup_hour,
          coalesce(fare_amount, 0) + coalesce(surcharge, 0) + coalesce(tip_amount, 0) AS earning
        FROM legacy""",
    ),
    "sums": (
        ("featured",),
        """SELECT hack_license, sum(earning) / count(DISTINCT pickup_date) AS average_daily_income,
          sum(trip_time_in_secs) / 3600e0 / count(DISTINCT pickup_date) AS average_daily_hours
        FROM featured GROUP BY 1""",
    ),
}


def _needs(name: str) -> list[str]:
    """The named CTE's dependencies, deepest first."""
    reads = _DERIVED[name][0] if name in _DERIVED else _READS.get(name, ())
    order: list[str] = []
    for dependency in reads:
        if dependency not in _BASE:
            order += [n for n in [*_needs(dependency), dependency] if n not in order]
    return order


def with_views(body: str, *names: str) -> str:
    """SQL text with the named views, and what they read, as CTEs."""
    order: list[str] = []
    for name in names:
        order += [n for n in [*_needs(name), name] if n not in order]
    parts = []
    for name in order:
        kept = " MATERIALIZED" if name == "numbered" else ""  # its numbers must be the same wherever they are read
        parts.append(f"{name} AS{kept} ({_DERIVED[name][1]})" if name in _DERIVED else _cte(name))
    return f"WITH {', '.join(parts)} {body}"
