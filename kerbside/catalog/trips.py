"""Silver flags, Gold demand and the descriptive report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.catalog.registry import query
from kerbside.catalog.support import dates_as_text, rounded
from kerbside.catalog.tables import Tables, with_views
from kerbside.functions import clock, rules
from kerbside.operators import gates, gold, profile, sampling, silver

FLAGS = list(silver.FLAG_COUNTS.values())
ATTRIBUTES = [f"{end}_{part}" for end in ("pickup", "dropoff") for part in ("borough", "zone", "service_zone")]
MEASURES = ["derived_duration_seconds", "derived_speed_mph"]


def flagged(t: Tables) -> DataFrame:
    return silver.with_flags(t.trips, t.zones)


def product(t: Tables) -> DataFrame:
    return gold.hourly_zone_demand_from_trips(t.trips, t.zones)


def _sql(columns: list[str]) -> str:
    return with_views(f"SELECT trip_id, {', '.join(columns)} FROM silver", "silver")


@query("silver_enrich", _sql(["trip_distance", "fare_amount", *ATTRIBUTES, *MEASURES, *FLAGS]))
def silver_enrich(t: Tables) -> DataFrame:
    enriched = silver.build_silver(t.trips, t.zones)
    return enriched.select("trip_id", "trip_distance", "fare_amount", *ATTRIBUTES, *MEASURES, *FLAGS)


SIMPLE_FLAGS = [f for f in FLAGS if f not in ("dq_candidate_duplicate", "dq_valid_for_demand", "dq_valid_for_fare")]


@query("dq_flags", _sql(SIMPLE_FLAGS))
def dq_flags(t: Tables) -> DataFrame:
    return flagged(t).select("trip_id", *SIMPLE_FLAGS)


@query("eligibility_demand", _sql(["dq_valid_for_demand"]))
def eligibility_demand(t: Tables) -> DataFrame:
    return flagged(t).select("trip_id", "dq_valid_for_demand")


@query("eligibility_fare", _sql(["dq_valid_for_fare"]))
def eligibility_fare(t: Tables) -> DataFrame:
    return flagged(t).select("trip_id", "dq_valid_for_fare")


@query("derived_duration", _sql(["derived_duration_seconds"]))
def derived_duration(t: Tables) -> DataFrame:
    return silver.with_duration(t.trips).select("trip_id", "derived_duration_seconds")


@query("derived_speed", _sql(["derived_speed_mph"]))
def derived_speed(t: Tables) -> DataFrame:
    return silver.with_speed(silver.with_duration(t.trips)).select("trip_id", "derived_speed_mph")


@query("dq_candidate_duplicate", _sql(["dq_candidate_duplicate"]))
def dq_candidate_duplicate(t: Tables) -> DataFrame:
    return silver.flag_duplicates(t.trips).select("trip_id", "dq_candidate_duplicate")


@query("join_zone_roles", _sql(["PULocationID AS \"PULocationID\"", "DOLocationID AS \"DOLocationID\"", *ATTRIBUTES]))
def join_zone_roles(t: Tables) -> DataFrame:
    return silver.join_zone_roles(t.trips, t.zones).select("trip_id", "PULocationID", "DOLocationID", *ATTRIBUTES)


_COUNTS = ", ".join(f"count(*) FILTER (WHERE {flag}) AS {name}" for name, flag in silver.FLAG_COUNTS.items())


@query("quality_counts", with_views(f"SELECT count(*) AS source_rows, {_COUNTS} FROM silver", "silver"))
def quality_counts(t: Tables) -> DataFrame:
    return silver.quality_counts(silver.build_silver(t.trips, t.zones))


@query(
    "row_reconciliation",
    with_views(
        """SELECT CAST(month AS INTEGER) AS month, count(*) AS input_rows, count(*) AS output_rows,
        TRUE AS reconciled FROM trips GROUP BY 1""",
        "trips",
    ),
)
def row_reconciliation(t: Tables) -> DataFrame:
    return silver.reconcile(t.trips, silver.build_silver(t.trips, t.zones), "month")


@query(
    "row_reconciliation_loss",
    with_views(
        """SELECT CAST(month AS INTEGER) AS month, count(*) AS input_rows, count(*) FILTER (WHERE trip_id % 17 <> 3) AS output_rows,
        count(*) = count(*) FILTER (WHERE trip_id % 17 <> 3) AS reconciled FROM trips GROUP BY 1""",
        "trips",
    ),
)
def row_reconciliation_loss(t: Tables) -> DataFrame:
    """The same reconciliation against an output that has lost rows, which it must report."""
    damaged = silver.build_silver(t.trips, t.zones).filter(F.col("trip_id") % 17 != 3)
    return silver.reconcile(t.trips, damaged, "month")


def _reports(t: Tables) -> DataFrame:
    """Quality reports per day of the trips, as the gates read them; trips without any time count under their delivery month."""
    enriched = silver.build_silver(t.trips, t.zones)
    day = F.date_format(F.coalesce("tpep_pickup_datetime", "tpep_dropoff_datetime"), "yyyy-MM-dd")
    delivered = F.coalesce(F.format_string("%04d-%02d", "year", "month"), F.lit("unknown"))
    counts = silver.quality_counts(enriched.withColumn("period", F.coalesce(day, delivered)), "period")
    return counts.withColumn("reconciled", F.col("source_rows") % 13 != 0)


_REPORTS = f"""SELECT coalesce(strftime(coalesce(tpep_pickup_datetime, tpep_dropoff_datetime), '%Y-%m-%d'),
    printf('%04d-%02d', year, month)) AS period,
  count(*) AS source_rows, {_COUNTS}, count(*) % 13 <> 0 AS reconciled FROM silver GROUP BY 1"""
_CHECKS = f"""
  SELECT period, 'reconciled' AS "check", CAST(CAST(reconciled AS INT) AS DOUBLE) AS value, 1e0 AS lim, reconciled AS passed, TRUE AS blocking FROM reports
  UNION ALL SELECT period, 'pickup_outside_partition_rate', pickup_outside_partition / source_rows, 0.0002e0, pickup_outside_partition / source_rows <= 0.0002e0, TRUE FROM reports
  UNION ALL SELECT period, 'unknown_pickup_zone_rate', unknown_pickup_zone / source_rows, 0.01e0, unknown_pickup_zone / source_rows <= 0.01e0, TRUE FROM reports
  UNION ALL SELECT period, 'candidate_duplicate_rows_rate', candidate_duplicate_rows / source_rows, 0.001e0, candidate_duplicate_rows / source_rows <= 0.001e0, TRUE FROM reports
  UNION ALL SELECT period, 'negative_fare_rate', negative_fare / source_rows, 0.03e0, negative_fare / source_rows <= 0.03e0, FALSE FROM reports
  UNION ALL SELECT period, 'implausible_speed_rate', implausible_speed / source_rows, 0.005e0, implausible_speed / source_rows <= 0.005e0, TRUE FROM reports
  UNION ALL SELECT period, 'demand_eligible_rate', demand_eligible / source_rows, 0.95e0, demand_eligible / source_rows >= 0.95e0, TRUE FROM reports"""


def _gate_sql(body: str) -> str:
    return with_views("", "silver").rstrip() + f", reports AS ({_REPORTS}), checks AS ({_CHECKS}) {body}"


@query(
    "quality_gate",
    _gate_sql('SELECT period, "check", round(value, 6) AS value, lim AS "limit", passed, blocking FROM checks'),
)
def quality_gate(t: Tables) -> DataFrame:
    return rounded(gates.quality_checks(_reports(t)))


@query(
    "gate_completeness",
    _gate_sql(
        """SELECT count(*) AS expected_periods, count(*) FILTER (WHERE v.passed IS NULL) AS missing_reports,
          bool_and(coalesce(v.passed, FALSE)) AS passed
        FROM (SELECT DISTINCT strftime(ts + INTERVAL 5 DAY, '%Y-%m-%d') AS period FROM events) e
        LEFT JOIN (SELECT period, bool_and(passed OR NOT blocking) AS passed FROM checks GROUP BY 1) v
          ON e.period = v.period"""
    ),
)
def gate_completeness(t: Tables) -> DataFrame:
    expected = t.base("events").select(F.date_format(clock.shift("ts", days=5), "yyyy-MM-dd").alias("period"))
    return gates.completeness(expected, gates.quality_verdict(gates.quality_checks(_reports(t))))


@query(
    "anti_missing_reports",
    with_views(
        """SELECT DISTINCT strftime(ts + INTERVAL 5 DAY, '%Y-%m-%d') AS period FROM events
        WHERE strftime(ts + INTERVAL 5 DAY, '%Y-%m-%d') NOT IN
          (SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d') FROM trips WHERE tpep_pickup_datetime IS NOT NULL)""",
        "trips",
    ),
)
def anti_missing_reports(t: Tables) -> DataFrame:
    expected = t.base("events").select(F.date_format(clock.shift("ts", days=5), "yyyy-MM-dd").alias("period"))
    reported = t.trips.select(F.date_format("tpep_pickup_datetime", "yyyy-MM-dd").alias("period"))
    return gates.missing_reports(expected, reported.distinct())


@query("gold_demand", with_views("SELECT * FROM gold", "gold"))
def gold_demand(t: Tables) -> DataFrame:
    return product(t)


@query(
    "hourly_demand_stats",
    with_views(
        """SELECT CAST(PULocationID AS INTEGER) AS pickup_zone_id, date_trunc('hour', tpep_pickup_datetime) AS pickup_hour,
          count(*) AS trip_count, round(avg(CASE WHEN fare_amount >= 0 THEN fare_amount END), 6) AS avg_fare,
          round(avg(CASE WHEN trip_distance >= 0 THEN trip_distance END), 6) AS avg_distance,
          round(avg(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime))
            FILTER (WHERE tpep_dropoff_datetime >= tpep_pickup_datetime), 6) AS avg_duration_seconds
        FROM trips WHERE PULocationID BETWEEN 1 AND 265 AND tpep_pickup_datetime IS NOT NULL GROUP BY 1, 2""",
        "trips",
    ),
)
def hourly_demand_stats(t: Tables) -> DataFrame:
    return rounded(gold.hourly_demand_stats(t.trips))


def _gold(name: str, sql: str):
    return query(name, with_views(sql, "gold"))


@_gold("lineage_totals", "SELECT count(*) AS rows, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold")
def lineage_totals(t: Tables) -> DataFrame:
    return gold.product_totals(product(t))


@_gold(
    "eda_monthly",
    "SELECT CAST(date_trunc('month', pickup_hour) AS TIMESTAMP) AS month, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold GROUP BY 1",
)
def eda_monthly(t: Tables) -> DataFrame:
    return gold.monthly(product(t))


@_gold(
    "eda_weekday_hour",
    """SELECT CAST(dayofweek(pickup_hour) AS INTEGER) AS day_of_week, CAST(hour(pickup_hour) AS INTEGER) AS hour,
    CAST(sum(trip_count) AS BIGINT) AS trips FROM gold GROUP BY 1, 2""",
)
def eda_weekday_hour(t: Tables) -> DataFrame:
    return gold.weekday_hour(product(t))


_CELLS = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN hour(pickup_hour) = {h} THEN trip_count END), 0) AS BIGINT) AS h{h:02d}" for h in range(24)
)


@_gold(
    "pivot_weekday_hour",
    f"""SELECT CAST(d.day_of_week AS INTEGER) AS day_of_week, {_CELLS}
    FROM (SELECT unnest(range(7)) AS day_of_week) d LEFT JOIN gold g ON dayofweek(g.pickup_hour) = d.day_of_week GROUP BY 1""",
)
def pivot_weekday_hour(t: Tables) -> DataFrame:
    return gold.weekday_hour_matrix(product(t))


@_gold("eda_borough", "SELECT pickup_borough AS borough, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold GROUP BY 1")
def eda_borough(t: Tables) -> DataFrame:
    return gold.by_borough(product(t))


@_gold(
    "top_zones",
    """SELECT pickup_zone_id, pickup_zone, pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold
    GROUP BY 1, 2, 3 ORDER BY trips DESC, pickup_zone_id LIMIT 15""",
)
def top_zones(t: Tables) -> DataFrame:
    return gold.top_zones(product(t))


@_gold(
    "eda_airport",
    """SELECT CASE WHEN pickup_zone_id IN (32, 38) THEN 'Airport' ELSE 'Non-airport' END AS segment,
    CAST(sum(trip_count) AS BIGINT) AS trips FROM gold GROUP BY 1""",
)
def eda_airport(t: Tables) -> DataFrame:
    return gold.by_airport(product(t), (32, 38))


@query(
    "eda_day_type",
    with_views(
        """, days AS (SELECT CAST(pickup_hour AS DATE) AS day, sum(trip_count) AS n FROM gold GROUP BY 1),
        kinds AS (SELECT if(strftime(day, '%a') IN ('Sat', 'Sun'), 'Weekend', 'Weekday') AS day_type, n FROM days)
        SELECT day_type, CAST(sum(n) AS BIGINT) AS trips, count(*) AS calendar_days, round(avg(n), 6) AS pickups_per_day
        FROM kinds GROUP BY day_type""",
        "gold",
    ),
)
def eda_day_type(t: Tables) -> DataFrame:
    return rounded(gold.by_day_type(product(t)))


@_gold(
    "eda_summary",
    """SELECT CAST(sum(trip_count) AS BIGINT) AS eligible_pickups,
      (SELECT CAST(CAST(date_trunc('month', pickup_hour) AS DATE) AS VARCHAR) FROM gold GROUP BY 1
        ORDER BY sum(trip_count) DESC, 1 LIMIT 1) AS peak_month,
      (SELECT pickup_borough FROM gold GROUP BY 1 ORDER BY sum(trip_count) DESC, 1 LIMIT 1) AS top_borough,
      (SELECT pickup_zone FROM gold GROUP BY pickup_zone_id, pickup_zone
        ORDER BY sum(trip_count) DESC, pickup_zone_id LIMIT 1) AS top_zone,
      CAST(coalesce(sum(trip_count) FILTER (WHERE pickup_zone_id IN (32, 38)), 0) AS BIGINT) AS airport_pickups,
      (SELECT round(sum(trip_count) / count(DISTINCT CAST(pickup_hour AS DATE)), 2) FROM gold
        WHERE dayofweek(pickup_hour) NOT IN (0, 6)) AS weekday_pickups_per_day,
      (SELECT round(sum(trip_count) / count(DISTINCT CAST(pickup_hour AS DATE)), 2) FROM gold
        WHERE dayofweek(pickup_hour) IN (0, 6)) AS weekend_pickups_per_day
    FROM gold""",
)
def eda_summary(t: Tables) -> DataFrame:
    return dates_as_text(gold.summary(product(t), (32, 38)))


def _silver(name: str, sql: str):
    return query(name, with_views(sql, "silver"))


def _at(p: float, value: str, rank: str) -> str:
    """The quantile of ``n`` ranked values: at most two ranks, counted from 0, lie within 1 of its place."""
    return f"round(sum({value} * greatest(0, 1 - abs({rank} - (n - 1) * {p}e0))), 6)"


@_silver(
    "eda_fare_distribution",
    f"""SELECT max(n) AS fare_eligible_rows, round(sum(fare) / max(n), 6) AS mean_fare, round(sum(miles) / max(n), 6) AS mean_distance,
      round(sum(minutes) / max(n), 6) AS mean_duration_minutes, {_at(0.5, "fare", "f")} AS median_fare, {_at(0.95, "fare", "f")} AS p95_fare,
      {_at(0.5, "miles", "m")} AS median_distance, {_at(0.5, "minutes", "t")} AS median_duration_minutes
    FROM (SELECT fare_amount AS fare, trip_distance AS miles, derived_duration_seconds / 60 AS minutes, count(*) OVER () AS n,
      row_number() OVER (ORDER BY fare_amount) - 1 AS f, row_number() OVER (ORDER BY trip_distance) - 1 AS m,
      row_number() OVER (ORDER BY derived_duration_seconds) - 1 AS t FROM silver WHERE dq_valid_for_fare)""",
)
def eda_fare_distribution(t: Tables) -> DataFrame:
    return rounded(gold.fare_distribution(flagged(t)))


@_silver("eda_payment", "SELECT payment_type, count(*) AS trips FROM silver WHERE dq_valid_for_fare GROUP BY 1")
def eda_payment(t: Tables) -> DataFrame:
    return gold.by_payment(flagged(t))


_BANDED = """bands(place, distance_miles, low, high) AS (
      VALUES (1, '<1', '-infinity'::DOUBLE, 1), (2, '1-3', 1, 3), (3, '3-10', 3, 10), (4, '10+', 10, 'infinity'::DOUBLE)),
    banded AS (
      SELECT place, distance_miles, fare_amount AS fare, count(*) OVER band AS n, row_number() OVER (band ORDER BY fare_amount) - 1 AS f
      FROM silver JOIN bands ON low <= trip_distance AND trip_distance < high WHERE dq_valid_for_fare
      WINDOW band AS (PARTITION BY place))"""


@_silver(
    "eda_distance_bands",
    f""", {_BANDED} SELECT distance_miles, count(*) AS trips, {_at(0.5, "fare", "f")} AS median_fare, {_at(0.95, "fare", "f")} AS p95_fare
    FROM banded GROUP BY distance_miles""",
)
def eda_distance_bands(t: Tables) -> DataFrame:
    return rounded(gold.by_distance_band(flagged(t)))


@_silver(
    "band_ordered",
    f""", {_BANDED} SELECT distance_miles, count(*) AS trips, CAST(rank() OVER (ORDER BY place) AS BIGINT) AS place
    FROM banded GROUP BY banded.place, distance_miles""",
)
def band_ordered(t: Tables) -> DataFrame:
    bands = gold.by_distance_band(flagged(t)).select("distance_miles", "trips")
    ordered = bands.agg(
        F.array_sort(F.collect_list(F.struct(rules.distance_band_rank("distance_miles").alias("rank"), "distance_miles", "trips"))).alias("b")
    )
    return ordered.select(F.posexplode("b").alias("place", "b")).select(
        "b.distance_miles", "b.trips", (F.col("place") + 1).cast("bigint").alias("place")
    )


@query(
    "eda_quality_totals",
    _gate_sql(
        " UNION ALL ".join(
            f"SELECT '{flag}' AS quality_flag, CAST(sum({flag}) AS BIGINT) AS rows FROM reports"
            for flag in gold.REPORTED_FLAGS
        )
    ),
)
def eda_quality_totals(t: Tables) -> DataFrame:
    return gold.flag_totals(_reports(t))


@query(
    "stratified_sample_rank",
    with_views(
        """SELECT trip_id, row_number() OVER (PARTITION BY CAST(tpep_pickup_datetime AS DATE)
          ORDER BY md5(concat_ws('|', strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), CAST(PULocationID AS VARCHAR),
            CAST(DOLocationID AS VARCHAR), CAST(trip_id AS VARCHAR))), trip_id) AS sample_rank
        FROM trips WHERE tpep_pickup_datetime IS NOT NULL""",
        "trips",
    ),
)
def stratified_sample_rank(t: Tables) -> DataFrame:
    texted = t.trips.withColumn("_at", F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return sampling.rank_within_day(texted, "trip_id", key=("_at", "PULocationID", "DOLocationID", "trip_id")).select("trip_id", "sample_rank")


@query(
    "deterministic_sample",
    with_views(
        """SELECT trip_id FROM (SELECT trip_id, CAST(tpep_pickup_datetime AS DATE) AS d,
          row_number() OVER (PARTITION BY CAST(tpep_pickup_datetime AS DATE)
            ORDER BY md5(concat_ws('|', strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), CAST(PULocationID AS VARCHAR),
              CAST(DOLocationID AS VARCHAR), CAST(trip_id AS VARCHAR))), trip_id) AS r
        FROM trips WHERE tpep_pickup_datetime IS NOT NULL) ORDER BY r, md5(CAST(d AS VARCHAR)), d LIMIT 10000""",
        "trips",
    ),
)
def deterministic_sample(t: Tables) -> DataFrame:
    texted = t.trips.withColumn("_at", F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return sampling.stratified_sample(texted, 10_000, "trip_id", key=("_at", "PULocationID", "DOLocationID", "trip_id")).select("trip_id")


@query(
    "drop_columns",
    with_views("SELECT trip_id, fare_amount, tip_amount FROM trips", "trips"),
)
def drop_columns(t: Tables) -> DataFrame:
    keep = {"trip_id", "fare_amount", "tip_amount"}
    return t.trips.drop(*[c for c in t.trips.columns if c not in keep])


@query(
    "union_distinct_ids",
    with_views(
        'SELECT PULocationID AS "LocationID" FROM trips UNION SELECT DOLocationID FROM trips', "trips"
    ),
)
def union_distinct_ids(t: Tables) -> DataFrame:
    ends = t.trips.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("LocationID"))
    return ends.distinct()


_TRIP_COLUMNS = (
    "trip_id", "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "RatecodeID",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount", "tip_amount", "tolls_amount", "total_amount", "year", "month",
)


@query(
    "null_profile",
    with_views(
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM trips" for c in _TRIP_COLUMNS), "trips"
    ),
)
def null_profile(t: Tables) -> DataFrame:
    """Every column of the trips."""
    return profile.null_counts(t.trips)
