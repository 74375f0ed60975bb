"""Reading, writing, discovering and checking tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window, functions as F

from kerbside.catalog.registry import query
from kerbside.catalog.support import name_files_by_month, written
from kerbside.catalog.tables import Tables, with_views
from kerbside.functions import parsing
from kerbside.operators import gold, silver
from kerbside.plans import monthly_release
from kerbside.session import scratch_path
from kerbside.sources import digests, months, rank_feed, tables


def _by_pickup_month(t: Tables) -> DataFrame:
    at = F.col("tpep_pickup_datetime")
    dated = t.trips.filter(at.isNotNull())
    return dated.withColumns({"year": F.year(at), "month": F.month(at)})


@query(
    "scan_trips_partitioned",
    with_views(
        """SELECT trip_id, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
          CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, fare_amount
        FROM trips WHERE year(tpep_pickup_datetime) = 2024""",
        "trips",
    ),
)
def scan_trips_partitioned(t: Tables) -> DataFrame:
    root = written(_by_pickup_month(t), "bronze", "year", "month")
    found = months.read_partitioned(t.spark, root, "2023-02", "2024-12")
    return found.select("trip_id", "year", "month", "fare_amount")


@query(
    "scan_union_by_name",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS trips,
      sum(CAST(l_linenumber AS DOUBLE)) AS passengers, count(CASE WHEN month(l_shipdate) % 3 > 0 THEN l_tax END) AS with_tolls
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-11-01' AND l_shipdate < TIMESTAMP '1998-03-01' GROUP BY 1, 2""",
)
def scan_union_by_name(t: Tables) -> DataFrame:
    """Months that hold passengers as INTEGER, BIGINT or DOUBLE in turn, the first kind without the column of tolls."""
    root, at = scratch_path(t.spark, "evolving"), F.col("l_shipdate")
    shipped = t.base("lineitem").select(
        F.year(at).alias("year"), F.month(at).alias("month"), F.col("l_linenumber").alias("passenger_count"), F.col("l_tax").alias("tolls_amount")
    )
    for rest, kind in enumerate(("int", "bigint", "double")):
        part = shipped.filter(F.col("month") % 3 == rest).withColumn("passenger_count", F.col("passenger_count").cast(kind))
        part = part if rest else part.drop("tolls_amount")
        part.repartition("year", "month").write.mode("append").partitionBy("year", "month").parquet(root)
    merged = months.read_partitioned(t.spark, root, "1996-11", "1998-02")
    return merged.groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers"), F.count("tolls_amount").alias("with_tolls")
    )


@query(
    "scan_month_bounded",
    with_views(
        """SELECT trip_id, tpep_pickup_datetime, CAST(passenger_count AS DOUBLE) AS passenger_count FROM trips
        WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01' AND trip_id % 2 = 0
          OR tpep_pickup_datetime >= TIMESTAMP '2024-02-01' AND tpep_pickup_datetime < TIMESTAMP '2024-03-01' AND trip_id % 2 = 1""",
        "trips",
    ),
)
def scan_month_bounded(t: Tables) -> DataFrame:
    """Two deliveries of different types, each with trips of all months: even trips as January, odd ones as February."""
    root = scratch_path(t.spark, "deliveries")
    for rest, (period, kind) in enumerate((("2024-01", "bigint"), ("2024-02", "double"))):
        part = t.trips.filter(F.col("trip_id") % 2 == rest).drop("year", "month")
        part.withColumn("passenger_count", F.col("passenger_count").cast(kind)).write.parquet(f"{root}/{period}")
        name_files_by_month(t.spark, f"{root}/{period}", period)
    return months.read_month_bounded(t.spark, root).select("trip_id", "tpep_pickup_datetime", "passenger_count")


@query(
    "scan_csv_legacy",
    with_views(
        "SELECT trip_id, hack_license, pickup_datetime, trip_distance, surcharge FROM legacy",
        "legacy",
    ),
)
def scan_csv_legacy(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "legacy-csv")
    timed = t.legacy.withColumns({c: F.col(c).cast("string") for c in ("pickup_datetime", "dropoff_datetime")})
    timed.write.option("header", True).csv(path)
    read = tables.read_csv(t.spark, path, t.legacy.schema)
    return read.select("trip_id", "hack_license", "pickup_datetime", "trip_distance", "surcharge")


@query(
    "scan_zone_lookup",
    with_views('SELECT LocationID AS "LocationID", Borough AS "Borough", Zone AS "Zone", service_zone FROM zones', "zones"),
)
def scan_zone_lookup(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "zones-csv")
    months.write_csv(t.zones, path)
    return tables.require_zone_dimension(tables.read_zones(t.spark, path))


@query(
    "validate_dimension",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def validate_dimension(t: Tables) -> DataFrame:
    return tables.key_violations(t.base("lineitem"), "l_orderkey", "l_linenumber")


def rank_documents(t: Tables) -> DataFrame:
    """One document per event with a good record and one that may miss a key or the array."""
    keys = [c for c in t.rank_rows.columns if c not in ("event_id", "ts")]
    good = F.struct(*keys)
    short = F.struct(*[key for key in keys if key != "average_wait"])
    event = F.col("event_id")
    text = (
        F.when(event % 101 == 0, F.to_json(F.struct(good.alias("something_else"))))
        .when(event % 89 == 0, F.to_json(F.struct(F.array(short).alias("rank_history"))))
        .otherwise(F.to_json(F.struct(F.array(good).alias("rank_history"))))
    )
    return t.rank_rows.select(F.concat(F.lit("event-"), event.cast("string")).alias("source_file"), text.alias("document"))


@query(
    "scan_json_root_array",
    with_views(
        """SELECT 'event-' || CAST(event_id AS VARCHAR) AS source_file,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE rank_id END AS rank_id,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE start_time END AS start_time,
          CASE WHEN event_id % 101 = 0 THEN 'no rank_history array'
               WHEN event_id % 89 = 0 THEN 'missing average_wait' END AS problem
        FROM rank_rows""",
        "rank_rows",
    ),
)
def scan_json_root_array(t: Tables) -> DataFrame:
    records = rank_feed.root_records(rank_documents(t), "historical")
    return records.select(
        "source_file",
        F.col("record")["rank_id"].alias("rank_id"),
        F.col("record")["start_time"].alias("start_time"),
        "problem",
    )


@query("scan_hourly", with_views("SELECT pickup_zone_id, pickup_hour, trip_count FROM gold", "gold"))
def scan_hourly(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "gold")
    months.write_sorted(gold.hourly_zone_demand(silver.with_flags(t.trips, t.zones)), path, "pickup_hour", "pickup_zone_id")
    return t.spark.read.parquet(path).select("pickup_zone_id", "pickup_hour", "trip_count")


_FOUND = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "int",
    "fare_amount": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
}


@query(
    "schema_contract_check",
    with_views(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{kind}' AS found_type, TRUE AS conforms, count({c}) AS present FROM trips"
            for c, kind in _FOUND.items()
        ),
        "trips",
    ),
)
def schema_contract_check(t: Tables) -> DataFrame:
    """Contract columns of the trips: found type, verdict, rows with a value."""
    broken = {column for column, _, _ in tables.contract_violations(t.trips)}
    found = {field.name: field.dataType.simpleString() for field in t.trips.schema}
    entries = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(found.get(column)).alias("found_type"),
            F.lit(column not in broken).alias("conforms"),
            F.count(column).alias("present"),
        )
        for column in tables.TRIP_CONTRACT
    ]
    return t.trips.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


@query(
    "sink_parquet_zstd",
    with_views(
        """SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, count(*) AS trips,
          count(*) FILTER (WHERE dq_valid_for_demand) AS eligible FROM silver GROUP BY 1, 2""",
        "silver",
    ),
)
def sink_parquet_zstd(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "silver")
    months.write_partitioned(silver.with_flags(t.trips, t.zones), path)
    return (
        t.spark.read.parquet(path)
        .groupBy("year", "month")
        .agg(F.count("*").alias("trips"), F.count_if("dq_valid_for_demand").alias("eligible"))
    )


@query(
    "sink_csv",
    with_views("SELECT pickup_borough AS borough, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold GROUP BY 1", "gold"),
)
def sink_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "boroughs-csv")
    months.write_csv(gold.by_borough(gold.hourly_zone_demand(silver.with_flags(t.trips, t.zones))), path)
    return t.spark.read.csv(path, header=True, schema="borough string, trips bigint")


def _periods(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.date_format(column, "yyyy-MM").alias("period"))


@query(
    "incremental_partitions",
    """SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS period FROM lineitem
    WHERE strftime(l_shipdate, '%Y-%m') NOT IN
      (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderpriority = '1-URGENT' AND month(o_orderdate) < 7)""",
)
def incremental_partitions(t: Tables) -> DataFrame:
    orders = t.base("orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.month("o_orderdate") < 7))
    return months.pending_months(_periods(t.base("lineitem"), "l_shipdate"), _periods(orders, "o_orderdate"))


@query(
    "month_range",
    """SELECT strftime(unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
      INTERVAL 1 MONTH)), '%Y-%m') AS period FROM lineitem""",
)
def month_range(t: Tables) -> DataFrame:
    ends = t.base("lineitem").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    return months.month_range(ends.select(F.to_date("first").alias("first"), F.to_date("last").alias("last")), "first", "last")


@query(
    "release_window_union",
    """SELECT strftime(unnest(generate_series(date_trunc('month', min(d)), date_trunc('month', max(d)),
      INTERVAL 1 MONTH)), '%Y-%m') AS period
    FROM (SELECT o_orderdate AS d FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT ts FROM events)""",
)
def release_window_union(t: Tables) -> DataFrame:
    finished = t.base("orders").filter(F.col("o_orderstatus") == "F")
    return months.release_window(_periods(t.base("events"), "ts").distinct(), _periods(finished, "o_orderdate").distinct())


@query("file_digests")
def file_digests(t: Tables) -> DataFrame:
    found = digests.file_digests(t.spark, t.sf_dir)
    return digests.latest_records(found).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "bytes", "sha256"
    )


@query(
    "digests_known",
    """SELECT CAST(c_custkey // 100 AS BIGINT) AS file, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes,
      sha256(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS sha256, 1 AS copies
    FROM customer GROUP BY 1""",
)
def digests_known(t: Tables) -> DataFrame:
    """Digests of files of known content, a hundred customers each: full files in blocks, the others whole."""
    lines = t.base("customer").select(F.floor(F.col("c_custkey") / 100).alias("file"), "c_custkey", "c_name")
    path = scratch_path(t.spark, "known-files")
    listed = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("_of"))
    listed.select("file", F.array_join("_of.c_name", "\n").alias("value")).write.partitionBy("file").text(path)
    found = digests.file_digests(t.spark, path, "*.txt", whole_bytes=1_800, block_bytes=500)
    number = F.regexp_extract("path", r"file=(\d+)", 1).cast("long").alias("file")
    return found.groupBy(number, "bytes", "sha256").agg(F.count("*").cast("int").alias("copies"))


@query("lineage_verify")
def lineage_verify(t: Tables) -> DataFrame:
    """Declared digests of the table files, with one changed and one that no longer exists."""
    found = digests.file_digests(t.spark, t.sf_dir)
    changed = F.when(F.col("path").endswith("orders.parquet"), F.reverse("sha256")).otherwise(F.col("sha256"))
    moved = F.when(F.col("path").endswith("part.parquet"), F.concat("path", F.lit(".old"))).otherwise(F.col("path"))
    declared = found.select(moved.alias("path"), changed.alias("sha256"))
    broken = digests.lineage_mismatches(declared, found)
    return broken.select(F.element_at(F.split("path", "/"), -1).alias("file"), "status")


@query(
    "lineage_record",
    with_views(
        """SELECT 'hourly_zone_demand' AS product, count(*) AS rows, CAST(sum(trip_count) AS BIGINT) AS trips,
          0 AS broken, CAST(sum(trip_count) AS BIGINT) AS trips_read FROM gold""",
        "gold",
    ),
)
def lineage_record(t: Tables) -> DataFrame:
    """What the job that wrote Gold recorded, beside the product as it is read back once its record has been verified."""
    silver_path, gold_path, record_path = (scratch_path(t.spark, name) for name in ("silver", "gold", "lineage"))
    months.write_partitioned(silver.with_flags(t.trips, t.zones), silver_path)
    record = monthly_release.write_gold(t.spark, silver_path, gold_path, record_path)
    broken = digests.broken_lineage(t.spark, record).agg(F.count("*").cast("int")).scalar()
    read = digests.read_product(t.spark, record).agg(F.sum("trip_count")).scalar()
    return record.select("product", "rows", "trips").distinct().withColumns({"broken": broken, "trips_read": read})


@query(
    "union_by_name",
    """SELECT l_orderkey AS order_id, l_shipdate AS at, l_quantity AS quantity, NULL AS price FROM lineitem
    UNION ALL SELECT o_orderkey, o_orderdate, NULL, o_totalprice FROM orders""",
)
def union_by_name(t: Tables) -> DataFrame:
    items = t.base("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("at"), F.col("l_quantity").alias("quantity")
    )
    orders = t.base("orders").select(
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price")
    )
    return months.union_by_name(items, orders).select("order_id", "at", "quantity", "price")


@query("sorted_product")
def sorted_product(t: Tables) -> DataFrame:
    """Gold rows with the file that holds them, to show consecutive hour ranges."""
    path = scratch_path(t.spark, "sorted-gold")
    months.write_sorted(t.hourly, path, "pickup_hour", "pickup_zone_id")
    read = t.spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    return read.groupBy("file").agg(
        F.min("pickup_hour").alias("first_hour"), F.max("pickup_hour").alias("last_hour"), F.count("*").alias("rows")
    )


@query(
    "sorted_product_ranges",
    with_views("SELECT 0 AS overlaps, count(*) AS rows, min(h) AS first_hour, max(h) AS last_hour FROM (SELECT pickup_hour AS h FROM hourly)", "hourly"),
)
def sorted_product_ranges(t: Tables) -> DataFrame:
    """Files of the sorted product that begin before the file in front of them has ended, beside the hours and rows of all."""
    behind = Window.orderBy("first_hour", "last_hour")  # a row per file
    files = sorted_product(t).withColumn("overlap", F.col("first_hour") < F.lag("last_hour").over(behind))
    return files.agg(
        F.count_if("overlap").cast("int").alias("overlaps"), F.sum("rows").alias("rows"),
        F.min("first_hour").alias("first_hour"), F.max("last_hour").alias("last_hour"),
    )


@query(
    "period_from_name",
    """SELECT 2024 AS year, 1 AS month, TIMESTAMP '2024-01-01 00:00:00' AS first_instant,
      TIMESTAMP '2024-01-31 23:59:59.999999' AS last_instant, count(*) AS rows FROM events""",
)
def period_from_name(t: Tables) -> DataFrame:
    path = written(t.base("events"), "named")
    name_files_by_month(t.spark, path, "2024-01")
    parts = parsing.period_of_file(F.col("_metadata.file_name"))
    read = t.spark.read.parquet(path).select(*[c.alias(n) for n, c in parts.items()])
    return read.groupBy(*parts).agg(F.count("*").alias("rows"))


@query(
    "release_path_window",
    """SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS rows FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-11-01' AND l_shipdate < TIMESTAMP '1999-03-01' GROUP BY 1, 2""",
)
def release_path_window(t: Tables) -> DataFrame:
    at = F.col("l_shipdate")
    dated = t.base("lineitem").select(F.year(at).alias("year"), F.month(at).alias("month"))
    return dated.filter(months.within_months("1996-11", "1999-02")).groupBy("year", "month").agg(F.count("*").alias("rows"))
