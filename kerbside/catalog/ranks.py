"""Rank feed and time-zone queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.catalog.registry import query
from kerbside.catalog.scans import rank_documents
from kerbside.catalog.tables import Tables, with_views
from kerbside.functions import clock
from kerbside.operators import rank_history
from kerbside.sources import rank_feed

# The usable records of the documents, typed independently of the operator: measures as one long table, counted per record.
_BASE = """SELECT event_id, 'event-' || CAST(event_id AS VARCHAR) AS source_file, lower(class) AS class, lower(class) = 'passenger' AS banded,
    nullif(rank_id, 'N/A') AS rank_id, nullif(tsn, 'N/A') AS tsn, nullif(comments, 'None') AS comments,
    TRY_CAST(total_bays AS DOUBLE) AS total_bays,
    TRY_CAST(replace(replace(start_time, 'T', ' '), 'Z', '') AS TIMESTAMP) AS s,
    TRY_CAST(replace(replace(end_time, 'T', ' '), 'Z', '') AS TIMESTAMP) AS e,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE TRY_CAST(average_wait AS DOUBLE) END AS wait
  FROM rank_rows WHERE event_id % 101 <> 0"""
_MEASURES = """SELECT event_id, banded, measure, raw, CASE WHEN NOT banded THEN TRY_CAST(raw AS DOUBLE) END AS number,
    CASE WHEN banded THEN list_position(['Low', 'Medium', 'High'], raw) - 1 END AS band
  FROM (SELECT event_id, class = 'Passenger' AS banded,
      unnest(['from_previous', 'total', 'new_arrivals']) AS measure,
      unnest([CASE WHEN m NOT IN ('', 'N/A', 'None') THEN m END FOR m IN [from_previous_count, total, new_arrivals]]) AS raw
    FROM rank_rows)"""
_WIDE = f"""SELECT event_id, {", ".join(
    f"max({value}) FILTER (WHERE measure = '{name}') AS {name}_{suffix}"
    for name in ("from_previous", "total", "new_arrivals") for value, suffix in (("raw", "raw"), ("number", "count"), ("band", "band"))
  )}, count(*) FILTER (WHERE banded AND band IS NULL) > 0 AS dq_invalid_passenger_band,
    count(*) FILTER (WHERE NOT banded AND number IS NULL) > 0 AS dq_invalid_numeric_count FROM ({_MEASURES}) GROUP BY 1"""
_SILVER = f"""SELECT rank_id, tsn, comments, total_bays, s AS start_time_utc, e AS end_time_utc,
    s + INTERVAL 11 HOUR AS start_time_sydney, e + INTERVAL 11 HOUR AS end_time_sydney, class, wide.* EXCLUDE (event_id),
    wait AS average_wait_seconds, source_file, rank_id IS NULL AS dq_missing_rank_id,
    class NOT IN ('taxi', 'passenger', 'wat') AS dq_unknown_class, s IS NULL OR e IS NULL AS dq_invalid_timestamp,
    coalesce(epoch(e) - epoch(s) <> 900, TRUE) AS dq_invalid_interval, coalesce(wait < 0, FALSE) AS dq_negative_wait
  FROM ({_BASE}) JOIN ({_WIDE}) wide USING (event_id)"""
_FLAGS = [
    "dq_missing_rank_id", "dq_unknown_class", "dq_invalid_timestamp", "dq_invalid_interval", "dq_invalid_passenger_band",
    "dq_invalid_numeric_count", "dq_negative_wait",
]


def history(t: Tables) -> DataFrame:
    records = rank_feed.root_records(rank_documents(t), "historical")
    return rank_history.normalize(records.filter("position IS NOT NULL"))


@query("history_normalize", with_views(_SILVER, "rank_rows"))
def history_normalize(t: Tables) -> DataFrame:
    """All columns of the normalised history."""
    return history(t)


@query(
    "ordinal_band",
    with_views(f"SELECT source_file, class, total_band, total_count FROM ({_SILVER})", "rank_rows"),
)
def ordinal_band(t: Tables) -> DataFrame:
    return history(t).select("source_file", "class", "total_band", "total_count")


@query(
    "silver_feed_report",
    with_views("", "rank_rows").rstrip()
    + f", h AS ({_SILVER}) SELECT 'class' AS section, class AS name, count(*) AS rows FROM h GROUP BY 2 UNION ALL "
    + " UNION ALL ".join(f"SELECT 'flag', '{f}', count(*) FILTER (WHERE {f}) FROM h" for f in _FLAGS),
)
def silver_feed_report(t: Tables) -> DataFrame:
    return rank_history.feed_report(history(t))


@query(
    "utc_to_local",
    "SELECT event_id, ts + INTERVAL 11 HOUR AS sydney, ts - INTERVAL 5 HOUR AS new_york FROM events",
)
def utc_to_local(t: Tables) -> DataFrame:
    """January instants: Sydney is on summer time, New York on standard time."""
    return t.base("events").select(
        "event_id",
        clock.utc_to_local("ts", "Australia/Sydney").alias("sydney"),
        clock.utc_to_local("ts", "America/New_York").alias("new_york"),
    )


@query(
    "classify_local_time",
    """SELECT kind, count(*) AS rows FROM (SELECT CASE
        WHEN month(w) = 10 AND isodow(w) = 7 AND day(w) <= 7 AND hour(w) = 2 THEN 'nonexistent'
        WHEN month(w) = 4 AND isodow(w) = 7 AND day(w) <= 7 AND hour(w) = 2 THEN 'ambiguous' ELSE 'normal' END AS kind
      FROM (SELECT l_shipdate + to_seconds(l_orderkey * 7 % 86400) + INTERVAL 14 YEAR AS w FROM lineitem)) GROUP BY 1""",
)
def classify_local_time(t: Tables) -> DataFrame:
    """Ship times moved to 2009-2015, when Sydney changed on the first Sundays of October and April."""
    wall = F.expr("timestampadd(SECOND, l_orderkey * 7 % 86400, l_shipdate) + INTERVAL 14 YEAR")
    kinds = t.base("lineitem").select(clock.classify_local_time(wall, "Australia/Sydney").alias("kind"))
    return kinds.groupBy("kind").agg(F.count("*").alias("rows"))
