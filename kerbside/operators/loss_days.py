"""Analyses of the days on which a forecast lost against its baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kerbside.functions import errors, rules
from kerbside.operators.scoring import BASELINE, FORECAST_HOUR, PREDICTED
from kerbside.operators.series import COUNT, HOUR, ZONE

PROFILE_FIELDS = (
    "previous_day_demand",
    "previous_week_same_day",
    "prior_week_mean",
    "prior_week_cv",
    "recent_trend",
    "airport_share",
)


def day_profile(demand: DataFrame, airports: tuple[int, ...] = rules.AIRPORT_ZONE_IDS) -> DataFrame:
    """Demand before each day: previous day, same weekday, prior-week level, variation, trend, airport share.

    The windows run over one row per calendar day; days without trips are filled in as zero.
    """
    observed = demand.groupBy(F.to_date(HOUR).alias("day")).agg(
        F.sum(COUNT).cast("double").alias("trips"),
        F.sum(F.when(F.col(ZONE).isin(*airports), F.col(COUNT)).otherwise(0)).cast("double").alias("airport"),
    )
    ends = demand.agg(F.min(F.to_date(HOUR)).alias("first"), F.max(F.to_date(HOUR)).alias("last"))
    days = ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    totals = days.join(observed, "day", "left").na.fill(0.0)
    order = Window.partitionBy().orderBy("day")
    week, recent = order.rowsBetween(-7, -1), order.rowsBetween(-3, -1)
    mean = F.avg("trips").over(week)
    full = F.count("trips").over(week) == 7
    measured = {
        "previous_day_demand": F.lag("trips", 1).over(order),
        "previous_week_same_day": F.lag("trips", 7).over(order),
        "prior_week_mean": mean,
        "prior_week_cv": F.try_divide(F.stddev_pop("trips").over(week), mean),
        "recent_trend": F.try_divide(F.avg("trips").over(recent), mean) - 1,
        "airport_share": F.try_divide(F.sum("airport").over(week), F.sum("trips").over(week)),
    }
    return totals.select("day", "trips", *[F.when(full, c).alias(n) for n, c in measured.items()])


def daily_outcome(scored: DataFrame) -> DataFrame:
    """Per forecast day: candidate and baseline WAPE, bias, improvement and whether it won."""
    truth, guess, base = F.col(COUNT), F.col(PREDICTED), F.col(BASELINE)
    daily = scored.groupBy(F.to_date(FORECAST_HOUR).alias("day")).agg(
        errors.wape(truth, errors.clip(guess)).alias("candidate_wape"),
        errors.wape(truth, errors.clip(base)).alias("baseline_wape"),
        errors.bias(truth, guess).alias("bias"),
    )
    return daily.withColumns(
        {
            "improvement": errors.relative_improvement(F.col("baseline_wape"), F.col("candidate_wape")),
            "won": F.col("candidate_wape") < F.col("baseline_wape"),
        }
    )


def win_loss_medians(profile: DataFrame, outcome: DataFrame) -> DataFrame:
    joined = profile.join(outcome.select("day", "won"), "day")
    return joined.groupBy("won").agg(
        F.count("*").alias("days"), *[F.median(name).alias(name) for name in PROFILE_FIELDS]
    )


def loss_clusters(outcome: DataFrame) -> DataFrame:
    """Runs of consecutive lost days. One row per day enters the window."""
    order = Window.partitionBy().orderBy("day")
    lost = outcome.filter(~F.col("won")).withColumn(
        "island", F.date_sub("day", F.row_number().over(order))
    )
    return lost.groupBy("island").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")
    ).drop("island")


def excess_error(scored: DataFrame, outcome: DataFrame, top: int = 10) -> DataFrame:
    """Absolute error beyond the baseline's on lost days, by market, hour and top zones.

    ``share`` relates to the net excess over all lost days.
    """
    lost = outcome.filter(~F.col("won")).select("day")
    excess = F.abs(F.col(COUNT) - F.col(PREDICTED)) - F.abs(F.col(COUNT) - F.col(BASELINE))
    cells = (
        scored.withColumn("day", F.to_date(FORECAST_HOUR))
        .join(lost, "day", "left_semi")
        .groupBy(ZONE, F.hour(FORECAST_HOUR).alias("hour"))
        .agg(F.sum(COUNT).alias("actual"), F.sum(excess).alias("excess"))
    )
    scopes = F.array(
        F.struct(F.lit("all").alias("scope"), F.lit("all").alias("segment")),
        F.struct(F.lit("market").alias("scope"), rules.market(ZONE).alias("segment")),
        F.struct(F.lit("hour").alias("scope"), F.col("hour").cast("string").alias("segment")),
        F.struct(F.lit("zone").alias("scope"), F.col(ZONE).cast("string").alias("segment")),
    )
    grouped = (
        cells.select(F.inline(scopes), "actual", "excess")
        .groupBy("scope", "segment")
        .agg(F.sum("actual").alias("actual"), F.sum("excess").alias("excess"))
    )
    net = cells.agg(F.sum("excess")).scalar()
    order = Window.partitionBy("scope").orderBy(F.desc("excess"), "segment")
    return (
        grouped.withColumns({"position": F.row_number().over(order), "share": F.try_divide(F.col("excess"), net)})
        .filter((F.col("scope") != "zone") | (F.col("position") <= top))
        .select("scope", "segment", "position", "actual", "excess", "share")
    )


def spearman(profile: DataFrame, outcome: DataFrame) -> DataFrame:
    """Rank correlation of each profile field with the improvement, ties on average ranks.

    One row per forecast day is ranked, so each window is over the length of the evaluation.
    """
    joined = profile.join(outcome.select("day", "improvement"), "day").filter(
        F.col("improvement").isNotNull()
    )
    pairs = joined.unpivot(["day", "improvement"], list(PROFILE_FIELDS), "field", "value").filter(
        F.col("value").isNotNull()
    )

    def average_rank(column: str):
        ordered = Window.partitionBy("field").orderBy(column)
        tied = Window.partitionBy("field", column)
        return F.rank().over(ordered) + (F.count("*").over(tied) - 1) / 2

    # Values that differ only by floating-point noise share a rank.
    pairs = pairs.withColumns({c: F.round(c, 9) for c in ("value", "improvement")})
    ranked = pairs.withColumns({"_x": average_rank("value"), "_y": average_rank("improvement")})
    return ranked.groupBy("field").agg(F.count("*").alias("days"), errors.correlation(F.col("_x"), F.col("_y")).alias("rho"))


def stability(outcome: DataFrame, drift: DataFrame, horizons: DataFrame) -> DataFrame:
    """Win rate, worst day, drift pass rate and horizon hours won.

    ``drift`` has ``day, drift_passed``; ``horizons`` has ``wape, baseline_wape`` per horizon hour.
    """
    days = outcome.join(drift, "day").agg(
        F.count("*").alias("days"),
        F.count_if("won").alias("wins"),
        F.avg(F.col("won").cast("int")).alias("win_rate"),
        F.max(-F.col("improvement")).alias("worst_relative_degradation"),
        F.avg(F.col("drift_passed").cast("int")).alias("drift_pass_rate"),
    )
    won = horizons.agg(F.count_if(F.col("wape") < F.col("baseline_wape"))).scalar()
    return days.withColumn("horizon_wins", won)
