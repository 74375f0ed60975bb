"""Descriptive statistics of columns and column pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.operators.quantiles import quantile_columns, stacked_quantiles
from kerbside.session import broadcast_if_small

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "null_rows")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values by falling frequency."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), column)
    )


def distinct_profile(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Distinct values per column, NULL counting as one more value.

    Columns are stacked into (column, value) rows and deduplicated in one shuffle, so no task holds
    the set of all values of a column.
    """
    if approximate:
        counts = [
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns
        ]
        return df.agg(*counts).unpivot([], list(columns), "column_name", "distinct_values")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = texts.unpivot([], list(columns), "column_name", "value").distinct()
    return pairs.groupBy("column_name").agg(F.count("*").alias("distinct_values"))


def describe(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    structs = [
        F.struct(
            F.lit(column).alias("column_name"),
            *[measure(F.col(column).cast("double")).alias(name) for name, measure in measures.items()],
        )
        for column in columns
    ]
    moments = df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))
    quartiles = stacked_quantiles(df, columns, QUARTILES)
    described = moments.join(quartiles, "column_name", "left")
    numbers = ("mean", "std", "min", *QUARTILES, "max")
    return described.select("column_name", "count", *[F.round(n, digits).alias(n) for n in numbers])


def min_max(df: DataFrame, *columns: str) -> DataFrame:
    structs = [
        F.struct(F.lit(c).alias("column_name"), F.min(c).alias("minimum"), F.max(c).alias("maximum"))
        for c in columns
    ]
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def share_of_total(df: DataFrame, column: str, counted: str | None = None) -> DataFrame:
    """Non-NULL count per group and its percentage of all rows of ``df``."""
    rows = F.count(counted) if counted else F.count("*")
    total = df.agg(F.count("*")).scalar()
    groups = df.groupBy(column).agg(rows.alias("trips"))
    return groups.withColumn("percentage", F.round(F.col("trips") / total * 100, 2))


def share_over_total(counts: DataFrame, value: str) -> DataFrame:
    """Percentage of the grand total of ``value``."""
    total = counts.agg(F.sum(value)).scalar()
    return counts.withColumn("percentage", F.round(F.col(value) / total * 100, 2))


def covariance(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Two-by-two sample covariance matrix in long form."""
    pairs = df.select(x.cast("double").alias("x"), y.cast("double").alias("y"))
    cells = {"xx": ("x", "x"), "xy": ("x", "y"), "yx": ("y", "x"), "yy": ("y", "y")}
    return pairs.agg(*[F.covar_samp(a, b).alias(name) for name, (a, b) in cells.items()]).unpivot(
        [], list(cells), "cell", "covariance"
    )


def box_stats(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Quartiles, whisker fences at 1.5 interquartile ranges and rows outside them, per group."""
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    fences = quantile_columns(df, column, QUARTILES, *by).withColumns(
        {"lower_fence": F.col("q25") - reach, "upper_fence": F.col("q75") + reach}
    )
    fences = broadcast_if_small(fences, store="box-fences")
    names = (*QUARTILES, "lower_fence", "upper_fence")
    value = F.col(column)
    outside = [
        F.count_if(value < F.col("lower_fence")).alias("below"),
        F.count_if(value > F.col("upper_fence")).alias("above"),
    ]
    if by:
        right = fences.withColumnsRenamed({b: f"_{b}" for b in by})
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
        return df.select(*by, column).join(right, same).groupBy(*by, *names).agg(*outside)
    known = fences.select(F.struct(*names).alias("_f")).scalar()
    return df.select(column, known.alias("_f")).select(column, "_f.*").groupBy(*names).agg(*outside)


def histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int, *by: str, log: bool = False
) -> DataFrame:
    """Rows per equal-width bin; bins 0 and bins+1 hold what lies outside [low, high).

    With ``log`` the bins are over the natural logarithm and values that have none are left out.
    """
    value = F.col(column).cast("double")
    if log:
        value = F.ln(F.when(value > 0, value))
    binned = df.select(*by, F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
    return binned.filter("bin IS NOT NULL").groupBy(*by, "bin").agg(F.count("*").alias("rows"))


def point_grid(df: DataFrame, lat: str, lng: str, cell: float = 0.01) -> DataFrame:
    """Rows per square coordinate cell."""
    return (
        df.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
        .groupBy(F.floor(F.col(lat) / cell).alias("lat_cell"), F.floor(F.col(lng) / cell).alias("lng_cell"))
        .agg(F.count("*").alias("rows"))
    )


def scatter_bins(df: DataFrame, x: Column, y: Column, x_width: float, y_width: float) -> DataFrame:
    """Rows per rectangular cell of two measures."""
    cells = df.select(F.floor(x / x_width).alias("x_bin"), F.floor(y / y_width).alias("y_bin"))
    return (
        cells.filter("x_bin IS NOT NULL AND y_bin IS NOT NULL")
        .groupBy("x_bin", "y_bin")
        .agg(F.count("*").alias("rows"))
    )


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """One 0/1 column per level, all levels kept; the source column is dropped."""
    flags = {
        f"{column}_{level}": F.coalesce(F.col(column) == level, F.lit(False)).cast("int") for level in levels
    }
    return df.withColumns(flags).drop(column)
