"""Exact quantiles by distributed selection.

``percentile`` keeps every distinct value of a group in one reducer. Here a sketch brackets each wanted rank, rows below a
bracket are only counted, and the values inside are counted by value, partly in every task. While the brackets of a large
group may still hold more than CELLS values, a further pass counts and sketches inside them and narrows them. What then
meets in one place are at most about CELLS values of a group and quantile with their counts, however many rows it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.session import broadcast_if_small, stored

# Rank error of the sketch is at most rows / ACCURACY; brackets reach twice as far on both sides.
# A group of up to WHOLE_GROUP rows is ranked as a whole: there a bracket could miss the next rank.
ACCURACY = 10_000
WHOLE_GROUP = 100_000
CELLS = 200_000  # values of a group and quantile that are put in order in one place
GRID = 500  # ranges into which a further pass divides a bracket


def _brackets(values: DataFrame, probabilities: tuple[float, ...], by: list[str]) -> DataFrame:
    """Per group: row count and lower and upper bound of each probability's bracket."""
    margin = 2.0 / ACCURACY
    edges = [edge for p in probabilities for edge in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = F.approx_percentile("_v", F.array(*[F.lit(e) for e in edges]), F.lit(ACCURACY))
    found = values.groupBy(*by).agg(F.count("_v").alias("_n"), sketch.alias("_q"))
    bounds = []
    for place, p in enumerate(probabilities):
        open_low = (F.col("_n") <= WHOLE_GROUP) | F.lit(p <= margin)
        open_high = (F.col("_n") <= WHOLE_GROUP) | F.lit(p >= 1 - margin)
        low = F.when(open_low, float("-inf")).otherwise(F.col("_q")[2 * place])
        high = F.when(open_high, float("inf")).otherwise(F.col("_q")[2 * place + 1])
        bounds += [low.alias(f"_low_{place}"), high.alias(f"_high_{place}")]
    return found.select(*by, "_n", *bounds)


def _in_brackets(values: DataFrame, brackets: DataFrame, keys: list[str], places: int) -> DataFrame:
    """``(keys, _n, _v, _place, _low, _high)``: each value once for every bracket that it isn't above."""
    bounds = [f"_{side}_{place}" for place in range(places) for side in ("low", "high")]
    right = broadcast_if_small(brackets).select(*[F.col(k).alias(f"{k}_r") for k in keys], "_n", *bounds)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys])
    each = [
        F.struct(F.lit(i).alias("_place"), F.col(f"_low_{i}").alias("_low"), F.col(f"_high_{i}").alias("_high")) for i in range(places)
    ]
    return values.join(right, same).select(*keys, "_n", "_v", F.inline(F.array(*each))).filter("_v <= _high")


def _rank(probabilities: tuple[float, ...]) -> tuple[Column, Column]:
    """A row's probability, by ``_place``, and the rank that it asks for, counted from 0."""
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probabilities]), F.col("_place") + 1)
    return p, (F.col("_n") - 1) * p


def _narrowed(values: DataFrame, brackets: DataFrame, probabilities: tuple[float, ...], keys: list[str]) -> tuple[DataFrame, int]:
    """Brackets of about 4 / GRID of their rows, and how many values the largest may hold."""
    _, rank = _rank(probabilities)
    inside = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    found = (
        _in_brackets(values, brackets, keys, len(probabilities))
        .groupBy(*keys, "_n", "_place", "_low", "_high")
        .agg(F.count_if(F.col("_v") < F.col("_low")).alias("_under"), F.count(inside).alias("_rows"), F.approx_percentile(inside, grid, F.lit(ACCURACY)).alias("_edges"))
        .withColumn("_at", F.floor((F.floor(rank) - F.col("_under")) / F.greatest("_rows", F.lit(1)) * GRID).cast("int"))
    )
    low = F.when(F.col("_at") >= 2, F.get("_edges", F.col("_at") - 2)).otherwise(F.col("_low"))
    high = F.when(F.col("_at") + 3 < GRID, F.get("_edges", F.col("_at") + 3)).otherwise(F.col("_high"))
    found = found.select(*keys, "_n", "_place", low.alias("_low"), high.alias("_high"), "_rows")
    sides = [
        F.max(F.when(F.col("_place") == place, F.col(f"_{side}"))).alias(f"_{side}_{place}")
        for place in range(len(probabilities))
        for side in ("low", "high")
    ]
    most = F.max(F.when((F.col("_low") < F.col("_high")) & (F.col("_n") > WHOLE_GROUP), F.col("_rows")).otherwise(0))
    wide = stored(found.groupBy(*keys, "_n").agg(*sides, most.alias("_most")), "quantile-brackets")
    largest = wide.agg(F.max("_most")).first()[0] or 0
    return wide.drop("_most"), 6 * largest // GRID + 2


def exact_quantiles(
    df: DataFrame, column: str, probabilities: tuple[float, ...], *by: str
) -> DataFrame:
    """Linear-interpolated quantiles per group as (by..., p, value); NULL values are ignored.

    A value below a bracket only adds to one counter per group and task. Groups are compared null-safely.
    """
    keys = [f"_by_{place}" for place in range(max(len(by), 1))]
    own = [F.col(b) for b in by] or [F.lit(0)]
    values = df.select(*[b.alias(k) for b, k in zip(own, keys)], F.col(column).cast("double").alias("_v")).filter("_v IS NOT NULL")
    brackets = stored(_brackets(values, probabilities, keys), "quantile-brackets")
    # A group's bracket holds at most about six parts in ACCURACY of its rows in distinct values.
    largest = brackets.agg(F.max("_n")).first()[0] or 0
    cells = 6 * largest // ACCURACY + 2
    while cells > CELLS and largest > WHOLE_GROUP:
        brackets, narrower = _narrowed(values, brackets, probabilities, keys)
        if narrower >= cells:
            break
        cells = narrower

    inside = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    counted = (
        _in_brackets(values, brackets, keys, len(probabilities))
        .groupBy(*keys, "_n", "_place", inside.alias("_cell"))
        .agg(F.count("*").alias("_rows"))
    )
    p, rank = _rank(probabilities)
    ordered = counted.groupBy(*keys, "_n", "_place").agg(
        F.coalesce(F.sum(F.when(F.col("_cell").isNull(), F.col("_rows"))), F.lit(0)).alias("_under"),
        F.array_sort(F.collect_list(F.when(F.col("_cell").isNotNull(), F.struct("_cell", "_rows")))).alias("_cells"),
    ).withColumns({"_p": p, "_rank": rank, "_at": F.floor(rank)})
    start = F.struct(F.col("_under").alias("seen"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))

    def step(state: Column, cell: Column) -> Column:
        seen = state["seen"] + cell["_rows"]
        reached = lambda side, at: F.when(state[side].isNotNull() | (seen <= at), state[side]).otherwise(cell["_cell"])
        return F.struct(seen.alias("seen"), reached("lo", F.col("_at")).alias("lo"), reached("hi", F.col("_at") + 1).alias("hi"))

    picked = ordered.withColumn("_found", F.aggregate("_cells", start, step))
    lo, hi, at = F.col("_found")["lo"], F.col("_found")["hi"], F.col("_at")
    # Both ranks must lie inside the bracket; a value is never taken from outside it.
    bracketed = (F.col("_under") <= at) & lo.isNotNull() & (hi.isNotNull() | (at + 1 >= F.col("_n")))
    outside = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    value = F.when(bracketed, lo + (F.coalesce(hi, lo) - lo) * (F.col("_rank") - at)).otherwise(outside)
    return picked.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], F.col("_p").alias("p"), value.alias("value"))


def quantile_columns(
    df: DataFrame, column: str, names: dict[str, float], *by: str
) -> DataFrame:
    """The quantiles of one column as one named column per probability."""
    long = exact_quantiles(df, column, tuple(dict.fromkeys(names.values())), *by)
    wide = [F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(n) for n, p in names.items()]
    return long.groupBy(*by).agg(*wide)


def stacked_quantiles(df: DataFrame, columns: tuple[str, ...], names: dict[str, float]) -> DataFrame:
    """Quantiles of several columns, one row per column, sharing the same two passes."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numbers.unpivot([], list(columns), "column_name", "_value")
    return quantile_columns(long, "_value", names, "column_name")
