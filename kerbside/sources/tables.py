"""Delimited files, dimensions and schema contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Required columns of a modern trip file and the type families each may have.
INTEGRAL = ("int", "bigint")
REAL = ("double", "float", "decimal")
TRIP_CONTRACT = {
    "VendorID": INTEGRAL,
    "tpep_pickup_datetime": ("timestamp",),
    "tpep_dropoff_datetime": ("timestamp",),
    "passenger_count": (*INTEGRAL, "double"),
    "trip_distance": REAL,
    "RatecodeID": (*INTEGRAL, "double"),
    "PULocationID": INTEGRAL,
    "DOLocationID": INTEGRAL,
    "payment_type": INTEGRAL,
    "fare_amount": REAL,
    "tip_amount": REAL,
    "tolls_amount": REAL,
    "total_amount": REAL,
}


class ContractError(ValueError):
    """Input does not have the declared columns, types or keys."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType, rows: int | None = None) -> DataFrame:
    """CSV with a header and spaces after separators; optionally only the first rows."""
    df = spark.read.csv(path, schema=schema, header=True, ignoreLeadingWhiteSpace=True)
    return df if rows is None else df.limit(rows)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ZONE_SCHEMA)


def missing_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required, what: str = "columns") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"Missing {what}: {', '.join(missing)}")
    return df


def contract_violations(df: DataFrame, contract: dict[str, tuple[str, ...]] = TRIP_CONTRACT) -> list[tuple]:
    """(column, found type or None, allowed types) for each broken requirement."""
    found = {field.name: field.dataType.simpleString() for field in df.schema}
    return [
        (column, found.get(column), ", ".join(allowed))
        for column, allowed in contract.items()
        if not found.get(column, "").startswith(tuple(allowed))
    ]


def check_contract(df: DataFrame, contract: dict[str, tuple[str, ...]] = TRIP_CONTRACT) -> DataFrame:
    broken = contract_violations(df, contract)
    if broken:
        raise ContractError("; ".join(f"{c} is {got}, expected {want}" for c, got, want in broken))
    return df


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row counts."""
    null_key = F.lit(False)
    for column in key:
        null_key = null_key | F.col(column).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | null_key)


def require_unique_key(df: DataFrame, *key: str) -> DataFrame:
    if not key_violations(df, *key).isEmpty():
        raise ContractError(f"{', '.join(key)} must be non-null and unique")
    return df


def require_zone_dimension(zones: DataFrame) -> DataFrame:
    require_columns(zones, ZONE_SCHEMA.names, "zone columns")
    return require_unique_key(zones, "LocationID")
