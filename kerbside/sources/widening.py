"""Reading Parquet files whose columns differ in type or presence from month to month.

Spark reads all files of one scan with one schema, and merging schemas stops at the first column that is BIGINT in one file
and DOUBLE in another. Here folders (or, within a folder that disagrees with itself, files) are grouped by the schemas that
do merge, each group is one scan with its own schema, and its columns are cast to the narrowest type that holds all of them
before the groups are united by name. Only footers of the given folders are opened. Columns of a contract may only have the
types which it allows; any other column widens within whole numbers, decimals and floating point.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kerbside.sources.tables import TRIP_CONTRACT, ContractError

_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_CLASHES = ("CANNOT_MERGE_SCHEMAS", "FAILED_MERGE_FIELDS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "Failed to merge")


@dataclass(frozen=True)
class Group:
    """Paths that one scan with one schema can read."""

    paths: tuple[str, ...]
    schema: T.StructType


def wider(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The narrowest type that holds values of both, or None."""
    if left == right:
        return left
    if isinstance(left, T.NullType) or isinstance(right, T.NullType):
        return right if isinstance(left, T.NullType) else left
    a, b = left.simpleString(), right.simpleString()
    if a in _DIGITS and b in _DIGITS:
        return left if _DIGITS[a] >= _DIGITS[b] else right
    floating = {"float", "double"}
    exact = lambda name: name in _DIGITS or name.startswith("decimal")
    if a in floating and b in floating or (a in floating and exact(b)) or (b in floating and exact(a)):
        return T.DoubleType()
    if exact(a) and exact(b):
        (whole_a, scale_a), (whole_b, scale_b) = _decimal(left), _decimal(right)
        whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if {a, b} <= {"timestamp", "timestamp_ntz"}:
        return T.TimestampNTZType()  # wall-clock times; the session's zone is UTC
    return None


def _decimal(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _DIGITS[kind.simpleString()], 0


def schema_groups(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> list[Group]:
    """Halve the paths until each half's schemas merge.

    Schemas merge in a Spark job over the footers of these paths. Without any clash that is a single job, and with
    g changes of type along the sorted paths about g * log(paths) of them.
    """
    try:
        return [Group(tuple(paths), spark.read.options(**options, mergeSchema="true").parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if not any(clash in str(error) for clash in _CLASHES):
            raise
    if len(paths) == 1:
        files = data_files(spark, paths[0])
        if files == [paths[0]] or not files:
            raise ContractError(f"Columns of {paths[0]} clash with its folder names")
        return schema_groups(spark, files, options)
    middle = len(paths) // 2
    with ThreadPoolExecutor(2) as halves:  # the two jobs share the cluster
        left, right = halves.map(lambda half: schema_groups(spark, half, options), (paths[:middle], paths[middle:]))
    return left + right


def joined_groups(groups: Sequence[Group]) -> list[Group]:
    """Groups of equal column types as one, wherever their paths lie.

    Their schemas may differ in columns that only some have.
    """
    out: list[Group] = []
    for group in groups:
        for i, other in enumerate(out):
            known = {f.name.lower(): f.dataType for f in other.schema}
            if all(known.get(f.name.lower(), f.dataType) == f.dataType for f in group.schema):
                extra = [f for f in group.schema if f.name.lower() not in known]
                out[i] = Group(other.paths + group.paths, T.StructType([*other.schema.fields, *extra]))
                break
        else:
            out.append(group)
    return out


def common_types(groups: Sequence[Group], contract: dict[str, tuple[str, ...]] | None) -> dict[str, tuple[str, T.DataType]]:
    """For each column, by lower-case name: the name it was first seen with and the type that holds all its values."""
    allowed = {name.lower(): (name, kinds) for name, kinds in (contract or {}).items()}
    out: dict[str, tuple[str, T.DataType]] = {}
    for group in groups:
        for field in group.schema:
            key, kind = field.name.lower(), field.dataType
            if key in allowed and not kind.simpleString().startswith(tuple(allowed[key][1])):
                wanted = ", ".join(allowed[key][1])
                raise ContractError(f"{field.name} is {kind.simpleString()} in {group.paths[0]}, expected {wanted}")
            name, before = out.get(key, (field.name, kind))
            found = wider(before, kind)
            if found is None:
                raise ContractError(
                    f"{field.name} is {kind.simpleString()} in {group.paths[0]} and {before.simpleString()} elsewhere"
                )
            if key in allowed and not found.simpleString().startswith(tuple(allowed[key][1])):
                raise ContractError(f"No allowed type of {field.name} holds {before.simpleString()} and {kind.simpleString()}")
            out[key] = name, found
    return out


def read_widened(
    spark: SparkSession,
    paths: Sequence[str],
    base: str | None = None,
    contract: dict[str, tuple[str, ...]] | None = TRIP_CONTRACT,
    each: Callable[[DataFrame, Group], DataFrame] | None = None,
) -> DataFrame:
    """All rows of the paths under the widest of their types; columns absent from a path are NULL there.

    ``base`` is the folder below which ``name=value`` folders are columns. ``each`` may filter a group's scan before its
    columns are cast, so that a condition on raw columns is pushed into it.
    """
    if not paths:
        raise ValueError("No files to read")
    options = {"basePath": base} if base else {}
    groups = joined_groups(schema_groups(spark, sorted(paths), options))
    types = common_types(groups, contract)
    parts = []
    for group in groups:
        scan = spark.read.options(**options).schema(group.schema).parquet(*group.paths)
        if each:
            scan = each(scan, group)
        parts.append(scan.select(*[_as(field, *types[field.name.lower()]) for field in group.schema]))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.select(*[F.col(f"`{name}`") for name, _ in types.values()])


def _as(field: T.StructField, name: str, kind: T.DataType):
    column = F.col(f"`{field.name}`")
    return (column if field.dataType == kind else column.cast(kind)).alias(name)


# -- listings: metadata of folders, read by the driver ----------------------------------------------------------------


def file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    system, path = file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [] if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files at or below a path, but for hidden ones; none where there is no such path."""
    system, root = file_system(spark, path)
    if not system.exists(root):
        return []
    listed, found = system.listFiles(root, True), []
    while listed.hasNext():
        name = listed.next().getPath()
        if name.getName().endswith(".parquet") and not name.getName().startswith(("_", ".")):
            found.append(name.toString())
    return sorted(found)
