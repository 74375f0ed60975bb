"""Shared pieces: reading tables, running Python over Arrow batches, shipping this package to executors."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kerbside.session import configure

# Work on one slice of a batch at a time, so that a batch of long texts doesn't multiply in memory.
SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches that stay small when texts are long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_kerbside_llm_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="kerbside-llm-"), "kerbside_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("kerbside/__init__.py", "")
        for name in sorted(os.listdir(package)):
            if name.endswith(".py"):
                archive.write(os.path.join(package, name), f"kerbside/llm/{name}")
        archive.write(os.path.join(top, "session.py"), "kerbside/session.py")
    context.addPyFile(path)
    context._kerbside_llm_shipped = True


def utf8(column: str = "text"):
    """A text column as UTF-8 bytes; null counts as the empty text."""
    return F.coalesce(F.col(f"`{column}`"), F.lit("")).cast("binary")


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column in ``taken`` has, whatever its case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, sized: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most about SLICE_BYTES in column number ``sized``, one row at least."""
    column = batch.column(sized)
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = held = 0
    for i, length in enumerate(lengths):
        if i > begin and held + length > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += length
    yield batch.slice(begin)


def give_back() -> None:
    """Return a worker's freed memory to the system. Workers outlive their tasks, and idle ones count for their executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def annotate(df: DataFrame, value, make: Callable, fields: str, prefix: str = "", done: Callable | None = None) -> DataFrame:
    """Every row and column of ``df`` with columns computed from ``value``, in one Arrow pass and without a shuffle.

    ``value`` is a Column (bytes or text). ``make()`` runs once in each task and gives a function from a list of
    values to a list of columns. ``fields`` is a DDL schema of these; their names get ``prefix``. A column of ``df``
    that has such a name is replaced. ``done()`` runs at the end of each task.
    """
    ship(df.sparkSession)
    out = StructType.fromDDL(fields)
    for field in out:
        field.name = prefix + field.name
    out = StructType(list(out))
    lower = {f.name.lower() for f in out}
    kept = [c for c in df.columns if c.lower() not in lower]
    hidden = fresh("value", df.columns)
    schema = StructType([df.schema[c] for c in kept] + list(out))

    def run(batches):
        work = make()
        types = None
        for batch in batches:
            for part in slices(batch, 0):
                columns = work(part.column(0).to_pylist())
                if types is None:
                    types = [_arrow(f.dataType.simpleString()) for f in out]
                made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(part.columns[1:] + made, names=kept + [f.name for f in out])
        if done:
            del work
            done()

    return df.select(value.alias(hidden), *[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
        "binary": pa.binary(), "boolean": pa.bool_(),
    }
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return simple[kind]
