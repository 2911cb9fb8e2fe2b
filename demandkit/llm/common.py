"""Helpers shared by the operators: text access, bounded Arrow batches and
written intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows and bytes of text handed to one numpy pass inside a task. The bound
#: is on memory only: a longer text makes a pass of its own.
PASS_ROWS = 4096
PASS_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: str = "text") -> Column:
    """Whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def passes(batches: Iterator[pa.RecordBatch], column: str = "text", rows: int = PASS_ROWS,
           size: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows and about
    ``size`` bytes of ``column`` (one longer value stays whole)."""
    for batch in batches:
        lengths = [v.as_buffer().size if v.is_valid else 0 for v in batch.column(column)] \
            if batch.nbytes > size else None
        if lengths is None:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
            continue
        at = total = 0
        for i, n in enumerate(lengths):
            if i > at and (total + n > size or i - at >= rows):
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        if at < batch.num_rows:
            yield batch.slice(at)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: the lineage is cut, and a lost executor loses nothing."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    executors need no copy of it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = Path(__file__).resolve().parents[1]
    # Executors fetch the archive from the driver at their first task: it stays until the driver ends.
    folder = os.path.realpath(tempfile.mkdtemp(prefix="code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand on the workers."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` from batches sorted by ``key`` (runs may span
    batches)."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(key).to_pylist()
        start = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[start]:
                continue
            part = batch.slice(start, i - start)
            if held and values[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = values[start]
            held.append(part)
            start = i
    if held:
        yield pa.Table.from_batches(held)


def map_passes(df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], dict],
               column: str = "text", size: int = PASS_BYTES) -> DataFrame:
    """``mapInArrow`` over bounded passes; ``step`` returns columns."""
    arrow = arrow_schema(schema)

    def run(batches):
        for part in passes(batches, column, size=size):
            out = step(part)
            yield pa.RecordBatch.from_arrays(
                [as_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return map_arrow(df, run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a DDL schema (flat columns and arrays of them)."""
    kinds = {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(),
             "float": pa.float32(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32()),
             "array<string>": pa.list_(pa.string())}
    fields = [x.split(" ", 1) for x in ddl.split(", ")]
    return pa.schema([pa.field(n, kinds[k]) for n, k in fields])


def small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a checkpointed table of short rows that is proven
    to have at most ``most_rows`` (about 10 MB); a larger one is joined by a
    shuffle, whose skewed partitions Spark splits."""
    return F.broadcast(df) if df.count() <= most_rows else df
