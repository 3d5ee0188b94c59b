"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorcast.session import scratch_path

# Texts are handed to the vectorised helpers in slices of about this many
# bytes, so that a task's memory does not depend on the Arrow batch size.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared checkpoint folder; the table read back, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`stored` wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; the other characters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of at most 512 rows and about ``limit`` text bytes.

    Yields ``(first row, row after the last, bytes, offsets)``: the UTF-8
    bytes of the run and the offset of every row in them.  Null is empty.  A
    single longer text is a run of its own.
    """
    col = batch.column(column).fill_null("")
    if len(col) == 0:
        return
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(col):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + SLICE_ROWS, len(col))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def map_texts(fn: Callable[[list[str]], dict], schema: pa.Schema, keep: list[str]):
    """A ``mapInArrow`` function: ``fn`` gets the texts of a slice of rows and
    returns one list or array per new column; ``keep`` columns pass through."""
    def run(batches):
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                made = fn([t or "" for t in part.column("text").to_pylist()])
                cols = [part.column(n) if n in keep else pa.array(made[n], schema.field(n).type) for n in schema.names]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
    return run
