"""Shared helpers: the shared folder, saved tables, Arrow batches, free column names."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.storage import saved  # noqa: F401 (the operators take it from here)

#: Text bytes that a task works on at a time (a longer text is one slice of its own).
SLICE_BYTES = 4 << 20
#: Rows that a task works on at a time, at most.
SLICE_ROWS = 2048
#: Bound on an Arrow batch that Spark hands to a task's Python.
BATCH_BYTES = 16 << 20
#: Id lists up to this many rows (8 bytes each) may be broadcast; longer ones are shuffled.
BROADCAST_IDS = 1_000_000
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def not_held_out(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id's text, mod 4, is not 2."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4) != 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce((F.crc32(doc_id.cast("string").cast("binary")) % 4) == 2, F.lit(False))


def ship(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast what a model holds: plain values, which tasks read without the library."""
    return spark.sparkContext.broadcast(vars(model))


def received(kind: type, shared: Broadcast) -> object:
    """The model that was shipped."""
    model = kind.__new__(kind)
    model.__dict__ = shared.value
    return model


def kept_between_tasks() -> dict:
    """What this Python process keeps from task to task."""
    return vars(sys.modules.setdefault("roadspark_task_state", types.ModuleType("roadspark_task_state"))).setdefault("kept", {})


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python in Arrow batches of 16 MB at most.

    A session whose own bound is smaller keeps it, in whatever form (``4m``, ``4194304b``) it is
    written; a larger one, or none, is lowered for the jobs that run from then on.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < bound <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch so that each part holds at most ``limit`` text bytes, or one text.

    Yields the part, its text bytes as one array, and the offsets of its texts in them.
    A null text counts as empty.
    """
    for first in range(0, batch.num_rows, SLICE_ROWS):
        rows = batch.slice(first, SLICE_ROWS)
        texts = pc.fill_null(rows.column(column), "").cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield rows.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
