"""Arrow batches in and out of tasks, in pieces of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
# Batches are cut on the JVM's side as well: by rows alone, one of long texts takes tens of MB there and in the worker.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

Piece = dict[str, list]
Work = Callable[[Piece], Piece]


def pieces(batches: Iterable[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes (one row at least), so that what a task derives from them stays bounded."""
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def columns_of(batch: pa.RecordBatch) -> Piece:
    return {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}


def arrow_type(schema: str) -> pa.Schema:
    """Arrow schema of a flat ``name type, ...`` list."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
             "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(","))])


def packed_numbers(values: np.ndarray) -> bytes:
    """64-bit numbers, byte plane by byte plane, compressed: small or repeated ones take little room in a shuffle."""
    planes = values.astype("<i8" if values.dtype.kind == "i" else "<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked_numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").reshape(-1)


def _give_back() -> None:
    """Return freed memory to the system: Python workers live on and serve later stages, beside those of other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not a GNU system
        pass


def map_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` that leaves no memory behind in the worker when a task ends."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    df.sparkSession.conf.set(BATCH_BYTES, 4 * PIECE_BYTES)
    return df.mapInArrow(whole, schema)


def map_pieces(df: DataFrame, schema: str, start: Callable[[], Work]) -> DataFrame:
    """Each task calls ``start`` once and then its result on every piece. No shuffle, no state between tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, out = start(), arrow_type(schema)
        for piece in pieces(batches):
            made = work(columns_of(piece))
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)
            del made
        del work

    return map_arrow(df, run, schema)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hash_share(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """A little more than ``rows`` rows (all, if there are not more), chosen by a hash of ``key``: the same at every run.

    A filter, so nothing is sorted or gathered to find them.
    """
    share = min(1.0, (1.1 * rows + 100) / max(1, df.count()))
    return df.where(F.xxhash64(F.lit(seed), F.col(key)) <= F.lit(min(int((share - 0.5) * 2.0 ** 64), (1 << 63) - 1)))
