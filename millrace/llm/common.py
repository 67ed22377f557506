"""Helpers that the operators share: written intermediate tables, Arrow slices, driver-side bounds."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import millrace
from millrace.llm.hashing import mix
from millrace.session import shared_folder

# Workers get functions by value, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(millrace)

#: Bytes of text that one vectorised step works on; a longer single text is a step of its own.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the shared one that spark.checkpoint.dir names."""
    return shared_folder(spark)


def materialise(df: DataFrame, where: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{where}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{where}/{name}")


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets of each; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def release() -> None:
    """Gives freed memory back to the system; a reused Python worker would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES, text: str = "text", most: int = 1 << 30) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with at most `limit` bytes of text and `most` rows each, or one longer row: (rows, bytes, offsets)."""
    for batch in batches:
        raw, offs = text_buffers(batch.column(batch.schema.get_field_index(text)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
            hi = min(n, max(hi, lo + 1), lo + most)
            yield batch.slice(lo, hi - lo), raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi
        del batch, raw, offs
        release()


def int_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An integer column without nulls; a null becomes the smallest long."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.int64())
    return pc.fill_null(column, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def sum_by(keys: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(keys, weights=values, minlength=n)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Slots of a bit map for each value in it, and the most values it is made for (2 ** 28 bits, 32 MB).
SLOTS_EACH = 16
MAP_VALUES = 1 << 24


def _slots(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64) + np.uint64(9)) >> np.uint64(64 - bits)).astype(np.int64)


def _marks(bits: int):
    """Parts of the bit map of the first column's values: (part, bits of 2 ** 16 slots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            slots = np.unique(_slots(b.column(0).to_numpy(zero_copy_only=False), bits))
            part = slots >> 16
            cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                parts.setdefault(int(part[lo]), np.zeros(1 << 16, bool))[slots[lo:hi] & 0xFFFF] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([np.packbits(p, bitorder="little").tobytes() for p in parts.values()], pa.binary())], ["part", "bits"])

    return run


def _joined_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for b in batches:
        for part, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            have = parts.setdefault(part, np.zeros(1 << 13, np.uint8))
            have |= np.frombuffer(bits, np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([p.tobytes() for p in parts.values()], pa.binary())], ["part", "bits"])


class Marks:
    """A broadcast bit map of long values; one of no bits passes all."""

    def __init__(self, held, bits: int):
        self.held, self.bits = held, bits

    def has(self, values: np.ndarray) -> np.ndarray:
        """Whether each value may be in the map; one in SLOTS_EACH of the others, too."""
        if not self.bits:
            return np.ones(len(values), bool)
        at, s = np.frombuffer(self.held.value, np.uint8), _slots(values, self.bits)
        return (at[s >> 3] >> (s & 7).astype(np.uint8) & 1).astype(bool)


def bit_map(values: DataFrame) -> Marks:
    """Of the values of a long column without nulls: SLOTS_EACH bits a value; over MAP_VALUES values (counted) a map that passes all."""
    n, spark = values.count(), values.sparkSession
    if n > MAP_VALUES:
        return Marks(None, 0)
    bits = max(16, (SLOTS_EACH * n).bit_length())
    parts = values.mapInArrow(_marks(bits), "part int, bits binary").repartition(16, "part").mapInArrow(_joined_marks, "part int, bits binary").collect()  # 2 ** bits bits
    marks = bytearray(1 << (bits - 3))
    for part, got in parts:
        marks[part << 13 : (part + 1) << 13] = bytes(got)
    return Marks(spark.sparkContext.broadcast(bytes(marks)), bits)


def _passing(marks: Marks, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(marks.has(b.column(place).to_numpy(zero_copy_only=False))))

    return run


def only(rows: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """At least the rows whose `column` (a long, never null) is in `values`, and few others: what the caller joins exactly afterwards.

    Up to MAP_VALUES values go out as a bit map, so rows need not move; more are joined."""
    values = values.select(column)
    marks = bit_map(values)
    if not marks.bits:
        return rows.join(values.distinct(), column, "left_semi")
    return rows.mapInArrow(_passing(marks, rows.columns.index(column)), rows.schema)


def discard(spark: SparkSession, where: str, names: list[str]) -> None:
    """Removes intermediate tables that nothing reads any more."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{where}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
