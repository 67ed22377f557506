"""Token-ID binary output in Simple-8b: word-aligned coding with escapes and per-block offsets.

Format of one segment (little endian): magic "MS8B", version u16, block length u16, ids u64, blocks u32, words u32;
then per block u32 the offset of its first word; then the 64-bit words. A word's top 4 bits select how many ids of how
many bits its low 60 bits hold, first id lowest; selector 15 escapes: the next word is one raw id. Words never cross
blocks, so any block decodes alone, and all blocks decode in one vectorised pass.

A file is a Parquet file of segments (written by Spark, so on any store): one row per run of whole documents, with
the document ids, their id counts and the segment.

Defined results: null text is an empty text (only its end id); empty table gives no rows; repeated doc_ids keep each row,
in any order among themselves; rows without a doc_id (or with the least long) come first and are read back with null; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import int_column, shared_dir, shuffle_partitions, slices
from millrace.llm.tokens import encoder

#: selector -> (ids in a word, bits of each); 15 is the escape.
LAYOUT = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
BLOCK = 512
#: Ids after which a segment ends; a longer document makes a longer segment of its own.
SEGMENT_IDS = 1 << 20
#: Ids that one batch of read documents holds, or one longer document.
READ_IDS = 1 << 24
#: Stands for a missing doc_id in files.
NO_ID = -(2**63)
_HEAD = "<4sHHQII"
_HEAD_BYTES = struct.calcsize(_HEAD)


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One segment. All blocks are packed in lockstep: a step writes one word of every unfinished block."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    end_of = np.repeat(ends, ends - starts)
    width = np.full(n + 64, 64, np.uint8)
    most = int(ids.max()) if n else 0
    width[:n] = 0
    for _, bits in LAYOUT[::-1]:  # the fewest bits of a selector that hold the id; 64 if none does
        width[:n][ids < np.uint64(1) << np.uint64(bits)] = bits
    width[:n][ids >= np.uint64(1) << np.uint64(60)] = 64
    choice = np.full(n, ESCAPE, np.uint8)
    left = np.arange(n)
    for s in range(len(LAYOUT) - 1, -1, -1):  # ids that fit a selector also fit each with fewer, wider places
        count, bits = LAYOUT[s]
        if most >> bits:
            for j in range(count):
                at = left + j
                left = left[(width[at] <= bits) | (at >= end_of[left])]
        if len(left) == n:
            choice[:] = s + 1
        else:
            choice[left] = s + 1
    counts = np.array([0, *(c for c, _ in LAYOUT), 1], np.int64)
    step = np.minimum(counts[choice], end_of - np.arange(n)) if n else np.zeros(0, np.int64)
    where, sel, owner = [], [], []
    pos, live = starts.copy(), np.arange(len(starts))
    while len(live):
        p = pos[live]
        where.append(p)
        owner.append(live)
        sel.append(choice[p])
        pos[live] = p + step[p]
        live = live[pos[live] < ends[live]]
    if where:
        where, sel, owner = np.concatenate(where), np.concatenate(sel), np.concatenate(owner)
        by = np.argsort(where, kind="stable")
        where, sel, owner = where[by], sel[by], owner[by]
    else:
        where, sel, owner = np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    size = 1 + (sel == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s, (count, bits) in enumerate(LAYOUT, 1):
        rows = np.flatnonzero(sel == s)
        if len(rows):
            first, stop = where[rows], end_of[where[rows]]
            value = np.full(len(rows), np.uint64(s) << np.uint64(60), np.uint64)
            whole = first + count <= stop
            full, part = np.flatnonzero(whole), np.flatnonzero(~whole)
            packed = ids[first[full]]
            for j in range(1, count):
                packed |= ids[first[full] + j] << np.uint64(j * bits)
            value[full] |= packed
            for j in range(count if len(part) else 0):
                part = part[first[part] + j < stop[part]]
                value[part] |= ids[first[part] + j] << np.uint64(j * bits)
            words[place[rows]] = value
    rows = np.flatnonzero(sel == ESCAPE)
    words[place[rows]] = np.uint64(ESCAPE) << np.uint64(60)
    words[place[rows] + 1] = ids[where[rows]]
    per_block = np.bincount(owner, weights=size, minlength=len(starts)).astype(np.int64)
    offsets = (np.cumsum(per_block) - per_block).astype("<u4")
    return struct.pack(_HEAD, b"MS8B", 1, block, n, len(starts), len(words)) + offsets.tobytes() + words.astype("<u8").tobytes()


def decode(segment: bytes, first_block: int = 0, blocks: int | None = None) -> np.ndarray:
    """Ids (uint64) of some blocks of a segment, of all by default."""
    magic, version, block, n, have, total = struct.unpack_from(_HEAD, segment)
    if magic != b"MS8B" or version != 1:
        raise ValueError("not a Simple-8b segment")
    offsets = np.append(np.frombuffer(segment, "<u4", have, _HEAD_BYTES), total).astype(np.int64)
    last = have if blocks is None else min(have, first_block + blocks)
    lo, hi = offsets[first_block], offsets[last]
    words = np.frombuffer(segment, "<u8", hi - lo, _HEAD_BYTES + 4 * have + 8 * lo)
    starts = np.arange(first_block, last) * block
    lens = np.minimum(starts + block, n) - starts
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (sel == ESCAPE).any():  # a raw word may look like an escape itself: they alternate within a run of such
        flags = np.flatnonzero(sel == ESCAPE)
        skip = -1
        for i in flags.tolist():
            if i > skip:
                skip = i + 1
                raw[skip] = True
    counts = np.array([0, *(c for c, _ in LAYOUT), 1])[np.where(raw, 0, np.minimum(sel, ESCAPE))]
    ends_at = np.append(offsets[first_block + 1 : last + 1] - lo, 0)[:-1]
    owner = np.searchsorted(ends_at, np.arange(len(words)), side="right")
    before = np.cumsum(counts) - counts
    base = before[offsets[first_block:last] - lo] if last > first_block else np.zeros(0, np.int64)
    inner = before - base[owner] if len(words) else before  # place within the block
    shift = starts - starts[0] if len(starts) else starts
    out = np.zeros(int(lens.sum()), np.uint64)
    for s, (count, bits) in enumerate(LAYOUT, 1):
        rows = np.flatnonzero((sel == s) & ~raw)
        mask = (np.uint64(1) << np.uint64(bits)) - np.uint64(1)
        for j in range(count if len(rows) else 0):
            ok = rows[inner[rows] + j < lens[owner[rows]]]
            out[shift[owner[ok]] + inner[ok] + j] = (words[ok] >> np.uint64(j * bits)) & mask
    rows = np.flatnonzero((sel == ESCAPE) & ~raw)
    if len(rows):
        out[shift[owner[rows]] + inner[rows]] = words[rows + 1]
    return out


SEGMENT_SCHEMA = "part long, seq long, doc_ids binary, lens binary, n_ids long, segment binary"


def write_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None) -> None:
    """Encodes every text, appends end_id, writes segments in ascending doc_id order under `path`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, part, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        docs_, lens_, flats, have = [], [], [], 0

        def flush():
            nonlocal docs_, lens_, flats, have, seq
            ids = np.concatenate(flats)
            row = [[part], [seq], [np.concatenate(docs_).astype("<i8").tobytes()], [np.concatenate(lens_).astype("<i8").tobytes()], [len(ids)], [encode(ids)]]
            seq, docs_, lens_, flats, have = seq + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()], strict=True)], ["part", "seq", "doc_ids", "lens", "n_ids", "segment"])

        for rows, raw, offs in slices(batches, text="text"):
            flat, lens = tok.ids_of(raw, offs)
            out = np.full(len(flat) + len(lens), end_id, np.uint32)
            ends = np.cumsum(lens + 1)
            keep = np.ones(len(out), bool)
            keep[ends - 1] = False
            out[keep] = flat
            docs_.append(int_column(rows, "doc_id"))
            lens_.append(lens + 1)
            flats.append(out)
            have += len(out)
            if have >= SEGMENT_IDS:
                yield flush()
        if docs_:
            yield flush()

    n = partitions or shuffle_partitions(docs.sparkSession)
    (
        docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(run, SEGMENT_SCHEMA)
        .write.mode("overwrite").parquet(path)
    )


def read_files(spark, path: str, ids: bool = True) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 (unsigned, of the ids as little-endian uint32) and, with ids, ids (that
    binary) from the files under `path`."""
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One small row per segment: segments hold about 2**20 ids, and their starts are summed in two levels.
    from pyspark.sql import Window

    seq = files.select("part", "seq", "n_ids")
    parts = seq.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.withColumn("base", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", F.coalesce("base", F.lit(0)).alias("base"))
    within = seq.withColumn("inner", F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)))
    starts = within.join(before, "part").select("part", "seq", (F.coalesce("inner", F.lit(0)) + F.col("base")).alias("seg_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                data = memoryview(decode(row["segment"]).astype("<u4").tobytes())
                docs, lens = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lens"], "<i8")
                ends = np.cumsum(lens)
                at = 0
                while at < len(lens):  # as many documents as READ_IDS allows, or one longer
                    to = max(at + 1, int(np.searchsorted(ends, ends[at] - lens[at] + READ_IDS, side="right")))
                    own = [data[4 * (z - n) : 4 * z] for z, n in zip(ends[at:to].tolist(), lens[at:to].tolist(), strict=True)]
                    n = to - at
                    columns = [
                        pa.array([row["part"]] * n, pa.int64()), pa.array([row["seq"]] * n, pa.int64()), pa.array(docs[at:to], mask=docs[at:to] == NO_ID), pa.array((ends - lens)[at:to]), pa.array(lens[at:to]),
                        pa.array([zlib.crc32(x) for x in own], pa.int64()), *([pa.array([bytes(x) for x in own], pa.binary())] if ids else []),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32", *(["ids"] if ids else [])])
                    at = to

    schema = "part long, seq long, doc_id long, inner long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    rows = files.select("part", "seq", "lens", "doc_ids", "segment").mapInArrow(run, schema)
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("seg_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """The contract's digest: writes the files to the shared folder, reads them back, one row per document."""
    path = shared_dir(docs.sparkSession) + "/simple8b"
    write_files(docs, path, vocabulary, end_id)
    return read_files(docs.sparkSession, path, ids=False)


__all__ = ["decode", "encode", "read_files", "round_trip", "write_files"]
