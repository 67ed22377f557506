"""Best-fit packing by hierarchical residual rounds.

Each partition packs its own pieces best-fit decreasing and emits the nearly full bins. Underfull bins become items
(their pieces stay together) that are mixed anew by a hash and packed again, in as many tasks as there are ROUND_ITEMS of them, so
that ever fewer tasks hold what is left. Rounds end when one task has packed the rest, or when a round has merged away less than one
in LEAST_SAVED of its bins: bins that a random mix can't fill, such as documents of just over half a sequence, would fill in no
other. No task packs more than ROUND_ITEMS bins or LOCAL_PIECES pieces (and one bin) at once, however many are left.

Defined results: a null text is an empty one (only its end id); repeated doc_ids are packed as rows of their own, and a missing doc_id
(or the least long) is null; an empty table gives no rows; other columns are ignored. A sequence's number is that of its first bin and
means nothing else.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import int_column, materialise, shared_dir, slices
from millrace.llm.tokens import encoder

#: Items (bins of the round before) that one task of a merge round packs at most.
ROUND_ITEMS = 200_000
#: Pieces that a task packs at once; bounds its memory.
LOCAL_PIECES = 400_000
#: Share of the capacity from which a bin is emitted: in 2048 tokens, 4 or fewer may stay empty.
NEARLY_FULL = 0.998
#: Another round follows one that has saved at least one in so many bins.
LEAST_SAVED = 50
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long, done boolean"
_NAMES = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.bool_()]


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item: largest items first, each into the fullest bin that still holds it."""
    out = np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0  # bit r of rooms: there is a bin with room r
    order = np.argsort(-sizes, kind="stable").tolist()
    size_list = sizes.tolist()
    for i in order:
        size = size_list[i]
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            b, room = bins, capacity
            bins += 1
        out[i] = b
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return out


def _pack(cols: dict[str, np.ndarray], capacity: int, full: int) -> pa.RecordBatch:
    """Packs the bins that the rows make up into new bins, each with the number of its first; rows of a bin stay in their order."""
    old, inverse = np.unique(cols["bin"], return_inverse=True)
    sizes = np.zeros(len(old), np.int64)
    np.add.at(sizes, inverse, cols["length"])
    new = best_fit(sizes, capacity)
    # Each item starts in its bin where the items before it end.
    order = np.argsort(new, kind="stable")
    ends = np.cumsum(sizes[order])
    first = np.searchsorted(new[order], np.arange(new.max() + 1 if len(new) else 0))
    item_start = np.zeros(len(old), np.int64)
    item_start[order] = ends - sizes[order] - (ends - sizes[order])[first[new[order]]]
    fill = np.zeros(len(first), np.int64)
    np.add.at(fill, new, sizes)
    cols = cols | {"offset": cols["offset"] + item_start[inverse], "fill": fill[new[inverse]]}
    cols["bin"] = old[order[first]][new[inverse]]
    cols["done"] = cols["fill"] >= full
    return pa.RecordBatch.from_arrays([pa.array(cols[n], t) for n, t in zip(_NAMES, _TYPES, strict=True)], _NAMES)


def tokenise_pieces(vocabulary: str, end_id: int, capacity: int, full: int):
    """The first round: ids, pieces, and best-fit within the partition. Ids themselves are dropped; start and length find them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, part, made, have = encoder(vocabulary), TaskContext.get().partitionId(), [], 0
        bins = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, have, bins
            cols = {k: np.concatenate([m[k] for m in made]) for k in made[0]}
            cols["bin"] = (part << 36) + bins + np.arange(len(cols["length"]))
            cols["offset"] = np.zeros(len(cols["length"]), np.int64)
            out = _pack(cols, capacity, full)
            bins += len(cols["length"])
            made, have = [], 0
            return out

        for rows, raw, offs in slices(batches):
            flat, lens = tok.ids_of(raw, offs)
            lens = lens + 1
            ends = np.cumsum(lens)
            ids = np.full(int(ends[-1]), end_id, "<u4")
            keep = np.ones(len(ids), bool)
            keep[ends - 1] = False
            ids[keep] = flat
            pieces = -(-lens // capacity)
            doc = np.repeat(np.arange(len(lens)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, lens[doc] - start)
            lo = ((ends - lens)[doc] + start) * 4
            data = memoryview(ids.tobytes())
            crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(lo.tolist(), (lo + 4 * length).tolist(), strict=True)), np.int64, len(doc))
            made.append({"doc_id": int_column(rows, "doc_id")[doc], "piece": piece.astype(np.int32), "start": start, "length": length, "ids_crc32": crc})
            have += len(doc)
            if have >= LOCAL_PIECES:
                yield flush()
        if made:
            yield flush()

    return run


def _merge(capacity: int, full: int):
    """Packs the bins of a task, which come by bin and offset, as many at once as memory allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, have = ("doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"), None
        for b in batches:
            now = {n: b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names}
            have = now if have is None else {n: np.concatenate([have[n], now[n]]) for n in names}
            while len(firsts := np.flatnonzero(have["offset"] == 0)) > ROUND_ITEMS or len(have["bin"]) > LOCAL_PIECES:
                n = min(ROUND_ITEMS, len(firsts) - 1, max(1, int(np.searchsorted(firsts, LOCAL_PIECES, side="right")) - 1))  # the last bin may go on in the next batch
                if not n:
                    break
                cut = int(firsts[n])
                yield _pack({n: x[:cut] for n, x in have.items()}, capacity, full)
                have = {n: x[cut:] for n, x in have.items()}
        if have is not None and len(have["bin"]):
            yield _pack(have, capacity, full)

    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 2048, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A bin filled to at least nearly_full of the capacity is emitted at once; others go to the next round."""
    spark, where = docs.sparkSession, shared_dir(docs.sparkSession)
    full = max(1, math.ceil(capacity * nearly_full))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tokenise_pieces(vocabulary, end_id, capacity, full), PIECE_SCHEMA)
    done: list[DataFrame] = []
    tasks, stage, before = None, 0, None
    while True:
        rows = materialise(rows, where, f"round{stage}")
        bins, items = rows.where("offset = 0").agg(F.count(F.lit(1)), F.count_if(~F.col("done"))).first()
        if items == 0 or tasks == 1 or (before is not None and (before - bins) * LEAST_SAVED < before):
            done.append(rows)
            break
        done.append(rows.where("done"))
        tasks, stage, before = -(-items // ROUND_ITEMS), stage + 1, items
        rows = rows.where("not done").repartition(tasks, F.xxhash64("bin", F.lit(stage))).sortWithinPartitions("bin", "offset").mapInArrow(_merge(capacity, full), PIECE_SCHEMA)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.nullif("doc_id", F.lit(-(2**63))).alias("doc_id"), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
