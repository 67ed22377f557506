"""N-gram Jaccard join by parity sketches.

A text's shingle set is XOR-hashed into a bit sketch: each shingle flips one bit, so the Hamming distance of two
sketches is at most the size of the sets' symmetric difference. Two sets of a and b shingles with Jaccard similarity
s or more differ in at most (1 - s) / (1 + s) * (a + b) shingles.

Pigeonhole join. Sizes fall into bands a factor 1 / s apart, so a pair lies in one band or two adjacent ones, and
a band has one bound d on the difference. Per band the sketch is cut into d + margin segments, each kept as one
64-bit XOR word over its shingles (a hash of a very wide sparse segment). Two similar sets agree in at least `margin`
segments; a set with fewer empty segments than that shares a non-empty one. Sets with more empty segments send those as
keys too, which finds the pairs in which both are such. So no similar pair is lost.

Verification. Within a group of equal keys the sets' short bit sketches rule out nearly all dissimilar pairs by their Hamming
distance. Where few pairs are left, all are verified on the whole shingle sets and the group is done with; else a spanning
forest is verified, and then, in rounds over the groups still open, pairs between different components, best first and ever
more of them, until none is left. Equal sets are one node from the start. A group over GROUP nodes is dealt out to blocks that
share a few nodes; only nodes outside its largest component are then compared across blocks. Sketches are made of the nodes
in groups only, whole sets of the nodes in pairs only.

Defined results: A-Z count as a-z; a text of fewer than k words is one shingle; a null or blank text has no shingles, size 0,
and is linked with nothing, its component being itself; repeated doc_ids fall in one component (equal texts) or are
linked only if similar; rows without a doc_id (or with the least long) are documents, too, return null as doc_id and never name a
component: one of such rows only has a null component_id; an empty table gives no rows; other columns are ignored. Shingles are compared by 54-bit hashes, sets by
a 64-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Marks, bit_map, discard, int_column, materialise, only, shared_dir, shuffle_partitions, slices
from millrace.llm.components import components
from millrace.llm.hashing import SPACED, gram_hashes, mix, sequence_hash, word_bounds, word_hashes

#: Nodes of a key group that one task compares at once; a larger group is dealt out as pairs of blocks of half as many.
GROUP = 2048
#: A block sends all pairs that pass the sketches if there are at most this many per node, else a spanning forest.
FEW = 4
#: Nodes that all blocks of a large group share in the first round.
TIES = 16
#: Stands for a missing doc_id.
NO_ID = -(2**63)
#: How much more pairs of two components each further round verifies.
GROWTH = 16
#: Keys a task gathers before it sends them by bucket.
FLUSH_KEYS = 600_000


class Bands:
    """Size bands for a threshold: lower bounds, the most differing shingles of a pair, and segments."""

    def __init__(self, num: int, den: int):
        s = Fraction(num, den)
        self.num, self.den = num, den
        low = [1]
        while low[-1] < 1 << 31:
            low.append(max(low[-1] + 1, int(low[-1] / s)))
        self.low = np.array(low, np.int64)
        top = [(x - 1, int((x - 1) / s)) for x in low[1:]]
        self.d = np.array([int((1 - s) / (1 + s) * (a + b)) for a, b in top], np.int64)
        self.margin = 3 + (self.d * 12 + 99) // 100
        self.segments = self.d + self.margin

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, side="right") - 1


def shingle_sets(raw: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 54-bit shingle hashes of all texts end to end, each text's in ascending order, and how many each has."""
    texts = len(offs) - 1
    start, end, doc = word_bounds(raw, offs, SPACED)
    words = word_hashes(raw, start, end)
    grams = gram_hashes(words, k)
    whole = doc[: len(grams)] == doc[k - 1 : k - 1 + len(grams)]
    tokens, owner = grams[whole], doc[: len(grams)][whole]
    counts = np.bincount(doc, minlength=texts)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.cumsum(counts) - counts
        tokens = np.concatenate([tokens, np.array([mix(np.array([sequence_hash(words[first[i] : first[i] + counts[i]]) + np.uint64(counts[i])]))[0] for i in short], np.uint64)])
        owner = np.concatenate([owner, short])
    keys = np.unique((owner.astype(np.uint64) << np.uint64(54)) | (tokens >> np.uint64(10)))
    return keys & np.uint64((1 << 54) - 1), np.bincount((keys >> np.uint64(54)).astype(np.int64), minlength=texts)


def digests(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit digest of each set; 0 for an empty one."""
    out = np.zeros(len(sizes), np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        a = np.add.reduceat(mix(tokens + np.uint64(0x51ED)), at)
        b = np.bitwise_xor.reduceat(mix(tokens ^ np.uint64(0xC0FFEE1234567)), at)
        out[full] = mix(a ^ mix(b + sizes[full].astype(np.uint64))).view(np.int64)
    return out


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the short sketch of a set of n: a power of two of 2 n or more."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64))


def sketches(tokens: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    bits = sketch_bits(sizes)
    off = np.cumsum(bits) - bits
    flags = np.zeros(int(bits.sum()), np.uint8)
    place = np.repeat(off, sizes) + (mix(tokens + np.uint64(77)).astype(np.int64) & np.repeat(bits - 1, sizes))
    np.bitwise_xor.at(flags, place, np.uint8(1))
    packed = np.packbits(flags, bitorder="little").tobytes()
    return [packed[a // 8 : (a + b) // 8] for a, b in zip(off.tolist(), bits.tolist(), strict=True)]


def segment_keys(tokens: np.ndarray, sizes: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of sets in the given bands, and the set number of each."""
    segs = bands.segments[band]
    off = np.cumsum(segs) - segs
    words = np.zeros(int(segs.sum()), np.uint64)
    seg = ((mix(tokens + np.uint64(3)) >> np.uint64(32)) * np.repeat(segs, sizes).astype(np.uint64)) >> np.uint64(32)
    np.bitwise_xor.at(words, np.repeat(off, sizes) + seg.astype(np.int64), mix(tokens ^ np.uint64(0x5EED)))
    owner = np.repeat(np.arange(len(sizes)), segs)
    empty = words == 0
    many = np.bincount(owner[empty], minlength=len(sizes)) >= bands.margin[band]
    send = ~empty | many[owner]
    number = np.arange(len(words)) - off[owner]
    salt = (band[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64)
    return mix(words + mix(salt + np.uint64(11)))[send], owner[send]


def _nodes(k: int):
    """Per document: doc_id, size of its set, node (digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in slices(batches, most=1000):
            tokens, sizes = shingle_sets(raw, offs, k)
            yield pa.RecordBatch.from_arrays([pa.array(int_column(rows, "doc_id")), pa.array(sizes.astype(np.int64)), pa.array(digests(tokens, sizes))], ["doc_id", "n", "node"])

    return run


_BUCKET_SCHEMA = "bucket int, keys binary, nodes binary"
#: Bytes of a key that are sent, its lowest bit being the role: with the bucket, enough to tell keys apart; equal ones by chance are a candidate more.
KEY_BYTES = 6


def _keys(k: int, bands: Bands, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        have = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, have
            keys, node = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
            # Equal sets of other slices go here, too: one key (with its role) of a node.
            by = np.lexsort((node, keys))
            keys, node = keys[by], node[by]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])
            keys, node = keys[once], node[once]
            bucket = (keys >> np.uint64(40)).astype(np.int64) % buckets
            by = np.argsort(bucket, kind="stable")
            keys, node, bucket = keys[by], node[by], bucket[by]
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
            short = np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()
            nodes = node.astype("<i8").tobytes()
            rows = [bucket[cut[:-1]].tolist(), [short[KEY_BYTES * x : KEY_BYTES * y] for x, y in zip(cut[:-1], cut[1:], strict=True)], [nodes[8 * x : 8 * y] for x, y in zip(cut[:-1], cut[1:], strict=True)]]
            made, have = [], 0
            return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, [pa.int32(), pa.binary(), pa.binary()], strict=True)], ["bucket", "keys", "nodes"])

        for _, raw, offs in slices(batches, most=1000):
            tokens, sizes = shingle_sets(raw, offs, k)
            node = digests(tokens, sizes)
            _, first = np.unique(node, return_index=True)
            keep = np.zeros(len(node), bool)
            keep[first] = True
            keep &= sizes > 0
            tokens, sizes, node = tokens[np.repeat(keep, sizes)], sizes[keep], node[keep]
            if not len(node):
                continue
            band = bands.of(sizes)
            k0, o0 = segment_keys(tokens, sizes, band, bands)
            lower = np.flatnonzero(band > 0)
            k1, o1 = segment_keys(tokens[np.repeat(band > 0, sizes)], sizes[lower], band[lower] - 1, bands)
            role = np.uint64(1)
            made.append((np.concatenate([k0 & ~role, k1 | role]), node[np.concatenate([o0, lower[o1]])]))
            have += len(k0) + len(k1)
            if have >= FLUSH_KEYS:
                yield flush()
        if made:
            yield flush()

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each group of two nodes or more under one key; equal groups of a bucket once. Rows come by bucket."""

    def close(parts: list[tuple]) -> pa.RecordBatch | None:
        keys, nodes, role = (np.concatenate([p[i] for p in parts]) for i in range(3))
        by = np.argsort(keys, kind="stable")
        keys = keys[by]
        again = np.zeros(len(keys), bool)
        same = keys[1:] == keys[:-1]
        again[1:] |= same
        again[:-1] |= same
        by = by[again]  # most keys are alone
        if not len(by):
            return None
        keys, nodes, role = keys[again], nodes[by], role[by]
        by = np.lexsort((role, nodes, keys))
        keys, nodes, role = keys[by], nodes[by], role[by]
        once = np.ones(len(keys), bool)
        once[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, role = keys[once], nodes[once], role[once]
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        count = np.diff(np.append(cut, len(keys)))
        # A group needs two nodes, one of them of the band itself.
        good = (count > 1) & (np.minimum.reduceat(role, cut) == 0)
        gid = mix(np.add.reduceat(mix(nodes.view(np.uint64) + np.uint64(5)), cut) + count.astype(np.uint64)).view(np.int64)
        pick = np.zeros(len(cut), bool)
        # An equal group may stand under a key that is not good; keep a good one.
        at = np.flatnonzero(good)
        pick[at[np.unique(gid[at], return_index=True)[1]]] = True
        member = np.repeat(pick, count)
        if not member.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(gid, count)[member]), pa.array(nodes[member])], ["gid", "node"])

    now, parts = None, []
    for b in batches:
        for bucket, keys, nodes in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != now and parts:
                if (out := close(parts)) is not None:
                    yield out
                parts = []
            now = bucket
            short = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
            keys = np.zeros((len(short), 8), np.uint8)
            keys[:, :KEY_BYTES] = short
            keys = keys.view("<u8").ravel()
            parts.append((keys >> np.uint64(1), np.frombuffer(nodes, "<i8"), (keys & np.uint64(1)).astype(np.uint8)))
    if parts and (out := close(parts)) is not None:
        yield out


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _near(sk: list[bytes], n: np.ndarray, bands: Bands) -> np.ndarray:
    """Pairs that sizes and sketches let pass, as a boolean matrix."""
    g = len(n)
    size = min(map(len, sk))
    m = np.stack([_folded(np.frombuffer(s, np.uint64), size // 8) for s in sk])
    near = np.zeros((g, g), bool)
    num, den = bands.num, bands.den
    for i in range(g - 1):
        apart = np.bitwise_count(m[i + 1 :] ^ m[i]).sum(axis=1, dtype=np.int64)
        both = n[i + 1 :] + n[i]
        ok = (apart * (den + num) <= both * (den - num)) & (np.minimum(n[i + 1 :], n[i]) * den >= np.maximum(n[i + 1 :], n[i]) * num)
        near[i, i + 1 :] = ok
        near[i + 1 :, i] = ok
    return near


def _forest(near: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Edges of a spanning forest, and each place's tree (-1: nothing is near)."""
    left = near.any(axis=1)
    tree = np.full(len(near), -1)
    out = []
    for root in np.argsort(-near.sum(axis=1), kind="stable").tolist():
        if not left[root]:
            continue
        left[root] = False
        tree[root] = root
        queue = [root]
        while queue:
            i = queue.pop()
            found = np.flatnonzero(near[i] & left)
            left[found] = False
            tree[found] = root
            out += [(i, j) for j in found.tolist()]
            queue += found.tolist()
    return out, tree


def _candidates(bands: Bands, best: int | None):
    """Pairs (a, b) to verify in each block. best None: all pairs that the sketches let pass if they are few for the block's size, else
    a spanning forest; later, of each two components in a block the `best` nearest pairs. Where there are more, the trees of the forest are
    groups (open) of the next round, a row (a) for each node. Rows come by block: block, node, n, sketch, label."""

    def pairs(node, n, sk, label) -> tuple[set[tuple[int, int]], list[tuple[int, int]]]:
        label = np.array(label)
        if (label == label[0]).all():
            return set(), []
        near = np.triu(_near(sk, np.array(n), bands))
        near &= label[:, None] != label[None, :]
        i, j = np.nonzero(near)
        named = lambda ps: {(min(node[a], node[b]), max(node[a], node[b])) for a, b in ps}
        if len(i) <= FEW * len(n):
            return named(zip(i.tolist(), j.tolist(), strict=True)), []
        edges, tree = _forest(near | near.T)
        of = [(int(t), node[x]) for x, t in enumerate(tree.tolist()) if t >= 0]
        if best is None:
            return named(edges), of
        by: dict = {}
        width = min(map(len, sk)) // 8
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            by.setdefault((min(label[a], label[b]), max(label[a], label[b])), []).append((a, b))
        out, more = set(), False
        for ps in by.values():
            if len(ps) > best:
                far = lambda p: int(np.bitwise_count(_folded(np.frombuffer(sk[p[0]], np.uint64), width) ^ _folded(np.frombuffer(sk[p[1]], np.uint64), width)).sum())
                ps, more = sorted(ps, key=lambda p: (far(p), node[p[0]], node[p[1]]))[:best], True
            out |= named(ps)
        return out, of if more else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        now, rows = None, []

        def close() -> pa.RecordBatch | None:
            nonlocal sent
            found, more = pairs(*zip(*rows, strict=True)) if len(rows) > 1 else (set(), [])
            found -= sent
            if not found and not more:
                return None
            if len(sent) > 500_000:
                sent = set()
            sent |= found
            a = np.array(list(found), np.int64).reshape(-1, 2)
            gid = mix(np.array([t for t, _ in more], np.int64).view(np.uint64) + mix(np.array([now], np.int64).view(np.uint64))).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(a[:, 0].tolist() + [x for _, x in more], pa.int64()), pa.array(a[:, 1].tolist() + [None] * len(more), pa.int64()), pa.array([None] * len(a) + gid.tolist(), pa.int64())], ["a", "b", "open"])

        for b in batches:
            for row in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("block", "node", "n", "sketch", "label")), strict=True):
                if row[0] != now and rows:
                    if (out := close()) is not None:
                        yield out
                    rows = []
                now = row[0]
                if not rows or rows[-1][0] != row[1]:
                    rows.append(row[1:])
        if rows and (out := close()) is not None:
            yield out

    return run


def _once(node: np.ndarray, marks: Marks) -> np.ndarray:
    """Places of the first of equal non-empty sets that are marked."""
    at = np.unique(node, return_index=True)[1]
    return np.sort(at[(node[at] != 0) & marks.has(node[at])])


def _sketched(k: int, marks: Marks):
    """Size and sketch of the sets that are marked, of equal sets of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, offs in slices(batches, most=1000):
            tokens, sizes = shingle_sets(raw, offs, k)
            node = digests(tokens, sizes)
            at = pa.array(_once(node, marks))
            yield pa.RecordBatch.from_arrays([pa.array(node).take(at), pa.array(sizes.astype(np.int64)).take(at), pa.array(sketches(tokens, sizes), pa.binary()).take(at)], ["node", "n", "sketch"])

    return run


def _sets(k: int, marks: Marks):
    """The sets that are marked, equal ones of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, offs in slices(batches, most=1000):
            tokens, sizes = shingle_sets(raw, offs, k)
            node, ends = digests(tokens, sizes), np.cumsum(sizes)
            at, data = _once(node, marks), tokens.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array([data[8 * (e - n) : 8 * e] for e, n in zip(ends[at].tolist(), sizes[at].tolist(), strict=True)], pa.binary())], ["node", "tokens"])

    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("x", "y"))
            keep = np.zeros(b.num_rows, bool)
            for i, (s, t) in enumerate(zip(x, y, strict=True)):
                s, t = np.frombuffer(s, "<u8"), np.frombuffer(t, "<u8")
                at = np.searchsorted(t, s)
                both = int((t[np.minimum(at, len(t) - 1)] == s).sum())
                keep[i] = den * both >= num * (len(s) + len(t) - both)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _spread(groups: DataFrame, big: DataFrame) -> DataFrame:
    """(block, node) of the first round: a small group is a block; a large one is dealt out to blocks of GROUP / 2 nodes, each
    with the same few nodes besides, spread by hash, that may tie the blocks together."""
    small = groups.join(big, "gid", "left_anti").select(F.col("gid").alias("block"), "node")
    dealt = groups.join(big, "gid").withColumn("k", F.expr(f"cast(ceil(c * 2 / {GROUP}) as int)"))
    own = dealt.select(F.expr("xxhash64(gid, pmod(xxhash64(node), k))").alias("block"), "node")
    ties = dealt.groupBy("gid", "k", F.expr(f"pmod(xxhash64(node, 1), {TIES})")).agg(F.min("node").alias("node"))
    ties = ties.select(F.explode(F.expr("sequence(0, k - 1)")).alias("i"), "gid", "node").select(F.expr("xxhash64(gid, cast(i as bigint))").alias("block"), "node")
    return small.unionByName(own).unionByName(ties).distinct()


def _apart(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(block, node, label) of the groups whose nodes are in two components or more. A large group's blocks pair up the
    nodes outside its largest component with one another and with that component, whose own nodes need no comparing."""
    rows = groups.join(labels, "node", "left").select("gid", "node", F.coalesce("label", "node").alias("label"))
    of = rows.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("gid").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("c"), F.max(F.struct("c", "label")).alias("most"))
    of = of.where("parts > 1").select("gid", "c", F.col("most.label").alias("major"), F.expr(f"cast(ceil(most.c * 2 / {GROUP}) as int)").alias("km"), F.expr(f"cast(ceil((c - most.c) * 2 / {GROUP}) as int)").alias("kr"))
    rows = rows.join(of, "gid")
    small = rows.where(f"c <= {GROUP}").select(F.col("gid").alias("block"), "node", "label")
    # Blocks 0 to kr - 1 hold the rest, blocks kr to kr + km - 1 the largest component.
    rows = rows.where(f"c > {GROUP}").withColumn("own", F.expr("cast(case when label = major then kr + pmod(xxhash64(node), km) else pmod(xxhash64(node), kr) end as int)"))
    rows = rows.withColumn("o", F.explode(F.expr("sequence(0, case when label = major then kr - 1 else kr + km - 1 end)")))
    return small.unionByName(rows.select(F.expr("xxhash64(gid, least(own, o), greatest(own, o))").alias("block"), "node", "label"))


def similar(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links_found (verified links of its set; a set's other links are implied).

    num / den: the least Jaccard similarity of a link."""
    spark, where, bands = docs.sparkSession, shared_dir(docs.sparkSession), Bands(num, den)
    n = shuffle_partitions(spark)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    nodes = materialise(texts.mapInArrow(_nodes(k), "doc_id long, n long, node long"), where, "nodes")
    sent = texts.mapInArrow(_keys(k, bands, 4 * n), _BUCKET_SCHEMA)
    groups = sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_groups, "gid long, node long").distinct()
    groups = materialise(groups, where, "groups")
    # One document stands for each node that is in a group.
    wanted = nodes.join(groups.select("node").distinct(), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = materialise(wanted, where, "wanted")
    sketch = materialise(only(texts, wanted, "doc_id").mapInArrow(_sketched(k, bit_map(wanted.select("node"))), "node long, n long, sketch binary"), where, "sketches")
    big = materialise(groups.groupBy("gid").agg(F.count(F.lit(1)).alias("c")).where(f"c > {GROUP}"), where, "big")
    labels, counted, sets, best, turn = None, None, None, None, 0
    rows = _spread(groups, big).withColumn("label", F.col("node"))
    while True:
        rows = rows.join(sketch, "node").select("block", "node", "n", "sketch", "label")
        found = rows.repartition(n, "block").sortWithinPartitions("block", "node").mapInArrow(_candidates(bands, best), "a long, b long, open long").distinct()
        found = materialise(found, where, f"pairs{turn}")
        pairs = found.where("open is null").select("a", "b")
        # Sets of nodes that no earlier round has fetched.
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        fetch = materialise(wanted.join(ends if sets is None else ends.join(sets, "node", "left_anti"), "node", "left_semi"), where, f"fetch{turn}")
        if not fetch.isEmpty():
            # Sets that nobody asked for join no pair.
            own = materialise(only(texts, fetch, "doc_id").mapInArrow(_sets(k, bit_map(fetch.select("node"))), "node long, tokens binary"), where, f"sets{turn}")
            sets = own if sets is None else sets.unionByName(own)
        if sets is not None and not pairs.isEmpty():
            own = only(sets, ends, "node") if turn else sets  # later rounds need few
            x, y = own.select(F.col("node").alias("a"), F.col("tokens").alias("x")), own.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
            new = materialise(pairs.join(x, "a").join(y, "b").mapInArrow(_verify(num, den), "a long, b long").distinct(), where, f"links{turn}")
            counted = new if counted is None else counted.unionByName(new)
            if not new.isEmpty():
                # Labels so far are stars, so new links only join stars.
                edges = new if labels is None else new.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
                labels = components(edges, where, f"components{turn}")
        if labels is None:
            labels = spark.createDataFrame([], "node long, label long")
        # Groups all of whose pairs went are done with; so are, by _apart, those in one component by now.
        open_ = found.where("open is not null").select(F.col("open").alias("gid"), F.col("a").alias("node"))
        if best is None:
            open_ = open_.unionByName(groups.join(big, "gid", "left_semi").select("gid", "node"))
        rows = materialise(_apart(open_, labels), where, f"apart{turn}")
        if rows.isEmpty():
            break
        best, turn = (4 if best is None else best * GROWTH), turn + 1
    links = None if counted is None else counted.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links_found"))
    links = spark.createDataFrame([], "node long, n_links_found long") if links is None else links
    # Smallest doc_id of each component: first over equal sets, then over their labels.
    real = F.nullif(F.col("doc_id"), F.lit(NO_ID))
    rep = nodes.where("n > 0").groupBy("node").agg(F.min(real).alias("least")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    comp = rep.groupBy("label").agg(F.min("least").alias("component_id"))
    of = materialise(rep.join(comp, "label").join(links, "node", "left").select("node", "component_id", "n_links_found"), where, "of")
    discard(spark, where, ["groups", "wanted", "sketches", "big", *(f"{x}{i}" for i in range(turn + 1) for x in ("pairs", "fetch", "sets", "links", "apart"))])
    return nodes.join(of, "node", "left").select(
        real.alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(real).alias("component_id"), F.coalesce("n_links_found", F.lit(0)).alias("n_links_found"),
    )
