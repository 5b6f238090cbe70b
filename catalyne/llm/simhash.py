"""SimHash near-dedup: 64-bit fingerprints, linked by bit-sliced comparison of those that share blocks of bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, one_each, small_batches, written

#: Most fingerprints of a bucket that one comparison takes; larger buckets are dealt out in pairs of chunks.
CHUNK = 512
#: Rows of whole buckets that are compared at once.
AT_ONCE = 8_192
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The SimHash of a text: A-Z lower-cased, words split at ASCII white space, shingles hashed by XXH64. A bit is 1 if
    it is set in over half of the hashes. Fewer words than a shingle: the whole sequence; none, or null: 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())])
    n, counts = len(hashes) // 8, np.zeros(64, np.int64)
    octets = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 16):
        counts += np.unpackbits(octets[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def blocks_for(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """Tables of a pigeonhole cover: of radius + k blocks of bits, k stay equal between fingerprints that differ in at most
    radius bits. More equal bits make smaller buckets in more tables; no choice of k loses a link."""
    k = next((k for k in (1, 2, 3) if n >> (64 * k // (radius + k)) < 16), 4)
    edges = [64 * i // (radius + k) for i in range(radius + k + 1)]
    return [list(c) for c in combinations(list(zip(edges, edges[1:])), k)]


def matches(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions (i, j), i < j in one group and at most radius bits apart. group: sorted. Where a group has both
    sides, only pairs over them count.

    The fingerprints of a group are laid out in blocks of 64 lanes, one plane for each bit. A query's difference to a block
    is one XOR a plane; carry-save counters add the planes up for 64 lanes at a time, and a block is abandoned once all of
    its lanes exceed the radius.
    """
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    per = (sizes + 63) // 64
    first = np.cumsum(per) - per  # a group's first block
    which = np.repeat(np.arange(len(starts)), sizes)
    lane = np.arange(n) - starts[which]
    block = first[which] + lane // 64
    grid = np.zeros((int(per.sum()), 64), np.uint64)
    here = np.zeros(grid.shape, bool)
    grid[block, lane % 64] = fps
    here[block, lane % 64] = True
    index = np.zeros(grid.shape, np.int64)
    index[block, lane % 64] = np.arange(n)
    lanes = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    valid = (here * lanes).sum(axis=1, dtype=np.uint64)
    one = np.uint64(1)
    planes = np.empty((64, len(grid)), np.uint64)
    for j in range(64):
        planes[j] = (((grid >> np.uint64(j)) & one) * lanes).sum(axis=1, dtype=np.uint64)
    # Every fingerprint asks the blocks from its own to its group's last.
    times = first[which] + per[which] - block
    query = np.repeat(np.arange(n), times)
    asked = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times) + block[query]
    left, right, digits = [], [], max(1, radius.bit_length())
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, len(query), 1 << 18):
        q, w = query[at : at + (1 << 18)], asked[at : at + (1 << 18)]
        *counters, more = (np.zeros(len(q), np.uint64) for _ in range(digits + 1))
        for j in range(64):
            d = planes[j][w] ^ np.where((fps[q] >> np.uint64(j)) & one, full, np.uint64(0))
            for i, counter in enumerate(counters):
                counters[i], d = counter ^ d, counter & d
            more |= d  # beyond what the counters hold
            if j % 8 == 7 and j < 63:
                alive = (beyond(counters, more, radius) & valid[w]) != valid[w]
                if not alive.all():
                    q, w, more, *counters = (x[alive] for x in (q, w, more, *counters))
        near = ~beyond(counters, more, radius) & valid[w]
        some = np.flatnonzero(near)
        hit, bit = np.nonzero((near[some, None] >> np.arange(64, dtype=np.uint64)) & one)
        a, b = q[some[hit]], index[w[some[hit]], bit]
        ok = (a < b) & ((side[a] != side[b]) | ~mixed(side, starts, sizes)[which[a]])
        left.append(a[ok])
        right.append(b[ok])
    return np.concatenate(left or [np.empty(0, np.int64)]), np.concatenate(right or [np.empty(0, np.int64)])


def mixed(side: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each group, whether it holds two sides."""
    total = np.add.reduceat(side.astype(np.int64), starts)
    return (total > 0) & (total < sizes)


def beyond(counters: list[np.ndarray], more: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter, ones first, exceeds the radius. more: those that have overflown."""
    out, equal = more.copy(), ~more
    for i, digit in reversed(list(enumerate(counters))):
        if radius >> i & 1:
            equal = equal & digit
        else:
            out |= equal & digit
            equal = equal & ~digit
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each position reaches over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def links(classes: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) that connect all fingerprints at most radius bits apart. classes: (node, fp), each fp once.

    Rows meet in buckets of equal blocks. A bucket gives a spanning forest of its links rather than all pairs. Buckets over
    chunk rows are dealt out in pairs of chunks, every pair to a group of its own.
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius: 0 to 7")
    tables = blocks_for(classes.count(), radius)

    def bits(spans: list[tuple[int, int]]) -> Column:
        out, at = F.lit(0).cast("long"), 0
        for a, b in spans:
            part = F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1))
            out, at = out.bitwiseOR(F.shiftleft(part, at)), at + b - a
        return out

    keyed = classes.select("node", "fp", F.posexplode(F.array(*[bits(t) for t in tables])).alias("t", "key"))

    def compare(rows: pa.Table, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, root = rows["node"].to_numpy(), forest(rows.num_rows, a, b)
        own = np.flatnonzero(root != np.arange(len(root)))
        return node[own], node[root[own]]

    return compared(keyed, radius, chunk, compare)


def compared(keyed: DataFrame, radius: int, chunk: int, pick: Callable[[pa.Table, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(u, v): what pick makes of the pairs of rows, as positions, that share a bucket (t, key) and differ in at most radius
    bits of fp. keyed: (t, key, node, fp) and more. Buckets over chunk rows are dealt out in pairs of chunks."""
    names = [c for c in keyed.columns if c not in ("t", "key")]
    counts = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = keyed.join(counts, ["t", "key"]).withColumn("k", F.ceil(F.col("n") / chunk).cast("int"))
    keyed = keyed.withColumn("c", F.pmod(F.xxhash64("fp", "node", "t"), F.col("k")).cast("int"))
    keyed = keyed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    keyed = keyed.select("t", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", *names)
    dealt = keyed.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")

    def compare(rows: pa.Table) -> pa.RecordBatch:
        cols = [rows[c].to_numpy() for c in ("t", "key", "i", "j")]
        group = np.cumsum(np.r_[False, np.logical_or.reduce([c[1:] != c[:-1] for c in cols])])
        a, b = matches(rows["fp"].to_numpy().view(np.uint64), group, rows["c"].to_numpy() == cols[3], radius)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pick(rows, a, b)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= AT_ONCE:
                rows = pa.Table.from_batches(held).combine_chunks()
                cols = [rows[c].to_numpy() for c in ("t", "key", "i", "j")]
                ends = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))
                if len(ends):  # the last group may go on
                    yield compare(rows.slice(0, ends[-1] + 1))
                    held = rows.slice(ends[-1] + 1).to_batches()
        if sum(x.num_rows for x in held):
            yield compare(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text).

    Fingerprints at most radius bits apart are linked; component_id is the smallest doc_id that a row reaches. Copies
    collapse into one node before any comparison, so that a group of equal texts costs one row. Nulls: a null or empty text
    has fingerprint 0, linked like any other; a row with a null doc_id takes no part and gets a null component. Rows that
    share a doc_id each keep their own fingerprint. An empty table gives no rows. Other columns are ignored.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    roots = components(links(classes, radius))
    named = classes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    out = rows.join(named, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """docs, with the row of the smallest doc_id of every group of near-duplicates; of rows that repeat a doc_id, one
    stays, the smallest by its columns. Rows with a null doc_id stay."""
    return one_each(docs, near_duplicates(docs, radius, shingle))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
