"""SimHash near-dedup at a similarity of 0.8: fingerprints at a small distance are linked as op5 links them, and the exact
similarity of the shingles decides.

Blocks of bits alone can't find all pairs of a similarity of 0.8: some 10 of 64 bits differ there, and up to 24, beyond any
number of equal blocks. So documents also meet by the smallest hashes of their shingles and by their rarest shingles;
fingerprints leave out what can't be near, and the exact similarity decides there as well."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import components, discard, one_each, small_batches, written

#: Words of a shingle, and the Jaccard similarity from which documents are near-duplicates, as a fraction.
SHINGLE, NUMERATOR, DENOMINATOR = 5, 4, 5
#: Bands of so many smallest hashes each. A pair at the threshold misses all bands once in 9,000 times, closer ones less often.
BANDS, PER_BAND = 30, 6
SEED = 42
#: Bits in which fingerprints differ that are linked by blocks of equal bits.
LINKED = 4
#: Bits in which fingerprints may differ. At the threshold the sets' vectors have a cosine of 0.889, a bit differs with a
#: probability of 0.15, and more than 24 of 64 do once in some millions of pairs.
RADIUS = 24
#: Documents that a task holds against one other.
PARTNERS = 256
#: Shingles that are multiplied at once.
AT_ONCE = 2_048

_rng = np.random.default_rng(SEED)
FACTORS = _rng.integers(0, 1 << 63, BANDS * PER_BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, BANDS * PER_BAND, dtype=np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted: A-Z lower-cased, words split at ASCII white space. Fewer words than
    a shingle: the whole sequence; none, or null: nothing."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k, digest = min(SHINGLE, len(words)), xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())])
    return np.unique(np.frombuffer(hashes, ">u8").astype(np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """A number for each band; equal sets of shingles have equal ones."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), AT_ONCE):
        least = np.minimum(least, (hashes[i : i + AT_ONCE, None] * FACTORS + OFFSETS).min(axis=0))
    octets = least.tobytes()
    step = 8 * PER_BAND
    return [int.from_bytes(xxhash.xxh64_digest(octets[step * i : step * (i + 1)], i), "big", signed=True) for i in range(BANDS)]


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of distinct shingles, as a signed long: a bit is 1 if it is set in over half of them."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles are similar enough. Empty sets are only like each other."""
    if min(len(a), len(b)) * DENOMINATOR < NUMERATOR * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * DENOMINATOR >= NUMERATOR * (len(a) + len(b) - shared)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, fp, bands) of every row of docs; copy: a 128-bit hash of the words, equal for copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            copies = [xxhash.xxh3_128_digest(b" ".join(t.lower().split()) if t else b"") for t in texts]
            sets = [shingles(t) for t in texts]
            cols = [b.column(0), pa.array(copies, pa.binary()), pa.array(map(fingerprint, sets), pa.int64()), pa.array(map(bands, sets), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "copy", "fp", "bands"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, copy binary, fp long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) whose texts (node, text) are near. The documents that are held against one v are dealt out
    by PARTNERS; a task reads v's text once for each such part, then theirs, and holds two at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = None, None
        for b in batches:
            us, vs = [], []
            for v, part, u, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).cast(pa.binary()).to_pylist()):
                if u is None:
                    of, own = (v, part), shingles(text)
                elif of == (v, part) and near(own, shingles(text)):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    many = pairs.groupBy("v").agg(F.count("*").alias("n"))
    dealt = pairs.join(many, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.ceil(F.col("n") / PARTNERS)).cast("int").alias("part"))
    theirs = dealt.join(texts.withColumnRenamed("node", "u").hint("merge"), "u").select("v", "part", "u", "text")
    own = dealt.select("v", "part").distinct().join(texts.withColumnRenamed("node", "v").hint("merge"), "v").select("v", "part", F.lit(None).cast("long").alias("u"), "text")
    return own.unionByName(theirs).repartition("v", "part").sortWithinPartitions("v", "part", F.asc_nulls_first("u")).mapInArrow(run, "u long, v long")


def shingle_sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root, fp, hashes): the shingles of some nodes (node, root, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = pa.array([shingles(t).view(np.int64) for t in b.column(3).cast(pa.binary()).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), hashes], ["node", "root", "fp", "hashes"])

    return nodes.join(texts, "node").select("node", "root", "fp", "text").mapInArrow(run, "node long, root long, fp long, hashes array<long>")


def candidates(sets: DataFrame) -> DataFrame:
    """(u, v), u the larger: every pair of sets (node, root, fp, hashes) of different roots that can be near, and few others.

    Shingles are put into one order for all, the rarest first. Sets of a similarity of 0.8 or more share one of the first
    fifth of their shingles, and where they first meet in that order enough must be left of both (prefix and positional filters;
    exact, so that no near pair is lost). What is a document's own comes first: texts of one template that differ in more
    than a fifth never meet, however many they are. Fingerprints beyond the radius are left out.
    """
    each = sets.select("node", "root", "fp", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("many")).where("many > 1")
    of = Window.partitionBy("node")
    # Shingles that no other set has stand before all others, and meet none.
    met = each.join(often, "h").withColumn("place", F.col("n") - F.count("*").over(of) + F.row_number().over(of.orderBy("many", "h")) - 1)
    least = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    first = met.where(F.col("place") <= F.col("n") - least).select("h", "node", "root", "fp", "n", "place")
    x, y = first.alias("x"), first.alias("y")
    left = F.least(F.expr("x.n - x.place"), F.expr("y.n - y.place"))
    may = (
        F.expr("x.h = y.h AND x.node > y.node AND x.root <> y.root")
        & (F.least("x.n", "y.n") * DENOMINATOR >= F.greatest("x.n", "y.n") * NUMERATOR)
        & (left * (NUMERATOR + DENOMINATOR) >= (F.col("x.n") + F.col("y.n")) * NUMERATOR)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= RADIUS)
    )
    return x.join(y, may).select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct()


def linked(classes: DataFrame, radius: int = LINKED) -> DataFrame:
    """(u, v): pairs of nodes that connect all of classes (node, fp) whose fingerprints differ in at most radius bits. Nodes
    of one fingerprint are held against the smallest of them, the fingerprints are linked by simhash.links()."""
    prints = written(classes.groupBy("fp").agg(F.min("node").alias("lead")), "prints")
    same = classes.join(prints, "fp").where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    out = written(same.unionByName(simhash.links(prints.select(F.col("lead").alias("node"), "fp"), radius)), "linked")
    discard(prints)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row of docs (doc_id, text) with a doc_id: the smallest doc_id that it reaches over
    pairs of a similarity of 0.8 or more.

    Copies collapse into one node first. Nodes of near fingerprints are linked, as linked() has it; every node of a bucket (equal bands) is held against the bucket's smallest, and the exact similarity decides about these pairs; then
    the nodes of buckets that aren't connected yet meet by their rarest shingles, as candidates() has it. A large group costs
    a row each, texts that only look alike are not held against each other, and no pair of a bucket is left out. Nulls: rows
    with a null doc_id take no part; null and empty texts are copies of each other. Repeated rows share their group; an empty
    table gives no rows; other columns are ignored.
    """
    rows = written(sketches(docs.where("doc_id is not null")), "sketches")
    classes = written(rows.groupBy("copy").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("fp").alias("fp")), "classes")
    alike = linked(classes.select("node", "fp"))
    keyed = classes.select("node", "fp", F.posexplode("bands").alias("t", "key"))
    leads = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min(F.struct("node", "fp")).alias("least")).where("n > 1")
    buckets = written(keyed.join(leads.select("t", "key", F.col("least.node").alias("lead"), F.col("least.fp").alias("lead_fp")), ["t", "key"]), "buckets")
    asked = buckets.select("node").unionByName(alike.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(asked, "node", "left_semi")
    texts = written(texts.groupBy("node").agg(F.min("text").alias("text")), "texts")
    likely = buckets.where((F.col("node") != F.col("lead")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("lead_fp"))) <= RADIUS))
    likely = likely.select(F.col("node").alias("u"), F.col("lead").alias("v")).unionByName(alike)
    first = written(verified(likely.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), texts), "links")
    roots = components(first)
    placed = buckets.drop("lead_fp").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("t", "key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("t", "key")
    sets = written(shingle_sets(placed.join(open_, ["t", "key"]).select("node", "root", "fp").distinct(), texts), "sets")
    pairs = written(candidates(sets), "pairs")
    more = written(verified(pairs, texts), "links")
    if not more.isEmpty():
        roots = components(first.unionByName(more))
    named = rows.groupBy("copy").agg(F.min("doc_id").alias("node")).join(roots, "node", "left").select("copy", F.coalesce("root", "node").alias("component_id"))
    out = written(rows.select("doc_id", "copy").join(named, "copy").drop("copy"), "groups")
    discard(rows, classes, alike, buckets, texts, first, sets, pairs, more)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """docs, with the row of the smallest doc_id of every group of near-duplicates; of rows that repeat a doc_id, the
    smallest by its columns. Rows with a null doc_id stay. Null and empty texts are copies of each other; an empty table
    gives no rows; other columns stay."""
    return one_each(docs, near_duplicates(docs))
