"""Substring dedup: windows of words that repeat across documents, found by level-wise doubling from short ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, discard, small_batches, written

WINDOW = 50
#: Words of the shortest windows that are looked at, about.
SHORTEST = 6

#: Odd multipliers of two independent hash families.
FAMILIES = (
    (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD),
    (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xC4CEB9FE1A85EC53),
)
DOC = "_doc long, _tkey long"


def mix(a: np.ndarray, b: np.ndarray, family: int) -> np.ndarray:
    """One hash of two, order included."""
    p, q, r = (np.uint64(x) for x in FAMILIES[family])
    x = a * p
    x ^= (b ^ (b >> np.uint64(29))) * q
    x ^= x >> np.uint64(32)
    x *= r
    x ^= x >> np.uint64(29)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)


def level(h: np.ndarray, length: int, family: int) -> np.ndarray:
    """The hash of every window of that many words: a level is two windows of the level below, side by side, and one word
    more where the length is odd."""
    if length == 1:
        return h
    half = level(h, length // 2, family)
    out = mix(half[: len(half) - length // 2], half[length // 2 :], family)
    return mix(out[:-1], h[length - 1 :], family) if length % 2 else out


def ladder(window: int) -> list[int]:
    """The lengths below the window's, each half of the next, from SHORTEST words on; one at least."""
    lengths = [window // 2]
    while lengths[0] >= 2 * SHORTEST:
        lengths.insert(0, lengths[0] // 2)
    return lengths


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every width neighbours, by doubling."""
    out, k = x, 1
    while 2 * k <= width:
        out, k = np.minimum(out[:-k], out[k:]), 2 * k
    return np.minimum(out[: len(out) - (width - k)], out[width - k :]) if k < width else out


def run_rows(words: list[bytes], window: int, length: int, alive: np.ndarray | None, last: bool) -> tuple[np.ndarray, ...] | None:
    """(m, a, b), and s at the last level, for each run a..b of neighbouring windows that are alive and have the same anchor
    m: the smallest hash among the windows of the given length inside. Equal windows have equal anchors, and neighbours
    mostly share theirs. s: a hash of all words that the run covers; its first and last window overlap."""
    n = len(words) - window + 1
    if n <= 0:
        return None
    h = word_hashes(words)
    m = sliding_min(level(h, length, 0), window - length + 1)[:n]
    at = np.arange(n) if alive is None else np.flatnonzero(alive[:n])
    if not len(at):
        return None
    new = np.r_[True, (np.diff(at) != 1) | (m[at[1:]] != m[at[:-1]])]
    first = np.flatnonzero(new)
    along = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    first = np.flatnonzero(along % (window // 2 + 1) == 0)
    a, b = at[first], at[np.r_[first[1:], len(at)] - 1]
    out = m[a].view(np.int64), a.astype(np.int32), b.astype(np.int32)
    if not last:
        return out
    whole = level(h, window, 0)
    return *out, (mix(whole[a], whole[b], 1) + (b - a).astype(np.uint64)).view(np.int64)


def places(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of n places are in one of the intervals a..b."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, a, 1)
    np.add.at(change, b + 1, -1)
    return np.cumsum(change[:-1]) > 0


def keyed(docs: DataFrame) -> DataFrame:
    """docs with their key: doc_id and, to tell apart texts that share one, a hash of the text. Others are left out."""
    return docs.where("doc_id is not null and text is not null").withColumns({"_doc": F.col("doc_id").cast("long"), "_tkey": F.xxhash64("text")})


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_doc, _tkey, spans): of every text with any, the word intervals [start, end) that windows cover which also start in
    a document with a smaller id. texts: of keyed(), best in buckets by the key; texts that share an id aren't compared.

    Level by level: windows of 6, 12 and 25 words (of a window of 50) are looked at in turn, and of each length only where
    the length below is in several documents; each level is written. At a level, a full window stands for itself by one of
    the shorter windows inside, its anchor, so that a run of full windows on one anchor is one row; a full window that
    repeats has an anchor that does, at each length. Runs that are left at the last level are extended to the full length:
    first as a whole (a run that a smaller document also has is settled with one row), then, where runs on one anchor
    differ, window by window, in the one document that has the run first. Anchors whose runs are all the same need no more.
    """
    small_batches(texts.sparkSession)
    text, lengths = F.col("text").cast("binary").alias("text"), ladder(window)

    def rows_of(source: DataFrame, length: int, last: bool) -> DataFrame:
        names = ["_doc", "_tkey", "m", "a", "b", *(["s"] if last else [])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, keys, found = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
                for i, t in enumerate(batch.column(2)):
                    words, alive = t.as_py().split(), None
                    if batch.num_columns > 3:
                        alive = places(max(1, len(words)), *(batch.column(c)[i].values.to_numpy() for c in (3, 4)))
                    if r := run_rows(words, window, length, alive, last):
                        found.append((i, r))
                if found:
                    times, rows = [len(r[0]) for _, r in found], [i for i, _ in found]
                    cols = [np.repeat(ids[rows], times), np.repeat(keys[rows], times), *(np.concatenate(c) for c in zip(*(r for _, r in found)))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

        return source.mapInArrow(run, f"{DOC}, m long, a int, b int" + ", s long" * last)

    def with_runs(runs: DataFrame) -> DataFrame:
        """The texts that have runs, with these. A merge join at every size: the lists grow with the corpus."""
        each = runs.groupBy("_doc", "_tkey").agg(F.collect_set(F.struct("a", "b")).alias("_runs")).hint("merge")
        return texts.join(each, ["_doc", "_tkey"]).select("_doc", "_tkey", text, F.col("_runs.a").alias("a"), F.col("_runs.b").alias("b"))

    source = texts.select("_doc", "_tkey", text)
    for length in lengths[:-1]:
        table = written(rows_of(source, length, False), f"windows{length}")
        several = table.groupBy("m").agg(F.min("_doc").alias("lo"), F.max("_doc").alias("hi")).where("lo < hi").select("m")
        alive = written(table.join(several, "m").select("_doc", "_tkey", "a", "b"), f"alive{length}")
        discard(table)
        source = with_runs(alive)
    table = written(rows_of(source, lengths[-1], True), f"windows{lengths[-1]}")

    # Of each run the smallest document, and whether its anchor has runs that begin with other documents.
    runs = table.groupBy("m", "s").agg(F.min("_doc").alias("lo"), F.max("_doc").alias("hi"))
    forked = runs.groupBy("m").agg(F.min("lo").alias("a"), F.max("lo").alias("b")).where("a < b").select("m", F.lit(True).alias("forked"))
    owners = runs.join(forked, "m", "left").where("lo < hi or forked").select("m", "s", "lo", F.coalesce("forked", F.lit(False)).alias("forked"))
    met = table.join(owners, ["m", "s"]).where("_doc > lo or forked")
    hits = written(met.select("_doc", "_tkey", "a", "b", (F.col("_doc") > F.col("lo")).alias("settled")), "hits")
    discard(table)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rest, window by window."""
        for batch in batches:
            for i in range(batch.num_rows):
                h = word_hashes(batch.column(2)[i].as_py().split())
                one, two = (level(h, window, f) for f in (0, 1))
                at = np.flatnonzero(places(len(one), *(batch.column(c)[i].values.to_numpy() for c in (3, 4))))
                cols = [np.full(len(at), batch.column(0)[i].as_py()), np.full(len(at), batch.column(1)[i].as_py()), one[at].view(np.int64), two[at].view(np.int64), at.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["_doc", "_tkey", "h1", "h2", "p"])

    each = written(with_runs(hits.where("not settled")).mapInArrow(windows, f"{DOC}, h1 long, h2 long, p int"), f"windows{window}")
    first = each.groupBy("h1", "h2").agg(F.min("_doc").alias("lo"), F.max("_doc").alias("hi")).where("lo < hi")
    late = each.join(first, ["h1", "h2"]).where("_doc > lo").select("_doc", "_tkey", F.col("p").alias("a"), F.col("p").alias("b"))
    covered = hits.where("settled").select("_doc", "_tkey", "a", "b").unionByName(late)
    merged = covered.groupBy("_doc", "_tkey").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("runs"))
    found = merged.select("_doc", "_tkey", F.col("runs.a").alias("a"), F.col("runs.b").alias("b")).mapInArrow(joined(window), f"{DOC}, spans array<struct<start:int,end:int>>")
    found = written(found, "found")
    discard(hits, each)
    return found


def joined(window: int):
    """Merges runs of windows, sorted by their start, into intervals of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                a, b = batch.column(2)[i].values.to_numpy(), np.maximum.accumulate(batch.column(3)[i].values.to_numpy()) + window
                cut = np.flatnonzero(a[1:] > b[:-1]) + 1
                out.append([{"start": s, "end": e} for s, e in zip(a[np.r_[0, cut]].tolist(), b[np.r_[cut - 1, len(b) - 1]].tolist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], ["_doc", "_tkey", "spans"])

    return run


def without_spans(texts: DataFrame, names: list[str], rest: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of texts and of rest, with n_words, n_removed and kept: the words outside of the spans, joined by one
    space (a null text stays null, with 0 words). found: of repeated_spans()."""
    spans = found.select("_doc", "_tkey", F.col("spans").alias("_spans")).hint("merge")
    both = texts.join(spans, ["_doc", "_tkey"], "left").select(*names, "_spans")
    both = both.unionByName(rest.select(*names).withColumn("_spans", F.lit(None).cast(both.schema["_spans"].dataType)))
    place = {c: i for i, c in enumerate(both.columns)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column(place["text"]).cast(pa.binary()).to_pylist(), batch.column(place["_spans"]).to_pylist()):
                words = text.split() if text is not None else []
                n.append(len(words))
                for x in reversed(spans or []):
                    del words[x["start"] : x["end"]]
                gone.append(n[-1] - len(words))
                kept.append(None if text is None else b" ".join(words).decode("utf-8", "replace"))
            cols = [batch.column(place[c]) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], [*names, "n_words", "n_removed", "kept"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema.fields if f.name != "_spans")
    return both.mapInArrow(cut, f"{kinds}, n_words long, n_removed long, kept string")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_removed and kept (columns of these names, and _doc, _tkey and _spans, are replaced).

    A word goes if a window of consecutive words covers it which also starts in a document with a smaller doc_id; windows
    are judged on the input. Words: runs of anything but ASCII white space, unchanged. Null and empty texts: 0 words. Texts
    that share a doc_id aren't held against each other, repeated rows are treated alike, and rows with a null doc_id are
    left as they are. An empty table gives no rows. Other columns stay.

    The texts are dealt out once, into buckets by document; every level reads them there.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept", "_doc", "_tkey", "_spans")]
    docs = docs.select(*names)
    texts = bucketed(keyed(docs), ["_doc", "_tkey"], "texts")
    return without_spans(texts, names, docs.where("doc_id is null or text is null"), repeated_spans(texts, window))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))
