"""Approximate nearest neighbours: robust-pruned directed graphs, one a shard, searched by beams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Different vectors of a shard, about; a graph is built and held by one task. Every query is searched for in every shard,
#: so that larger shards, as far as memory goes, save work.
SHARD = 8192
#: Out-degree, beam of the build, and the factor by which a nearer neighbour must be nearer to prune an edge.
DEGREE, BUILD_BEAM, ALPHA = 32, 48, 1.2
#: Beam of the search.
BEAM = 128
#: Points that are inserted, and queries that are searched, at once.
BATCH = 256
#: Digits of a cosine that decide a place.
DIGITS = 12


def beam_search(vectors: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy search for many queries side by side: (ids, distances, visited) of each query's beam, nearest first. A step
    expands every query's nearest beam member that isn't expanded yet, until none is left. Missing places: id -1."""
    q = len(queries)
    ids = np.full((q, width), -1)
    dist = np.full((q, width), np.inf, np.float32)
    done = np.ones((q, width), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = 1 - queries @ vectors[entry]
    seen = np.zeros((q, len(vectors)), bool)
    seen[:, entry] = True
    while len(open_ := np.flatnonzero(~done.all(axis=1))):
        at = np.argmin(done[open_], axis=1)  # the first that isn't expanded
        done[open_, at] = True
        nxt = graph[ids[open_, at]]
        fresh = (nxt >= 0) & ~seen[open_[:, None], nxt]
        d = 1 - (vectors[nxt] @ queries[open_][:, :, None])[:, :, 0]
        d = np.where(fresh, d, np.inf).astype(np.float32)
        seen[np.broadcast_to(open_[:, None], nxt.shape)[fresh], nxt[fresh]] = True
        all_d = np.concatenate([dist[open_], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        take = lambda x, y: np.take_along_axis(np.concatenate([x[open_], y], axis=1), order, axis=1)
        ids[open_] = take(ids, np.where(fresh, nxt, -1))
        done[open_] = take(done, ~fresh)
        dist[open_] = np.take_along_axis(all_d, order, axis=1)
    return ids, dist, seen


def robust_prune(vectors: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point, diverse neighbours out of its candidates (-1: none): the nearest candidate is taken, and those that
    are alpha times nearer to it than to the point fall, again and again."""
    cand = np.where(cand == points[:, None], -1, cand)
    cand = -np.sort(-cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    c = vectors[cand]
    d = np.where(cand >= 0, 1 - (c @ vectors[points][:, :, None])[:, :, 0], np.inf)
    among = 1 - c @ c.transpose(0, 2, 1)
    out, rows = np.full((len(points), degree), -1), np.arange(len(points))
    for k in range(degree):
        at = np.argmin(d, axis=1)
        ok = np.isfinite(d[rows, at])
        if not ok.any():
            break
        out[ok, k] = cand[rows[ok], at[ok]]
        fall = alpha * among[rows, at] <= d
        d[fall] = np.inf
        d[rows, at] = np.inf
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, int]:
    """(neighbours of each vector, -1 where fewer, and the entry) over unit vectors. Points come in a random order, in
    batches that grow from one; each is searched for in the graph so far, linked to what robust pruning leaves of the
    beam, and linked back; a point with too many edges is pruned again."""
    n = len(vectors)
    graph = np.full((n, degree), -1)
    if n == 0:
        return graph, -1
    mean = vectors.mean(axis=0)
    entry = int(np.argmax(vectors @ mean))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        batch = order[at : at + min(at, BATCH)]
        at += len(batch)
        found, _, _ = beam_search(vectors, graph, entry, vectors[batch], beam)
        graph[batch] = robust_prune(vectors, batch, found, degree, alpha)
        back = graph[batch]
        source, target = np.repeat(batch, degree), back.ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        points, first, many = np.unique(target, return_index=True, return_counts=True)
        extra = np.full((len(points), many.max(initial=1)), -1)
        extra[np.repeat(np.arange(len(points)), many), np.arange(len(target)) - np.repeat(first, many)] = source
        for i in range(0, len(points), BATCH):
            p, more = points[i : i + BATCH], extra[i : i + BATCH]
            cand = np.concatenate([graph[p], more[:, : many[i : i + BATCH].max()]], axis=1)
            full = (cand >= 0).sum(axis=1) > degree
            if full.any():
                graph[p[full]] = robust_prune(vectors, p[full], cand[full], degree, alpha)
            if (~full).any():
                graph[p[~full]] = -np.sort(-cand[~full], axis=1)[:, :degree]
    return graph, entry


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that leads its largest component to 0.5 to 1: exact, so that cosines are those of
    the vectors as they were given, and no square overflows or vanishes that counts."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -exponent[:, None])


def units(x: np.ndarray) -> np.ndarray:
    """As unit vectors, from scaled ones."""
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the rows of scaled vectors x with y, in double precision."""
    return np.clip(np.einsum("...d,...d->...", x, y) / np.sqrt(np.einsum("...d,...d->...", x, x) * np.einsum("...d,...d->...", y, y)), -1, 1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: an id, and no null, zero or non-finite among the components."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return v.where(finite & F.exists("embedding", lambda x: x != 0))


def direction() -> Column:
    """A digest of a vector's direction: its components against the largest, in steps of 2**-40. Multiples of a vector share
    it, rounded as they may be."""
    largest = F.array_max(F.transform("embedding", F.abs))
    return F.sha2(F.transform("embedding", lambda x: F.rint(x / largest * float(2**40)).cast("long")).cast("string"), 256)


def graphs(vectors: DataFrame, keep: int, shard: int = SHARD) -> tuple[DataFrame, int]:
    """((shard, dim, node, entry, ids, embedding, neighbours), number of shards): every direction once, in the graph of its
    shard, with the keep smallest of its ids and their vectors one after the other. Copies and multiples of a vector collapse
    before any task holds them."""
    copy = Window.partitionBy("direction").orderBy("vec_id", "embedding")
    few = vectors.withColumn("direction", direction()).withColumn("_rank", F.row_number().over(copy)).where(F.col("_rank") <= keep)
    listed = F.array_sort(F.collect_list(F.struct("vec_id", "embedding")))
    grouped = few.groupBy("direction", F.size("embedding").alias("dim")).agg(listed.alias("l"))
    classes = written(grouped.select("direction", "dim", F.col("l.vec_id").alias("ids"), F.flatten("l.embedding").alias("embedding")), "vectors")
    shards = max(1, -(-classes.count() // shard))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("direction"), F.lit(shards)).cast("int"))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("direction").reset_index(drop=True)
        graph, entry = build(units(scaled(leaders(rows))))
        return rows.assign(node=np.arange(len(rows), dtype=np.int32), entry=np.int32(entry), neighbours=list(graph.astype(np.int32)))[["shard", "dim", "node", "entry", "ids", "embedding", "neighbours"]]

    kind = "shard int, dim int, node int, entry int, ids array<long>, embedding array<double>, neighbours array<int>"
    return written(dealt.groupBy("shard", "dim").applyInPandas(one, kind), "graphs"), shards


def leaders(rows: pd.DataFrame) -> np.ndarray:
    """The first vector of each node."""
    return np.stack([x[:d] for x, d in zip(rows["embedding"], rows["dim"])])


class Shard:
    """A shard's graph, held for many queries."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("node")
        self.exact = scaled(leaders(rows))
        self.vectors, self.graph, self.entry = units(self.exact), np.stack(rows["neighbours"]), int(rows["entry"].iloc[0])
        self.ids, self.members = rows["ids"].to_numpy(), rows["embedding"].to_numpy()

    def search(self, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
        """The k nearest of each query: the beam's members, ranked anew by the cosine in double precision. Members of a node
        have one place, by the cosine of the first; each has a score of its own."""
        out = []
        for at in range(0, len(queries), BATCH):
            part = queries.iloc[at : at + BATCH]
            asked = scaled(np.stack(part["embedding"]))
            found, _, _ = beam_search(self.vectors, self.graph, self.entry, units(asked), beam)
            place = np.where(found >= 0, np.round(cosines(self.exact[found], asked[:, None]), DIGITS), -np.inf)
            for i, own in enumerate(part["query_id"].to_numpy()):
                got: list[tuple[float, int, int, int]] = []
                for j in np.argsort(-place[i], kind="stable"):
                    if found[i, j] < 0 or (len(got) >= k and place[i, j] < -sorted(got)[k - 1][0]):
                        break
                    got += [(-place[i, j], v, found[i, j], m) for m, v in enumerate(self.ids[found[i, j]]) if v != own]
                best = sorted(got)[:k]
                if best:
                    each = np.stack([self.members[node].reshape(-1, asked.shape[1])[m] for _, _, node, m in best])
                    out += [(own, v, -p, s) for (p, v, _, _), s in zip(best, cosines(scaled(each), asked[i]))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "place", "score"]).astype({"query_id": "int64", "vec_id": "int64", "place": float, "score": float})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of each query with the largest cosine that the graphs find, nearest
    first, ties to the smaller vec_id; a query isn't its own neighbour. Scores tie if they are equal to twelve digits, which
    is what sums of rounded products can tell apart: multiples of a vector tie, as their cosines are the same.

    vectors, queries: (vec_id, embedding). Every vector is in the graph of one shard and every shard is asked: a task reads
    a shard's graph, then any number of queries, some hundred at a time. Copies and multiples of a vector are one node, which
    answers with the smallest ids, however many there are. Components can be of any finite size. Vectors with a null id, null,
    zero or with null or non-finite components take no part, on either side; vectors of different lengths aren't compared;
    repeated rows count once. Fewer vectors than k: all of them. An empty table gives no rows; other columns are ignored.
    """
    graph, shards = graphs(usable(vectors).distinct(), k + 1, shard)
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = usable(queries).distinct().select(F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("dim"), every)
    held = graph.select("shard", "dim", F.lit(0).alias("kind"), "node", "entry", "ids", "embedding", "neighbours", F.lit(None).cast("long").alias("query_id"))
    both = held.unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, index = None, [], None
        for b in batches:
            for (*own, kind), part in b.to_pandas().groupby(["shard", "dim", "kind"], sort=True):
                if own != key:
                    key, rows, index = own, [], None
                if kind == 0:
                    rows.append(part)
                    continue
                if index is None and rows:
                    index, rows = Shard(pd.concat(rows)), []
                if index is not None:  # a shard may hold no vector of this length
                    yield pa.RecordBatch.from_pandas(index.search(part, k, beam), preserve_index=False)

    dealt = both.repartition(shards, "shard", "dim").sortWithinPartitions("shard", "dim", "kind")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, place double, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
