"""Clusters around centroids by annulus search: only centroids whose norms lie in a vector's annulus are compared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

CLUSTERS, ROUNDS, DIM, SCALE = 40, 5, 64, 256
#: Components are below this: squared distances over DIM components then fit 63 bits.
MOST = 1 << 27
#: Vectors compared at once.
BATCH = 8192


def kept(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors of exactly dim components, none of them null or non-finite, as integers floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dim) & fine)
    whole = F.transform("x", lambda c: F.floor(c * scale))
    small = F.forall("x", lambda c: (c * scale > -MOST) & (c * scale < MOST))
    return rows.select("vec_id", F.when(small, whole).otherwise(F.raise_error(F.lit(f"a component times {scale} is not below {MOST}: distances would not be exact"))).alias("v"))


class Centroids:
    """Centroids sorted by norm, so that the norms within an annulus are found by binary search."""

    def __init__(self, centres: np.ndarray):
        norms = np.sqrt((centres.astype(float) ** 2).sum(axis=1))
        self.order = np.argsort(norms, kind="stable")
        self.norms, self.centres = norms[self.order], centres[self.order]
        self.place = np.argsort(self.order)

    def distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        d = x - self.centres[at]
        return np.einsum("nd,nd->n", d, d)

    def assign(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, its squared distance, how many were compared) of each vector. before: each
        vector's centroid so far, or -1.

        A vector's upper bound is its exact distance to its centroid so far, or to that of the nearest norm if this is less. A
        centroid nearer than that has a norm that differs from the vector's by no more (triangle inequality), so that it
        lies in the annulus; bounds are widened by more than rounding can amount to, so that those on the boundary are in
        it too. All in it are compared by whole numbers, ties go to the smaller number.
        """
        n, k = len(x), len(self.norms)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        by_norm = np.clip(np.searchsorted(self.norms, norm), 1, k - 1) if k > 1 else np.zeros(n, int)
        if k > 1:
            by_norm -= norm - self.norms[by_norm - 1] < self.norms[by_norm] - norm
        upper = self.distance(x, by_norm)
        known = np.flatnonzero(before >= 0)
        upper[known] = np.minimum(upper[known], self.distance(x[known], self.place[before[known]]))
        radius = np.sqrt(upper.astype(float))
        slack = 1e-9 * (radius + norm + 1)
        lo = np.searchsorted(self.norms, norm - radius - slack, "left")
        hi = np.searchsorted(self.norms, norm + radius + slack, "right")
        # One place of the annuli at a time, of all vectors whose annulus goes so far.
        best, cluster = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        for step in range(int((hi - lo).max())):
            rows = np.flatnonzero(lo + step < hi)
            at = lo[rows] + step
            d, c = self.distance(x[rows], at), self.order[at]
            better = (d < best[rows]) | (d == best[rows]) & (c < cluster[rows])
            best[rows[better]], cluster[rows[better]] = d[better], c[better]
        return cluster, best, int((hi - lo).sum())


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def assigned(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(vec_id, v, cluster, distance) of rows (vec_id, v, cluster): the nearest centroid of each. centres: some tens of rows."""
    dim = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Centroids(centres)
        for whole in batches:
            for b in (whole.slice(at, BATCH) for at in range(0, len(whole), BATCH)):
                cluster, distance, _ = index.assign(matrix(b.column(1), dim), b.column(2).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "v", "cluster", "distance"])

    return rows.select("vec_id", "v", "cluster").mapInArrow(run, "vec_id long, v array<long>, cluster int, distance long")


def first_centres(rows: DataFrame, clusters: int, dim: int) -> np.ndarray:
    """The vectors with the smallest hashes of `2:<vec_id>`, in their order; a null vec_id comes last, repeats by their components."""
    hashed = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    top = rows.select("v", hashed.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()
    return np.array([r["v"] for r in top], np.int64).reshape(-1, dim)


def means(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The floors of the exact means of the vectors of each cluster; a cluster without any keeps its centre. Sums are
    combined before the shuffle, so that a hot cluster costs a row a task; the driver sees a row a cluster."""
    out, dim = centres.copy(), centres.shape[1]
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        if r["n"] * MOST >= 1 << 63:
            raise OverflowError("a cluster has so many vectors that their sums may not be exact")
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
    return out


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector (vec_id, embedding) that takes
    part: of exactly dim components, none null or non-finite. Others are left out.

    Lloyd's rounds over whole numbers: the start is the vectors with the smallest hashes, as many as there are if they are
    fewer than clusters; a round assigns each vector to the nearest centroid (ties: the smaller number) and moves centroids to
    the floors of their means; then vectors are assigned once more. Each round's assignments are written, as they bound
    the next round's search; the table before goes. Repeated rows count each; a vector without an id takes part, and starts a
    cluster only if others are too few; an empty table gives no rows; other columns are ignored. A component too large for
    exact distances stops the job with an error.
    """
    now = written(kept(vectors, dim, scale).withColumn("cluster", F.lit(-1)), "vectors")
    centres = first_centres(now, clusters, dim)
    for _ in range(rounds if len(centres) else 0):
        after = written(assigned(now, centres).drop("distance"), "assigned")
        discard(now)
        now, centres = after, means(after, centres)
    if not len(centres):
        return now.select("vec_id", "cluster", *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    last = written(assigned(now, centres).drop("v"), "clusters")
    discard(now)
    spent = {r["cluster"]: int(r["d"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    of = F.create_map(*[F.lit(x) for c, d in spent.items() for x in (c, d)])
    sha = F.create_map(*[F.lit(x) for c in spent for x in (c, names[c])])
    long = lambda c: c.cast("long")
    return last.select("vec_id", "cluster", "distance", long(of[F.col("cluster")]).alias("cluster_inertia"), long(F.lit(sum(spent.values()))).alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every vector of embeddings in one of 40 clusters."""
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    kept_rows = f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""
    square = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [kept_rows, f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM kept QUALIFY cluster < {CLUSTERS})"]
    for r in range(ROUNDS + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT k.vec_id, k.v, min((struct_pack(d := {square}, c := c.cluster))) AS best FROM kept k, c{r} c GROUP BY k.vec_id, k.v)")
        if r < ROUNDS:
            cell = "(s - ((s % n) + n) % n) // n"
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT cluster, list({cell} ORDER BY i) AS v FROM (
  SELECT best.c AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {DIM + 1}) t(i) GROUP BY ALL) GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.c AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c ON c.cluster = best.c"""


#: Vectors' ids are unique in the table.
SQL = _sql()
