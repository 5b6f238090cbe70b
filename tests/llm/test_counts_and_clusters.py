"""Token counts, source divergence and centroid clusters, against the library, SQL and brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF, same
from pyspark.sql import functions as F
from test_small_operators import ODD, documents

from catalyne.llm import clusters, divergence, queries, tokens


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_centroid_clusters"])
def test_against_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF), duck, queries.ORACLE_SQL[name])


# Token counts.

MARKED = ["<|endoftext|>", "a<|endoftext|> <|endoftext|><|endof", "it's we'LL 'S  \n\n x\t\ty 12½² ", "\U0001f600 emoji ’quoted’ …", "՘֋ẞ ſ", "x" * 70_000, "word\n" * 50_000, " " * 3000 + "a"]


@pytest.fixture(scope="module")
def library():
    return tokens.library(tokens.default_tokenizer())


def test_counts_of_the_library(spark, library):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD + MARKED
    docs = documents(spark, texts, n_tokens="x", n_bytes=1, _counts=2)
    docs = docs.union(docs.where("doc_id < 3"))
    rows = tokens.counted(docs).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        t = texts[r["doc_id"]] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 512)
    assert tokens.counted(documents(spark, [])).count() == 0
    none = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in tokens.counted(none, limit=1).collect()] == [(None, 3, 2, True)]


def test_proof_of_whole_tokens(library):
    whole = tokens.whole_tokens(tokens.default_tokenizer())
    vocabulary = library.get_vocab(with_added_tokens=False)
    assert len(whole) > 0.95 * len(vocabulary)
    letters = {b: c for c, b in tokens.byte_letters().items()}
    for t in random.Random(1).sample(whole, 500):
        assert "".join(letters[b] for b in t.encode()) in vocabulary and len(library.encode(t, add_special_tokens=False).ids) == 1


@pytest.mark.parametrize("together", [5, 1 << 20])
def test_random_texts_part_by_part(library, monkeypatch, together):
    path = tokens.default_tokenizer()
    monkeypatch.setattr(tokens, "TOGETHER", together)
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    unsure = tokens.disputed(path)
    counter, rnd = tokens.Counter(path, tokens.whole_tokens(path), unsure), random.Random(together)
    signs = [*"ab 's'll  \n\t1.?é日  \x1c\x85　ſ²", "<|endoftext|>", "<|endof", " the", "\U0001f600", *unsure[:10]]
    for _ in range(5000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), ascii(text)
    assert len(counter) <= counter.room + 1


# Source divergence.

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute_divergence(rows):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = collections.Counter(t for _, _, terms in own for t in set(terms))
        kept = [t for t, n in df.items() if n >= 3]
        counts = {s: collections.Counter(t for _, x, terms in own if x == s for t in terms if df[t] >= 3) for _, s, _ in own}
        both = sum(counts.values(), collections.Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        q = {t: 1 + 10**9 * (both[t] + 1) // (sum(both.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(items[:top], 1)]
    return sorted(out)


def test_divergence_against_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    names = ["a", "B", "é", "Ünï", "日本", "x1y", "", "\U0001f600"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows = [(" ".join(rnd.choice(names) for _ in range(rnd.choice([0, 3, 200]))), rnd.choice(["en", "fr", None, ""]), rnd.choice(["s", "t", "S", None, "日"])) for _ in range(250)]
    rows += [(None, "xx", "only"), ("!!", "xx", "other"), (None, None, None), ("a a a", "yy", "alone")] + rows[:20] + [("A b " * 3000, "en", "t")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"n": F.lit(1), "p": F.lit("x"), "doc_id": F.lit(0), "groups": F.lit(2)}).repartition(5)
    assert sorted(map(tuple, divergence.divergence(docs).collect())) == brute_divergence(rows)
    # Long texts in parts, small holds.
    monkeypatch.setattr(divergence, "TOGETHER", 64)
    monkeypatch.setattr(divergence, "HELD", 10)
    monkeypatch.setattr(divergence, "ROWS", 7)
    assert sorted(map(tuple, divergence.divergence(docs).collect())) == brute_divergence(rows)
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_probabilities_of_large_counts(spark):
    """Counts beyond what a long times 1,000,000,000 can hold."""
    rows = [(0, 1, 0), (10**9, 10**9, 3), (9 * 10**9 - 1, 10**12, 10**6), (10**12, 10**13 + 7, 12_345), (2**50, 2**52, 10**9)]
    got = spark.createDataFrame(rows, "n long, total long, v long").select("n", "total", "v", divergence.probability(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 1) // (r["total"] + r["v"]) for r in got)


# Centroid clusters.


def brute_clusters(rows, k=40, rounds=5):
    rows = [(i, np.array([int(np.floor(256.0 * x)) for x in v], object)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((r for r in rows if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), list(r[1]))) + [r for r in rows if r[0] is None]
    centres = [v for _, v in start[:k]]

    def assign():
        return [min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(centres)) for _, v in rows]

    for _ in range(rounds):
        at = assign()
        for j in range(len(centres)):
            own = [v for (_, v), (_, a) in zip(rows, at) if a == j]
            if own:
                centres[j] = np.array([int(x) // len(own) for x in sum(own)], object)
    at = assign()
    total = collections.Counter()
    for d, j in at:
        total[j] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, total[j], sum(total.values()), names[j]) for (i, _), (d, j) in zip(rows, at)), key=repr)


def vectors(rng, n, spread=1.0):
    return [(i, [float(x) for x in rng.normal(0, 1, 64).astype(np.float32) * spread]) for i in range(n)]


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(7)
    base = vectors(rng, 150)
    scaled = [(1000 + i, [x * (i + 1) / 5 for x in base[i % 5][1]]) for i in range(60)]
    odd = [(2000, None), (2001, [1.0] * 63), (2002, [None] + [1.0] * 63), (2003, [float("nan")] * 64), (2004, [float("inf")] * 64), (2005, [0.0] * 64), (None, [0.5] * 64)]
    rows = base + scaled + odd + base[:9] + [(3000 + i, base[3][1]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("x"), "v": F.lit(1), "distance": F.lit(2)}).repartition(4)
    assert sorted(map(tuple, clusters.clustered(table).collect()), key=repr) == brute_clusters(rows)
    few = [r for r in rows if r[0] in (1, 2)]
    assert sorted(map(tuple, clusters.clustered(table.where("vec_id in (1, 2)")).collect()), key=repr) == brute_clusters(few)
    none = clusters.clustered(table.limit(0))
    assert none.count() == 0 and none.columns == clusters.clustered(table.limit(5)).columns
    with pytest.raises(Exception):
        clusters.clustered(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))


@pytest.mark.parametrize("seed", range(20))
def test_annulus_holds_the_nearest(seed):
    """Ties, equal centroids, one centroid, vectors on them: as comparing all."""
    rng = np.random.default_rng(seed)
    k, dim = int(rng.choice([1, 2, 5, 40])), 4
    centres = rng.integers(-3, 4, (k, dim)) * int(rng.choice([1, 1000, 1 << 25]))
    x = np.concatenate([rng.integers(-3, 4, (300, dim)) * int(rng.choice([1, 1000, 1 << 25])), centres])
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    index = clusters.Centroids(centres)
    for before in (np.full(len(x), -1), rng.integers(0, k, len(x))):
        cluster, distance, _ = index.assign(x, before)
        assert (distance == d.min(axis=1)).all() and (cluster == d.argmin(axis=1)).all()


def test_annulus_compares_few():
    """Vectors of many norms: the bound of the last round leaves some of the centroids."""
    rng = np.random.default_rng(1)
    centres = np.rint(rng.normal(0, 100, (40, 64)) * np.linspace(0.1, 10, 40)[:, None]).astype(np.int64)
    x = np.rint(centres[rng.integers(0, 40, 2000)] + rng.normal(0, 5, (2000, 64))).astype(np.int64)
    index = clusters.Centroids(centres)
    cluster, _, _ = index.assign(x, np.full(2000, -1))
    _, _, compared = index.assign(x, cluster)
    print(f"compared: {compared} of {2000 * 40}")
    assert compared < 0.3 * 2000 * 40
