"""Near-dedup by shingles, against brute force."""

import itertools
import random

import corpus_pipeline
import pytest
from conftest import SF
from test_small_operators import ODD, documents, roots


def brute_near(texts):
    """The group of each text: exact similarity of all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    near = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    return roots(sets, near)


def edited(rnd, words, n):
    out = list(words)
    for at in rnd.sample(range(len(out)), n):
        out[at] = f"new{rnd.getrandbits(30)}"
    return " ".join(out)


def test_near_copies_beyond_four_bits(spark):
    rnd = random.Random(5)
    texts = list(ODD)
    for _ in range(12):
        base = [f"w{rnd.getrandbits(14)}" for _ in range(300)]
        texts += [" ".join(base), *(edited(rnd, base, n) for n in (1, 3, 5, 6, 9, 30))]
    group = brute_near(dict(enumerate(texts)))
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert {r["doc_id"] for r in stage(spark, documents(spark, texts), SF).collect()} == set(group.values())


def test_fingerprints_link_near_copies(spark, monkeypatch):
    """Without any bucket in common, those whose fingerprints differ in four bits or fewer are found by their blocks."""
    from catalyne.llm import near

    rnd, texts = random.Random(6), ["", None]
    for _ in range(30):
        base = [f"w{rnd.getrandbits(14)}" for _ in range(300)]
        texts += [" ".join(base), edited(rnd, base, 1), edited(rnd, base, 40)]
    prints = [near.fingerprint(near.shingles((t or "").encode())) for t in texts]
    sets = [near.shingles((t or "").encode()) for t in texts]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= near.LINKED and near.near(sets[a], sets[b])]
    assert len(pairs) > 15
    monkeypatch.setattr(near, "bands", lambda hashes: [int(hashes.sum()) >> 1])
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(documents(spark, texts)).collect()}
    assert found == roots(range(len(texts)), pairs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_duplicates_of_the_table(spark, sf):
    from catalyne.llm import near

    docs = spark.read.parquet(f"{SF}/../{sf}/documents.parquet")
    expected = brute_near({r["doc_id"]: r["text"] for r in docs.collect()})
    assert {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs).collect()} == expected


def template(rnd, n, shared, own):
    """Texts that share a run of words and have one of their own."""
    run = [f"t{i}" for i in range(shared)]
    return [" ".join(run + [f"o{rnd.getrandbits(40)}" for _ in range(own)]) for _ in range(n)]


@pytest.mark.parametrize("n", [400, 4000])
def test_texts_of_one_template_do_not_meet(spark, monkeypatch, n):
    """Some 0.7 alike, each with each: no pair may be verified. Ten near copies among them are found."""
    from catalyne.llm import near

    rnd, pairs = random.Random(n), []
    texts = template(rnd, n, 170, 35)
    texts += [edited(rnd, texts[i].split(), 1) for i in range(10)]
    real = near.verified
    monkeypatch.setattr(near, "verified", lambda p, t: pairs.append(p.count()) or real(p, t))
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(documents(spark, texts)).collect()}
    assert found == {i: i if i < n else i - n for i in range(n + 10)}
    print(f"{n} texts of a template: {pairs} pairs verified")
    assert sum(pairs) <= 31 * n


def test_recall_near_the_threshold(spark):
    """Pairs between 0.80 and 0.85: how many are found. Each pair has words of its own."""
    from catalyne.llm import near

    rnd, texts, expected = random.Random(11), [], 0
    sets = lambda t: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)}
    while expected < 2000:
        base = [f"w{rnd.getrandbits(40)}" for _ in range(120)]
        a, b = " ".join(base), edited(rnd, base, rnd.choice([2, 3]))
        x, y = sets(a), sets(b)
        if 0.8 <= len(x & y) / len(x | y) <= 0.85:
            texts += [a, b]
            expected += 1
    found = sum(r["component_id"] != r["doc_id"] for r in near.near_duplicates(documents(spark, texts)).collect())
    print(f"recall between 0.80 and 0.85: {found} of {expected}")
    assert found >= 0.999 * expected
