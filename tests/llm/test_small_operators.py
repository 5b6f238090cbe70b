"""Operators against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalyne.llm import ann, langid, licenses, lines, packing, pieces, quality, simhash, substring, warc
from catalyne.llm.common import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Nulls, empty and blank texts, repeats, ties, a long text, and letters of all kinds.
ODD = [None, "", " \n\t", "a", "a b c", "A B  c", "x " * 30_000, "Ünïcode ßtraße   日本 \U0001f600 é", "\x0b\x0c", "one two three four five " * 12, "!!! 123 ???", " \x1c\x85"]


def documents(spark, texts, **more):
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def words(t):
    return WORDS.findall(t or "")


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of the small tables, and the odd ones."""
    return [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(150).collect()] + ODD


# Packing.


def check_packed(rows, capacity=2048):
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.packed(documents(spark, corpus, length=7, piece="x", _salt=1)).collect()
    expected = set()
    for i, t in enumerate(corpus):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        expected |= {(i, k // 2048, k, len(p := ids[k : k + 2048]), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(0, len(ids), 2048)}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == expected and len(got) == len(expected)
    used = check_packed(got)
    assert used <= -(-sum(r["length"] for r in got) // 2048) * 1.05 + 1


def test_packing_of_nothing_and_of_ties(spark):
    assert packing.packed(documents(spark, [])).count() == 0
    same = documents(spark, ["a b"] * 100)
    assert check_packed(packing.packed(same.union(same)).collect()) == 1
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length long"), 8)


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= capacity}:
            k = bins.index(room)
            bins[k] += items[i]
            go(i + 1, bins)
            bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 20, 30])
    items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 10))]
    fixed, left = packing.reduced(dict(collections.Counter(items)), capacity)
    assert all(sum(x) <= capacity for _, x in fixed)
    rest = list(collections.Counter(left).elements())
    assert sum(n for n, _ in fixed) + (optimum(rest, capacity) if rest else 0) == optimum(items, capacity)


def test_places_do_not_depend_on_how_rows_are_dealt_out(spark):
    rows = [(i % 40, i % 3, 5 + i % 2, i) for i in range(300)] + [(7, 0, 5, 7)] * 3
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, x long")
    one, two = (sorted(map(tuple, packing.pack(d, 20).collect())) for d in (df.repartition(2), df.orderBy(F.desc("x")).repartition(7)))
    assert one == two


def test_best_fit_is_best_fit():
    for seed in range(40):
        rnd = random.Random(seed)
        counts = {rnd.randint(1, 50): rnd.randint(1, 9) for _ in range(12)}
        bins = []
        for x in sorted(collections.Counter(counts).elements(), reverse=True):
            open_ = [b for b in bins if 50 - sum(b) >= x]
            max(open_, key=sum).append(x) if open_ else bins.append([x])
        got = packing.best_fit(counts, 50)
        assert sum(n for n, _ in got) == len(bins)


def test_encoder_on_parts():
    from tokenizers import Tokenizer

    encoder, library = packing.Encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    texts = ["it's !'s don't'll 'sx", "É× ÷Ö ªµ", "a b\x0bc", "<|endoftext|> x<|startoftext|>", "ΟΔΟΣ İ ﬁ", "12 3a4 \x1c!", "\r\n x\ny "]
    for t, ids in zip(texts, encoder.batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


# Language identification.


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).select("doc_id", "lang", "held_out", "lang_pred", "score").collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got}
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    docs = documents(spark, ["der und die"] * 4 + ["the and of"] * 4 + ODD, lang_pred="x", score=9)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 4, "de").when(F.col("doc_id") < 8, "en"))
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(got) == 8 + len(ODD) and got[0]["lang_pred"] == "de" and got[5]["lang_pred"] == "en"
    for i, t in enumerate(ODD):
        if not any(map(str.isalpha, t or "")):
            assert got[8 + i]["lang_pred"] == "und" and got[8 + i]["score"] == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_forward_sums_all_segmentations():
    vocab = ["a", "ab", "abc", "b", "bc", "c", "▁a", "▁ab"]
    probs = np.random.default_rng(1).random((len(vocab), 2))
    lattice = langid.Lattice(vocab)

    def brute(word, column):
        if not word:
            return 1.0
        total = langid.FLOOR * brute(word[1:], column)
        return total + sum(probs[i, column] * brute(word[len(p) :], column) for i, p in enumerate(vocab) if word.startswith(p))

    for w in ("abc", "cab", "aabbcc", "x", "abxabc"):
        expected = [np.log(brute("▁" + w, k)) for k in (0, 1)]
        assert np.allclose(langid.log_scores([w], lattice, probs)[0], expected)


def plain_log_score(word, column, vocab, probs):
    """All segmentations, place by place, in exact fractions of two."""
    import fractions

    word, sums = "▁" + word, [fractions.Fraction(1)]
    for i in range(1, len(word) + 1):
        total = sums[-1] * fractions.Fraction(langid.FLOOR)
        for p, x in zip(vocab, probs[:, column]):
            if word[:i].endswith(p) and len(p) <= i:
                total += sums[i - len(p)] * fractions.Fraction(float(x))
        sums.append(total)
    return np.log2(float(sums[-1].numerator >> max(0, sums[-1].numerator.bit_length() - 60))) + max(0, sums[-1].numerator.bit_length() - 60) - sums[-1].denominator.bit_length() + 1


def test_long_words_are_scored_whole(monkeypatch):
    vocab = ["a", "ab", "abc", "b", "bc", "c", "▁a", "▁ab"]
    probs = np.random.default_rng(1).random((len(vocab), 2)) / 64
    lattice, rnd = langid.Lattice(vocab), random.Random(4)
    words = ["".join(rnd.choice("abcx") for _ in range(n)) for n in (1, 31, 32, 33, 60, 61, 500)]
    got = langid.log_scores(words, lattice, probs) / np.log(2)
    assert np.allclose(got, [[plain_log_score(w, k, vocab, probs) for k in (0, 1)] for w in words])
    monkeypatch.setattr(langid, "SEGMENT", 17)
    monkeypatch.setattr(langid, "RESCALE", 5)
    assert np.allclose(langid.log_scores(words, lattice, probs) / np.log(2), got)
    assert np.isfinite(langid.log_scores(["x" * 50_000], lattice, probs)).all()


def test_fit_against_all_segmentations(monkeypatch):
    """One round of expectation-maximisation, by counting the pieces of every segmentation."""
    vocab, counts = ["a", "ab", "abc", "b", "bc", "c", "▁a", "▁ab"], {"abc": 3, "cab": 1, "ababc": 2, "x": 1}
    expected = np.zeros(len(vocab))

    def every(word):
        if not word:
            yield 1.0, []
        else:
            yield from ((langid.FLOOR * p, own) for p, own in every(word[1:]))
            for i, piece in enumerate(vocab):
                if word.startswith(piece):
                    yield from ((p / len(vocab), [i, *own]) for p, own in every(word[len(piece) :]))

    for word, n in counts.items():
        found = list(every("▁" + word))
        total = sum(p for p, _ in found)
        for p, own in found:
            for i in own:
                expected[i] += n * p / total
    expected = (expected + 0.01) / (expected + 0.01).sum()
    assert np.allclose(langid.fit(counts, langid.Lattice(vocab), len(vocab), 1), expected)
    monkeypatch.setattr(langid, "SEGMENT", 2)
    assert np.allclose(langid.fit(counts, langid.Lattice(vocab), len(vocab), 1), expected)


def test_predictions_are_the_most_probable_languages(spark):
    """The query's model: a plain forward pass in logarithms over every word of every held-out text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = langid.default_vocabulary()
    langs, probs = langid.train(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"), path)
    place = {p: i for i, p in enumerate(langid.vocabulary(path))}
    longest, scores = max(map(len, place)), {}

    def score(word):
        word, sums = "▁" + word, [np.zeros(len(langs))]
        for i in range(1, len(word) + 1):
            terms = [sums[-1] + np.log(langid.FLOOR)]
            terms += [sums[i - k] + np.log(probs[place[word[i - k : i]]]) for k in range(1, min(i, longest) + 1) if word[i - k : i] in place]
            sums.append(np.logaddexp.reduce(terms))
        return sums[-1]

    got = {r["doc_id"]: r for r in langid.query(spark, SF).where("held_out").collect()}
    for r in docs.where("doc_id < 60").collect():
        own = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        if r["doc_id"] not in got:
            continue
        if not own:
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        total = sum(scores.setdefault(w, score(w)) if w not in scores else scores[w] for w in own)
        best = int(total.argmax())
        assert got[r["doc_id"]]["lang_pred"] == langs[best]
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / np.exp(total - total[best]).sum())


# Pieces.


def test_pieces_against_a_plain_viterbi(corpus):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    own = pieces.Pieces(pieces.default_model())
    score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    longest = max(map(len, score))
    for t in [x[:400] for x in corpus if x] + ["a  b   c ", "☃☃ naïve", "\U0001f600"]:
        marked = "▁" + t.replace(" ", "▁")
        best = [0.0] + [float("-inf")] * len(marked)
        for i in range(len(marked)):
            for j in range(i + 1, min(len(marked), i + longest) + 1):
                s = score.get(marked[i:j], own.unknown if j == i + 1 else None)
                if s is not None:
                    best[j] = max(best[j], best[i] + s)
        total, ids = 0.0, np.frombuffer(own.encode(t), "<u4").tolist()
        run = b""
        for i in ids:
            if i in own.bytes_of:
                run += bytes([own.bytes_of[i]])
                try:
                    run.decode()
                except UnicodeDecodeError:
                    continue
                total, run = total + own.unknown, b""
            else:
                total += score[own.names[i]]
        assert total == best[-1] and own.decode(own.encode(t)) == t.replace("▁", " ")


def test_pieces_round_trip(spark, corpus):
    docs = documents(spark, corpus, ids=1)
    got = {r["doc_id"]: r for r in pieces.decoded(pieces.encoded(docs)).collect()}
    assert [got[i]["text"] for i in range(len(corpus))] == corpus
    assert got[corpus.index("")]["ids"] == b"" and pieces.encoded(docs.limit(0)).count() == 0


# Lines.


def brute_lines(rows, least):
    sites, first = collections.defaultdict(set), {}
    for doc, text, site in rows:
        for x in (text or "").split("\n"):
            if k := x.strip(lines.BLANKS):
                sites[k] |= {site} - {None}
                first[k] = min(first.get(k, doc), doc)
    out = {}
    for doc, text, _ in rows:
        parts = (text or "").split("\n")
        gone = [bool(k := x.strip(lines.BLANKS)) and len(sites[k]) >= least and doc > first[k] for x in parts]
        out[doc] = (None if text is None else "\n".join(x for x, g in zip(parts, gone) if not g), sum(map(bool, (x.strip(lines.BLANKS) for x in parts))), sum(gone))
    return out


def test_lines_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, "\n".join(rnd.choice(["home", " home\t", "x", "", "about us", f"own {i}", "é"]) for _ in range(rnd.randint(0, 9))), rnd.choice(["a", "b", "c", "d", None])) for i in range(200)]
    rows += [(200 + i, t, "z") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"n_lines": F.lit("x"), "h1": F.lit(1), "first": F.lit(2)})
    for least in (2, 4, 5):
        got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(docs, min_sites=least).collect()}
        assert got == brute_lines(rows, least)
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    unnamed = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert lines.dedup_lines(unnamed, min_sites=2).agg(F.sum("n_removed")).first()[0] == 0


def test_lines_in_sql(spark, duck):
    from conftest import same

    same(lines.query(spark, SF), duck, lines.SQL)


# SimHash.


def brute_simhash(text):
    import xxhash

    w = words(ascii_lower(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def roots(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {k: find(k) for k in keys}


def test_simhash_against_brute_force(spark, corpus):
    texts = [*corpus[:-12], *(t + " extra" for t in corpus[:20]), *ODD]
    docs = documents(spark, texts, fp=1, component_id="x", node=2)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs.union(docs.limit(3))).collect()}
    prints = {i: brute_simhash(t) for i, t in enumerate(texts)}
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == prints
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {i: r["component_id"] for i, r in got.items()} == roots(prints, near)
    kept = simhash.keep_one(documents(spark, texts)).collect()
    assert {r["doc_id"] for r in kept} == set(roots(prints, near).values()) and len(kept) == len({r["doc_id"] for r in kept})


def test_simhash_of_nothing_and_without_ids(spark):
    docs = documents(spark, ["a b c d", "a b c d"])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert {r["component_id"] for r in simhash.near_duplicates(docs.withColumn("doc_id", F.lit(None).cast("long"))).collect()} == {None}
    assert simhash.keep_one(docs.withColumn("doc_id", F.lit(None).cast("long"))).count() == 2


@pytest.mark.parametrize("radius,chunk", [(4, 512), (4, 7), (0, 512), (7, 64)])
def test_links_of_dense_and_sparse_fingerprints(spark, radius, chunk):
    rnd = random.Random(radius)
    centre = rnd.getrandbits(64)
    prints = {rnd.getrandbits(64) for _ in range(150)} | {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(250)}
    rows = list(enumerate(sorted(prints)))
    classes = spark.createDataFrame([(i, p - 2**64 if p >= 2**63 else p) for i, p in rows], "node long, fp long")
    got = [(r["u"], r["v"]) for r in simhash.links(classes, radius, chunk).collect()]
    near = [(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if (x ^ y).bit_count() <= radius]
    assert roots(dict(rows), got) == roots(dict(rows), near)
    assert set(map(frozenset, got)) <= set(map(frozenset, roots_pairs(dict(rows), near)))


def roots_pairs(keys, near):
    """All pairs within a component: an edge of a forest need not be a link itself."""
    by = collections.defaultdict(list)
    for k, r in roots(keys, near).items():
        by[r].append(k)
    return [p for g in by.values() for p in itertools.combinations(g, 2)]


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100)] + [(200, 200 + i) for i in range(1, 50)] + [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = roots({x for e in edges for x in e}, edges)
    assert got == {k: r for k, r in expected.items() if k != r}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Nearest neighbours.


def brute_nearest(rows, queries, k):
    out = {}
    for q, x in queries:
        scored = sorted((-round(float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y))), 12), v) for v, y in rows if v != q and len(y) == len(x))
        out[q] = [v for _, v in scored[:k]]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(900)] + [(1000 + i, [1.0] * 16) for i in range(60)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None, *[1.0] * 15]), (2004, [float("inf")] * 16), (2005, []), (None, [1.0] * 16), (2006, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd + rows[:2], "vec_id long, embedding array<float>").withColumns({"shard": F.lit(1), "node": F.lit("x")})
    got = collections.defaultdict(list)
    asked = df.where("vec_id % 20 = 0 or vec_id >= 2000")
    for r in ann.nearest(df, asked, shard=200).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    exact = [(i, np.array(x, np.float32).astype(float)) for i, x in rows]
    expected = brute_nearest(exact, [(i, x) for i, x in exact if i % 20 == 0], 5)
    assert set(got) == set(expected)
    assert sum(len(set(got[q]) & set(v)) for q, v in expected.items()) >= 0.95 * sum(map(len, expected.values()))
    assert got[1000] == [1001, 1002, 1003, 1004, 1005] and got[1020] == [1000, 1001, 1002, 1003, 1004]


def test_few_neighbours(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id = 50")).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    all_rows = [(r["vec_id"], np.array(r["embedding"])) for r in rows.collect()]
    expected = brute_nearest(all_rows, [r for r in all_rows if r[0] % 50 == 0], 5)
    got = collections.defaultdict(list)
    for r in ann.query(spark, "/root/testdata/sf0.01").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert sum(len(set(got[q]) & set(v)) for q, v in expected.items()) >= 0.9 * sum(map(len, expected.values()))


# WARC.


def test_derivatives(spark):
    page = '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><meta name="d" content="x&quot;y"><script>no</script></head><body><!-- no --><p>One<br>two &lt;3</p><a href="/l?a=1&amp;b=2">link</a><style>no</style></body></html>'
    pages = spark.createDataFrame([(1, "http://x/\r\ny", page), (1, "http://x/\r\ny", page), (2, None, None), (None, "u", ""), (4, "u", "<p>" * 20_000)], "page_id long, url string, html string")
    made = warc.responses(pages.withColumns({"record": F.lit("x"), "kind": F.lit(1)}))
    rows = warc.derive(made).collect()
    assert len(rows) == 10
    source = {r["page_id"]: warc.parse(r["record"]) for r in made.collect()}
    for r in rows:
        headers, block, rest = warc.parse(r["record"])
        own, original, _ = source[r["page_id"]]
        assert rest == b"" and headers["warc-block-digest"] == warc.digest(block) == r["block_digest"]
        assert headers["warc-refers-to"] == own["warc-record-id"] and headers["warc-target-uri"] == own["warc-target-uri"] and headers["warc-date"] == own["warc-date"]
        assert headers["warc-source-payload-digest"] == own["warc-payload-digest"] == warc.digest(original.partition(b"\r\n\r\n")[2])
    import json

    block = {r["kind"]: warc.parse(r["record"])[1] for r in rows if r["page_id"] == 1}
    html = json.loads(block["metadata"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]
    assert html == {"Title": "A & B", "Lang": "fr", "Metas": [{"name": "d", "content": 'x"y'}], "Links": ["/l?a=1&b=2"]}
    assert block["conversion"].decode() == "One\ntwo <3\nlink"
    assert warc.derive(made.limit(0)).count() == 0


def test_damaged_records(spark, tmp_path):
    import gzip

    good, other = warc.response(1, "u", "<p>x"), warc.record([("WARC-Type", "request")], b"x")
    assert warc.derivatives(b"") == warc.derivatives(good[:-9]) == warc.derivatives(other) == warc.derivatives(b"WARC/1.1\r\n\r\n") == []
    (tmp_path / "a.warc").write_bytes(good + other + b"damage")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(good) + gzip.compress(good))
    assert warc.read_warc(spark, f"file://{tmp_path}/*").count() == 4
    assert warc.derive(warc.read_warc(spark, f"file://{tmp_path}/*")).count() == 6


# Substrings.


def brute_substring(rows, window):
    first = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), doc)
    out = {}
    for doc, text in rows:
        w, gone = words(text), set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < doc:
                gone.update(range(p, p + window))
        out[doc] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [7, 8, 24, 27, 50])
def test_substrings_against_brute_force(spark, corpus, window):
    rnd = random.Random(window)
    passage = " ".join(f"w{i}" for i in range(window + 15))
    made = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    made += [f"{rnd.random()} {passage} {rnd.random()}" for _ in range(20)] + [passage, passage, passage + " " + passage, passage[: len(passage) // 2]]
    texts = [*corpus[:60], *made, *ODD]
    docs = documents(spark, texts, n_words="x", tkey=1, spans=2, kept=3, a=4, m="y")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256((r["kept"] or "").encode()).hexdigest()) for r in substring.dedup_substrings(docs, window).collect()}
    assert got == brute_substring(list(enumerate(texts)), window)


def test_substring_edges(spark):
    docs = documents(spark, ["x y z " * 30, "x y z " * 30])
    assert substring.dedup_substrings(docs.limit(0)).count() == 0
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert [r["n_removed"] for r in substring.dedup_substrings(nameless).collect()] == [0, 0]
    shared = docs.withColumn("doc_id", F.lit(5).cast("long"))
    assert [r["n_removed"] for r in substring.dedup_substrings(shared).collect()] == [0, 0]
    twice = docs.union(docs)
    assert sorted(r["n_removed"] for r in substring.dedup_substrings(twice).collect()) == [0, 0, 90, 90]


# Licences.


def brute_licenses(text, rules):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
    places, base = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    norm = " " + " ".join(w) + " " if w else " "
    seen = {(m.start(), m.end(), r.rank, r.label) for r in rules for m in re.finditer(r.regex, norm)}
    ordered = sorted(seen, key=lambda d: (d[0], -d[1], -d[2], d[3]))
    stand = [d for i, d in enumerate(ordered) if not any(j != i and e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:3] != d[:3] or j < i) for j, e in enumerate(ordered))]
    score = 1.0 if places else max((d[2] for d in stand), default=0) / licenses.RANKS
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | {d[3] for d in stand})), score)


LICENSE_TEXTS = [
    "Under the MIT License. Apache License, Version 2.0 cc-by-nc CC BY NC cc by nc", "é#é under the mit license under the mit license", "ccbync cc by-NC-ND xcc by nc", "under the mit licenses",
    "SPDX-License-Identifier: GPL-2.0 only; licensed under the GNU General Public License version 2.0. All Rights Reserved", "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "distributed under the terms of the BSD 3-Clause license; Apache License 2.0 license; neither the name of x y nor the names of its contributors may be used", "mit mit mit lizenz", "Kind license",
]


def test_licenses_against_brute_force(spark, corpus):
    rules = licenses.signature_rules()
    assert len(rules) >= 200 and len({r.rank for r in rules}) == licenses.RANKS
    texts = [*corpus, *LICENSE_TEXTS]
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(documents(spark, texts, labels="x", norm=1, found=2)).collect()}
    assert got == {i: brute_licenses(t, rules) for i, t in enumerate(texts)}
    assert licenses.scan(documents(spark, [])).count() == 0


def samples(expression, rnd):
    """A text that an expression matches, of its many."""
    parsed = re._parser.parse(expression)

    def made(items):
        out = ""
        for op, x in items:
            op = str(op)
            if op == "LITERAL":
                out += chr(x)
            elif op == "IN":
                kind, value = x[0]
                out += chr(value if str(kind) == "LITERAL" else value[0])
            elif op == "BRANCH":
                out += made(rnd.choice(x[1]))
            elif op == "SUBPATTERN":
                out += made(x[3])
            elif op in ("MAX_REPEAT", "MIN_REPEAT"):
                out += "".join(made(x[2]) for _ in range(rnd.randint(x[0], min(int(x[1]), x[0] + 1))))
            elif op == "ANY":
                out += "x"
            else:
                assert op == "ASSERT", op
        return out

    return made(parsed)


def test_prefilter_and_keywords_cover_every_rule():
    rnd, words_of_all = random.Random(9), set(licenses.prefilter())
    for r in licenses.signature_rules():
        for _ in range(150):
            core = samples(r.regex, rnd)
            assert re.search(r.regex, f" {core} ") and any(k in core for k in r.keywords) and set(core.split()) & set(r.words) and set(r.words) <= words_of_all, (r, core)
    for phrase, _ in licenses.BASE:
        assert set(phrase.split()) & words_of_all


def test_every_rule_is_found_in_its_own_texts(spark):
    """Texts made of each rule's expression, in capitals and with punctuation, have its label or that of a rule that holds it."""
    rnd, rules = random.Random(8), licenses.signature_rules()
    assert len(rules) >= 300 and len({r.regex for r in rules}) == len(rules)
    texts, owners = [], []
    for r in rules:
        for _ in range(3):
            core = samples(r.regex, rnd)
            texts.append(f"Xxx. {core.upper().replace(' ', rnd.choice([' ', '-', chr(10)]))}, yyy")
            owners.append(r)
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, texts)).collect()}
    for i, (t, r) in enumerate(zip(texts, owners)):
        assert tuple(got[i])[1:] == brute_licenses(t, rules), t
        assert got[i]["labels"] and got[i]["score"] >= r.rank / licenses.RANKS, t


NOTICES = {
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.": "apache-2",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl,gpl-3.0",
    "// SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file": "mpl-2.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa",
    "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa", "released into the public domain": "public-domain", "Distributed under the Boost Software License, Version 1.0.": "boost-1.0",
    "THE SOFTWARE IS PROVIDED \"AS IS\"": "", "Unauthorized copying of this file, via any medium, is strictly prohibited": "proprietary", "a kind word about the weather": "",
}


def test_notices(spark):
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(documents(spark, list(NOTICES))).collect()}
    assert list(NOTICES.values()) == [got[i] for i in range(len(NOTICES))]


def test_many_places_take_time_in_proportion(spark):
    import time

    times = []
    for n in (2_000, 16_000):
        docs = documents(spark, ["apache license 2.0, gpl-3.0; mit license cc-by-nc-4.0. " * n])
        began = time.perf_counter()
        (row,) = licenses.scan(docs).collect()
        times.append(time.perf_counter() - began)
        assert row["labels"] == "apache-2,cc-by-nc,gpl-3.0,mit" and row["n_base"] == n
    assert times[1] < 24 * times[0] + 2


# Quality.


def brute_quality(t):
    w = words(t)
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    listed = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(listed) - len(set(listed)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_against_brute_force(spark, corpus):
    texts = [*corpus, "x\r\nx\r\n\n\nx", "a b c a b c a b c x", "a a a a"]
    got = quality.judged(documents(spark, texts, n_words="x", quality=1, votes=2, lines=3)).collect()
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got} == {i: brute_quality(t) for i, t in enumerate(texts)}
    assert all(0 <= r["quality"] <= 1 and r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5) for r in got)
    assert quality.judged(documents(spark, [])).count() == 0


def plain_weak_supervision(votes):
    """Posteriors by an expectation-maximisation of its own, text by text, in arrays: two kinds of texts, three outcomes."""
    x = np.array(votes)
    seen = np.stack([x == -1, x == 1, x == 0], axis=2).astype(float)
    believed = np.array([[0.02, 0.78, 0.2], [0.3, 0.5, 0.2]])
    rates, share = np.repeat(believed[:, None], x.shape[1], axis=1), 0.85
    for _ in range(2000):
        joint = np.stack([np.exp(np.einsum("trv,rv->t", seen, np.log(rates[k]))) * w for k, w in ((0, share), (1, 1 - share))])
        p = joint / joint.sum(axis=0)
        tallies = np.einsum("kt,trv->krv", p, seen) + 100 * believed[:, None]
        rates, share = tallies / tallies.sum(axis=2, keepdims=True), (p[0].sum() + 85) / (len(x) + 100)
    return p[0]


def test_posteriors_against_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = quality.rules()
    votes = quality.features(docs).select("doc_id", *[v.alias(f"v{j}") for j, (_, v) in enumerate(named)]).collect()
    expected = dict(zip((r["doc_id"] for r in votes), plain_weak_supervision([list(r)[1:] for r in votes])))
    got = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert {i: r["quality"] for i, r in got.items()} == pytest.approx(expected, abs=1e-6)
    assert all(r["kept"] == (not brute_quality(t)[5] and expected[i] >= 0.5) for (i, r), t in ((x, texts[x[0]]) for texts in [{d["doc_id"]: d["text"] for d in docs.collect()}] for x in got.items()))


def plain_features(t):
    """The features that the contract doesn't name, word by word and letter by letter."""
    import unicodedata

    w = words(t)
    t = t or ""
    listed = [x for x in t.split("\n") if words(x)]
    kinds = [unicodedata.category(c) for c in t]
    letters, upper, digits = sum(k[0] == "L" for k in kinds), sum(k == "Lu" for k in kinds), sum(c in "0123456789" for c in t)
    ended = sum(x.rstrip(" \t\r\x0b\x0c")[-1] in ".!?:" for x in listed)
    marked = sum(any(c in "#*$%&|<>" for c in x) for x in w)
    wordless = sum(not any(unicodedata.category(c)[0] in "LN" for c in x) for x in w)
    return (len(listed), upper, digits, letters, len(set(w)), ended, sum("!!" in x or "??" in x for x in w), marked, wordless)


def test_features_against_brute_force(spark, corpus):
    texts = [*corpus, "a!! b? c?? ??", "! !a a! # a#b ## \x0b#", "| a | b", "x: \ny.\t\nz", "1 2 a1 \u0663 \u2167"]
    got = quality.features(documents(spark, texts)).collect()
    names = ["n_lines", "n_upper", "n_digits", "n_letters", "n_distinct", "n_ended", "n_shouts", "n_marked", "n_wordless"]
    assert {r["doc_id"]: tuple(r[x] for x in names) for r in got} == {i: plain_features(t) for i, t in enumerate(texts)}


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in quality.judged(docs).where("not base_failed").collect() if r["doc_id"] in labels]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_estimate_recovers_accuracies():
    rnd = random.Random(1)
    truth = [((0.02, 0.8, 0.18), (0.7, 0.2, 0.1)), ((0.01, 0.9, 0.09), (0.5, 0.1, 0.4)), ((0.03, 0.77, 0.2), (0.9, 0.05, 0.05)), ((0.3, 0.4, 0.3), (0.6, 0.1, 0.3))]
    patterns = collections.Counter()
    for _ in range(20_000):
        kind = rnd.random() >= 0.8
        patterns[tuple(rnd.choices((quality.BAD, quality.GOOD, 0), t[kind])[0] for t in truth)] += 1
    prior, rates = quality.estimate([(list(p), n) for p, n in patterns.items()], 4)
    assert abs(prior - 0.8) < 0.03 and np.allclose(rates, truth, atol=0.05)
    assert quality.estimate([], 2)[0] == pytest.approx(0.85) and np.allclose(quality.estimate([], 2)[1], [(quality.PRIOR_GOOD, quality.PRIOR_BAD)] * 2)
