"""Language identification by unigrams of pieces, summed over all segmentations of a word."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, worker_cache

#: Bound of the training sample: rows a language, by a hash of doc_id.
SAMPLE_ROWS = 250
#: Languages that a model can have: each has a probability for every piece, in every task.
MOST_LANGS = 256
#: Rounds of expectation-maximisation.
ROUNDS = 3
#: Letters of words that are scored at once, and places of a long word that are looked at together.
CELLS, SEGMENT = 1 << 17, 4096
#: Places after which the forward sums are scaled anew, so that words of any length stay within the range of a double.
RESCALE = 32
#: Words whose scores a worker remembers.
REMEMBERED = 300_000
UNKNOWN = "und"
#: Probability of one letter that no piece covers.
FLOOR = 1e-7
WORD = re.compile(r"[^\W\d_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """The pieces made of lower-cased letters; a leading mark says that the piece begins a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.lstrip("▁").isalpha() and p == p.lower() and "▁" not in p[1:]})


def marked(word: str) -> str:
    """A word as pieces know it: a mark says where it begins."""
    return "▁" + word


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Lattice:
    """The pieces found in words, as arrays: which piece ends at place i with length k, or -1."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self.by_length = {}
        for k in range(1, self.longest + 1):
            own = [(i, p) for i, p in enumerate(pieces) if len(p) == k]
            if own:
                keys = hashed(codes([p for _, p in own], k), k)[:, 0]
                order = np.argsort(keys)
                self.by_length[k] = keys[order], np.array([i for i, _ in own])[order]

    def find(self, grid: np.ndarray) -> dict[int, np.ndarray]:
        """For each length of pieces, the piece that starts at each place of the words in grid."""
        found = {}
        for k, (keys, index) in self.by_length.items():
            if k > grid.shape[1]:
                break
            h = hashed(grid, k)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found[k] = np.where(keys[at] == h, index[at], -1)
        return found

    def segments(self, grid: np.ndarray, backward: bool = False) -> Iterator[tuple[int, int, int, dict[int, np.ndarray]]]:
        """(begin, end, low, pieces from place low on): all places where a piece can end, a segment at a time."""
        begins = range(0, grid.shape[1], SEGMENT)
        for begin in reversed(begins) if backward else begins:
            end, low = min(grid.shape[1], begin + SEGMENT), max(0, begin - self.longest)
            yield begin, end, low, self.find(grid[:, low:end])


def codes(words: list[str], width: int) -> np.ndarray:
    """Code points, one row a word, filled up with zeros."""
    raw = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4").reshape(len(words), width)


def hashed(grid: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k code points."""
    n = grid.shape[1] - k + 1
    h = np.zeros((len(grid), n), np.uint64)
    for i in range(k):
        h = (h ^ grid[:, i : i + n].astype(np.uint64)) * MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


def groups(words: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(places in words, lengths, code points) of words of like length, shorter ones first; CELLS letters or one word."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        n = 1
        while at + n < len(order) and (n + 1) * len(words[order[at + n]]) <= CELLS:
            n += 1
        own = order[at : at + n]
        lengths = np.array([len(words[i]) for i in own])
        yield own, lengths, codes([words[i] for i in own], max(1, int(lengths[-1])))
        at += n


def forward(lengths: np.ndarray, grid: np.ndarray, lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """The log-probability of each word, summed over all of its segmentations, for each column of probs (pieces x
    languages); a letter without a piece has FLOOR. lengths: rising. Sums of the latest places are scaled again and again,
    by word and language, and the logarithms of the scales added up."""
    (n, width), reach, columns = grid.shape, lattice.longest, probs.shape[1]
    out, scale = np.zeros((n, columns)), np.zeros((n, columns))
    alpha = np.zeros((min(width, SEGMENT) + reach + 1, n, columns))
    alpha[reach] = 1  # the segment's first place
    for begin, end, low, found in lattice.segments(grid):
        for i in range(begin + 1, end + 1):
            row = reach + i - begin
            alpha[row] = alpha[row - 1] * FLOOR
            for k, piece in found.items():
                if k <= i:
                    own = piece[:, i - k - low]
                    some = np.flatnonzero(own >= 0)
                    alpha[row, some] += alpha[row - k, some] * probs[own[some]]
            a, b = np.searchsorted(lengths, (i, i + 1))
            out[a:b] = np.log(alpha[row, a:b]) + scale[a:b]
            if i % RESCALE == 0 and i < width:
                recent = alpha[row - reach : row + 1]
                most = recent.max(axis=0)
                recent /= most
                scale += np.log(most)
        alpha[: reach + 1] = alpha[end - begin : end - begin + reach + 1].copy()
    return out


def log_scores(words: list[str], lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """The log-probability of each word under each language, over all segmentations of the whole word."""
    out = np.zeros((len(words), probs.shape[1]))
    for own, lengths, grid in groups([marked(w) for w in words]):
        out[own] = forward(lengths, grid, lattice, probs)
    return out


def fit(counts: dict[str, int], lattice: Lattice, n_pieces: int, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation-maximisation over all segmentations of its counted words, in
    logarithms."""
    words, times = [marked(w) for w in counts], np.array(list(counts.values()), float)
    log_probs, log_floor = np.full(n_pieces, -math.log(max(n_pieces, 1))), math.log(FLOOR)
    for _ in range(rounds):
        expected = np.zeros(n_pieces)
        for members, lengths, grid in groups(words):
            n, width = grid.shape
            alpha = np.full((width + 1, n), -np.inf)
            alpha[0] = 0
            for begin, end, low, found in lattice.segments(grid):
                for i in range(begin + 1, end + 1):
                    alpha[i] = alpha[i - 1] + log_floor
                    for k, piece in found.items():
                        if k <= i:
                            own = piece[:, i - k - low]
                            some = np.flatnonzero(own >= 0)
                            alpha[i, some] = np.logaddexp(alpha[i, some], alpha[i - k, some] + log_probs[own[some]])
            rows = np.arange(n)
            total = alpha[lengths, rows]
            beta = np.full_like(alpha, -np.inf)
            beta[lengths, rows] = 0
            for begin, end, low, found in lattice.segments(grid, backward=True):
                for i in range(end, begin, -1):
                    beta[i - 1] = np.logaddexp(beta[i - 1], beta[i] + log_floor)
                    for k, piece in found.items():
                        if k <= i:
                            own = piece[:, i - k - low]
                            some = np.flatnonzero((own >= 0) & (beta[i] > -np.inf))
                            flow = beta[i, some] + log_probs[own[some]]
                            np.add.at(expected, own[some], times[members][some] * np.exp(alpha[i - k, some] + flow - total[some]))
                            beta[i - k, some] = np.logaddexp(beta[i - k, some], flow)
        log_probs = np.log((expected + 0.01) / (expected + 0.01).sum())
    return np.exp(log_probs)


def train(rows: DataFrame, vocabulary_path: str, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, pieces x languages) from rows (doc_id, text, lang), of which about sample_rows a language are read
    through, chosen by a hash of doc_id, and all of their words counted. Languages are fitted side by side, each by one
    task. Rows with a null text or lang teach nothing, repeated rows teach again; no such rows: no languages; more than
    MOST_LANGS values of lang: an error, as the model has a column for each."""
    rows = rows.where("text is not null and lang is not null").select(F.col("doc_id").cast("string").alias("doc"), "text", F.col("lang").cast("string").alias("lang"))
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(found) > MOST_LANGS:
        raise ValueError(f"lang has more than {MOST_LANGS} values: a model of each would not fit a task")
    sizes = {r["lang"]: r["n"] for r in found}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, 0))
    # Above a share of the hashes' range that holds sample_rows rows on the average, nothing is read.
    share = F.create_map(*[F.lit(x) for l in langs for x in (l, min(1.0, sample_rows / sizes[l]))])
    part = rows.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    words = part.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    n_pieces = len(vocabulary(vocabulary_path))

    def one(rows: pd.DataFrame) -> pd.DataFrame:  # as many words as the sample's rows of a language have
        rows = rows.sort_values("word")
        lattice = worker_cache(f"langid lattice {vocabulary_path}", lambda: Lattice(vocabulary(vocabulary_path)))
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "probs": [fit(dict(zip(rows["word"], rows["n"])), lattice, n_pieces)]})

    # Partitions that adaptive execution doesn't merge, so that languages are fitted side by side.
    fitted = counted.repartition(4 * len(langs), "lang").groupBy("lang").applyInPandas(one, "lang string, probs array<double>")
    known = {r["lang"]: np.array(r["probs"]) for r in fitted.collect()}
    untaught = np.full(n_pieces, 1 / max(n_pieces, 1))  # texts without a word
    return langs, np.stack([known.get(l, untaught) for l in langs], axis=1)


def predict(docs: DataFrame, langs: list[str], probs: np.ndarray, vocabulary_path: str) -> DataFrame:
    """docs with lang_pred and score (columns of these names are replaced), from text alone.

    score: the posterior probability of lang_pred among the languages, from the whole text's words by the forward sums. Null
    texts, texts without a letter, and any text if no language was learnt: `und` with score 0. Ties: the smaller name.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*names, F.col("text").cast("string").alias("_text"))
    place = {c: i for i, c in enumerate(docs.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = worker_cache(f"langid lattice {vocabulary_path}", lambda: Lattice(vocabulary(vocabulary_path)))
        known: dict[str, int] = {}
        table = np.zeros((0, len(langs)))
        for b in batches:
            texts = b.column(place["_text"]).to_pylist()
            words = [words_of(t) if t and langs else [] for t in texts]
            new = [w for w in set().union(*words) if w not in known]
            if len(known) + len(new) > REMEMBERED:
                known, table = {}, table[:0]
                new = list(set().union(*words))
            if new:
                known.update(zip(new, range(len(table), len(table) + len(new))))
                table = np.concatenate([table, log_scores(new, lattice, probs)])
            preds, scores = [], []
            for t, ws in zip(texts, words):
                if not t or not ws or not has_letter(t):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = table[[known[w] for w in ws]].sum(axis=0)
                best = int(total.argmax())
                preds.append(langs[best])
                scores.append(1 / math.fsum(np.exp(total - total[best])))
            yield pa.RecordBatch.from_arrays([*[b.column(place[c]) for c in names], pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    small_batches(docs.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "_text")
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """docs with held_out, lang_pred and score. Learns from rows that aren't held out (crc32 of doc_id as text, mod 3, is
    not 1; a null doc_id isn't held out either) and have a text and a lang. Other columns stay."""
    path = vocabulary_path or default_vocabulary()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    docs = docs.withColumn("held_out", held)
    langs, probs = train(docs.where("not held_out").select("doc_id", "text", "lang"), path)
    return predict(docs, langs, probs, path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
