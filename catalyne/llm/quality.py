"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them. Native."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Rounds of expectation-maximisation at most, and the change of every rate below which it ends.
ROUNDS, CHANGE = 500, 1e-9
#: What a rule is believed to do before any text is seen: the shares of its votes against, for and abstentions, on good and
#: on bad texts, worth so many texts of each kind. This says which of the two kinds is called good, and smooths the rates; on
#: a corpus of any size beyond that, the texts decide.
PRIOR_GOOD, PRIOR_BAD, PRIOR_TEXTS = (0.02, 0.78, 0.2), (0.3, 0.5, 0.2), 100
#: The share of good texts believed in before, worth as many texts.
PRIOR_SHARE = 0.85
KEEP = 0.5

GOOD, BAD = 1, -1
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_letters", "n_distinct", "n_ended", "n_shouts", "n_marked", "n_wordless"]


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


def vote(good: Column, bad: Column) -> Column:
    """1, -1, or 0 where the rule abstains; a null abstains."""
    return F.when(F.coalesce(bad, F.lit(False)), BAD).when(F.coalesce(good, F.lit(False)), GOOD).otherwise(0)


def rules() -> list[tuple[str, Column]]:
    """(name, vote). A rule is one judgement on the features; thresholds leave a zone in which it abstains."""
    n = F.col("n_words")

    def share(x: str, of: str, good: float, bad: float) -> Column:
        return vote(ratio(x, of) < good, ratio(x, of) > bad)

    return [
        ("length", vote(n >= 60, n < 30)),
        ("word_length", vote(ratio("word_chars", "n_words").between(3, 10), ~ratio("word_chars", "n_words").between(2, 14))),
        ("symbols", share("n_symbols", "word_chars", 0.02, 0.08)),
        ("repeated_lines", vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), ratio("n_dup_lines", "n_lines") > 0.3)),
        ("repeated_words", vote((n >= 30) & (ratio("n_repeat_words", "n_words") < 0.15), ratio("n_repeat_words", "n_words") > 0.4)),
        ("capitals", share("n_upper", "n_letters", 0.25, 0.6)),
        ("digits", share("n_digits", "word_chars", 0.1, 0.3)),
        ("letters", vote(ratio("n_letters", "word_chars") > 0.8, ratio("n_letters", "word_chars") < 0.75)),
        ("vocabulary", vote((n >= 50) & (ratio("n_distinct", "n_words") > 0.25), (n >= 50) & (ratio("n_distinct", "n_words") < 0.1))),
        ("ended_lines", vote(ratio("n_ended", "n_lines") > 0.5, (F.col("n_lines") >= 5) & (ratio("n_ended", "n_lines") < 0.1))),
        ("shouts", share("n_shouts", "n_words", 0.02, 0.1)),
        ("marked_words", share("n_marked", "n_words", 0.02, 0.15)),
        ("wordless", share("n_wordless", "n_words", 0.05, 0.15)),
    ]


def removed(text: Column, pattern: str) -> Column:
    """How many characters are in runs that match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def words_with(text: Column, before: str, what: str) -> Column:
    """How many words have what, after as many characters of before as there are; looked for at the starts of words alone."""
    return F.regexp_count(text, F.lit(rf"(?<![^\x20\x09-\x0D]){before}*+{what}[^\x20\x09-\x0D]*+"))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, the features as longs) of every whole text. A null text has no words and no lines.

    Repeated three-word windows: hashes of a text's windows that are all different settle most texts. Of the others,
    windows are sorted by hash and place, so that equal ones are neighbours, and the words that the repeated ones cover are
    counted in order of place.
    """
    t, k = F.col("t"), F.lit
    a = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), k("")).alias("t"))
    a = a.select("doc_id", "t", F.regexp_extract_all(t, k(WORD), k(0)).alias("w"), F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    windows = F.when(n >= 3, F.transform(F.sequence(k(0), n - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": removed(t, "[#*$%&|<>]+"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_lines": F.size("lines"),
        "n_upper": removed(t, r"\p{Lu}+"),
        "n_digits": removed(t, "[0-9]+"),
        "n_letters": removed(t, r"\p{L}+"),
        "n_distinct": F.size(F.array_distinct("w")),
        "n_ended": F.size(F.filter("lines", lambda x: x.rlike(r"[.!?:][\x20\x09-\x0D]*$"))),
        "n_marked": F.when(t.rlike("[#*$%&|<>]"), words_with(t, r"[^\x20\x09-\x0D#*$%&|<>]", "[#*$%&|<>]")).otherwise(0),
        "n_wordless": F.regexp_count(t, k(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}\p{N}]++(?![^\x20\x09-\x0D])")),
        "n_shouts": F.when(F.contains(t, k("!!")) | F.contains(t, k("??")), words_with(t, r"(?:(?!!!|\?\?)[^\x20\x09-\x0D])", r"(?:!!|\?\?)")).otherwise(0),
    }
    b = a.select("doc_id", *[c.cast("long").alias(x) for x, c in counts.items()], windows.alias("h"))
    some = F.size(F.array_distinct("h")) < F.size("h")
    sorted_ = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    c = b.select("doc_id", *counts, F.when(some, sorted_).alias("s"))

    def twin(x: Column, i: Column) -> Column:
        return F.coalesce(x["h"] == F.get("s", i + 1)["h"], k(False)) | F.coalesce(x["h"] == F.get("s", i - 1)["h"], k(False))

    c = c.select("doc_id", *counts, F.when(F.col("s").isNotNull(), F.sort_array(F.transform(F.filter("s", twin), lambda x: x["i"]))).alias("p"))
    start = F.struct(k(-3).alias("last"), k(0).cast("long").alias("sum"))
    covered = F.aggregate("p", start, lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(k(3), p - acc["last"])).alias("sum")), lambda acc: acc["sum"])
    return c.select("doc_id", *counts, F.coalesce(covered, k(0).cast("long")).alias("n_repeat_words")).select("doc_id", *FEATURES)


#: Where a vote stands in a rule's rates.
SLOT = {BAD: 0, GOOD: 1, 0: 2}
Rates = list[tuple[tuple[float, ...], tuple[float, ...]]]


def estimate(patterns: list[tuple[list[int], int]], n_rules: int, rounds: int = ROUNDS) -> tuple[float, Rates]:
    """(share of good texts, each rule's rates of votes against, for and abstentions on good and on bad texts) by
    expectation-maximisation over vote patterns and their counts. A rule's rates on the two kinds are its own, abstentions
    included; given the kind of a text, rules vote by themselves. No texts: what is believed before."""
    prior, rates = PRIOR_SHARE, [(PRIOR_GOOD, PRIOR_BAD)] * n_rules
    for _ in range(rounds):
        good = total = 0.0
        sums = [([PRIOR_TEXTS * x for x in PRIOR_GOOD], [PRIOR_TEXTS * x for x in PRIOR_BAD]) for _ in range(n_rules)]
        log_odds, tables = start(prior), [weights(r) for r in rates]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, log_odds + sum(t[SLOT[v]] for t, v in zip(tables, votes)))))
            good, total = good + n * p, total + n
            for s, v in zip(sums, votes):
                s[0][SLOT[v]] += n * p
                s[1][SLOT[v]] += n * (1 - p)
        after = [tuple(tuple(x / sum(side) for x in side) for side in s) for s in sums]
        share = (good + PRIOR_TEXTS * PRIOR_SHARE) / (total + PRIOR_TEXTS)
        moved = max([abs(share - prior), *(abs(x - y) for r, q in zip(rates, after) for a, b in zip(r, q) for x, y in zip(a, b))])
        prior, rates = share, after
        if moved < CHANGE:
            break
    return prior, rates


def weights(rates: tuple[tuple[float, ...], tuple[float, ...]]) -> list[float]:
    """What a vote against, a vote for and an abstention add to the log-odds of a good text."""
    return [math.log(good / bad) for good, bad in zip(*rates)]


def start(prior: float) -> float:
    return math.log(prior / (1 - prior))


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, features, base_failed, quality, kept) of every row of docs (doc_id, text).

    quality: the posterior probability that the text is good, from the rules' votes and the accuracies that this corpus
    gives them. The driver sees only how many texts have each pattern of votes, 3 to the number of rules at most. kept:
    not base_failed, and a quality of KEEP or more. Null and empty texts have no words and fail the base rules; rows that
    share a doc_id are judged each on its own; an empty table gives no rows; other columns are ignored.
    """
    named = rules()
    code = sum(((v + 1) * 3**j for j, (_, v) in enumerate(named)), F.lit(0)).cast("long")
    table = written(features(docs).withColumn("votes", code), "features")
    found = table.groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns = sorted(([r["votes"] // 3**j % 3 - 1 for j in range(len(named))], r["n"]) for r in found)
    prior, rates = estimate(patterns, len(named))
    digit = [F.floor(F.col("votes") / F.lit(3**j)) % 3 - 1 for j in range(len(named))]
    parts = [F.when(d == GOOD, w[SLOT[GOOD]]).when(d == BAD, w[SLOT[BAD]]).otherwise(w[SLOT[0]]) for d, w in zip(digit, map(weights, rates))]
    total = sum(parts, F.lit(start(prior)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = table.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-total)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP)).drop("votes")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
