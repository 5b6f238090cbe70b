"""License scans: ordered signature rules, hand-written, behind a keyword prefilter. Native."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import table, triggers

#: What stands between words of a text whose A-Z are lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

RANKS = 5
#: The one character beyond ASCII that lower-casing would turn into an ASCII letter by itself, and one that stays a letter.
KELVIN, KRA = "\u212a", "\u0138"


@dataclass(frozen=True)
class Rule:
    """keywords: texts of which every place has one; words: whole words of which every place has one."""

    label: str
    regex: str
    keywords: tuple[str, ...]
    words: tuple[str, ...]
    rank: int


def whole(regex: str) -> str:
    """Over whole words."""
    return f"(?<= )(?:{regex})(?= )"


def signature_rules() -> list[Rule]:
    return [Rule(label, whole(expression), keywords, tuple(dict.fromkeys(w for k in keywords for w in triggers(k))), rank) for label, rank, keywords, expression in table()]


def prefilter() -> list[str]:
    """Whole words: a text without any of them has no place of any rule or base phrase."""
    return sorted({w for r in signature_rules() for w in r.words} | {"mit", "apache", "cc"})


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


PLACES = "array<struct<start:int,stop:int,rank:int,label:string>>"
#: Places of a rule whose starts are added up together.
TOGETHER = 64


def places(r: Column) -> Column:
    """The places of a rule, from its matches and the text between them, as structs (start, minus end, minus rank, label).
    Lengths are added up within blocks and over blocks, so that many matches cost little more than their number."""
    hits = r["hits"]
    pairs = F.arrays_zip(F.transform(hits, F.length).alias("hit"), F.transform(F.slice(r["parts"], F.lit(1), F.size(hits)), F.length).alias("gap"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / TOGETHER).cast("int")), lambda b: F.slice(pairs, b * TOGETHER + 1, F.lit(TOGETHER)))
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda at, x: at + x["hit"] + x["gap"]))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    begins = F.aggregate(totals, nothing, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.struct(begin.alias("start"), (-(begin + x["hit"])).alias("stop"), (-r["rank"]).alias("rank"), r["label"].alias("label"))
        return F.struct((begin + x["hit"]).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def within(block: Column, begin: Column) -> Column:
        return F.aggregate(block, F.struct(begin.alias("at"), F.array().cast(PLACES).alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.zip_with(blocks, begins, within))


def met(norm: str, present: str) -> Column:
    """Of the rules that match, the label, the rank, the matches and the text between them. A rule's expression is a
    literal, compiled once, and looked at behind its words among those present and its keywords. In SQL, which takes many
    columns at once."""
    each = []
    for r in signature_rules():
        here = " OR ".join(f"array_contains({present}, '{w}')" for w in r.words)
        gate = " OR ".join(f"contains({norm}, '{k}')" for k in r.keywords)
        found = f"named_struct('label', '{r.label}', 'rank', {r.rank}, 'hits', regexp_extract_all({norm}, '{r.regex}', 0), 'parts', split({norm}, '{r.regex}'))"
        each.append(f"CASE WHEN ({here}) AND ({gate}) AND rlike({norm}, '{r.regex}') THEN {found} END")
    return F.expr(f"array_compact(array({', '.join(each)}))")


def detections(found: Column) -> Column:
    """All places of the rules that match, in order of their start, longer ones first."""
    return F.sort_array(F.flatten(F.transform(found, places)))


def survivors(found: Column) -> Column:
    """(labels, rank): distinct labels of the places that stand, and their highest rank. A place falls if another of the
    same rank or a higher one contains it; of equal places of one rank, the first label stands. Places come in order of
    their start, longer ones first, so that only the furthest end of each rank need be known."""
    start = F.struct(F.array(*[F.lit(0)] * RANKS).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0).alias("rank"))

    def step(acc: Column, x: Column) -> Column:
        end, rank = -x["stop"], -x["rank"]
        falls = F.exists(F.slice(acc["ends"], rank, F.lit(RANKS)), lambda e: e >= end)
        ends = F.transform(acc["ends"], lambda e, i: F.when(i + 1 == rank, F.greatest(e, end)).otherwise(e))
        return F.struct(
            F.when(falls, acc["ends"]).otherwise(ends).alias("ends"),
            F.when(falls, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(x["label"]))).alias("labels"),
            F.when(falls, acc["rank"]).otherwise(F.greatest(acc["rank"], rank)).alias("rank"),
        )

    return F.aggregate(found, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["rank"].alias("rank")))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs (doc_id, text).

    Words: A-Z lowered, cut at ASCII characters that are neither letters nor digits. Base phrases count wherever their words
    stand in a row. Signature rules run over the words, joined by one space, of texts that have a word of the prefilter, each
    behind words and keywords of its own. score: 1 with a base phrase, else the highest rank among the standing places out of 5, 0 without
    any. Null and empty texts have no words and empty labels; an empty table gives no rows; other columns are ignored.
    """
    text, norm = F.col("text"), F.col("norm")
    a = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Beyond ASCII, lower-casing changes words but makes none that a rule knows.
    a = a.select("doc_id", F.array_remove(F.split(F.lower(F.replace(text, F.lit(KELVIN), F.lit(KRA))), GAP), "").alias("words"))
    every_word = F.array(*map(F.lit, prefilter()))
    a = a.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.arrays_overlap("words", every_word), F.array_intersect("words", every_word)).alias("present"),
                 F.when(F.arrays_overlap("words", every_word), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))).alias("norm"))
    pieces = [F.when(F.contains(norm, F.lit(f" {p} ")), F.split(norm, f"(?<= ){re.escape(p).replace(chr(92) + ' ', ' ')}(?= )")).alias(f"p{i}") for i, (p, _) in enumerate(BASE)]
    b = a.select("doc_id", "n_words", "norm", *pieces, F.when(norm.isNotNull(), met("norm", "present")).alias("met"))
    b = b.select("doc_id", "n_words", "norm", *[f"p{i}" for i in range(len(BASE))], F.when(F.size("met") > 0, detections(F.col("met"))).alias("found"))
    counts = [F.when(F.col(f"p{i}").isNotNull(), F.size(f"p{i}") - 1).otherwise(0) for i in range(len(BASE))]
    firsts = [F.when(c > 0, spaces(F.get(f"p{i}", F.lit(0))) - 1) for i, c in enumerate(counts)]
    # Before the last place stand all spaces but those of the phrase and of what follows.
    lasts = [F.when(c > 0, spaces(norm) - spaces(F.element_at(f"p{i}", -1)) - (len(p.split()) - 1) - 1) for i, (c, (p, _)) in enumerate(zip(counts, BASE))]
    labels = F.array_compact(F.array(*[F.when(c > 0, F.lit(label)) for c, (_, label) in zip(counts, BASE)]))
    c = b.select("doc_id", "n_words", sum(counts, F.lit(0)).cast("long").alias("n_base"), F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"), labels.alias("base"), F.when(F.size("found") > 0, survivors(F.col("found"))).alias("own"))
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("own.labels", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.col("own.rank") / RANKS, F.lit(0.0)))
    return c.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
