"""Ranked search in two phases: a cheap score for all, a finer one for the best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.text import compact, fuzzy_ratio, normalized, plain_ratio, ratio_bound, tokens
from ..sources.files import written
from .filters import brand_matches
from .pruned import best_by_bound

#: Candidates of the first phase, and the shares of the ranking.
CANDIDATES, FULL_TEXT_WEIGHT, FUZZY_WEIGHT = 100, 0.4, 0.2
#: What a brand's match counts in the first phase; how name and brand blend in the second.
QUICK_BRAND, NAME_SHARE, BRAND_SHARE, FUZZY_BRAND = 0.85, 0.8, 0.2, 0.85


def documents(products: DataFrame, fold: bool = True) -> DataFrame:
    """(code, product_name, brands, and their normalized forms and tokens); compute once and cache for many searches."""
    rows = products.select("code", "product_name", "brands").withColumns({f"{x}_norm": normalized(c, fold=fold) for x, c in (("code", F.col("code").cast("string")), ("name", F.col("product_name")), ("brand", F.col("brands")))})
    return rows.withColumns({"name_tokens": tokens("name_norm"), "brand_tokens": tokens("brand_norm")})


def query_forms(products: DataFrame, q: str) -> tuple[str, list[str]]:
    """A query's normalized form and tokens, by the same expressions as the documents'."""
    row = products.sparkSession.range(1).select(normalized(F.lit(q)).alias("n")).select("n", tokens("n").alias("t")).first()
    return row["n"], row["t"]


def field_score(norm: str, words: list[str], field: str, field_tokens: str) -> Column:
    """1 for the same text, .95 if the field contains the query or equals it without spaces, .9 if it contains it without
    spaces or has all of its tokens, else the share of tokens that it has."""
    f, squeezed = F.col(field), norm.replace(" ", "")
    wanted = F.array(*[F.lit(w) for w in dict.fromkeys(words)]).cast("array<string>")
    share = F.size(F.array_intersect(F.col(field_tokens), wanted)) / F.lit(max(len(set(words)), 1))
    ladder = F.when(f == norm, 1.0).when(F.contains(f, F.lit(norm)) | (compact(f) == squeezed), 0.95).when(F.contains(compact(f), F.lit(squeezed)), 0.9)
    covered = F.when(share >= 1, 0.9).otherwise(share)
    return F.when(F.coalesce(f, F.lit("")) == "", 0.0).otherwise(ladder.otherwise(covered))


def nearest_in_spelling(docs: DataFrame, norm: str, wanted: int = CANDIDATES) -> DataFrame:
    """The documents whose name or brand is most like a query by plain ratio, under `near`; ties by code. The ratio runs on the
    few spellings whose letters allow for it, once for all documents that share one. Of each spelling the smallest code
    stands for it: before any other document come those of a hundred spellings."""

    def near(f) -> Column:
        return F.greatest(f(norm, "name_norm"), FUZZY_BRAND * f(norm, "brand_norm"))

    spelled = written(docs.groupBy("name_norm", "brand_norm").agg(F.min("code").alias("code")), "spelled")  # read by each round
    best = best_by_bound(spelled, near(ratio_bound), lambda rows: rows.withColumn("near", near(plain_ratio)), wanted, "code", "near")
    same = F.col("name_norm").eqNullSafe(F.col("_name")) & F.col("brand_norm").eqNullSafe(F.col("_brand"))
    few = F.broadcast(best.select(F.col("name_norm").alias("_name"), F.col("brand_norm").alias("_brand"), "near"))  # wanted rows at most
    return docs.join(few, same).drop("_name", "_brand").orderBy(F.desc("near"), "code").limit(wanted)


def search(products: DataFrame, q: str, brand: str | None = None, limit: int = 500, fold: bool = True, min_score: float | None = None) -> DataFrame:
    """(code, product_name, brands, full_text_score, fuzzy_score, ranking_score, search_score, search_score_pct), best first.

    A blank query finds nothing; a query that is a code finds that product. Else the best candidates by the quick score are
    ranked by full text, or by fuzzy ratio if no product matches in any word; the best for that are found by a bound. min_score leaves out lower search scores;
    without it, candidates that don't match fill the list up. Ties: by name, then code.
    """
    norm, words = query_forms(products, q)
    # The normalized forms are made once, by all tasks however few files the products have, and read by each pass.
    docs = written(documents(products.select("code", "product_name", "brands").repartition("code"), fold).where(brand_matches("brand_norm", brand, normal=True)), "documents")
    scored = ["full_text_score", "fuzzy_score", "ranking_score", "search_score", "search_score_pct"]
    if not norm:
        return docs.limit(0).select("code", "product_name", "brands", *[F.lit(None).cast("int" if c.endswith("pct") else "double").alias(c) for c in scored])
    exact = F.col("code_norm") == norm
    name, label = field_score(norm, words, "name_norm", "name_tokens"), field_score(norm, words, "brand_norm", "brand_tokens")
    code = F.when(exact, 1.0).otherwise(0.0)
    quick = docs.withColumns({"is_code": exact, "quick": F.greatest(code, name, QUICK_BRAND * label), "full_text_score": F.greatest(code, name, NAME_SHARE * name + BRAND_SHARE * label)})
    best = quick.agg(F.max("quick").alias("q"), F.max("is_code").alias("c")).first()
    if best["c"]:
        one = quick.where("is_code").orderBy("code").limit(1)
        return one.select("code", "product_name", "brands", F.lit(1.0).alias("full_text_score"), F.lit(0.0).alias("fuzzy_score"), F.lit(FULL_TEXT_WEIGHT).alias("ranking_score"), F.lit(1.0).alias("search_score"), F.lit(100).alias("search_score_pct"))
    lexical = bool(best["q"])
    if lexical:
        top = quick.orderBy(F.desc("quick"), "code").limit(CANDIDATES)
        top = top.withColumns({"fuzzy_score": F.lit(0.0), "ranking_score": FULL_TEXT_WEIGHT * F.col("full_text_score"), "search_score": F.col("full_text_score")})
    else:
        top = nearest_in_spelling(quick, norm)
        top = top.withColumn("fuzzy_score", F.greatest(fuzzy_ratio(norm, "name_norm"), FUZZY_BRAND * fuzzy_ratio(norm, "brand_norm")))
        top = top.withColumns({"ranking_score": FULL_TEXT_WEIGHT * F.col("full_text_score") + FUZZY_WEIGHT * F.col("fuzzy_score"), "search_score": F.col("fuzzy_score")})
    if min_score is not None:
        top = top.where(F.col("search_score") >= min_score)
    out = top.select("code", "product_name", "brands", "full_text_score", "fuzzy_score", "ranking_score", "search_score", percent("search_score").alias("search_score_pct"))
    return out.orderBy(F.desc("ranking_score"), F.desc("full_text_score"), F.coalesce("product_name", F.lit("")), "code").limit(limit)
