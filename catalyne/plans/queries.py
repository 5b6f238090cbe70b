"""Every operator as a query over the star schema, beside SQL that gives the same rows."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import nested, numeric, text
from ..operators import columns, compare, filters, ingredients, rules, search, similarity, taxonomy
from ..operators import catalog as shop
from ..schemas import TRANSFORMED
from ..sources import readers, sinks
from ..sources.files import Files, shared_folder
from ..streaming import incremental
from .tables import PARTS_SQL, catalog, line_links, parts, place_edges, places, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *tables: str):
    """Registers a function of some tables (or of session and folder, if none is named) under its name."""

    def wrap(f: Callable[..., DataFrame]) -> Query:
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[read(spark, sf_dir, t) for t in tables]) if tables else f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return run

    return wrap


def key(c: str) -> Column:
    return F.col(c).cast("string")


#: SQL for the stable number of a text, and for the normalized form of a plain one.
ID = "(('0x' || substr(md5({0}), 1, 16))::UBIGINT % 9223372036854775808::UBIGINT)::BIGINT"
NORM = "trim(regexp_replace(regexp_replace(replace(regexp_replace(lower({0}), '^[a-z]{{2,3}}:', ''), '-', ' '), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"
STOP = "[" + ",".join(f"'{w}'" for w in text.STOPWORDS) + "]"
TOKENS = "list_filter(str_split({0}, ' '), lambda t: length(t) > 1 AND NOT regexp_full_match(t, '[0-9]+') AND NOT list_contains(" + STOP + ", t))"
CLEAN = "(upper(substr(trim(replace(regexp_replace({0}, '^[a-z]{{2,3}}:', ''), '-', ' ')), 1, 1)) || lower(substr(trim(replace(regexp_replace({0}, '^[a-z]{{2,3}}:', ''), '-', ' ')), 2)))"

# Scans, projections, filters.


@query("SELECT p_partkey, p_name, p_brand FROM part", "part")
def scan_project(part):
    return part.select("p_partkey", "p_name", "p_brand")


@query("SELECT o_orderkey::VARCHAR AS code, o_orderpriority AS grade, NULL::VARCHAR AS missing FROM orders", "orders")
def project_fallback_nullfill(orders):
    rows = orders.select(key("o_orderkey").alias("code"), F.col("o_orderpriority").alias("old_grade"))
    return columns.resolve(rows, "code,grade|old_grade,missing|also_missing")


@query("SELECT event_id::VARCHAR AS event_id, event_type, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events", "events")
def project_stringified(events):
    rows = events.select("event_id", "event_type", F.from_json("props", "k long").alias("props"))
    texts = columns.stringified(rows)
    return texts.select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT p_partkey FROM part WHERE len(list_filter(str_split(p_name, ' '), lambda t: contains(lower(t), 'wid'))) > 0", "part")
def filter_tag_contains(part):
    return part.where(filters.has_tag(F.split("p_name", " "), "Wid")).select("p_partkey")


@query("SELECT doc_id FROM documents WHERE lower(lang) = 'fr'", "documents")
def filter_lang_exact(documents):
    return documents.where(filters.is_language("lang", "FR")).select("doc_id")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')", "part")
def filter_name_contains(part):
    return part.where(filters.contains_text("p_name", "Ring")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_brand FROM part WHERE lower(p_brand) LIKE '%brand#1_%'", "part")
def filter_brand_contains(part):
    return part.where(filters.contains_text("p_brand", "Brand#1_", wildcards=True)).select("p_partkey", "p_brand")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END AS flag FROM lineitem", "lineitem")
def filter_whitelist_null(lineitem):
    return lineitem.select("l_orderkey", "l_linenumber", filters.listed_or_null("l_returnflag", ("A", "R")).alias("flag"))


@query(f"SELECT code FROM ({PARTS_SQL}) WHERE (sugars_100g IS NULL OR sugars_100g <= 9) AND (fat_100g IS NULL OR fat_100g <= 30) AND (salt_100g IS NULL OR salt_100g <= 5) AND (energy_kcal_100g IS NULL OR energy_kcal_100g <= 1000) AND nutriscore_grade IN ('a', 'b')")
def filter_null_tolerant_max(spark, sf_dir):
    return parts(spark, sf_dir).where(filters.page_filter({"a", "B"}, sugars_100g=9.0, fat_100g=30.0)).select("code")


@query("SELECT DISTINCT source AS file FROM documents WHERE source > 'src14'", "documents")
def filter_pending_files(documents):
    return incremental.pending_files(documents.select(F.col("source").alias("file")).distinct(), "src14")


@query("SELECT nation.n_name, region.r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE regexp_matches(n_name, '[a-zA-Z]') AND trim(r_name) <> ''", "nation", "region")
def filter_not_blank(nation, region):
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return rows.where(filters.has_letter("n_name") & filters.not_blank("r_name")).select("n_name", "r_name")


# Validation.

JUDGED = "(SELECT d.doc_id, l.quality, d.doc_id IS NOT NULL AND coalesce(trim(text) <> '', false) AS r1, l.quality IS NOT NULL AS r2, coalesce(l.toxic = 0, false) AS r3 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def labelled(documents, labels):
    rows = documents.select("doc_id", "text").join(labels, "doc_id", "left")
    return rows, [rules.Rule("text_not_blank", filters.not_blank("text")), rules.Rule("labelled", F.col("quality").isNotNull()), rules.Rule("not_toxic", F.col("toxic") == 0)]


@query(f"SELECT doc_id, quality FROM {JUDGED} WHERE r1 AND r2 AND r3", "documents", "labels")
def validate_split_valid(documents, labels):
    return rules.judged(*labelled(documents, labels)).where("valid").select("doc_id", "quality")


@query(f"SELECT doc_id, quality FROM {JUDGED} WHERE NOT (r1 AND r2 AND r3)", "documents", "labels")
def validate_split_invalid(documents, labels):
    return rules.judged(*labelled(documents, labels)).where("not valid").select("doc_id", "quality")


@query(f"SELECT 'text_not_blank' AS rule, count(*) FILTER (NOT r1) AS failed FROM {JUDGED} UNION ALL SELECT 'labelled', count(*) FILTER (NOT r2) FROM {JUDGED} UNION ALL SELECT 'not_toxic', count(*) FILTER (NOT r3) FROM {JUDGED}", "documents", "labels")
def validate_rule_counts(documents, labels):
    return rules.failures(*labelled(documents, labels))


@query(f"SELECT count(*) AS records_in, count(*) FILTER (r1 AND r2 AND r3) AS records_out, count(*) FILTER (NOT (r1 AND r2 AND r3)) AS records_rejected, round(count(*) FILTER (NOT (r1 AND r2 AND r3)) / count(*) * 100, 2) AS rejection_rate FROM {JUDGED}", "documents", "labels")
def validate_summary(documents, labels):
    return rules.summary(*labelled(documents, labels))


@query("SELECT o_orderstatus AS command, count(*) AS records_in, count(*) FILTER (o_totalprice < 100000) AS rejected, round(count(*) FILTER (o_totalprice < 100000) / count(*) * 100, 2) AS rejection_rate FROM orders GROUP BY 1", "orders")
def monitor_rejection_rate(orders):
    rows = orders.groupBy(F.col("o_orderstatus").alias("command")).agg(F.count("*").alias("records_in"), F.count_if(F.col("o_totalprice") < 100000).alias("rejected"))
    return rows.withColumn("rejection_rate", numeric.rate("rejected", "records_in"))


@query("SELECT 'split_orders' AS command, count(*) AS records_in, count(*) FILTER (o_totalprice >= 100000) AS records_out, count(*) FILTER (o_totalprice < 100000) AS records_rejected, round(count(*) FILTER (o_totalprice < 100000) / count(*) * 100, 2)::DOUBLE AS rejection_rate FROM orders")
def monitor_run_record(spark, sf_dir):
    """Orders are split and written; the counts come from that pass, and the run's row from the table of runs."""
    folder, table = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex[:8]}", own_table(spark, "runs")
    orders = rules.judged(read(spark, sf_dir, "orders"), [rules.Rule("large", F.col("o_totalprice") >= 100000)])
    counts = sinks.quarantine(orders, f"{folder}/good", f"{folder}/bad")
    sinks.record_run(spark, "split_orders", *counts.values(), run_id="queries", table=table)
    Files(spark, folder).delete()
    return sinks.read_table(spark, table).select("command", "records_in", "records_out", "records_rejected", "rejection_rate")


# Joins.


@query("SELECT p.p_partkey, p.p_name, x.n FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) x ON p.p_partkey = x.l_partkey", "part", "lineitem")
def join_left_finalize(part, lineitem):
    counts = lineitem.where("l_quantity > 45").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return columns.without(part.join(counts, "p_partkey", "left"), "p_brand", "p_type", "p_size", "p_retailprice", "absent")


@query("SELECT n.n_name AS name, r.r_name AS parent FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey UNION ALL SELECT r_name, NULL FROM region")
def join_left_residual_self(spark, sf_dir):
    c = places(spark, sf_dir)
    a, b = c.categories.alias("a"), c.categories.alias("b")
    up = c.closure.alias("u")
    both = a.join(up, (F.col("a.category_id") == F.col("u.category_id")) & (F.col("u.distance") == 1), "left").join(b, F.col("u.category_id_parent") == F.col("b.category_id"), "left")
    return both.select(F.col("a.category_name").alias("name"), F.col("b.category_name").alias("parent"))


@query("SELECT c.c_custkey::VARCHAR AS code, n.n_name AS category, 1 AS distance, r.r_name AS parent FROM customer c JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey")
def join_mixed_four_way(spark, sf_dir):
    c = places(spark, sf_dir)
    names = c.categories.select(F.col("category_id").alias("category_id_parent"), F.col("category_name").alias("parent"))
    rows = shop.category_links(c).join(c.categories, "category_id").join(c.closure, "category_id", "left").join(names, "category_id_parent", "left")
    return rows.select("code", F.col("category_name").alias("category"), "distance", "parent")


@query("SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey", "lineitem", "part")
def join_inner_junction(lineitem, part):
    return lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey")).join(part.select("p_partkey", "p_name"), "p_partkey").drop("p_partkey")


@query("SELECT p_partkey::VARCHAR AS code FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE contains(lower(s_name), '0007'))")
def join_semi_in_subquery(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return c.products.select("code").join(shop.with_ingredient(c, "0007"), "code", "left_semi")


@query("SELECT p_partkey::VARCHAR AS code FROM part WHERE contains(lower(p_type), 'econ')")
def join_semi_category(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return c.products.select("code").join(shop.in_category(c, "ECON"), "code", "left_semi")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)", "orders", "lineitem")
def join_anti_survivors(orders, lineitem):
    hit = lineitem.where("l_discount > 0.08").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.select("o_orderkey").join(hit, "o_orderkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_tax > 0.05 AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)", "lineitem")
def join_anti_composite(lineitem):
    keys = ["l_orderkey", "l_linenumber"]
    return lineitem.select(*keys).join(lineitem.where("l_tax > 0.05").select(*keys).distinct(), keys, "left_anti")


@query("SELECT n_name AS tag, coalesce(r_name, n_name) AS canonical FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3", "nation", "region")
def lookup_coalesce_passthrough(nation, region):
    known = nation.join(region.where("r_regionkey < 3"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("tag"), F.col("r_name").alias("canonical"))
    return nation.select(F.col("n_name").alias("tag")).join(known, "tag", "left").select("tag", F.coalesce("canonical", "tag").alias("canonical"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) WHEN p_name IN ('red widget', 'small ring') THEN 'known:' || replace(p_name, ' ', '-') WHEN p_partkey % 5 = 0 THEN lower(p_brand) ELSE 'en:' || replace(p_name, ' ', '-') END AS tag FROM part")
def lookup_candidates(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    third, fifth = F.col("p_partkey") % 3 == 0, F.col("p_partkey") % 5 == 0
    nodes = p.select("p_partkey", F.when(third | fifth, F.concat(F.lit(" "), F.upper("p_brand"))).alias("id"), F.when(~third, F.col("p_name")).alias("text"))
    tags = spark.createDataFrame([("en:red-widget", "known:red-widget"), ("fr:small-ring", "known:small-ring")], "tag string, canonical string")
    return ingredients.tagged(nodes, tags, "id", "text", "tag", fold=False).select("p_partkey", "tag")


@query("SELECT v.vec_id, round(list_dot_product(v.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS score FROM embeddings v, (SELECT * FROM embeddings WHERE vec_id = 0) b WHERE v.vec_id <> 0", "embeddings")
def cross_score_one_to_many(embeddings):
    rows = similarity.embedding_scores(embeddings.withColumnRenamed("vec_id", "doc"), 0)
    return rows.select(F.col("doc").alias("vec_id"), F.round("text_similarity", 6).alias("score"))


# Hierarchies.

EDGES = "SELECT 'N:' || n_nationkey AS tag, 'R:' || n_regionkey AS parent FROM nation UNION ALL SELECT 'C:' || c_custkey, 'N:' || c_nationkey FROM customer"
UP = f"WITH RECURSIVE e AS ({EDGES}), up AS (SELECT tag, parent AS ancestor, 1 AS distance FROM e UNION ALL SELECT up.tag, e.parent, up.distance + 1 FROM up JOIN e ON up.ancestor = e.tag)"


@query(f"{UP} SELECT tag, ancestor, distance FROM up")
def closure_ancestors(spark, sf_dir):
    return taxonomy.closure(place_edges(spark, sf_dir))


@query(f"{UP} SELECT {ID.format('tag')} AS category_id, tag AS category_name FROM (SELECT tag FROM up UNION SELECT ancestor FROM up)")
def closure_nodes_with_ids(spark, sf_dir):
    up = taxonomy.closure(place_edges(spark, sf_dir))
    names = up.select("tag").union(up.select("ancestor")).distinct()
    return names.select(text.stable_id("tag").alias("category_id"), F.col("tag").alias("category_name"))


TAGGED = "SELECT p_partkey::VARCHAR AS code, ['en:' || replace(p_name, ' ', '-'), 'en:' || split_part(p_name, ' ', 2), 'en:' || split_part(p_name, ' ', 2)] AS tags FROM part"
WIDGETS = "en:widget\nfr:gadget\n\n< en:widget\nen:red widget\n\n< en:ring\n< en:widget\nen:small ring\nxx:tiny ring\n\nen:ring\n"


def tagged(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    kind, name = F.split("p_name", " ")[1], F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
    return p.select(key("p_partkey").alias("code"), F.array(F.concat(F.lit(" EN:"), name), F.concat(F.lit("en:"), kind), F.concat(F.lit("en:"), kind)).alias("categories_tags"))


@query(f"SELECT code, 'en:' || split_part(tags[1], ':', 2) AS first_tag, {ID.format('tags[3]')} AS categorie_principale FROM ({TAGGED})")
def taxonomy_principal(spark, sf_dir):
    rows = tagged(spark, sf_dir)
    parsed = taxonomy.parse_categories(WIDGETS)
    first = taxonomy.canonical_tags(rows, parsed.tags(spark)).select("code", F.get("tags", F.lit(0)).alias("first_tag"))
    return first.join(taxonomy.normalize_categories(rows, parsed)[2], "code")


@query(f"SELECT DISTINCT {ID.format('t')} AS category_id, t AS category_name FROM (SELECT unnest(tags) AS t FROM ({TAGGED})) UNION SELECT {ID.format('x')}, x FROM (SELECT 'en:widget' AS x)")
def taxonomy_categories(spark, sf_dir):
    return taxonomy.normalize_categories(tagged(spark, sf_dir), taxonomy.parse_categories(WIDGETS))[0]


# Aggregation.


@query("SELECT l_partkey::VARCHAR AS code, string_agg(DISTINCT s_name, '|' ORDER BY s_name) AS names FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def agg_group_concat_distinct(spark, sf_dir):
    c = catalog(spark, sf_dir)
    links = c.product_ingredients.select("code", F.col("ingredient_id").alias("category_id"))
    names = c.ingredients.select(F.col("ingredient_id").alias("category_id"), F.col("ingredient_name").alias("category_name"))
    return shop.joined_names(links, names).withColumnRenamed("categories", "names")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem", "lineitem")
def agg_distinct_rows(lineitem):
    return lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


LONG = f"""
WITH p AS ({PARTS_SQL}), long AS (
  SELECT p_type, code, unnest(['energy_kcal_100g', 'fat_100g', 'carbohydrates_100g', 'sugars_100g', 'proteins_100g', 'salt_100g']) AS metric,
    unnest([energy_kcal_100g, fat_100g, carbohydrates_100g, sugars_100g, proteins_100g, salt_100g]) AS value FROM p
), stat AS (SELECT p_type, metric, min(value) AS lo, max(value) AS hi, avg(value) AS av, count(value) AS n FROM long GROUP BY 1, 2)
"""


@query(f"{LONG} SELECT p_type, metric, round(lo, 6) AS min, round(hi, 6) AS max, round(av, 6) AS avg FROM stat")
def agg_metric_stats(spark, sf_dir):
    rows = compare.stats(compare.long_form(parts(spark, sf_dir), by=["p_type"]), ["p_type"])
    return rows.select("p_type", "metric", *[F.round(c, 6).alias(c) for c in ("min", "max", "avg")])


@query(f"{LONG} SELECT l.p_type, l.code, l.metric FROM long l JOIN stat s ON l.p_type = s.p_type AND l.metric = s.metric WHERE s.n > 1 AND l.value = CASE WHEN l.metric = 'proteins_100g' THEN hi ELSE lo END")
def agg_best_in_row(spark, sf_dir):
    rows = compare.best_values(compare.long_form(parts(spark, sf_dir), by=["p_type"]), ["p_type"])
    return rows.where("is_best").select("p_type", "code", "metric")


@query("""
SELECT token, count(DISTINCT item_id) AS df FROM (SELECT item_id, unnest(str_split(lower(text), ' ')) AS token FROM benchmark) GROUP BY 1
""", "benchmark")
def agg_doc_frequency(benchmark):
    words = benchmark.select("item_id", F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("df"))


# Windows.


@query("""
WITH x AS (SELECT l_orderkey, l_shipmode, min(l_linenumber) AS first FROM (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) GROUP BY 1, 2)
SELECT l_orderkey::VARCHAR AS code, l_shipmode AS term, row_number() OVER (PARTITION BY l_orderkey ORDER BY first, l_shipmode) AS n FROM x QUALIFY n <= 2
""", "lineitem")
def window_ordered_dedupe_topn(lineitem):
    rows = lineitem.select(key("l_orderkey").alias("code"), F.concat("l_returnflag", "l_linestatus").alias("term"), "l_linenumber")
    return similarity.first_terms(rows, "code", "term", "l_linenumber", 2, fold=False)


@query("SELECT p_partkey, list_extract(str_split(p_name, ' '), -1) AS last FROM part", "part")
def window_last_element(part):
    return part.select("p_partkey", nested.last(F.split("p_name", " ")).alias("last"))


@query("SELECT p_partkey, list_filter(str_split(p_name, ' '), lambda t: contains(t, 'r'))[1] AS first FROM part", "part")
def window_first_match(part):
    return part.select("p_partkey", nested.first_match(F.split("p_name", " "), lambda t: F.contains(t, F.lit("r"))).alias("first"))


@query("SELECT lower(p_name) AS folded, min(p_partkey) AS p_partkey FROM part GROUP BY 1", "part")
def window_folded_label_dedupe(part):
    first = Window.partitionBy(F.lower("p_name")).orderBy("p_partkey")
    return part.withColumn("n", F.row_number().over(first)).where("n = 1").select(F.lower("p_name").alias("folded"), "p_partkey")


@query("SELECT p_partkey, CASE WHEN len(str_split(p_type, ' ')) >= 2 AND length(p_type) > length(p_name) THEN p_type ELSE p_name END AS label FROM part", "part")
def window_longest_label(part):
    return part.select("p_partkey", similarity.longest_label(F.array("p_brand", "p_type", "p_name")).alias("label"))


HEALTH = f"""
{LONG}, grade AS (
  SELECT p_type, code, CASE nutriscore_grade WHEN 'a' THEN 5 WHEN 'b' THEN 4 WHEN 'c' THEN 3 WHEN 'd' THEN 2 WHEN 'e' THEN 1 END AS g FROM p
), part_score AS (
  SELECT l.p_type, l.code, CASE WHEN hi <> lo THEN CASE WHEN l.metric = 'proteins_100g' THEN (value - lo) / (hi - lo) ELSE 1 - (value - lo) / (hi - lo) END END AS c
  FROM long l JOIN stat s ON l.p_type = s.p_type AND l.metric = s.metric
  UNION ALL
  SELECT p_type, code, CASE WHEN max(g) OVER w <> min(g) OVER w THEN (g - min(g) OVER w) / (max(g) OVER w - min(g) OVER w) END FROM grade WINDOW w AS (PARTITION BY p_type)
), score AS (SELECT p_type, code, coalesce(avg(c), 0) * 100 AS s FROM part_score GROUP BY 1, 2)
"""


@query(f"{HEALTH} SELECT p_type, code, round(s, 2) AS score FROM score")
def compare_health_score(spark, sf_dir):
    return compare.health_scores(parts(spark, sf_dir), by=["p_type"])


@query("SELECT p_type, p_partkey::VARCHAR AS code, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey::VARCHAR) AS rank FROM part", "part")
def window_rank_leaderboard(part):
    return compare.leaderboard(part.select("p_type", key("p_partkey").alias("code"), F.col("p_retailprice").alias("score")), ["p_type"]).drop("score")


@query("SELECT p_partkey, round((p_size - min(p_size) OVER w) / (max(p_size) OVER w - min(p_size) OVER w), 6) AS share FROM part WINDOW w AS (PARTITION BY p_type)", "part")
def window_minmax(part):
    w = Window.partitionBy("p_type")
    least, most = F.min("p_size").over(w), F.max("p_size").over(w)
    return part.select("p_partkey", F.round((F.col("p_size") - least) / (most - least), 6).alias("share"))


# Sorting, sets.


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS name FROM part ORDER BY name NULLS LAST, p_partkey LIMIT 100", "part")
def sort_nulls_last_topk(part):
    rows = part.select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")).alias("name"))
    return rows.orderBy(F.col("name").asc_nulls_last(), "p_partkey").limit(100)


@query("SELECT p_partkey::VARCHAR AS code, CASE p_partkey WHEN 30 THEN 0 WHEN 7 THEN 1 ELSE 2 END AS pos FROM part WHERE p_partkey IN (30, 7, 12)")
def sort_request_order(spark, sf_dir):
    wanted = shop.requested(spark, ["30", " 7 ", "", "30", "12", "999999999"])
    return parts(spark, sf_dir).select("code").join(wanted, "code").orderBy("pos")


@query("SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 40 UNION SELECT o_orderkey FROM orders WHERE o_totalprice > 300000", "lineitem", "orders")
def set_union_distinct(lineitem, orders):
    return lineitem.where("l_quantity > 40").select(F.col("l_orderkey").alias("k")).union(orders.where("o_totalprice > 300000").select("o_orderkey")).distinct()


@query("SELECT p_partkey, len(list_intersect(list_distinct(str_split(p_name, ' ')), ['red', 'widget'])) > 0 AS shared, len(list_intersect(list_distinct(str_split(p_name, ' ')), ['red', 'widget'])) / 2 AS coverage FROM part", "part")
def set_overlap_coverage(part):
    words, wanted = F.split("p_name", " "), F.array(F.lit("red"), F.lit("widget"))
    return part.select("p_partkey", F.arrays_overlap(words, wanted).alias("shared"), (F.size(F.array_intersect(words, wanted)) / 2).alias("coverage"))


# Text and numbers.


@query(f"SELECT p_partkey, {CLEAN.format('x')} AS label FROM (SELECT p_partkey, 'en:' || replace(p_name, ' ', '-') || '-OF-' || p_brand AS x FROM part)", "part")
def str_clean_name(part):
    return part.select("p_partkey", text.clean_name(F.concat(F.lit("en:"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("-OF-"), "p_brand")).alias("label"))


@query("SELECT p_partkey, lower(replace(regexp_replace('fr:' || p_brand || '-X', '^[a-z]{2,3}:', ''), '-', ' ')) AS k FROM part", "part")
def str_normalized_search(part):
    return part.select("p_partkey", text.search_key(F.concat(F.lit("fr:"), "p_brand", F.lit("-X"))).alias("k"))


@query("SELECT n_nationkey, replace(replace(n_name, '-', ' '), '_', ' ') AS name FROM nation", "nation")
def str_id_to_name(nation):
    return nation.select("n_nationkey", text.tag_name(F.concat(F.lit("en:"), "n_name")).alias("name"))


CLEANED = "trim(regexp_replace(regexp_replace(regexp_replace(replace({0}, '_', ' '), '<[^>]+>', ' ', 'g'), '[^a-zA-Z0-9%+\\-/,:.\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(None, "pages")
def str_clean_text_pages(pages):
    """Every page, with accents folded. SQL can't fold ligatures."""
    return pages.select("page_id", F.md5(text.clean_text("html")).alias("cleaned"))


@query(f"SELECT p_partkey, trim(regexp_replace(regexp_replace(replace(replace(lower({CLEANED.format('x')}), '/', ' '), ',', ' '), '\\s+', '-', 'g'), '-+', '-', 'g'), '-') AS slug FROM (SELECT p_partkey, p_brand || ' / ' || p_name || ', (' || p_type || ')' AS x FROM part)", "part")
def str_slugify(part):
    return part.select("p_partkey", text.slug(F.concat("p_brand", F.lit(" / "), "p_name", F.lit(", ("), "p_type", F.lit(")")), fold=False).alias("slug"))


@query("SELECT doc_id, md5(strip_accents(text)) AS folded FROM documents WHERE text IS NOT NULL", "documents")
def str_strip_accents(documents):
    return documents.where("text is not null").select("doc_id", F.md5(text.fold_accents("text", compatible=False)).alias("folded"))


FOLDED = NORM.format("strip_accents(text)")


@query(f"SELECT item_id, array_to_string({TOKENS.format(FOLDED)}, ' ') AS tokens FROM benchmark", "benchmark")
def str_tokenize_folded(benchmark):
    """Every item, with accents folded."""
    return benchmark.select("item_id", F.array_join(text.tokens(text.normalized("text")), " ").alias("tokens"))


PATH = "substr(c, 1, 3) || '/' || substr(c, 4, 3) || '/' || substr(c, 7, 3) || '/' || substr(c, 10)"


@query(f"SELECT p_partkey, {PATH} AS path FROM (SELECT p_partkey, lpad(p_partkey::VARCHAR, 13, '0') AS c FROM part)", "part")
def str_code_path(part):
    return part.select("p_partkey", text.code_path(key("p_partkey")).alias("path"))


@query(f"SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'https://i.example.org/' || {PATH} || '/front_en.' || p_size || '.400.jpg' END AS url FROM (SELECT p_partkey, p_size, lpad(p_partkey::VARCHAR, 13, '0') AS c FROM part)", "part")
def str_image_url(part):
    rev = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('"'), "p_size", F.lit('"')))
    return part.select("p_partkey", text.image_url("https://i.example.org/", key("p_partkey"), F.lit("front_en"), rev).alias("url"))


@query("SELECT p_partkey, 'Nom: ' || p_name || CASE WHEN p_size % 2 = 0 THEN chr(10) || 'Categorie: ' || p_type ELSE '' END || chr(10) || 'Alias: ' || p_brand AS text FROM part", "part")
def str_semantic_text(part):
    return part.select("p_partkey", text.semantic_text(Nom=F.col("p_name"), Categorie=F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" "), Alias=F.col("p_brand")).alias("text"))


@query("SELECT p_partkey, p_type || ' > ' || p_name AS path FROM part", "part")
def str_category_path(part):
    return part.select("p_partkey", text.category_path(F.array("p_type", "p_name", "p_type")).alias("path"))


@query("SELECT l_orderkey, l_linenumber, l_orderkey || '_' || l_linenumber AS stem FROM lineitem", "lineitem")
def str_digit_stem(lineitem):
    name = F.concat(F.lit("export_7_delta_"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit(".json.gz"))
    return lineitem.select("l_orderkey", "l_linenumber", text.digit_stem(name).alias("stem"))


@query("SELECT n_nationkey, 'en:' || lower(n_name) || '|' || 'en:x' AS items, 'a; b' AS free, n_name AS chosen, '&lt;' || n_name || '&gt; &amp; &quot;' AS safe FROM nation", "nation")
def str_lists_and_escapes(nation):
    raw = F.concat(F.lit("['en:"), F.lower("n_name"), F.lit("', 'en:x']"))
    free = F.array_join(text.free_list(F.lit(" a,\n\n;b ;")), "; ")
    safe = text.escape_html(F.concat(F.lit("<"), "n_name", F.lit('> & "')))
    return nation.select("n_nationkey", F.array_join(text.quoted_items(raw), "|").alias("items"), free.alias("free"), text.first_text(F.lit(" "), F.lit(None).cast("string"), F.col("n_name")).alias("chosen"), safe.alias("safe"))


@query(f"SELECT p_partkey, {ID.format('p_name')} AS id FROM part", "part")
def stable_hash_id(part):
    return part.select("p_partkey", text.stable_id("p_name").alias("id"))


@query("SELECT p_partkey, round(ln(1 + p_size), 6) AS feature, CASE WHEN p_size <= 10 THEN 'low' WHEN p_size <= 20 THEN 'medium' ELSE 'high' END AS tier, round(p_retailprice / 3, 2) AS third, CASE p_partkey % 7 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 END AS grade FROM part", "part")
def num_features(part):
    grade = F.get(F.split(F.lit("A, b,c,D,e,ab,-"), ","), F.pmod("p_partkey", F.lit(7)).cast("int"))
    return part.select("p_partkey", F.round(numeric.log_feature("p_size"), 6).alias("feature"), numeric.tier("p_size").alias("tier"), F.round(F.col("p_retailprice") / 3, 2).alias("third"), numeric.grade_value(grade).alias("grade"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 6 = 0 THEN ['x', 'en:y-z'] WHEN c_custkey % 6 = 1 THEN [replace(lower(c_mktsegment), 'e', '-'), 'b c'] WHEN c_custkey % 6 = 2 THEN ['foo bar', 'baz'] WHEN c_custkey % 6 = 3 THEN [trim(c_name), 'salt'] WHEN c_custkey % 6 = 4 THEN ['seul'] WHEN c_custkey % 6 = 5 AND c_custkey % 4 = 1 THEN ['nur'] END, [])::VARCHAR[] AS items FROM customer", "customer")
def str_ingredient_list(customer):
    """Each way that a product's ingredients can be known."""
    n = F.col("c_custkey") % 6
    rows = customer.select(
        "c_custkey",
        F.when(n == 0, F.array(F.lit("x"), F.lit("en:y-z"))).when(n == 3, F.array().cast("array<string>")).alias("ingredients"),
        F.when(n == 2, F.lit("['en:foo-bar', 'fr:baz']")).when(n == 3, F.lit("[]")).alias("ingredients_tags"),
        F.when(n == 3, F.concat(F.lit(" "), "c_name", F.lit(" ;\n salt,, "))).otherwise(F.lit(" ")).alias("ingredients_text"),
        F.when(n == 4, F.lit("seul")).alias("ingredients_text_fr"),
        F.when((n == 5) & (F.col("c_custkey") % 4 == 1), F.lit("nur")).when(n == 4, F.lit("zu spät")).alias("ingredients_text_nl"),
        F.when(n == 1, F.concat(F.replace(F.lower("c_mktsegment"), F.lit("e"), F.lit("-")), F.lit(", b c"))).alias("ingredients_text_it"),
    )
    return rows.select("c_custkey", text.ingredient_list(rows.dtypes).alias("items"))


@query("SELECT p_partkey, url_encode(p_name || ' é&(1)!') AS part, CASE WHEN p_partkey % 5 = 0 THEN '—' ELSE printf('%.2f', floor(p_retailprice / 7 * 100 + 0.5) / 100) || ' g' END AS shown FROM part", "part")
def str_display(part):
    grams = F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice") / 7)
    name = text.url_component(F.concat("p_name", F.lit(" é&(1)!")))
    # DuckDB writes out what a browser leaves as it is.
    for sign, code in (("(", "%28"), (")", "%29"), ("!", "%21")):
        name = F.replace(name, F.lit(sign), F.lit(code))
    return part.select("p_partkey", name.alias("part"), text.display_number(grams, "g").alias("shown"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey BETWEEN 1000 AND 1400", "lineitem")
def sort_range_lookup(lineitem):
    """The table in order of its key, and of that the files that hold some keys."""
    path = f"{shared_folder(lineitem.sparkSession)}/lines-{uuid.uuid4().hex[:8]}"
    sinks.write_sorted(lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), path, ["l_orderkey", "l_linenumber"], files=8)
    return readers.read_range(lineitem.sparkSession, path, 1000, 1400)


@query("SELECT n_nationkey, 'en:' || replace(lower(n_name), ' ', '-') AS tag, length(n_name) <= 3 AS code, upper(n_name) || ', x' AS top, lower(n_name) AS kept, CASE WHEN n_nationkey > 0 THEN 'low' ELSE NULL END AS seen, ['en:a', lower(n_name)] AS listed, 'en ' || replace(lower(n_name), '_', ' ') AS page FROM nation", "nation")
def str_tags(nation):
    name = F.col("n_name")
    return nation.select(
        "n_nationkey", text.to_tag("en", F.concat(F.lit(" "), name)).alias("tag"), text.is_language_code(name).alias("code"),
        text.top_labels(F.array(F.upper(name), F.lit("x"), F.lit("y"))).alias("top"), text.presence(F.lower(text.strip(F.concat(name, F.lit(" "))))).alias("kept"),
        text.presence(F.when(F.col("n_nationkey") > 0, "low").otherwise("")).alias("seen"), text.split_property(F.concat(F.lit("en: en:a, "), name)).alias("listed"),
        text.normalized(F.concat(F.lit("en:"), name), prefix=False).alias("page"),
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN ['en:' || lower(c_mktsegment), 'b''c'] WHEN c_custkey % 4 = 1 THEN ['1', c_name] ELSE [] END::VARCHAR[] AS items FROM customer", "customer")
def array_printed_list(customer):
    """Lists as a program prints them, and texts that are none."""
    kind, tag = F.col("c_custkey") % 4, F.lower("c_mktsegment")
    printed = F.when(kind == 0, F.concat(F.lit("['en:"), tag, F.lit("', \"b'c\"]"))).when(kind == 1, F.concat(F.lit("(1, '"), "c_name", F.lit("')"))).when(kind == 2, F.concat(F.lit("['en:"), tag))
    return customer.select("c_custkey", text.literal_list(printed).alias("items"))


def records(docs: DataFrame, nutrients: str) -> DataFrame:
    """Documents as records of a load, some of which lack something."""
    k = F.col("doc_id")
    return docs.select(
        F.when(k % 11 != 0, F.when(k % 7 != 0, k.cast("string")).otherwise("  ")).alias("code"), F.when(k % 5 != 0, F.col("lang")).alias("product_name"),
        F.when(k % 3 != 0, F.col("source")).alias(nutrients), F.when(k % 13 != 0, F.array("lang")).alias("categories_tags"),
    )


def failed_sql(nutrients: str) -> str:
    tests = {"code_present": "doc_id % 11 = 0", "code_not_blank": "doc_id % 11 = 0 OR doc_id % 7 = 0", "name_present": "doc_id % 5 = 0 OR lang IS NULL", f"{nutrients}_present": "doc_id % 3 = 0 OR source IS NULL", "categories_present": "doc_id % 13 = 0"}
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER ({test}) AS failed FROM documents" for name, test in tests.items())


@query(failed_sql("nutriments"), "documents")
def validate_snapshot_rules(documents):
    return rules.failures(records(documents, "nutriments"), rules.snapshot_rules())


@query(failed_sql("nutrition"), "documents")
def validate_delta_rules(documents):
    return rules.failures(records(documents, "nutrition"), rules.delta_rules())


@query("SELECT o_orderkey::VARCHAR AS code, o_orderstatus AS product_name, o_totalprice::DOUBLE AS ecoscore_score, o_custkey::BIGINT AS ingredients_n, ['x', o_orderpriority] AS categories_tags, NULL::VARCHAR AS brands, NULL::DOUBLE AS fat_100g, NULL::DOUBLE AS salt_100g, 34 AS columns FROM orders", "orders")
def project_conform(orders):
    """All columns of the transformed products, of which some are there, some of another type, and the rest missing."""
    kept = columns.keep_columns("o_orderkey,o_orderstatus|o_clerk,o_totalprice,o_custkey,o_orderpriority")
    rows = orders.select(*[c for c in orders.columns if c in kept])
    tags = F.concat(F.lit('["x","'), "o_orderpriority", F.lit('"]'))
    given = rows.select(F.col("o_orderkey").alias("code"), F.col("o_orderstatus").alias("product_name"), F.col("o_totalprice").cast("string").alias("ecoscore_score"), F.col("o_custkey").cast("string").alias("ingredients_n"), tags.alias("categories_tags"), F.lit("no number").alias("fat_100g"))
    made = columns.conform(given, TRANSFORMED)
    return made.select("code", "product_name", "ecoscore_score", "ingredients_n", "categories_tags", "brands", "fat_100g", "salt_100g", F.lit(len(made.columns)).alias("columns"))


@query("SELECT 'en:' || replace(lower(n_name), '_', '-') AS tag, 'en:' || replace(lower(n_name), '_', '-') AS canonical, CASE WHEN n_nationkey % 2 = 0 THEN replace(lower(r_name), '_', ' ') END AS role FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'fr:n' || n_nationkey, 'en:' || replace(lower(n_name), '_', '-'), NULL FROM nation")
def taxonomy_parse(spark, sf_dir):
    """Nations as additives of a taxonomy's text, whose classes are their regions."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    lines = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.concat(F.lit("# "), "n_nationkey", F.lit("\nsynonyms:en: no, nothing\n< en:above\nen: "), "n_name", F.lit("\nfr: N"), "n_nationkey"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\nadditives_classes: en: en:"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("-")))).otherwise(""),
    ).toDF("n", "block", "classes")
    additives = taxonomy.parse_ingredients("\n\n".join(r["block"] + r["classes"] for r in lines.orderBy("n").collect()))  # a taxonomy is a text of some MB
    classes = taxonomy.parse_ingredients("\n\n".join(f"en: {r['r_name']}" for r in region.collect()))
    roles = spark.createDataFrame(list(taxonomy.additive_roles(additives, classes).items()), "tag string, role string")
    return additives.tags(spark).join(roles, "tag", "left")


# JSON and trees.


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS missing FROM events", "events")
def json_path_extract(events):
    v = nested.parsed("props")
    return events.select("event_id", nested.path(v, "k", kind="long").alias("k"), nested.path(v, "a", "b").alias("missing"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events", "events")
def json_reparse(events):
    raw = F.when(F.col("event_id") % 3 != 0, F.col("props")).otherwise(F.concat(F.lit("{oops "), "props"))
    return events.select("event_id", nested.path(nested.parsed(raw), "k", kind="long").alias("k"))


TREE = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey"


def trees(spark, sf_dir):
    """Orders as products: their lines are ingredients, and each line's supplier is inside of it."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    child = F.array(F.struct(F.concat(F.lit("s:"), "l_suppkey").alias("id")))
    item = F.struct(F.concat(F.lit("P:"), "l_partkey").alias("id"), F.concat(F.lit("_"), "p_name", F.lit("_ ")).alias("text"), child.alias("ingredients"))
    # Sorted by the lines' numbers, which the texts don't hold.
    lists = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("item"))))
    listed = lines.groupBy("l_orderkey").agg(F.to_json(lists["item"]).alias("ingredients")).select(key("l_orderkey").alias("code"), "ingredients")
    return ingredients.normalize_ingredients(listed, taxonomy.Taxonomy({"p:7": "en:seven"}), {"en:seven": "lucky"}, fold=False)


TREE_TAG = "CASE WHEN l_partkey = 7 THEN 'en:seven' ELSE 'p:' || l_partkey END"


@query(f"SELECT DISTINCT l_orderkey::VARCHAR AS code, {ID.format(TREE_TAG)} AS ingredient_id, split_part({TREE_TAG}, ':', 2) AS ingredient_name, pos::INTEGER AS ingredient_order, CASE WHEN l_partkey = 7 THEN 'lucky' END AS role FROM ({TREE})")
def json_tree_flatten_l1(spark, sf_dir):
    return trees(spark, sf_dir)[1]


@query(f"SELECT DISTINCT l_orderkey::VARCHAR AS code, {ID.format(TREE_TAG)} AS ingredient_id, {ID.format(chr(39) + 's:' + chr(39) + ' || l_suppkey')} AS sous_ingredient_id, l_suppkey::VARCHAR AS sous_ingredient_name, 1 AS rang FROM ({TREE})")
def json_tree_flatten_l2(spark, sf_dir):
    return trees(spark, sf_dir)[2]


@query(f"SELECT DISTINCT {ID.format(TREE_TAG)} AS ingredient_id, p_name AS alias_name FROM ({TREE})")
def json_tree_flatten_alias(spark, sf_dir):
    return trees(spark, sf_dir)[3]


@query(f"SELECT DISTINCT {ID.format(TREE_TAG)} AS ingredient_id, split_part({TREE_TAG}, ':', 2) AS ingredient_name FROM ({TREE}) UNION SELECT {ID.format(chr(39) + 's:' + chr(39) + ' || l_suppkey')}, l_suppkey::VARCHAR FROM ({TREE})")
def json_tree_ingredients(spark, sf_dir):
    return trees(spark, sf_dir)[0]


@query("SELECT l_orderkey, round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS a, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS r FROM lineitem GROUP BY 1", "lineitem")
def pivot_metrics(lineitem):
    lists = lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("name")).agg(F.sum("l_quantity").alias("100g")).groupBy("l_orderkey").agg(F.collect_list(F.struct("name", "100g")).alias("n"))
    return lists.select("l_orderkey", *[F.round(nested.field_of("n", "name", f, "100g"), 2).alias(f.lower()) for f in ("A", "R")])


# Tables, upserts, increments.


def own_table(spark: SparkSession, name: str) -> str:
    """A query's table; what earlier calls have left of it goes, but for the version that they returned."""
    table = f"catalyne_{name}"
    sinks.versioned(spark, table).vacuum(keep=1, older_than=0)
    return table


def upserted(rows: DataFrame, batch: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The table after it was made of rows and a batch was upserted."""
    table = own_table(rows.sparkSession, name)
    sinks.replace_table(rows, table, keys)
    sinks.upsert(batch, table, keys)
    return sinks.read_table(rows.sparkSession, table)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < DATE '1998-01-01' AND o_orderkey % 10 <> 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 10 = 0", "orders")
def upsert_single_key(orders):
    rows = orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    batch = rows.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("new").alias("o_orderstatus"))
    return upserted(rows.where("o_orderdate < DATE '1998-01-01'").drop("o_orderdate"), batch, "single_key", ["o_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity > 45) UNION ALL SELECT l_orderkey, l_linenumber, -l_quantity FROM lineitem WHERE l_quantity > 45", "lineitem")
def upsert_composite_key(lineitem):
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    batch = rows.where("l_quantity > 45").withColumn("l_quantity", -F.col("l_quantity"))
    return upserted(rows, batch, "composite_key", ["l_orderkey", "l_linenumber"])


@query("SELECT r_regionkey, CASE WHEN r_regionkey = 1 THEN 'changed' ELSE r_name END AS r_name FROM region", "region")
def ctas_overwrite(region):
    return upserted(region, region.where("r_regionkey = 1").withColumn("r_name", F.lit("changed")), "region", ["r_regionkey"])


@query("SELECT o_orderkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1")
def incremental_checkpoint(spark, sf_dir):
    orders, table = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), own_table(spark, "orders")
    index = orders.select(F.col("o_orderpriority").alias("file")).distinct()
    sinks.replace_table(orders.drop("o_orderpriority").limit(0), table, ["o_orderkey"])

    def step(file: str) -> None:
        sinks.upsert(orders.where(F.col("o_orderpriority") == file).drop("o_orderpriority"), table, ["o_orderkey"])

    checkpoints = f"catalyne_checkpoints_{uuid.uuid4().hex[:8]}"
    incremental.run_pending(spark, index, step, checkpoints)
    if incremental.run_pending(spark, index, step, checkpoints):
        raise AssertionError("files ran twice")
    sinks.drop_table(spark, checkpoints)
    return sinks.read_table(spark, table)


@query("SELECT user_id, event_id, event_type FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 5 DESC, event_id DESC) = 1")
def stream_available_now(spark, sf_dir):
    """Events as five gzipped files of JSON lines, streamed in order of name: of each user, the last event of the last file
    that has any."""
    folder, table = f"{shared_folder(spark)}/events-{uuid.uuid4().hex[:8]}", own_table(spark, "events")
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type").where("user_id is not null")
    lines = events.select(F.concat(F.lit("e"), F.col("event_id") % 5).alias("name"), F.to_json(F.struct("*")).alias("value"))
    lines.write.partitionBy("name").option("compression", "gzip").text(folder)
    sinks.replace_table(events.limit(0), table, ["user_id"])
    index = spark.createDataFrame([(n,) for n in Files(spark, folder).names() if n.startswith("name=")], "file string")

    def step(file: str) -> None:
        rows = readers.read_delta(spark, f"{folder}/{file}", columns="event_id,user_id,event_type")
        batch = rows.select(F.col("event_id").cast("long"), F.col("user_id").cast("long"), "event_type")
        sinks.upsert(batch, table, ["user_id"], dedupe="event_id", mark=("delta", file))

    checkpoint = f"{folder}/_checkpoint"
    if len(incremental.stream_names(spark, index, step, checkpoint)) != index.count() or incremental.stream_names(spark, index, step, checkpoint):
        raise AssertionError("each file is run once")
    Files(spark, folder).delete()
    return sinks.read_table(spark, table)


@query(f"SELECT count(*) AS n FROM ({PARTS_SQL})")
def catalog_count(spark, sf_dir):
    return catalog(spark, sf_dir).products.agg(F.count("*").alias("n"))


@query("SELECT p.p_partkey::VARCHAR AS code, p.p_name AS product_name, coalesce(x.names, '') AS categories FROM part p LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT s_name, '|' ORDER BY s_name) AS names FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) x ON p.p_partkey = x.l_partkey WHERE contains(lower(p_name), 'widget') ORDER BY p_name NULLS LAST, p.p_partkey::VARCHAR LIMIT 50")
def catalog_products_list(spark, sf_dir):
    """Suppliers stand for categories here, so that the lists have many names."""
    c = catalog(spark, sf_dir)
    names = c.ingredients.select(F.col("ingredient_id").alias("category_id"), F.col("ingredient_name").alias("category_name"))
    none = c.products.withColumn("categorie_principale", F.lit(None).cast("long"))
    view = shop.Catalog(none, names, links=c.product_ingredients.select("code", F.col("ingredient_id").alias("category_id")))
    rows = shop.product_list(view, name="Widget", limit=50)
    return rows.select("code", "product_name", F.array_join("categories", "|").alias("categories"))


@query("SELECT p_partkey::VARCHAR AS code, p_name AS product_name, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS categories FROM part WHERE contains(lower(p_brand), 'brand#1') AND contains(lower(p_type), 'econ') AND p_partkey IN (SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE contains(lower(s_name), '0007')) ORDER BY p_name NULLS LAST, code LIMIT 500")
def catalog_all_filters(spark, sf_dir):
    rows = shop.product_list(catalog(spark, sf_dir), brand="brand#1", ingredient="0007", category="Econ")
    return rows.select("code", "product_name", F.array_join("categories", "|").alias("categories"))


@query(f"SELECT n.n_name AS category_name, r.r_name AS parent_name, {CLEAN.format('r.r_name')} || ' > ' || {CLEAN.format('n.n_name')} AS display_label FROM nation n JOIN region r ON n_regionkey = r_regionkey UNION ALL SELECT r_name, NULL, {CLEAN.format('r_name')} FROM region")
def catalog_categories(spark, sf_dir):
    return shop.category_list(places(spark, sf_dir)).select("category_name", "parent_name", "display_label")


@query(f"SELECT c_custkey::VARCHAR AS code, {CLEAN.format('n_name')} AS child, {CLEAN.format('r_name')} AS parent, {CLEAN.format('r_name')} || ' > ' || {CLEAN.format('n_name')} AS display FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey IN (3, 1, 8)")
def catalog_detail(spark, sf_dir):
    rows = shop.details(places(spark, sf_dir), ["3", "1", " 8", "1", "nobody"])
    return rows.select("code", F.explode("categories").alias("c")).select("code", "c.child", "c.parent", "c.display")


@query(f"SELECT p_partkey::VARCHAR AS code, string_agg(DISTINCT {CLEAN.format('s_name')}, '|' ORDER BY {CLEAN.format('s_name')}) AS ingredients FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def catalog_detail_ingredients_all(spark, sf_dir):
    """Every product. Line items are its links as they are; names are listed once each."""
    c = replace(catalog(spark, sf_dir), product_ingredients=line_links(spark, sf_dir))
    rows = shop.details(c, c.products.select("code", F.lit(0).alias("pos"))).where(F.size("ingredients") > 0)
    return rows.select("code", F.array_join("ingredients", "|").alias("ingredients"))


# Search, similarity, comparison.

WEIGHTS = f"""
w AS (SELECT item_id, unnest({TOKENS.format(FOLDED)}) AS token, len({TOKENS.format(FOLDED)}) AS total FROM benchmark), t AS (SELECT item_id, token, total, count(*) AS n FROM w GROUP BY 1, 2, 3), d AS (SELECT token, count(*) AS df FROM t GROUP BY 1),
weights AS (SELECT item_id, t.token, n / total * (ln((1 + (SELECT count(*) FROM benchmark WHERE trim(text) <> '')) / (1 + df)) + 1) AS weight FROM t JOIN d ON t.token = d.token)
"""


@query(f"WITH {WEIGHTS} SELECT item_id, token, round(weight, 6) AS weight FROM weights", "benchmark")
def tfidf_vectors_folded(benchmark):
    """Every item, with accents folded."""
    return similarity.term_weights(benchmark, "item_id").withColumn("weight", F.round("weight", 6))


@query(f"WITH {WEIGHTS}, b AS (SELECT token, weight FROM weights WHERE item_id = 0), n AS (SELECT item_id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY 1) SELECT i.item_id, round(coalesce(x.dot / (n.norm * (SELECT norm FROM n WHERE item_id = 0)), 0), 6) AS text_similarity FROM benchmark i LEFT JOIN n ON i.item_id = n.item_id LEFT JOIN (SELECT item_id, sum(weights.weight * b.weight) AS dot FROM weights JOIN b ON weights.token = b.token GROUP BY 1) x ON i.item_id = x.item_id WHERE i.item_id <> 0", "benchmark")
def tfidf_cosine_folded(benchmark):
    """Every item, with accents folded."""
    return similarity.text_scores(benchmark, 0, "item_id").withColumn("text_similarity", F.round("text_similarity", 6))


VECTORS = "SELECT v.vec_id, v.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b FROM embeddings v, (SELECT * FROM embeddings WHERE vec_id = 1) b"


def with_base(embeddings):
    return embeddings.crossJoin(F.broadcast(embeddings.where("vec_id = 1").select(F.col("embedding").alias("base"))))


@query(f"SELECT vec_id, round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS score FROM ({VECTORS})", "embeddings")
def vector_cosine(embeddings):
    return with_base(embeddings).select("vec_id", F.round(numeric.cosine("embedding", "base"), 6).alias("score"))


@query(f"SELECT vec_id, round(greatest(0, 1 - list_distance(a, b) / (sqrt(list_dot_product(a, a)) + sqrt(list_dot_product(b, b)))), 6) AS score FROM ({VECTORS})", "embeddings")
def vector_euclidean(embeddings):
    return with_base(embeddings).select("vec_id", F.round(numeric.euclidean_similarity("embedding", "base"), 6).alias("score"))


@query("SELECT c_custkey::VARCHAR AS code, CASE WHEN c_nationkey = b.n THEN 1.0 WHEN n_regionkey = b.r THEN 0.7 ELSE 0.0 END::DOUBLE AS score FROM customer JOIN nation ON c_nationkey = n_nationkey, (SELECT c_nationkey AS n, n_regionkey AS r FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 5) b")
def similar_hierarchy_score(spark, sf_dir):
    c = places(spark, sf_dir)
    context = similarity.hierarchy_context(c, c.products.select("code"), fold=False)
    base = F.broadcast(context.where("code = '5'").select(F.col("context").alias("base")))
    return context.crossJoin(base).select("code", similarity.hierarchy_score("context", "base").alias("score"))


BLEND = f"""
WITH p AS ({PARTS_SQL}), base AS (SELECT * FROM p WHERE brands = 'Brand#2' ORDER BY p_partkey LIMIT 1),
v AS (SELECT code, [ln(1 + coalesce(sugars_100g, 0)), ln(1 + carbohydrates_100g), ln(1 + fat_100g), ln(1 + coalesce(proteins_100g, 0)), ln(1 + salt_100g), ln(1 + coalesce(fiber_100g, 0)), coalesce(CASE nutriscore_grade WHEN 'a' THEN 5 WHEN 'b' THEN 4 WHEN 'c' THEN 3 WHEN 'd' THEN 2 WHEN 'e' THEN 1 END, 0) / 5.0]::DOUBLE[] AS x FROM p)
"""


@query(f"{BLEND} SELECT v.code, round(greatest(0, 1 - list_distance(v.x, b.x) / (sqrt(list_dot_product(v.x, v.x)) + sqrt(list_dot_product(b.x, b.x)))), 6) AS score FROM v, (SELECT x FROM v WHERE code = (SELECT code FROM base)) b")
def similar_nutrition_all(spark, sf_dir):
    """Every part against the same base."""
    p = parts(spark, sf_dir).withColumn("x", similarity.nutrition_vector())
    base = F.broadcast(p.where("brands = 'Brand#2'").orderBy("p_partkey").limit(1).select(F.col("x").alias("b")))
    return p.crossJoin(base).select("code", F.round(numeric.euclidean_similarity("x", "b"), 6).alias("score"))


def listed_sql(n: int, test: str) -> str:
    return f"SELECT * FROM (SELECT {n} AS list, row_number() OVER (ORDER BY o.product_name NULLS LAST, o.code) AS place, o.code FROM p o, base b WHERE {test}) WHERE place <= 60"


SIMILAR = f"""
{BLEND.replace("base AS (SELECT * FROM p WHERE brands = 'Brand#2' ORDER BY p_partkey LIMIT 1)", f"base AS (SELECT p.*, {CLEAN.format('p_type')} AS label, array_to_string(({TOKENS.format(NORM.format('product_name'))})[1:2], ' ') AS words FROM p WHERE code = '12')")},
lists AS ({listed_sql(0, "contains(lower(o.p_type), replace(lower(b.label), ' ', '-'))")} UNION ALL {listed_sql(1, "contains(lower(o.product_name), b.words)")} UNION ALL {listed_sql(2, "contains(lower(o.brands), lower(trim(b.brands)))")}),
pool AS (SELECT code FROM (SELECT code, min(list * 1000 + place) AS first FROM lists WHERE code <> '12' GROUP BY code) ORDER BY first LIMIT 60),
parts AS (SELECT l_partkey::VARCHAR AS code, {CLEAN.format('s_name')} AS label, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey),
texts AS (SELECT p.code, p.product_name, {CLEAN.format('p_type')} AS label, 'Nom: ' || p.product_name || chr(10) || 'Categorie: ' || {CLEAN.format('p_type')} || coalesce(chr(10) || 'Ingredients: ' || x.named, '') AS text
  FROM p LEFT JOIN (SELECT code, string_agg(label, ', ' ORDER BY n) AS named FROM parts WHERE n <= 8 GROUP BY 1) x USING (code) WHERE p.code = '12' OR p.code IN (SELECT code FROM pool)),
split AS (SELECT code, {TOKENS.format(NORM.format('text'))} AS t FROM texts),
t AS (SELECT code, token, total, count(*) AS n FROM (SELECT code, unnest(t) AS token, len(t) AS total FROM split) GROUP BY 1, 2, 3),
d AS (SELECT token, count(*) AS df FROM t GROUP BY 1),
weights AS (SELECT code, t.token, n / total * (ln((1 + (SELECT count(*) FROM texts)) / (1 + df)) + 1) AS weight FROM t JOIN d ON t.token = d.token),
norms AS (SELECT code, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY 1),
dots AS (SELECT w.code, sum(w.weight * b.weight) AS dot FROM weights w JOIN weights b ON w.token = b.token WHERE b.code = '12' GROUP BY 1),
scores AS (SELECT x.code, x.product_name, x.label AS category_label, coalesce(dot / (norm * (SELECT norm FROM norms WHERE code = '12')), 0) AS ts,
    greatest(0, 1 - list_distance(v.x, bv.x) / (sqrt(list_dot_product(v.x, v.x)) + sqrt(list_dot_product(bv.x, bv.x)))) AS ns, CASE WHEN x.label = base.label THEN 1.0 ELSE 0.0 END::DOUBLE AS cs
  FROM texts x JOIN v USING (code), base, (SELECT x FROM v WHERE code = '12') bv LEFT JOIN norms ON norms.code = x.code LEFT JOIN dots ON dots.code = x.code WHERE x.code <> '12')
SELECT code, product_name, category_label, round((ts + ns + cs) / 3, 4) AS similarity_score, round((ts + ns + cs) / 3 * 100)::INTEGER AS overall_similarity_pct,
  round(ts * 100)::INTEGER AS text_similarity_pct, round(ns * 100)::INTEGER AS nutrition_similarity_pct, round(cs * 100)::INTEGER AS category_similarity_pct
FROM scores ORDER BY similarity_score DESC, product_name, code LIMIT 12
"""


@query(SIMILAR)
def similar_products(spark, sf_dir):
    """One product against a pool of sixty, which shares its category, its words or its brand."""
    rows = similarity.similar_products(catalog(spark, sf_dir), "12", limit=12, pool=60, fold=False)
    return rows.select("code", "product_name", "category_label", "similarity_score", "overall_similarity_pct", "text_similarity_pct", "nutrition_similarity_pct", "category_similarity_pct")



def pool_sql(n: int, test: str) -> str:
    return f"SELECT * FROM (SELECT {n} AS list, row_number() OVER (PARTITION BY b.code ORDER BY o.product_name NULLS LAST, o.code) AS place, b.code AS base, o.code FROM p o, base b WHERE {test}) WHERE place <= 20"


#: As SIMILAR, with every part as a base.
SIMILAR_ALL = f"""
{BLEND.replace("base AS (SELECT * FROM p WHERE brands = 'Brand#2' ORDER BY p_partkey LIMIT 1)", f"base AS (SELECT p.*, {CLEAN.format('p_type')} AS label, array_to_string(({TOKENS.format(NORM.format('product_name'))})[1:2], ' ') AS words FROM p)")},
lists AS ({pool_sql(0, "contains(lower(o.p_type), replace(lower(b.label), ' ', '-'))")} UNION ALL {pool_sql(1, "b.words <> '' AND contains(lower(o.product_name), b.words)")} UNION ALL {pool_sql(2, "trim(b.brands) <> '' AND contains(lower(o.brands), lower(trim(b.brands)))")}),
pool AS (SELECT base, code FROM (SELECT base, code, min(list * 1000 + place) AS first FROM lists WHERE code <> base GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY base ORDER BY first) <= 20 UNION ALL SELECT code, code FROM base),
parts AS (SELECT l_partkey::VARCHAR AS code, {CLEAN.format('s_name')} AS label, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey),
texts AS (SELECT p.code, p.product_name, {CLEAN.format('p_type')} AS label, 'Nom: ' || p.product_name || chr(10) || 'Categorie: ' || {CLEAN.format('p_type')} || coalesce(chr(10) || 'Ingredients: ' || x.named, '') AS text
  FROM p LEFT JOIN (SELECT code, string_agg(label, ', ' ORDER BY n) AS named FROM parts WHERE n <= 8 GROUP BY 1) x USING (code)),
split AS (SELECT code, {TOKENS.format(NORM.format('text'))} AS t FROM texts),
t AS (SELECT code, token, total, count(*) AS n FROM (SELECT code, unnest(t) AS token, len(t) AS total FROM split) GROUP BY 1, 2, 3),
each AS (SELECT base, t.* FROM pool JOIN t USING (code)),
d AS (SELECT base, token, count(*) AS df FROM each GROUP BY 1, 2),
docs AS (SELECT base, count(*) AS docs FROM pool GROUP BY 1),
weights AS (SELECT e.base, e.code, e.token, n / total * (ln((1 + docs) / (1 + df)) + 1) AS weight FROM each e JOIN d ON e.base = d.base AND e.token = d.token JOIN docs ON e.base = docs.base),
norms AS (SELECT base, code, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY 1, 2),
dots AS (SELECT w.base, w.code, sum(w.weight * b.weight) AS dot FROM weights w JOIN weights b ON w.token = b.token AND w.base = b.base AND b.code = b.base GROUP BY 1, 2),
scores AS (SELECT q.base, x.code, x.product_name, coalesce(dot / (n.norm * m.norm), 0) AS ts,
    greatest(0, 1 - list_distance(v.x, bv.x) / (sqrt(list_dot_product(v.x, v.x)) + sqrt(list_dot_product(bv.x, bv.x)))) AS ns, CASE WHEN x.label = y.label THEN 1.0 ELSE 0.0 END::DOUBLE AS cs
  FROM pool q JOIN texts x ON x.code = q.code JOIN v ON v.code = q.code JOIN v bv ON bv.code = q.base JOIN texts y ON y.code = q.base
    LEFT JOIN norms n ON n.base = q.base AND n.code = q.code LEFT JOIN norms m ON m.base = q.base AND m.code = q.base LEFT JOIN dots ON dots.base = q.base AND dots.code = q.code WHERE q.code <> q.base),
best AS (SELECT base, code, round((ts + ns + cs) / 3, 4) AS similarity_score, row_number() OVER (PARTITION BY base ORDER BY round((ts + ns + cs) / 3, 4) DESC, product_name, code) AS rank FROM scores)
SELECT base, rank::INTEGER AS rank, code, similarity_score FROM best WHERE rank <= 4
"""


@query(SIMILAR_ALL)
def similar_products_all(spark, sf_dir):
    """Every part against a pool of twenty of its own, in one plan."""
    c = catalog(spark, sf_dir)
    return similarity.similar_to(c, c.products, fold=False).select("base", "rank", "code", "similarity_score")

FIELD = "CASE WHEN f = 'red widget' THEN 1.0 WHEN contains(f, 'red widget') OR replace(f, ' ', '') = 'redwidget' THEN 0.95 WHEN contains(replace(f, ' ', ''), 'redwidget') THEN 0.9 WHEN share >= 1 THEN 0.9 ELSE share END"


@query(f"SELECT code, round({FIELD}, 6) AS score FROM (SELECT p_partkey::VARCHAR AS code, p_name AS f, len(list_intersect(list_distinct(str_split(p_name, ' ')), ['red', 'widget'])) / 2 AS share FROM part)")
def search_full_text(spark, sf_dir):
    docs = search.documents(parts(spark, sf_dir), fold=False)
    norm, words = search.query_forms(docs, "Red-Widget")
    return docs.select("code", F.round(search.field_score(norm, words, "name_norm", "name_tokens"), 6).alias("score"))


SCORED = f"SELECT code, product_name, ({FIELD})::DOUBLE AS name_score FROM (SELECT p_partkey::VARCHAR AS code, p_name AS product_name, p_name AS f, len(list_intersect(list_distinct(str_split(p_name, ' ')), ['red', 'widget'])) / 2 AS share FROM part)"


@query(f"SELECT code, product_name, round(name_score, 6) AS search_score FROM (SELECT * FROM ({SCORED}) ORDER BY name_score DESC, code LIMIT 100)")
def search_two_phase(spark, sf_dir):
    rows = search.search(parts(spark, sf_dir), "red widget", fold=False)
    return rows.select("code", "product_name", F.round("search_score", 6).alias("search_score"))


@query()
def search_fuzzy(spark, sf_dir):
    """Rows only: SQL has no such ratio."""
    return search.search(parts(spark, sf_dir), "wdget rde", limit=20, fold=False).select("code", "product_name", "fuzzy_score", "search_score_pct")


@query(f"{LONG} SELECT l.p_type, l.code, l.metric, (CASE WHEN value IS NULL THEN 0 WHEN hi = lo THEN 50 ELSE floor(CASE WHEN l.metric = 'proteins_100g' THEN (value - lo) / (hi - lo) * 100 ELSE 100 - (value - lo) / (hi - lo) * 100 END + 0.5) END)::INTEGER AS points FROM long l JOIN stat s ON l.p_type = s.p_type AND l.metric = s.metric")
def compare_radar(spark, sf_dir):
    return compare.radar(parts(spark, sf_dir), by=["p_type"])


@query(f"WITH p AS ({PARTS_SQL}), x AS (SELECT 0 AS n, 'proteins_100g' AS metric, product_name, proteins_100g AS value FROM p WHERE proteins_100g > 0 QUALIFY row_number() OVER (ORDER BY proteins_100g DESC, code) = 1 UNION ALL SELECT 1, 'energy_kcal_100g', product_name, energy_kcal_100g FROM p QUALIFY row_number() OVER (ORDER BY energy_kcal_100g, code) = 1 UNION ALL SELECT 2, 'sugars_100g', product_name, sugars_100g FROM p WHERE sugars_100g > 10 QUALIFY row_number() OVER (ORDER BY sugars_100g DESC, code) = 1 UNION ALL SELECT 3, 'fiber_100g', product_name, fiber_100g FROM p WHERE fiber_100g > 2 QUALIFY row_number() OVER (ORDER BY fiber_100g DESC, code) = 1) SELECT n, metric, product_name, round(value, 6) AS value FROM x")
def agg_insights_argmax(spark, sf_dir):
    return compare.insights(parts(spark, sf_dir)).select("n", "metric", "product_name", F.round("value", 6).alias("value"))
