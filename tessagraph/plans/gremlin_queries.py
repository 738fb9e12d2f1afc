"""Queries with the traversal builder on the graph of the tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.graph import graph_of_tables
from tessagraph.operators.gremlin import P, Source
from tessagraph.operators.gremlin import anonymous as __
from tessagraph.operators.query_text import check_texts, run_text
from tessagraph.plans.graph_sql import E, V
from tessagraph.session import table


def _g(spark: SparkSession, d: str) -> Source:
    return Source(graph_of_tables(spark, d))


def g_has_values(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).V().has("company", "industry", P.within("Energy", "Media")).has("establishmentYear", P.between(1960, 1980)).values("name").to_df()


def g_containing(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).V().hasLabel("person").has("name", P.containing("an")).has("age", P.lt(40)).id().to_df()


def g_out_in_both(spark: SparkSession, d: str) -> DataFrame:
    """Bag of vertices reached from vertices of one city, three ways, counted per way and label."""
    start = _g(spark, d).V().hasLabel("person").has("city", P.starting_with("Port"))
    parts = [t.groupCount("label").withColumn("way", F.lit(w)) for w, t in (("out", start.out("serve", "created")), ("in", start.in_("knows")), ("both", start.both("partners")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def g_edge_ends(spark: SparkSession, d: str) -> DataFrame:
    """Holders of more than 60 % of a company, by edge and its other end."""
    t = _g(spark, d).V().has("company", "industry", "Energy").as_("c").inE("personInvest", "companyInvest").has("shareholdingRatio", P.gt(60.0)).as_("e").otherV().as_("h")
    return t.to_df("c", "e", "h")


def g_project(spark: SparkSession, d: str) -> DataFrame:
    """Companies with their number of staff, investors and branch names."""
    t = _g(spark, d).V().has("company", "industry", "Travel").project(id="id", year="establishmentYear", staff=__.in_("serve").count(), investors=__.in_("personInvest").id().fold(), branch=__.out("branch").values("name"))
    return t.to_df().withColumn("investors", F.array_join("investors", ","))


def g_where(spark: SparkSession, d: str) -> DataFrame:
    """Persons who serve a company and invest in it."""
    return _g(spark, d).V().hasLabel("person").where(__.out("created")).not_(__.out("knows")).id().to_df()


def g_where_tags(spark: SparkSession, d: str) -> DataFrame:
    """Other creators of one's software, each once."""
    return _g(spark, d).V().hasLabel("person").has("age", P.gt(60)).as_("a").out("created").in_("created").where_neq("a").dedup().id().to_df()


def g_match(spark: SparkSession, d: str) -> DataFrame:
    """Persons a who know b, both creators of one software c."""
    t = _g(spark, d).V().hasLabel("person").match(("a", __.out("knows"), "b"), ("a", __.out("created"), "c"), ("b", __.out("created"), "c"))
    return t.to_df("a", "b", "c")


def g_order_limit(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).V().hasLabel("software").has("price").order("price", desc=True).limit(10).valueMap("name", "price", unfold=True).to_df().select(F.col("value.name").alias("name"), F.col("value.price").alias("price"))


def g_fold_unfold(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).V().hasLabel("book").values("price").dedup().fold().unfold().to_df()


def g_count_none(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).V().hasLabel("unicorn").count().to_df()


def g_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """A person's software, else the company served, else a constant."""
    t = _g(spark, d).V().hasLabel("person").has("age", P.between(30, 33)).coalesce(__.out("created").id(), __.out("serve").id(), __.constant("none"))
    return t.to_df()


def g_repeat_emit(spark: SparkSession, d: str) -> DataFrame:
    """Paths upward in the departments, up to three steps."""
    t = _g(spark, d).V().hasLabel("department").repeat(__.out("reports_to"), times=3, emit=True).simplePath().path()
    return t.to_df().select(F.array_join("value", ">").alias("path"))


def g_edges_values(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).E().hasLabel("partners").has("weight", P.gte(0.9)).project(id="id", src="src", dst="dst", weight="weight").to_df()


def g_default_limit(spark: SparkSession, d: str) -> DataFrame:
    """A traversal without its own limit is cut at 100."""
    return Source(graph_of_tables(spark, d), default_limit=100).V().hasLabel("company").id().to_df()


def g_drop(spark: SparkSession, d: str) -> DataFrame:
    """What remains without cheap software and its edges."""
    left = _g(spark, d).V().hasLabel("software").has("price", P.lt(100)).drop()
    return left.edges.groupBy("label").agg(F.count("*").alias("edges"))


def g_value_maps(spark: SparkSession, d: str) -> DataFrame:
    t = _g(spark, d).V().hasLabel("department").valueMap("name", "headcount", "floor").to_df()
    return t.select(F.array_join(F.transform(F.array_sort(F.map_entries("value")), lambda x: F.concat(x.key, F.lit("="), F.array_join(x.value, "|"))), ";").alias("value"))


def _text(spark: SparkSession, d: str, query: str) -> DataFrame:
    return run_text(graph_of_tables(spark, d), query, None)


def g_text_staff(spark: SparkSession, d: str) -> DataFrame:
    return _text(spark, d, "g.V().has('company','industry','Energy').as('c').in('serve').has('age', gt(60)).where(out('created')).dedup().values('name')")


def g_text_order(spark: SparkSession, d: str) -> DataFrame:
    x = _text(spark, d, "g.V().hasLabel('software').has('price', between(20, 300)).order().by('price', desc).limit(10).valueMap('name','price').toList()")
    return x.select(F.col("value.name")[0].alias("name"), F.col("value.price")[0].alias("price"))


def g_text_project(spark: SparkSession, d: str) -> DataFrame:
    x = _text(spark, d, "g.V().has('company','industry','Travel').as('a').project('id','staff','investors').by(id).by(select('a').in('serve').count()).by(select('a').in('personInvest').id().fold());")
    return x.withColumn("investors", F.array_join("investors", ","))


def g_text_paths(spark: SparkSession, d: str) -> DataFrame:
    """Names along branches, and the labels of the edges between them."""
    x = _text(spark, d, "g.V().has('company','industry','Travel').outE('branch').inV().path().by('name').by('label')")
    return x.select(F.array_join("value", ">", "-").alias("path"))


def g_text_other_ends(spark: SparkSession, d: str) -> DataFrame:
    return _text(spark, d, "g.V().has('company','industry','Energy').as('a').bothE('companyInvest').has('shareholdingRatio', gte(50)).where(otherV().hasLabel('company')).otherV().where(neq('a')).groupCount().by('industry')")


def g_text_bag(spark: SparkSession, d: str) -> DataFrame:
    """How many departments there are, beside the ids of all."""
    x = _text(spark, d, "g.V().hasLabel('department').aggregate('ids').count().as('count').select('count','ids')")
    return x.withColumn("ids", F.array_join("ids", ","))


def g_text_limit(spark: SparkSession, d: str) -> DataFrame:
    """A text without a limit gets one of 100."""
    return run_text(graph_of_tables(spark, d), "g.V().hasLabel('person').not(out('knows')).id()")


def g_text_readable(spark: SparkSession, d: str) -> DataFrame:
    """Whether the answers of all pairs can be read as traversals, by source."""
    x = check_texts(table(spark, d, "gremlin_pairs").select("source", "gremlin"), "gremlin")
    return x.groupBy("source", F.col("problem").isNull().alias("readable")).agg(F.count("*").alias("pairs"))


QUERIES = {f.__name__: f for f in (
    g_text_staff, g_text_order, g_text_project, g_text_paths, g_text_other_ends, g_text_bag, g_text_limit, g_text_readable,
    g_has_values, g_containing, g_out_in_both, g_edge_ends, g_project, g_where, g_where_tags, g_match, g_order_limit, g_fold_unfold, g_count_none, g_coalesce, g_repeat_emit, g_edges_values, g_default_limit, g_drop, g_value_maps,
)}
_E, _V = "WITH RECURSIVE " + E + " ", "WITH " + V + " "
SQL = {
    "g_text_staff": _E + "SELECT value FROM (SELECT DISTINCT p.id, p.name AS value FROM v c JOIN e ON e.dst = c.id AND e.label = 'serve' JOIN v p ON p.id = e.src WHERE c.label = 'company' AND c.industry = 'Energy' AND p.age > 60 AND p.id IN (SELECT src FROM e WHERE label = 'created')) WHERE value IS NOT NULL",
    "g_text_order": _V + "SELECT name, CAST(price AS VARCHAR) AS price FROM v WHERE label = 'software' AND price >= 20 AND price < 300 ORDER BY v.price DESC, id LIMIT 10",
    "g_text_project": _E + "SELECT v.id, (SELECT count(*) FROM e WHERE dst = v.id AND label = 'serve') AS staff, (SELECT coalesce(string_agg(src, ',' ORDER BY src), '') FROM e WHERE dst = v.id AND label = 'personInvest') AS investors FROM v WHERE label = 'company' AND industry = 'Travel'",
    "g_text_paths": _E + "SELECT coalesce(a.name, '-') || '>branch>' || coalesce(b.name, '-') AS path FROM v a JOIN e ON e.src = a.id AND e.label = 'branch' JOIN v b ON b.id = e.dst WHERE a.label = 'company' AND a.industry = 'Travel'",
    "g_text_other_ends": _E + ", m AS (SELECT src AS a, dst AS b FROM e WHERE label = 'companyInvest' AND shareholdingRatio >= 50 UNION ALL SELECT dst, src FROM e WHERE label = 'companyInvest' AND shareholdingRatio >= 50) SELECT b.industry, count(*) AS count FROM m JOIN v a ON a.id = m.a AND a.label = 'company' AND a.industry = 'Energy' JOIN v b ON b.id = m.b AND b.label = 'company' WHERE m.a <> m.b GROUP BY b.industry",
    "g_text_bag": _V + "SELECT count(*) AS count, string_agg(id, ',' ORDER BY id) AS ids FROM v WHERE label = 'department'",
    "g_text_limit": _E + "SELECT id AS value FROM v WHERE label = 'person' AND id NOT IN (SELECT src FROM e WHERE label = 'knows') ORDER BY id LIMIT 100",
    "g_has_values": _V + "SELECT name AS value FROM v WHERE label = 'company' AND industry IN ('Energy', 'Media') AND establishmentYear >= 1960 AND establishmentYear < 1980 AND name IS NOT NULL",
    "g_containing": _V + "SELECT id AS value FROM v WHERE label = 'person' AND contains(name, 'an') AND age < 40",
    "g_out_in_both": _E + ", p AS (SELECT id FROM v WHERE label = 'person' AND starts_with(city, 'Port')), m AS (SELECT 'out' AS way, dst AS id FROM p JOIN e ON src = p.id AND e.label IN ('serve', 'created') UNION ALL SELECT 'in', src FROM p JOIN e ON dst = p.id AND e.label = 'knows' UNION ALL SELECT 'both', dst FROM p JOIN e ON src = p.id AND e.label = 'partners' UNION ALL SELECT 'both', src FROM p JOIN e ON dst = p.id AND e.label = 'partners') SELECT label, count(*) AS count, way FROM m JOIN v USING (id) GROUP BY label, way",
    "g_edge_ends": _E + "SELECT v.id AS c, e.id AS e, src AS h FROM e JOIN v ON v.id = dst AND v.label = 'company' AND industry = 'Energy' WHERE e.label IN ('personInvest', 'companyInvest') AND shareholdingRatio > 60",
    "g_project": _E + "SELECT v.id, establishmentYear AS year, (SELECT count(*) FROM e WHERE dst = v.id AND label = 'serve') AS staff, (SELECT coalesce(string_agg(src, ',' ORDER BY src), '') FROM e WHERE dst = v.id AND label = 'personInvest') AS investors, (SELECT min(b.name) FROM e JOIN v b ON b.id = e.dst WHERE src = v.id AND e.label = 'branch') AS branch FROM v WHERE label = 'company' AND industry = 'Travel'",
    "g_where": _E + "SELECT id AS value FROM v WHERE label = 'person' AND id IN (SELECT src FROM e WHERE label = 'created') AND id NOT IN (SELECT src FROM e WHERE label = 'knows')",
    "g_where_tags": _E + "SELECT DISTINCT b.src AS value FROM v JOIN e a ON a.src = v.id AND a.label = 'created' JOIN e b ON b.dst = a.dst AND b.label = 'created' AND b.src <> a.src WHERE v.label = 'person' AND age > 60",
    "g_match": _E + "SELECT k.src AS a, k.dst AS b, x.dst AS c FROM e k JOIN e x ON x.src = k.src AND x.label = 'created' JOIN e y ON y.src = k.dst AND y.dst = x.dst AND y.label = 'created' WHERE k.label = 'knows'",
    "g_order_limit": _V + "SELECT name, CAST(price AS VARCHAR) AS price FROM v WHERE label = 'software' AND price IS NOT NULL ORDER BY v.price DESC, id LIMIT 10",
    "g_fold_unfold": _V + "SELECT DISTINCT price AS value FROM v WHERE label = 'book' AND price IS NOT NULL",
    "g_count_none": _V + "SELECT count(*) AS value FROM v WHERE label = 'unicorn'",
    "g_coalesce": _E + ", p AS (SELECT id FROM v WHERE label = 'person' AND age >= 30 AND age < 33), c AS (SELECT src, dst FROM e WHERE label = 'created'), w AS (SELECT src, dst FROM e WHERE label = 'serve' AND src NOT IN (SELECT src FROM c)) SELECT coalesce(c.dst, w.dst, 'none') AS value FROM p LEFT JOIN c ON c.src = p.id LEFT JOIN w ON w.src = p.id",
    "g_repeat_emit": _E + ", r(p, n) AS (SELECT [id], id FROM v WHERE label = 'department' UNION ALL SELECT list_append(p, dst), dst FROM r JOIN e ON src = n AND e.label = 'reports_to' WHERE len(p) <= 3) SELECT array_to_string(p, '>') AS path FROM r WHERE len(p) > 1 AND len(list_distinct(p)) = len(p)",
    "g_edges_values": _E + "SELECT id, src, dst, weight FROM e WHERE label = 'partners' AND weight >= 0.9",
    "g_default_limit": _V + "SELECT id AS value FROM v WHERE label = 'company' ORDER BY id LIMIT 100",
    "g_drop": _E + ", gone AS (SELECT id FROM v WHERE label = 'software' AND price < 100) SELECT label, count(*) AS edges FROM e WHERE src NOT IN (FROM gone) AND dst NOT IN (FROM gone) GROUP BY label",
    "g_value_maps": _V + "SELECT concat_ws(';', 'floor=' || floor, 'headcount=' || headcount, 'name=' || name) AS value FROM v WHERE label = 'department'",
}
