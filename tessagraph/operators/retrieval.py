"""Retrieval for answers: matching vertices, expanding their surroundings, text of paths, merging and reranking.

Everything is keyed by `q`, the number of a question, so that a table of questions is one job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.functions.text import bleu, tokens
from tessagraph.graph import PropertyGraph, union_all
from tessagraph.session import checkpoint


def exact_matches(keywords: DataFrame, vertices: DataFrame, labels: int, limit: int = 8) -> tuple[DataFrame, DataFrame]:
    """(matches (q, keyword, id), unmatched (q, keyword)) of keywords (q, keyword).

    A keyword matches a vertex whose id is the keyword, or a label id 1..labels, a colon and the keyword; at most `limit` ids per
    question, the smallest. A keyword that occurs in a matched id of its question is not unmatched.
    """
    ids = F.array(F.col("keyword"), *[F.concat(F.lit(f"{i}:"), "keyword") for i in range(1, labels + 1)])
    hits = keywords.withColumn("id", F.explode(ids)).join(vertices.select("id"), "id", "left_semi")
    hits = hits.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("id", "keyword"))).filter(F.col("r") <= limit).select("q", "keyword", "id")
    k, h = keywords.alias("k"), hits.alias("h")
    left = k.join(h, (F.col("k.q") == F.col("h.q")) & F.contains(F.col("h.id"), F.col("k.keyword")), "left_anti")
    return hits, left


def fuzzy_matches(keyword_vectors: DataFrame, id_vectors: DataFrame, k: int = 1, threshold: float = 0.9) -> DataFrame:
    """(query, id, distance): the nearest ids of each keyword's vector below the threshold, exactly and in blocks."""
    from tessagraph.operators.vectors import search_many

    return search_many(id_vectors, "id", "vec", keyword_vectors, "query", k, threshold)


def element_text(id_col: Column, props: Column) -> Column:
    """id{k: v, ...} with keys in order; empty properties leave the id."""
    inner = F.array_join(F.transform(F.array_sort(F.map_entries(props)), lambda x: F.concat(x.key, F.lit(": "), x.value)), ", ")
    return F.when(inner == "", id_col.cast("string")).otherwise(F.concat(id_col.cast("string"), F.lit("{"), inner, F.lit("}")))


def property_map(df: DataFrame, skip: Sequence[str] = ("id", "label", "src", "dst")) -> Column:
    """Map of the other columns that aren't null, as text."""
    pairs = [x for c in df.columns if c not in skip for x in (F.lit(c), F.col(c).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def expand(g: PropertyGraph, starts: DataFrame, depth: int = 2, per_step: int = 40, max_paths: int = 30) -> DataFrame:
    """(q, path_no, start, path): paths of 1..depth edges from starts (q, id), in either direction.

    path is an array of struct (vertex, edge, back): `edge` led to the vertex, `back` against its direction. Each vertex of a path is
    new to it; at most per_step edges leave a path's end, and max_paths paths a start, shorter ones first, then by their ids.
    """
    e = g.edges.select("id", "src", "dst")
    adj = e.select("src", "dst", "id", F.lit(False).alias("back")).unionByName(e.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "id", F.lit(True).alias("back")))
    adj = checkpoint(adj.withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy("id", "back"))).filter(F.col("r") <= per_step).drop("r"))
    node = lambda v, e_, b: F.struct(v.alias("vertex"), e_.cast("bigint").alias("edge"), b.alias("back"))
    p = starts.select("q", F.col("id").alias("start")).distinct().withColumn("path", F.array(node(F.col("start"), F.lit(None), F.lit(None).cast("boolean"))))
    out = []
    for _ in range(depth):
        p = p.withColumn("src", F.element_at("path", -1).vertex).join(adj, "src").filter(~F.exists("path", lambda x: x.vertex == F.col("dst")))
        p = checkpoint(p.select("q", "start", F.concat("path", F.array(node(F.col("dst"), F.col("id"), F.col("back")))).alias("path")))
        out.append(p)
    order = Window.partitionBy("q", "start").orderBy(F.size("path"), F.transform("path", lambda x: x.vertex), F.transform("path", lambda x: x.edge))
    return union_all(out).withColumn("path_no", F.row_number().over(order)).filter(F.col("path_no") <= max_paths).select("q", "start", "path_no", "path")


def path_texts(g: PropertyGraph, paths: DataFrame) -> DataFrame:
    """(q, start, path_no, text): a{k: v}--[label{..}]-->b<--[label]--c; properties stand at an element's first place per question.

    First is by start, path number and place. Elements that are gone from the graph stand with their id alone.
    """
    x = paths.select("q", "start", "path_no", F.posexplode("path").alias("pos", "n")).select("q", "start", "path_no", "pos", "n.*")
    v = g.vertices.select(F.col("id").alias("vertex"), property_map(g.vertices).alias("vp"))
    e = g.edges.select(F.col("id").alias("edge"), F.col("label").alias("elabel"), property_map(g.edges).alias("ep"))
    x = x.join(v, "vertex", "left").join(e, "edge", "left")
    first = lambda c: F.row_number().over(Window.partitionBy("q", c).orderBy("start", "path_no", "pos")) == 1
    none = F.create_map().cast("map<string,string>")
    x = x.withColumns({"fv": first("vertex"), "fe": first("edge")})
    vertex = element_text(F.col("vertex"), F.when(F.col("fv"), F.coalesce("vp", none)).otherwise(none))
    edge = element_text(F.coalesce("elabel", F.lit("")), F.when(F.col("fe"), F.coalesce("ep", none)).otherwise(none))
    part = F.when(F.col("edge").isNull(), vertex).otherwise(F.concat(F.when(F.col("back"), F.concat(F.lit("<--["), edge, F.lit("]--"))).otherwise(F.concat(F.lit("--["), edge, F.lit("]-->"))), vertex))
    x = x.withColumn("part", part).groupBy("q", "start", "path_no").agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("parts"))  # at most depth + 1 parts
    return x.select("q", "start", "path_no", F.array_join(F.transform("parts", lambda s: s.part), "").alias("text"))


def depth_sets(paths: DataFrame) -> DataFrame:
    """(q, depth, vertices): the distinct vertices at each depth."""
    return paths.select("q", F.posexplode("path").alias("depth", "n")).groupBy("q", "depth").agg(F.array_sort(F.collect_set("n.vertex")).alias("vertices"))


def merge_rerank(questions: DataFrame, found: DataFrame, top: int = 20, graph_ratio: float = 0.5, score: Column | None = None) -> DataFrame:
    """(q, source, rank, text, score): the best texts of each question, graph and vector results by quota.

    questions: (q, question). found: (q, source 'graph' or 'vector', text). Where a question has both sources, the graph gets
    int(top * ratio) places and the vectors the others, else its one source gets all. Texts are made distinct per source
    and ranked by the score, by default BLEU over two orders with the question, then by the text.
    """
    x = found.select("q", "source", "text").distinct().join(questions, "q").withColumns({"_q": tokens(F.col("question")), "_t": tokens(F.col("text"))})
    x = x.withColumn("score", F.round(score if score is not None else bleu(F.col("_q"), F.col("_t"), 2), 9))
    both = found.groupBy("q").agg((F.count_distinct("source") > 1).alias("both"))
    share = int(top * graph_ratio)
    quota = F.when(~F.col("both"), top).when(F.col("source") == "graph", share).otherwise(top - share)
    r = x.join(both, "q").withColumn("rank", F.row_number().over(Window.partitionBy("q", "source").orderBy(F.desc("score"), "text")))
    return r.filter(F.col("rank") <= quota).select("q", "source", "rank", "text", "score")


def near_first(paths: DataFrame, rank: Column) -> DataFrame:
    """Paths with `order`: by the ranks of their vertices from the first on; a missing depth comes last."""
    return paths.withColumn("order", F.row_number().over(Window.partitionBy("q").orderBy(F.transform("path", lambda x: rank(x.vertex)), "path_no")))


def numbered_context(ranked: DataFrame, graph_first: bool = True) -> DataFrame:
    """(q, context): the texts as '1. text' lines; graph before vector results, or after them for low graph ratios."""
    place = F.when(F.col("source") == "graph", 0 if graph_first else 1).otherwise(1 if graph_first else 0)
    x = ranked.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(place, "rank")))
    lines = F.array_sort(F.collect_list(F.struct("n", "text")))  # at most the quota of a question
    return x.groupBy("q").agg(lines.alias("l")).select("q", F.array_join(F.transform("l", lambda s: F.concat(s.n.cast("string"), F.lit(". "), s.text)), "\n").alias("context"))


def semantic_ids(keywords: DataFrame, vertices: DataFrame, labels: int, near: Callable[[DataFrame], DataFrame], limit: int = 8) -> DataFrame:
    """(q, id): exact matches of keywords (q, keyword), and for those without one what `near` finds; each id once per question.

    near: from (q, keyword) to (q, id), such as a search of an index of ids.
    """
    hits, left = exact_matches(keywords, vertices, labels, limit)
    return hits.select("q", "id").unionByName(near(left).select("q", "id")).distinct()


def property_starts(keywords: DataFrame, vertices: DataFrame, properties: Sequence[str]) -> DataFrame:
    """(q, id): vertices one of whose properties is a keyword (q, keyword), for expansions that do not begin with ids."""
    values = vertices.select("id", F.explode(F.array_distinct(F.array(*[F.col(p).cast("string") for p in properties]))).alias("keyword")).filter("keyword is not null")
    return keywords.join(values, "keyword").select("q", "id").distinct()


def vertex_details(vertices: DataFrame, ids: DataFrame, limit: int = 20) -> DataFrame:
    """(id, label, properties): the first `limit` of the vertices `ids` (id), for a recall's report."""
    return vertices.join(ids.select("id").distinct(), "id", "left_semi").select("id", "label", property_map(vertices).alias("properties")).orderBy("id").limit(max(0, limit))


def near_neighbours_first(questions: DataFrame, g: PropertyGraph, paths: DataFrame, score: Column | None = None) -> DataFrame:
    """`paths` with `order` per question: by the ranks of their vertices' texts against the question, first depth first.

    questions: (q, question). At each depth the distinct vertices are ranked by the score (by default BLEU over two orders),
    then by id; a path that ends earlier comes after those that go on.
    """
    v = paths.select("q", F.posexplode("path").alias("depth", "n")).select("q", "depth", F.col("n.vertex").alias("id")).distinct()
    texts = g.vertices.select("id", element_text(F.col("id"), property_map(g.vertices)).alias("text"))
    x = v.join(texts, "id", "left").join(questions, "q").withColumns({"_q": tokens(F.col("question")), "_t": tokens(F.coalesce("text", F.lit("")))})
    x = x.withColumn("score", F.round(score if score is not None else bleu(F.col("_q"), F.col("_t"), 2), 9))
    ranks = x.withColumn("rank", F.row_number().over(Window.partitionBy("q", "depth").orderBy(F.desc("score"), "id"))).select("q", "depth", "id", "rank")
    longest = paths.groupBy("q").agg(F.max(F.size("path")).alias("most"))
    p = paths.select("q", "start", "path_no", F.posexplode("path").alias("depth", "n")).select("q", "start", "path_no", "depth", F.col("n.vertex").alias("id")).join(ranks, ["q", "depth", "id"])
    p = p.groupBy("q", "start", "path_no").agg(F.array_sort(F.collect_list(F.struct("depth", "rank"))).alias("r")).join(longest, "q")  # at most depth + 1 places
    missing = F.array_repeat(F.lit(1 << 30), F.col("most") - F.size("r"))
    p = p.withColumn("r", F.concat(F.transform("r", lambda s: s["rank"]), missing))
    p = p.withColumn("order", F.row_number().over(Window.partitionBy("q").orderBy("r", "start", "path_no"))).select("q", "start", "path_no", "order")
    return paths.join(p, ["q", "start", "path_no"])


def rerank_top(found: DataFrame, questions: DataFrame, scorer: Callable[[str, str], float], top: int | None = None) -> DataFrame:
    """(q, text, score, rank): texts by an external scorer; `top` of each question, which must not be negative, all without it."""
    from tessagraph.functions.models import rerank_score

    if top is not None and top < 0:
        raise ValueError(f"{top} texts of each question")
    x = found.select("q", "text").distinct().join(questions, "q").withColumn("score", rerank_score(F.col("question"), F.col("text"), scorer))
    x = x.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "text"))).select("q", "text", "score", "rank")
    return x if top is None else x.filter(F.col("rank") <= top)


def graph_results(g: PropertyGraph, queries: Mapping[int, str | None], fallback: Callable[[Sequence[int]], DataFrame], limit: int = 100) -> DataFrame:
    """(q, source, text): what the query texts of questions give; questions without rows or with a faulty text take the fallback.

    A text is run per question, as users ask a handful at once; fallback: from question numbers to (q, source, text).
    """
    from tessagraph.operators.query_text import try_text

    parts, left = [], []
    for q, text in sorted(queries.items()):
        rows = try_text(g, text, limit)[0] if text else None
        if rows is None or rows.isEmpty():
            left.append(q)
        else:
            parts.append(rows.select(F.lit(q).cast("bigint").alias("q"), F.lit("graph").alias("source"), F.to_json(F.struct(*rows.columns)).alias("text")))
    return union_all(parts + ([fallback(left)] if left or not parts else []))
