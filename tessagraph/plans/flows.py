"""Pipelines of the operators: index building, graph extraction, import, refresh, and the four kinds of answers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.functions.models import batch_answers, embed, fill, generate
from tessagraph.functions.text import chunks, fenced_code, hybrid_scores, parse_keywords, textrank, tokens, top_keywords, without_stop_words
from tessagraph.graph import PropertyGraph
from tessagraph.operators.loading import json_graph, load_edges, load_vertices
from tessagraph.operators.query_text import try_text
from tessagraph.operators.retrieval import exact_matches, expand, merge_rerank, numbered_context, path_texts, property_starts
from tessagraph.operators.vectors import VectorIndex, refresh, search_many
from tessagraph.schema import GraphSchema
from tessagraph.session import checkpoint
from tessagraph.streaming.streams import each_batch


@dataclass(frozen=True)
class Settings:
    """What a flow may vary."""

    top: int = 20
    graph_ratio: float = 0.5
    keywords: int = 5
    depth: int = 2
    per_step: int = 40
    max_paths: int = 30
    vector_k: int = 3
    threshold: float = 2.0


def build_chunk_index(docs: DataFrame, index: VectorIndex, embedder, mode: str = "paragraph") -> VectorIndex:
    """Chunks of docs (id, text), embedded and stored with the chunk as payload."""
    c = docs.select("id", F.posexplode(chunks(F.col("text"), mode)).alias("no", "payload"))
    return index.write(c.select(F.xxhash64("id", "no").alias("id"), "payload", embed(F.col("payload"), embedder).alias("vec")))


def refresh_index(ids: DataFrame, index: VectorIndex, embedder) -> tuple[int, int]:
    """Brings an index of vertex ids up to date; (removed, added). Only new ids are embedded, by their part behind the colon."""
    past = index.read().select("payload") if index.exists() else ids.select(F.col("id").alias("payload")).limit(0)
    gone, new = refresh(past, ids.select(F.col("id").alias("payload")), "payload")
    gone, new = checkpoint(gone), checkpoint(new)
    vec = new.select(F.xxhash64("payload").alias("id"), "payload", embed(F.regexp_replace("payload", r"^\d+:", ""), embedder).alias("vec"))
    kept = index.read().join(gone, "payload", "left_anti").unionByName(vec) if index.exists() else vec
    index.write(kept)
    return gone.count(), new.count()


def extract_graph(docs: DataFrame, schema: GraphSchema, model: Callable[[str], str], template: str = "{schema}\n{text}") -> dict[str, DataFrame]:
    """Vertices, edges and rejected rows that a model finds in the chunks of docs (id, text)."""
    c = docs.select(F.explode(chunks(F.col("text"))).alias("text"))
    answers = c.select(generate(fill(template, schema=F.lit(schema.to_json()), text=F.col("text")), model).alias("a"))
    els = checkpoint(answers.select(F.inline(json_graph(F.col("a")))))
    return import_graph(els, schema)


def import_graph(els: DataFrame, schema: GraphSchema) -> dict[str, DataFrame]:
    """Validated vertices and edges of elements as `json_graph` reads them."""
    v, m, bad = load_vertices(els.filter("type = 'vertex'").select("id", "label", "properties"), schema)
    e, wrong = load_edges(els.filter("type = 'edge'").select("label", "outV", "outVLabel", "inV", "inVLabel", "properties"), schema, m, v)
    return {"vertices": v, "edges": e, "rejected_vertices": bad, "rejected_edges": wrong}


def keywords_of(questions: DataFrame, k: int) -> DataFrame:
    """(q, keyword) by rank among the words of each question (q, question)."""
    s = questions.select("q", textrank(without_stop_words(tokens(F.col("question")))).alias("s"))
    return top_keywords(s, "q", "s", k).select(F.col("id").alias("q"), F.col("word").alias("keyword"))


def extract_keywords(questions: DataFrame, k: int, method: str = "textrank", model: Callable[[str], str] | None = None, weight: float = 0.5) -> DataFrame:
    """(q, keyword): the k best by 'textrank', by a 'model' that answers 'KEYWORDS:word:score, ..', or by both scores ('hybrid')."""
    if method == "textrank":
        return keywords_of(questions, k)
    if method not in ("model", "hybrid") or model is None:
        raise ValueError(f"no method {method!r}, or no model")
    said = checkpoint(questions.select(F.col("q").alias("id"), generate(F.col("question"), model).alias("a"))).select("id", F.inline(parse_keywords(F.col("a"))))
    if method == "hybrid":
        rank = questions.select(F.col("q").alias("id"), F.inline(textrank(without_stop_words(tokens(F.col("question"))))))
        said = hybrid_scores(rank, said, weight).select("id", "word", "score")
    best = said.groupBy("id", "word").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "word")))
    return best.filter(F.col("r") <= k).select(F.col("id").alias("q"), F.col("word").alias("keyword"))


def answer_stream(stream: DataFrame, flow: Callable[[DataFrame], DataFrame], path: str, state: str, every: str | None = None):
    """Runs a flow on each micro-batch of a stream of questions and appends its rows to a parquet path; a batch that is run again
    after a failure replaces what it wrote."""

    def run(batch: DataFrame, number: int) -> None:
        flow(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return each_batch(stream, run, state, every)


def example_pairs(examples: Sequence[dict]) -> list[dict]:
    """Examples for schemas: their descriptions and query texts alone; others, and those without both, are left out."""
    return [{"description": e["description"], "gremlin": e["gremlin"]} for e in examples if isinstance(e, dict) and e.get("description") and e.get("gremlin")]


def graph_recall(questions: DataFrame, g: PropertyGraph, labels: int, s: Settings = Settings(), keywords: DataFrame | None = None) -> DataFrame:
    """(q, source, text): texts of the paths around the vertices that the questions name."""
    hits, _ = exact_matches(keywords if keywords is not None else keywords_of(questions, s.keywords), g.vertices, labels)
    paths = expand(g, hits.select("q", "id"), s.depth, s.per_step, s.max_paths)
    return path_texts(g, paths).select("q", F.lit("graph").alias("source"), "text")


def vector_recall(questions: DataFrame, index: VectorIndex, embedder, s: Settings = Settings()) -> DataFrame:
    """(q, source, text): the nearest chunks of each question."""
    asked = questions.select("q", embed(F.col("question"), embedder).alias("vec"))
    data = index.read()
    near = search_many(data, "id", "vec", asked, "q", s.vector_k, s.threshold)
    return near.join(data.select("id", "payload"), "id").select(F.col("query").alias("q"), F.lit("vector").alias("source"), F.col("payload").alias("text"))


def answer_kind(raw: bool, vector: bool, graph: bool, both: bool) -> str:
    """Which answer the flags ask for: both sources before vectors before the graph before none."""
    return "graph_vector" if both or (graph and vector) else "vector" if vector else "graph" if graph else "raw"


def answers(questions: DataFrame, kind: str, model: Callable[[str], str], g: PropertyGraph | None = None, labels: int = 0, index: VectorIndex | None = None, embedder=None, s: Settings = Settings()) -> DataFrame:
    """(q, question, answer) for all questions at once by one kind of answer."""
    if kind == "raw":
        return batch_answers(questions, "{query}", model)
    parts = ([graph_recall(questions, g, labels, s)] if "graph" in kind else []) + ([vector_recall(questions, index, embedder, s)] if "vector" in kind else [])
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ranked = merge_rerank(questions, found, s.top, s.graph_ratio)
    return batch_answers(questions, "{context}\n{query}", model, numbered_context(ranked, s.graph_ratio >= 0.5))


def example_index(pairs: DataFrame, index: VectorIndex, embedder) -> VectorIndex:
    """Example pairs (query, gremlin) stored under their question's vector; an empty table gives an empty index."""
    rows = pairs.filter("query is not null and gremlin is not null").select(F.xxhash64("query", "gremlin").alias("id"), F.to_json(F.struct("query", "gremlin")).alias("payload"), embed(F.col("query"), embedder).alias("vec")).dropDuplicates(["id"])
    return index.write(rows)


def text_to_query(questions: DataFrame, examples: VectorIndex | None, embedder, model: Callable[[str], str], k: int = 2, schema: str = "") -> DataFrame:
    """(q, question, raw_query, query): a model's fenced queries, prompted with the question alone, and with the k most similar
    example pairs as well."""
    bare = batch_answers(questions, schema.replace("{", "").replace("}", "") + "{query}", model).select("q", "question", fenced_code(F.col("answer")).alias("raw_query"))
    if examples is None or k < 1:
        return bare.withColumn("query", F.col("raw_query"))
    near = vector_recall(questions, examples, embedder, Settings(vector_k=k, threshold=1.8))
    ctx = near.groupBy("q").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("context"))  # at most k examples
    shown = batch_answers(questions, "{context}\n{query}", model, ctx).select("q", fenced_code(F.col("answer")).alias("query"))
    return bare.join(shown, "q")


def ask_in_words(questions: DataFrame, g: PropertyGraph, examples: VectorIndex | None, embedder, model: Callable[[str], str], limit: int = 100) -> list[dict]:
    """For each question its queries, and their rows or what went wrong: {q, query, rows, error, raw_query, raw_rows, raw_error}."""
    out = []
    for r in checkpoint(text_to_query(questions, examples, embedder, model)).orderBy("q").collect():  # the questions asked at once
        done = {"q": r.q}
        for name in ("", "raw_"):
            rows, error = try_text(g, r[f"{name}query"], limit)
            try:
                done |= {f"{name}query": r[f"{name}query"], f"{name}rows": None if rows is None else [x.asDict(True) for x in rows.limit(limit).collect()], f"{name}error": error}
            except Exception as e:  # noqa: BLE001  # what a query does when it runs is part of the answer
                done |= {f"{name}query": r[f"{name}query"], f"{name}rows": None, f"{name}error": str(e).splitlines()[0][:500]}
        out.append(done)
    return out


def index_report(g: PropertyGraph, *indices: VectorIndex) -> dict:
    """Counts of the graph, and of each index that exists; an index that cannot be read counts as absent."""
    s = g.summary(0, 0).select("vertex_num", "edge_num").first()
    out = {"vertices": s.vertex_num, "edges": s.edge_num, "indices": []}
    for i in indices:
        try:
            r = i.info().first() if i.exists() else None
        except Exception:  # noqa: BLE001
            r = None
        out["indices"].append(None if r is None else {"dim": r.dim, "rows": r.rows})
    return out


def graph_only(questions: DataFrame, g: PropertyGraph, labels: int, model: Callable[[str], str] | None = None, s: Settings = Settings(), stop: str | None = None) -> DataFrame:
    """The answer from the graph alone, or what it has at an earlier point: stop 'vertices' gives (q, id), 'recall' (q, source, text)."""
    if stop == "vertices":
        return exact_matches(keywords_of(questions, s.keywords), g.vertices, labels)[0].select("q", "id").distinct()
    if stop == "recall" or model is None:
        return graph_recall(questions, g, labels, s)
    return answers(questions, "graph", model, g, labels, s=s)


@dataclass(frozen=True)
class Chain:
    """A fluent pipeline over a table of questions (q, question): every step returns a new chain; `found` holds its results so far."""

    questions: DataFrame
    g: PropertyGraph | None = None
    labels: int = 0
    s: Settings = Settings()
    words: DataFrame | None = None
    starts: DataFrame | None = None
    found: DataFrame | None = None

    def keywords(self, k: int | None = None) -> Chain:
        return replace(self, words=keywords_of(self.questions, k or self.s.keywords))

    def match(self) -> Chain:
        words = self.words if self.words is not None else keywords_of(self.questions, self.s.keywords)
        return replace(self, starts=exact_matches(words, self.g.vertices, self.labels)[0].select("q", "id").distinct())

    def match_properties(self, *properties: str) -> Chain:
        words = self.words if self.words is not None else keywords_of(self.questions, self.s.keywords)
        return replace(self, starts=property_starts(words, self.g.vertices, properties))

    def expand(self) -> Chain:
        paths = expand(self.g, self.starts, self.s.depth, self.s.per_step, self.s.max_paths)
        return self._with(path_texts(self.g, paths).select("q", F.lit("graph").alias("source"), "text"))

    def vectors(self, index: VectorIndex, embedder) -> Chain:
        return self._with(vector_recall(self.questions, index, embedder, self.s))

    def _with(self, rows: DataFrame) -> Chain:
        return replace(self, found=rows if self.found is None else self.found.unionByName(rows))

    def merge(self) -> Chain:
        return replace(self, found=merge_rerank(self.questions, self.found, self.s.top, self.s.graph_ratio))

    def answer(self, model: Callable[[str], str]) -> DataFrame:
        """(q, question, answer) from the merged texts, or without any."""
        if self.found is None:
            return batch_answers(self.questions, "{query}", model)
        return batch_answers(self.questions, "{context}\n{query}", model, numbered_context(self.found, self.s.graph_ratio >= 0.5))
