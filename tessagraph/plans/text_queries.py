"""Queries on texts, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.functions import text as X
from tessagraph.session import spread, table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text", "lang"))


def txt_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("no", "sentence"))


def txt_paragraph_chunks(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.posexplode(X.chunks(F.col("text"))).alias("no", "chunk"))


def txt_words(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words of each question with the parts of compounds."""
    return table(spark, d, "gremlin_pairs").select("pair_id", F.array_join(X.words(F.col("query")), " ").alias("words"))


def txt_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    """Word pairs near each other in at least 5 documents."""
    t = _docs(spark, d).select("doc_id", X.without_stop_words(X.tokens(F.col("text"))).alias("t"))
    return X.cooccurrence(t, "doc_id", "t", 2).groupBy("a", "b").agg(F.count("*").alias("docs"), F.sum("n").alias("n")).filter("docs >= 5")


def txt_textrank(spark: SparkSession, d: str) -> DataFrame:
    t = _docs(spark, d).select("doc_id", X.textrank(X.without_stop_words(X.tokens(F.col("text")))).alias("s"))
    return X.top_keywords(t, "doc_id", "s", 5)


def txt_hybrid_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Rank scores mixed with scores of term frequency."""
    t = _docs(spark, d).select("doc_id", X.without_stop_words(X.tokens(F.col("text"))).alias("t"))
    rank = t.select(F.col("doc_id").alias("id"), F.inline(X.textrank(F.col("t"))))
    tf = t.select(F.col("doc_id").alias("id"), F.explode("t").alias("word"), F.size("t").alias("n")).groupBy("id", "word").agg((F.count("*") / F.max("n")).alias("score"))
    return X.hybrid_scores(rank, tf, 0.6)


def txt_bleu(spark: SparkSession, d: str) -> DataFrame:
    """The ten documents that answer a question best by BLEU over single words and pairs."""
    q = F.array(*[F.lit(w) for w in "the worker of the archived registry feeds each missing scheduler".split()])
    x = _docs(spark, d).select("doc_id", X.tokens(F.col("text")).alias("t")).select("doc_id", F.round(X.bleu(q, F.col("t"), 2), 9).alias("score"))
    return x.orderBy(F.desc("score"), "doc_id").limit(10)


def txt_code_blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gremlin_pairs").select("pair_id", X.fenced_code(F.col("gremlin")).alias("code")).filter("code is not null")


def txt_redact(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.concat(F.lit('{"user_token": "t'), F.col("user_id"), F.lit('", "pwd":'), F.col("event_id"), F.lit(', "p": '), F.col("props"), F.lit("}")).alias("j"))
    return e.select("event_id", X.redact(F.col("j")).alias("safe"))


def txt_parse_keywords(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("ok KEYWORDS:"), F.col("event_type"), F.lit("："), (F.col("event_id") % 30) / 20, F.lit(", Bad, User:x, K:-1")).alias("r"))
    return e.select("event_id", F.inline(X.parse_keywords(F.col("r")))).withColumn("score", F.round("score", 6))


def txt_bigrams(spark: SparkSession, d: str) -> DataFrame:
    """The 50 most frequent pairs of neighbouring Chinese characters."""
    x = _docs(spark, d).filter("lang = 'zh'").select(F.explode(X.bigrams(F.col("text"))).alias("bigram"))
    return x.groupBy("bigram").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bigram").limit(50)


QUERIES = {f.__name__: f for f in (txt_sentences, txt_paragraph_chunks, txt_words, txt_cooccurrence, txt_textrank, txt_hybrid_keywords, txt_bleu, txt_code_blocks, txt_redact, txt_parse_keywords, txt_bigrams)}

_STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS["english"])
_TOKEN = X.TOKEN.replace("'", "''")


def _tok(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '{_TOKEN}')"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


_CODE = _strip("regexp_extract(gremlin, '(?s)```gremlin(.*?)```', 1)")
SQL = {
    "txt_sentences": f"WITH x AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{X.SENTENCE}'), lambda s: {_strip('s')}), lambda s: s <> '') AS s FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INT) AS no, unnest(s) AS sentence FROM x",
    "txt_words": f"WITH x AS (SELECT pair_id, {_tok('query')} AS t FROM gremlin_pairs) SELECT pair_id, array_to_string(list_sort(list_distinct(list_concat(t, list_filter(flatten(list_transform(t, lambda w: regexp_extract_all(w, '[\\p{{L}}\\p{{N}}_]+'))), lambda w: w NOT IN ({_STOP}))))), ' ') AS words FROM x",
    "txt_cooccurrence": f"WITH x AS (SELECT doc_id, list_filter({_tok('text')}, lambda w: w NOT IN ({_STOP})) AS t FROM documents), w AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM x), p AS (SELECT a.doc_id, least(a.w, b.w) AS a, greatest(a.w, b.w) AS b FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i + 1 AND a.i + 2 WHERE a.w <> b.w) SELECT a, b, count(DISTINCT doc_id) AS docs, count(*) AS n FROM p GROUP BY a, b HAVING count(DISTINCT doc_id) >= 5",
    "txt_bleu": f"""WITH q AS (SELECT string_split('the worker of the archived registry feeds each missing scheduler', ' ') AS r), x AS (SELECT doc_id, {_tok('text')} AS c, r FROM documents, q WHERE text IS NOT NULL),
h AS (SELECT doc_id, len(c) AS lc, len(r) AS lr, list_sum(list_transform(list_distinct(r), lambda g: least(len(list_filter(r, lambda y: y = g)), len(list_filter(c, lambda y: y = g))))) AS h1,
 list_sum(list_transform(list_distinct(list_transform(range(1, len(r)), lambda i: r[i] || ' ' || r[i + 1])), lambda g: least(len(list_filter(range(1, len(r)), lambda i: r[i] || ' ' || r[i + 1] = g)), len(list_filter(range(1, len(c)), lambda i: c[i] || ' ' || c[i + 1] = g))))) AS h2 FROM x)
SELECT doc_id, round(CASE WHEN h1 = 0 OR h2 = 0 OR lc = 0 THEN 0 ELSE (CASE WHEN lc <= lr THEN exp(1 - lr / lc) ELSE 1 END) * exp((ln(h1 / lc) + ln(h2 / (lc - 1))) / 2) END, 9) AS score FROM h ORDER BY score DESC, doc_id LIMIT 10""",
    "txt_code_blocks": f"SELECT pair_id, {_CODE} AS code FROM gremlin_pairs WHERE {_CODE} <> ''",
    "txt_redact": """SELECT event_id, '{"user_token": "***", "pwd":"***", "p": ' || props || '}' AS safe FROM events""",
    "txt_parse_keywords": "SELECT event_id, event_type AS word, round(least(1, (event_id % 30) / 20), 6) AS score FROM events UNION ALL SELECT event_id, 'k', 0 FROM events",
    "txt_bigrams": "WITH h AS (SELECT unnest(regexp_extract_all(text, '\\p{Han}{2,}')) AS s FROM documents WHERE lang = 'zh'), b AS (SELECT substr(s, i, 2) AS bigram FROM h, LATERAL (SELECT unnest(range(1, length(s))) AS i)) SELECT bigram, count(*) AS n FROM b GROUP BY bigram ORDER BY n DESC, bigram LIMIT 50",
}
