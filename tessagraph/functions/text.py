"""Text operators as column expressions; per-document ranking is a pandas UDF, as it iterates inside a row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tessagraph.functions.expr import let

#: Words that carry little meaning (fixed values; common English and Chinese function words).
STOP_WORDS = {
    "english": "a an and are as at be been but by can could did do does for from had has have he her his how i if in into is it its may more most my no not of on or our she should so such than that the their them then there these they this those to was we were what when where which who why will with would you your".split(),
    "chinese": "的 了 和 是 在 我 有 他 这 中 大 来 上 国 个 到 说 们 为 子 与 也 你 对 生 能 而 那 得 于 着 下 自 之 年 过 就 都 及 或 被 并 其".split(),
}
SENTENCE = r"[^.!?。！？；;]+[.!?。！？；;]*"
#: Things that stay one token: links, mail addresses, decimal numbers, compounds; then words.
TOKEN = r"https?://[^\s]+|[\p{L}\p{N}_.+-]+@[\p{L}\p{N}-]+\.[\p{L}\p{N}.-]+|\p{N}+\.\p{N}+|[\p{L}\p{N}_]+(?:['’-][\p{L}\p{N}_]+)+|[\p{L}\p{N}_]+"
KEYWORD = StructType([StructField("word", StringType()), StructField("score", DoubleType())])


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sentences(text: Column) -> Column:
    """Sentences with their end marks, trimmed, empty ones left out."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), strip), lambda x: x != "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def words(text: Column, language: str = "english") -> Column:
    """Tokens, and the parts of compound tokens that are no stop words; each once, sorted."""
    t = tokens(text)
    parts = F.flatten(F.transform(t, lambda x: F.regexp_extract_all(x, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))))
    return F.array_sort(F.array_union(t, F.array_except(parts, F.lit(STOP_WORDS[language]))))


def without_stop_words(t: Column, language: str = "english") -> Column:
    stop = F.lit(STOP_WORDS[language])
    return F.filter(t, lambda x: ~F.array_contains(stop, x))


def bigrams(text: Column) -> Column:
    """Pairs of neighbouring CJK characters, in place of a segmenter."""
    han = F.regexp_extract_all(text, F.lit(r"\p{IsHan}{2,}"), F.lit(0))
    return F.flatten(F.transform(han, lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substr(s, i, F.lit(2)))))


def cooccurrence(df: DataFrame, id_col: str, tokens_col: str, window: int = 3) -> DataFrame:
    """(id, a, b, n): unordered pairs of different words at most `window` apart (1..10, else 3), with their number."""
    window = window if 1 <= window <= 10 else 3
    pairs = let(F.col(tokens_col), lambda t: F.flatten(F.transform(t, lambda x, i: F.transform(F.slice(t, i + 2, window), lambda y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))))))
    return df.select(F.col(id_col).alias("id"), F.inline(pairs)).filter("a <> b").groupBy("id", "a", "b").agg(F.count("*").alias("n"))


def _rank(ts: list[str], window: int, alpha: float, rounds: int) -> list[tuple[str, float]]:
    names = sorted(set(ts))
    at = {w: i for i, w in enumerate(names)}
    x = np.array([at[t] for t in ts], np.int64)
    a = np.concatenate([x[: max(0, len(x) - k)] for k in range(1, window + 1)] or [x[:0]])
    b = np.concatenate([x[k:] for k in range(1, window + 1)] or [x[:0]])
    a, b = a[a != b], b[a != b]
    n = len(names)
    if not n:
        return []
    out = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    r = np.full(n, 1 / n)
    for _ in range(rounds):
        share = r / np.maximum(out, 1)
        # What words without neighbours hold goes to all words alike.
        new = (1 - alpha + alpha * r[out == 0].sum()) / n + alpha * (np.bincount(a, share[b], n) + np.bincount(b, share[a], n))
        done, r = np.abs(new - r).sum() < 1e-12 * n, new
        if done:
            break
    r = r / r.max()
    return [(w, round(float(s), 9)) for w, s in zip(names, r)]


def textrank(tokens_col: Column, window: int = 3, alpha: float = 0.85, rounds: int = 100, double_tokens: bool = False) -> Column:
    """array<struct<word, score>>: rank in the graph of words at most `window` apart, over the largest rank.

    double_tokens repeats every token, as some rankers do. The best word of a text scores 1, a single word too; it ends when
    the ranks stand still.
    """
    window = window if 1 <= window <= 10 else 3

    @F.pandas_udf(ArrayType(KEYWORD))
    def rank(col: pd.Series) -> pd.Series:
        return pd.Series([_rank([t for t in ts for _ in range(1 + double_tokens)] if ts is not None else [], window, alpha, rounds) for ts in col])

    return rank(tokens_col)


def top_keywords(df: DataFrame, id_col: str, scores_col: str, k: int = 5) -> DataFrame:
    """(id, rank, word, score): the k best words of each row; ties by word; quotes are taken off the words."""
    k = max(1, k)
    x = df.select(F.col(id_col).alias("id"), F.inline(F.transform(scores_col, lambda s: F.struct(F.replace(s.word, F.lit("'"), F.lit("")).alias("word"), s.score.alias("score")))))
    return x.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "word"))).filter(F.col("rank") <= k)


def hybrid_scores(a: DataFrame, b: DataFrame, weight: float | None = 0.5) -> DataFrame:
    """(id, word, score): weight * a + (1 - weight) * b over the words of either (id, word, score)."""
    w = min(1.0, max(0.0, weight)) if isinstance(weight, float) else 0.5
    x = a.groupBy("id", "word").agg(F.max("score").alias("sa")).join(b.groupBy("id", "word").agg(F.max("score").alias("sb")), ["id", "word"], "full")
    return x.select("id", "word", (w * F.coalesce("sa", F.lit(0.0)) + (1 - w) * F.coalesce("sb", F.lit(0.0))).alias("score"))


def parse_keywords(response: Column, start: str = "KEYWORDS:", lowercase: bool = True) -> Column:
    """array<struct<word, score>> of 'KEYWORDS:word:0.5, other:1'; scores are clamped to 0..1, malformed parts skipped."""
    r = F.translate(response, "：，、；", ":,,,")
    body = F.regexp_extract(r, rf"(?s){re.escape(start)}(.*)", 1)
    pairs = F.transform(F.split(body, r"[,\n]"), lambda p: F.struct(strip(F.regexp_extract(p, r"^(.*):[^:]*$", 1)).alias("word"), F.try_to_number(F.nullif(strip(F.regexp_extract(p, r":\s*(-?[0-9.]+)\s*$", 1)), F.lit("")), F.lit("S999.999999")).cast("double").alias("score")))
    good = F.filter(pairs, lambda x: (x.word != "") & x.score.isNotNull())
    return F.transform(good, lambda x: F.struct((F.lower(x.word) if lowercase else x.word).alias("word"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), x.score)).alias("score")))


def ngrams(t: Column, n: int) -> Column:
    return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.array_join(F.slice(t, i, n), "\x01"))).otherwise(F.array().cast("array<string>"))


def bleu(reference: Column, candidate: Column, n: int = 4) -> Column:
    """BLEU of two token arrays: clipped n-gram precisions, geometric mean, brevity penalty; 0 without an overlap of each order.

    Counts run over the reference's n-grams, so that a short query costs little against a long text.
    """
    times = lambda xs, y: F.size(F.filter(xs, lambda x: x == y))

    def order(k: int) -> Column:
        """Clipped precision of k-grams; null without an overlap."""
        both = F.struct(ngrams(reference, k).alias("r"), ngrams(candidate, k).alias("c"))
        hits = lambda z: F.aggregate(F.array_distinct(z.r), F.lit(0), lambda acc, g: acc + F.least(times(z.r, g), times(z.c, g)))
        return let(both, lambda z: F.try_divide(F.nullif(hits(z), F.lit(0)).cast("double"), F.size(z.c)))

    total = sum((F.ln(order(k)) for k in range(2, n + 1)), F.ln(order(1)))
    short = F.size(candidate) <= F.size(reference)
    penalty = F.when(short, F.exp(1 - F.size(reference) / F.greatest(F.size(candidate), F.lit(1)))).otherwise(1.0)
    return F.coalesce(penalty * F.exp(total / n), F.lit(0.0))


def fenced_code(response: Column, label: str = "gremlin") -> Column:
    """The first code block of a label, trimmed; null without one."""
    return F.nullif(strip(F.regexp_extract(response, rf"(?s)```{label}(.*?)```", 1)), F.lit(""))


def shorten(value: Column, kind: str = "vertex") -> Column:
    """At most 2048 characters of a vertex property, 256 of an edge property."""
    return F.substring(value, 1, {"vertex": 2048, "edge": 256}[kind])


def short_ids(df: DataFrame, id_col: str = "id", limit: int = 256) -> DataFrame:
    """Rows whose id has fewer than `limit` bytes."""
    return df.filter(F.octet_length(id_col) < limit)


def redact(json: Column) -> Column:
    """JSON text with the values of sensitive keys replaced, at any depth."""
    key = r'("[^"]*(?i:api_?key|password|pwd|passwd|token|secret|authorization|credential)[^"]*"\s*:\s*)'
    return F.regexp_replace(json, key + r'("(?:[^"\\]|\\.)*"|[^,}\]\s{\[]+)', r'$1"***"')


def _split(text: str, seps: list[str], size: int) -> list[str]:
    if len(text) <= size:
        return [text]
    for i, s in enumerate(seps):
        if s and s in text:
            parts = [p + s for p in text.split(s)[:-1]] + [text.split(s)[-1]]
            return [q for p in parts if p for q in (_split(p, seps[i + 1 :], size) if len(p) > size else [p])]
    return [text[i : i + size] for i in range(0, len(text), size)]


#: Separators from the strongest to the weakest.
SEPARATORS = ["\n\n", "\n", "。", "！", "？", "；", "，", ". ", "! ", "? ", "; ", ", ", " "]


def split_text(text: str | None, size: int = 500, overlap: int = 30, separators: list[str] | None = None) -> list[str]:
    """Chunks of at most `size`: parts by the strongest separator that helps, merged while they fit; whole parts of up to
    `overlap` characters are repeated at the next chunk's beginning."""
    if not text:
        return []
    out, cur = [], []
    for p in _split(text, separators or SEPARATORS, size):
        if cur and sum(map(len, cur)) + len(p) > size:
            out.append("".join(cur))
            while cur and (sum(map(len, cur)) > overlap or sum(map(len, cur)) + len(p) > size):
                cur.pop(0)
        cur.append(p)
    out.append("".join(cur))
    return [c.strip() for c in out if c.strip()]


def chunks(text: Column, mode: str = "paragraph", size: int = 500, overlap: int = 30) -> Column:
    """array<string>: 'document' (the text), 'sentence', or 'paragraph' (recursive split with overlap)."""
    if mode == "document":
        return F.filter(F.array(text), lambda x: x.isNotNull())
    if mode == "sentence":
        return sentences(text)

    @F.pandas_udf(ArrayType(StringType()))
    def split(col: pd.Series) -> pd.Series:
        return col.map(lambda t: split_text(t, size, overlap))

    return split(text)


def legacy_chunks(text: Column, mode: str = "paragraph", language: str = "zh") -> Column:
    """The older splitter: 'paragraph' is 500 with 30 overlapping, 'sentence' 50 without, both recursive by the language's marks."""
    marks = {"zh": ["\n\n", "\n", "。", "，"], "en": ["\n\n", "\n", ".", ",", " "]}[language]
    if mode == "document":
        return chunks(text, "document")
    size, overlap = {"paragraph": (500, 30), "sentence": (50, 0)}[mode]

    @F.pandas_udf(ArrayType(StringType()))
    def split(col: pd.Series) -> pd.Series:
        return col.map(lambda t: split_text(t, size, overlap, marks))

    return split(text)


def tagged_tokens(text: Column, tagger: Callable[[list[str]], list[str]] | None = None, keep: Sequence[str] = ("NN", "NNP", "NNS", "JJ"), language: str = "english") -> Column:
    """Tokens whose part of speech `tagger` names among `keep`; without a tagger all that are no stop words.

    The tagger is any function from a text's tokens to their tags; it runs in Arrow batches.
    """
    t = without_stop_words(tokens(text), language)
    if tagger is None:
        return t

    @F.pandas_udf(ArrayType(StringType()))
    def run(col: pd.Series) -> pd.Series:
        return col.map(lambda ts: [w for w, tag in zip(ts, tagger(list(ts))) if tag in keep] if ts is not None else [])

    return run(t)
