"""Queries on records, pairs, pieces and repetition, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.llm.pairs import defect_sql, main_defect, pair_defects
from tessagraph.llm.pieces import cut_pieces
from tessagraph.llm.records import collapse, record_fields
from tessagraph.llm.repetition import BIT, POLICIES, RULES, ablate, apply_policies, repetition_ledger
from tessagraph.session import stored, table, version


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(record_fields(table(spark, sf_dir, "gremlin_pairs"), "pair_id", ["query"], {"gremlin": "valueMap"}))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per copy of a record: the record's smallest pair_id and the copy's own."""
    return _copies(spark, sf_dir).select(F.col("first_id").alias("first_pair_id"), F.col("copy_id").alias("copy_pair_id"))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record, as its first row wrote it, with the number of its rows."""
    pairs = table(spark, sf_dir, "gremlin_pairs").select("pair_id", "query", "gremlin")
    copies = _copies(spark, sf_dir)
    more = copies.groupBy(F.col("first_id").alias("pair_id")).agg(F.count("*").alias("more"))
    kept = pairs.join(copies.select(F.col("copy_id").alias("pair_id")), "pair_id", "left_anti")
    return kept.join(more, "pair_id", "left").select("pair_id", "query", "gremlin", (1 + F.coalesce("more", F.lit(0))).alias("copies"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that need a cut where there is no natural boundary."""
    return cut_pieces(table(spark, sf_dir, "documents"), "doc_id", "text", with_text=False).filter("hard").select(F.col("id").alias("doc_id")).distinct()


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of at most 500 characters that overlap by 30."""
    return cut_pieces(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective pairs with the first defect in the order of the rules."""
    d = pair_defects(table(spark, sf_dir, "gremlin_pairs").select("pair_id", "query", "gremlin"), "query", "gremlin")
    return d.select("pair_id", main_defect(F.col("defects")).alias("defect")).filter("defect is not null")


def p5_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source, question language and triggered defect."""
    d = pair_defects(table(spark, sf_dir, "gremlin_pairs"), "query", "gremlin")
    return d.select("source", "lang", F.explode("defects").alias("defect")).groupBy("source", "lang", "defect").agg(F.count("*").alias("pairs"))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_ledger(table(spark, sf_dir, "documents"), "doc_id", "text")


def _stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the documents as they are now, measured once per application and then read from the shared folder."""
    return stored(spark, f"repetition-{version(table(spark, sf_dir, 'documents'))}", lambda: _ledger(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least 30 % of their letters and digits in repeated passages."""
    return _ledger(spark, sf_dir).filter(F.col("failed").bitwiseAND(F.lit(BIT["passages"])) != 0).select(F.col("id").alias("doc_id"))


def p9_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's failure bits and measurements."""
    return _stored_ledger(spark, sf_dir).select(F.col("id").alias("doc_id"), "failed", "n_letters", *[F.col("measures")[i].alias(n) for i, (n, _) in enumerate(RULES)])


def p9_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each version of a policy would drop, from the stored ledger."""
    return apply_policies(_stored_ledger(spark, sf_dir))


def p9_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule adds to each policy, from the stored ledger."""
    return ablate(_stored_ledger(spark, sf_dir))


QUERIES = {
    "p1_found": p1_found, "p1_records": p1_records, "p4_found": p4_found, "p4_pieces": p4_pieces, "p5_found": p5_found, "p5_defects": p5_defects,
    "p9_found": p9_found, "p9_ledger": p9_ledger, "p9_policies": p9_policies, "p9_ablation": p9_ablation,
}

_NORM = r"lower(regexp_replace(regexp_replace(regexp_replace({0}, '(\d)\.(\d)', '\1' || chr(2) || '\2', 'g'), '(\d)\.(\d)', '\1' || chr(2) || '\2', 'g'), '[^\p{{L}}\p{{N}}\x02]', '', 'g'))"
_RECORDS = rf"""
WITH parts AS (
  SELECT pair_id, query, gremlin, {_NORM.format("query")} AS q,
    string_split_regex(gremlin, '(?i)v\s*a\s*l\s*u\s*e\s*m\s*a\s*p\s*\(') AS p FROM gremlin_pairs),
canon AS (
  SELECT pair_id, query, gremlin, q, CASE WHEN gremlin IS NULL THEN NULL ELSE {_NORM.format("p[1]")} || array_to_string(list_transform(p[2:], lambda x:
    CASE WHEN regexp_matches(x, '^[^()]*\)') THEN '#' || array_to_string(list_sort(list_filter(list_transform(string_split(regexp_extract(x, '^([^()]*)\)', 1), ','), lambda n: {_NORM.format("n")}), lambda n: n <> '')), '+') || '#' || {_NORM.format("regexp_replace(x, '^[^()]*[)]', '')")}
    ELSE 'valuemap' || {_NORM.format("x")} END), '') END AS g FROM parts),
firsts AS (SELECT *, min(pair_id) OVER (PARTITION BY q, g) AS first_id, count(*) OVER (PARTITION BY q, g) AS n FROM canon)
"""
_RUN = r"'[^\s.,;:!?。，；：！？、\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}]{500}[^\s.,;:!?。，；：！？、\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}]'"
_SHARE = r"""
WITH d AS (SELECT doc_id, lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS s FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, substr(s, i, 20) AS g FROM d, LATERAL (SELECT unnest(range(1, length(s) - 18)) AS i) WHERE length(s) >= 20),
later AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT doc_id, i, min(i) OVER (PARTITION BY doc_id, g) AS first FROM w) WHERE i > first),
c AS (SELECT doc_id, sum(least(20, coalesce(i - before, 20))) AS covered FROM later GROUP BY doc_id)
"""
_BLANK = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}"
_PIECES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE text <> ''),
c AS (SELECT doc_id, n, unnest(regexp_extract_all(text, '(?s).')) AS ch, generate_subscripts(regexp_extract_all(text, '(?s).'), 1) AS i FROM d),
nat AS (SELECT doc_id, n, i FROM c WHERE regexp_matches(ch, '[.,;:!?。，；：！？、{_BLANK}]')),
b AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, n, i AS p FROM nat UNION ALL SELECT doc_id, n, i - 1 FROM nat UNION ALL SELECT doc_id, n, n FROM d) WHERE p > 0),
r(doc_id, n, no, s, e) AS (
  SELECT doc_id, n, -1, 0, 0 FROM d
  UNION ALL
  SELECT doc_id, n, no + 1, CASE WHEN no < 0 THEN 0 ELSE greatest(e - 30, nxt - 500, 0) END, nxt FROM (
    SELECT x.doc_id, x.n, x.no, x.e, CASE WHEN x.n <= x.reach THEN x.n ELSE coalesce(max(p) FILTER (p <= x.reach), min(p), x.reach) END AS nxt
    FROM (SELECT *, e + CASE WHEN no < 0 THEN 500 ELSE 470 END AS reach FROM r WHERE e < n) x LEFT JOIN b ON b.doc_id = x.doc_id AND p > x.e AND p <= x.e + 500
    GROUP BY x.doc_id, x.n, x.no, x.e, x.reach))
SELECT r.doc_id, CAST(no AS INT) AS piece_no, s AS start, e AS stop, NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = r.doc_id AND b.p = e) AS hard,
  substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) AS piece FROM r JOIN d ON d.doc_id = r.doc_id WHERE no >= 0
"""
_SEGMENTS = [("line", r"[\n\r]"), ("paragraph", r"[\n\r][\n\r]+"), ("sentence", r"[。！？!?；;\n\r\x{2}]")]
_LEDGER = _SHARE.rstrip() + r""",
t AS (SELECT doc_id, lower(coalesce(text, '')) AS x, regexp_replace(lower(coalesce(text, '')), '\.([^\p{L}\p{N}]|$)', chr(2) || '\1', 'g') AS y FROM documents),
""" + ",\n".join(f"""{name}s AS (
  SELECT doc_id, (count(*) - count(DISTINCT z)) / count(*) AS share, (sum(length(z)) - sum(length(z)) FILTER (k = 1)) / sum(length(z)) AS chars
  FROM (SELECT doc_id, z, row_number() OVER (PARTITION BY doc_id, z) AS k FROM (SELECT doc_id, regexp_replace(unnest(string_split_regex({"y" if name == "sentence" else "x"}, '{mark}')), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS z FROM t) WHERE z <> '') GROUP BY doc_id)""" for name, mark in _SEGMENTS) + r""",
words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(x, '[\p{L}\p{N}]+') AS w FROM t)),
runs AS (SELECT doc_id, [w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o] AS five FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
fives AS (SELECT doc_id, (count(*) - count(DISTINCT five)) / count(*) AS share FROM runs WHERE five[5] IS NOT NULL GROUP BY doc_id),
twos AS (SELECT doc_id, max(n * span) AS top FROM (SELECT doc_id, count(*) AS n, any_value(length(five[1]) + length(five[2])) AS span FROM runs WHERE five[2] IS NOT NULL GROUP BY doc_id, five[1:2] HAVING count(*) > 1) GROUP BY doc_id),
signs AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, ch, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(x, '(?s).')) AS ch FROM t) WHERE NOT regexp_matches(ch, '[""" + _BLANK + r"""]') GROUP BY ALL) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, length(regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')) AS n_letters, coalesce(covered / length(s), 0.0::DOUBLE) AS passages, coalesce(lines.share, 0) AS lines, coalesce(lines.chars, 0) AS line_chars,
    coalesce(paragraphs.share, 0) AS paragraphs, coalesce(paragraphs.chars, 0) AS paragraph_chars, coalesce(sentences.share, 0) AS sentences, coalesce(sentences.chars, 0) AS sentence_chars, coalesce(fives.share, 0) AS five_words,
    least(1.0::DOUBLE, coalesce(top, 0) / greatest(length(regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')), 1)) AS top_two_words, coalesce(signs.n / greatest(length(x), 1), 0) AS one_sign
  FROM t LEFT JOIN d USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN paragraphs USING (doc_id) LEFT JOIN sentences USING (doc_id) LEFT JOIN fives USING (doc_id) LEFT JOIN twos USING (doc_id) LEFT JOIN signs USING (doc_id)),
ledger AS (SELECT *, CAST(""" + " + ".join(f"CASE WHEN {n} >= {limit} THEN {BIT[n]} ELSE 0 END" for n, limit in RULES) + r""" AS BIGINT) AS failed FROM m),
policies(policy, version, mask, at_least) AS (VALUES """ + ", ".join(f"('{p.name}', {p.version}, {p.mask}::BIGINT, {p.at_least})" for p in POLICIES) + """),
rules(rule, bit) AS (VALUES """ + ", ".join(f"('{n}', {b}::BIGINT)" for n, b in BIT.items()) + """)
"""
SQL = {
    "p4_pieces": _PIECES,
    "p9_ledger": _LEDGER + f"SELECT doc_id, failed, n_letters, {', '.join(n for n, _ in RULES)} FROM ledger",
    "p9_policies": _LEDGER + "SELECT policy, version, count(*) AS texts, CAST(sum(CASE WHEN bit_count(failed & mask) >= at_least THEN 1 ELSE 0 END) AS BIGINT) AS dropped FROM ledger, policies GROUP BY ALL",
    "p9_ablation": _LEDGER + "SELECT policy, version, rule, CAST(count(*) FILTER (failed & bit <> 0) AS BIGINT) AS failing, CAST(count(*) FILTER (bit_count(failed & (mask - bit)) >= at_least) AS BIGINT) AS dropped_without, CAST(count(*) FILTER (bit_count(failed & mask) >= at_least AND bit_count(failed & (mask - bit)) < at_least) AS BIGINT) AS only_by_it FROM ledger, policies, rules WHERE mask & bit <> 0 GROUP BY ALL",
    "p1_found": _RECORDS + "SELECT first_id AS first_pair_id, pair_id AS copy_pair_id FROM firsts WHERE pair_id <> first_id",
    "p1_records": _RECORDS + "SELECT pair_id, query, gremlin, CAST(n AS BIGINT) AS copies FROM firsts WHERE pair_id = first_id",
    "p5_found": defect_sql() + "SELECT pair_id, coalesce(list_filter(defects, lambda x: x <> 'truncated')[1], defects[1]) AS defect FROM e WHERE len(defects) > 0",
    "p5_defects": defect_sql() + "SELECT source, lang, defect, count(*) AS pairs FROM (SELECT source, lang, unnest(defects) AS defect FROM e) GROUP BY ALL",
    "p4_found": f"SELECT doc_id FROM documents WHERE regexp_matches(text, {_RUN})",
    "p9_found": _SHARE + "SELECT c.doc_id FROM c JOIN d USING (doc_id) WHERE covered >= 0.3 * length(s)",
}
