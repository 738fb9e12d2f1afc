"""Defects of question and query pairs by ordered rules on column expressions, each evaluated on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessagraph.functions.expr import let

#: Answers that say nothing, as letters and digits only (fixed values).
PLACEHOLDERS = ["null", "none", "nan", "na", "nil", "todo", "tbd", "fixme", "placeholder", "empty", "undefined", "unknown", "xxx", "answer", "query", "gremlin", "无", "空", "暂无", "待定", "略", "待补充", "未填写", "没有"]

#: How answers decline, matched in lower case with straight quotes from the start of the answer (fixed values).
REFUSALS = [
    r"(i'?m|i am|we'?re|we are) (very |so |really |afraid |terribly )*(sorry|afraid|unable|not able|not allowed|not permitted)",
    r"(very |so )?sorry[,.:;! -]", r"(my |our |sincere )*apolog(y|ies|i[sz]e)", r"(unfortunately|regrettably|regretfully)",
    r"(i|we) (really |simply |just )?(can'?t|cannot|can not|could not|couldn'?t|won'?t|will not|must|have to|would rather not|do not|don'?t|am not|decline|refuse)\b",
    r"(i'?d|we'?d|i would|we would) (rather|prefer) not", r"as an? (\w+ )?(assistant|model|ai)\b", r"(this|that|it|the request|the question) (is|would be|falls|lies|goes) (not (something|appropriate|possible|within|allowed)|outside|beyond|against)",
    r"it (would|will) not be", r"(no (query|answer|statement|traversal) (can|could|will) be)", r"not (possible|able|allowed) to", r"(your |the |this )?(request|question) (is |was |has been |must be )?(refused|declined|denied|rejected)",
    r"(unable|impossible) to", r"(cannot|can'?t) (answer|help|assist|provide|comply)", r"(抱歉|对不起|很遗憾|遗憾|不好意思|恕)", r"作为.{0,8}(助手|模型|人工智能|ai)", r"(我|我们)?(无法|不能|不便|拒绝|没有办法|没法)",
    r"(该|此|这个|这一|您的|你的)?(请求|问题|查询|要求)(已|被)?(超出|不予|不便|无法|不能|不允许|被拒)", r"暂(时)?(无法|不能|没有办法)", r"(es tut mir leid|leider|entschuldigung|bedaure)", r"(ich|wir) (kann|können|möchte|möchten|darf|dürfen|will|wollen|werde|werden)\b.{0,60}\bnicht\b",
    r"(je suis )?désolée?", r"malheureusement", r"je regrette", r"(je|nous) n'?e? ?(peux|pouvons|veux|voulons|souhaite|dois)", r"(lo siento|lamentablemente|perdón|lamento|no (puedo|podemos|quiero|debo|es posible))", r"(mi dispiace|purtroppo|non posso)", r"(desculpe|infelizmente|não posso)",
    r"(извините|к сожалению|я не могу)", r"(申し訳|すみません|できません)", r"(죄송|미안)",
]

#: Words with which query languages other than the expected one begin (fixed values).
OTHER_HEADS = ["select", "match", "optional", "with", "prefix", "ask", "construct", "describe", "insert", "update", "delete", "create", "merge", "call", "unwind", "for", "let", "return", "query", "mutation", "db"]

_FENCE = r"(?i)```+[ \t]*(?:gremlin|groovy|sql|cypher|sparql|json|text|java|python|plaintext)?"
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Comment lines, which may stand before and in a traversal, and how one begins.
_COMMENT, _BEGIN = r"(?m)^[ \t]*(?://|#|--)[^\n]*(?:\n|$)", r"^\s*(?i:g|graph)\s*\."
#: What else may stand before a traversal: prompts, an assignment, the long way to name its source. (pattern, replacement)
_HEADS = [(r"^\s+", ""), (r"^(?:(?i:gremlin)\s*>|:>|>+)\s*", ""), (r"^(?:def\s+|var\s+)?\w+\s*=\s*((?i:g|graph)\s*\.)", r"$1"), (r"^(?i:graph)\s*\.\s*(?i:traversal)\s*\(\s*\)", "g"), (r"^[\"'](g\s*\.\s*[VE]\s*\()", r"$1")]
_TRAVERSAL = r"^(?i:g)\s*(?:$|…|\.\s*(?:$|…|\.|(?i:V|E|addV|addE|inject|with|tx|io|mergeV|mergeE)))"
_ESCAPE, _QUOTED = r"(?s)\\.", r"\"[^\"]*\"|'[^']*'"
_TAIL, _STEP = r"(?:[,(\[{…+=&|]|\.\.\.)$", r"(?:\.\s*\w*|\W\.)$"
_LABELS = "the|your|user|original|my|that|is|was|question|query|prompt|input|asked|you|q|问题|提问|问|题目|原问题|用户|您的|你的|是|answer|回答|答案"
#: Letters outside the block of a query's own words: Latin with marks, and every other script.
_SCRIPT = r"[\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2AF}\x{370}-\x{1FFF}\x{2C00}-\x{2DFF}\x{3040}-\x{D7FF}\x{F900}-\x{FFDC}\x{10000}-\x{2FFFF}]"
_PROSE, _OTHER = r"[A-Za-z]{2},? +[A-Za-z]{2}", r"^(?i:\{|(?:" + "|".join(OTHER_HEADS) + r")[\s.({?*])"
#: Letters and digits from which on an answer that begins like the question counts as its copy.
PREFIX = 12


def _bare(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def _swap(c: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, by in pairs:
        c = F.regexp_replace(c, pattern, by)
    return c


def open_brackets(c: Column) -> Column:
    """What stays of a text's brackets when pairs that close each other are taken out again and again: each kind closes only
    itself, and as many rounds are made as pairs could be nested."""
    once = lambda s: F.replace(F.replace(F.replace(s, F.lit("()")), F.lit("[]")), F.lit("{}"))
    return let(F.regexp_replace(c, r"[^()\[\]{}]", ""), lambda b: F.aggregate(F.sequence(F.lit(0), F.shiftright(F.length(b), 1)), b, lambda s, _: once(s)))


def pair_defects(df: DataFrame, question: str, answer: str) -> DataFrame:
    """`df` with `defects` array<string>: every defect type that triggers, in the order of the rules.

    'empty': null, nothing but punctuation, or only a placeholder. 'truncated': an unclosed quote, a bracket that its own kind does
    not close, or an abrupt end (a separator or an ellipsis in any language; in a traversal a step without its brackets
    too). 'refusal': begins by declining, in one of ten languages. 'copy': the question, once or repeated, with at most
    twelve labels around it; or it begins with the question, or is the beginning of at least half of it (both from PREFIX letters
    on). 'other_language': no traversal, and the scripts do not fit (letters outside the basic Latin block beyond
    quotes), or words follow each other as in prose, or it begins like another query language. The rules do not exclude each
    other: a refusal in prose is in another language too. Code fences, comments before a traversal, prompts, the long name of
    its source and typographic quotes are no defects. A null question copies nothing. Whole values are read.
    """
    raw = F.coalesce(F.col(answer), F.lit(""))
    raw = F.translate(F.when(raw.contains("```"), _swap(raw, (_FENCE, "\n"))).otherwise(raw), "‘’‛′＇`“”„″＂", "''''''" + '"' * 5)
    code = let(F.trim(raw, F.lit(_BLANKS)), lambda b: F.when(b.rlike(r"^[gG]\s*\."), b).otherwise(let(_swap(b, (_COMMENT, "")), lambda c: _swap(F.when(c.rlike(_BEGIN), c).otherwise(b), *_HEADS))))
    found = let(code, lambda c: let(F.struct(c.alias("code"), F.col(question).alias("question"), c.rlike(_TRAVERSAL).alias("traversal"), _swap(c, (_ESCAPE, ""), (_QUOTED, "S")).alias("open")), _rules))
    return df.withColumn("defects", found)


def _rules(z: Column) -> Column:
    """A traversal can only be broken off: it holds more than a placeholder, begins with no refusal and with no question's words."""
    quote = F.regexp_replace(z.open, r"([\p{L}])'([\p{L}])", "$1$2").rlike(r"[\"']")
    tail = F.rtrim(z.open, F.lit(_BLANKS + ";"))
    cut = quote | tail.rlike(_TAIL) | (z.traversal & (tail.rlike(_STEP) | (F.length(F.regexp_replace(z.open, r"\s", "")) <= 2))) | open_brackets(z.open).rlike(r"[(\[{]")
    text = let(F.struct(_bare(z.code).alias("bare"), _bare(z.question).alias("q")), lambda y: _text_rules(z, y, cut))
    none = F.array().cast("array<string>")
    return F.when(z.traversal, F.when(cut, F.array(F.lit("truncated"))).otherwise(none)).otherwise(text)


def _text_rules(z: Column, y: Column, cut: Column) -> Column:
    refusal = F.lower(F.regexp_replace(z.code, r"^[\s\p{Z}#/*\-\"'>(\[]+", "")).rlike("^(?:" + "|".join(REFUSALS) + ")")
    left = F.replace(y.bare, y.q, F.lit(""))
    own = F.regexp_replace(y.bare, f"^(?:{_LABELS}){{1,12}}", "")
    begins = lambda b: b.startswith(y.q) | (y.q.startswith(b) & (F.length(b) >= PREFIX) & (2 * F.length(b) >= F.length(y.q)))
    copy = (y.q != "") & ((y.bare.contains(y.q) & ((left == "") | left.rlike(f"^(?:{_LABELS}){{0,12}}$"))) | ((F.length(y.q) >= PREFIX) & (begins(y.bare) | begins(own))))
    other = z.open.rlike(_SCRIPT) | z.open.rlike(_PROSE) | z.open.rlike(_OTHER)
    rules = {"empty": (y.bare == "") | y.bare.isin(PLACEHOLDERS), "truncated": cut & (y.bare != ""), "refusal": refusal, "copy": copy, "other_language": other}
    return F.filter(F.array(*[F.when(hit, name) for name, hit in rules.items()]), lambda d: d.isNotNull())


def main_defect(defects: Column) -> Column:
    """The first defect; 'truncated' only if it is the only one, as it means a traversal that breaks off."""
    return F.coalesce(F.get(F.filter(defects, lambda d: d != "truncated"), F.lit(0)), F.get(defects, F.lit(0)))


def defect_sql() -> str:
    """The rules in SQL: a query with pair_id, source, lang and `defects` of gremlin_pairs."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    swap = lambda c, p, by, f="g": f"regexp_replace({c}, {text(p)}, {text(by.replace('$', chr(92)))}, '{f}')"
    bare = lambda c: f"lower({swap(c, '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]', '')})"
    hit = lambda c, p: f"regexp_matches({c}, {text(p)})"
    body = "coalesce(gremlin, '')"
    for p, by in ((_FENCE, "\n"), ("[‘’‛′＇`]", "'"), ("[“”„″＂]", '"')):
        body = swap(body, p, by)
    blanks = " || ".join(f"chr({ord(c)})" for c in _BLANKS)
    body = f"trim({body}, {blanks})"
    tail = f"rtrim(open, {blanks} || ';')"
    code = f"(CASE WHEN {hit(swap('body', _COMMENT, ''), _BEGIN)} THEN {swap('body', _COMMENT, '')} ELSE body END)"
    for p, by in _HEADS:
        code = swap(code, p, by)
    begins = lambda b: f"(starts_with({b}, q) OR (starts_with(q, {b}) AND length({b}) >= {PREFIX} AND 2 * length({b}) >= length(q)))"
    closed = "list_reduce(list_prepend(regexp_replace(open, '[^()\\[\\]{}]', '', 'g'), list_transform(range(length(open)), lambda i: '')), lambda s, i: replace(replace(replace(s, '()', ''), '[]', ''), '{}', ''))"
    cut = f"""({hit(swap("open", "([" + chr(92) + "p{L}])'([" + chr(92) + "p{L}])", "$1$2"), "[" + chr(34) + "']")} OR {hit(closed, "[([{]")} OR {hit(tail, _TAIL)} OR (traversal AND ({hit(tail, _STEP)} OR length({swap("open", chr(92) + "s", "")}) <= 2)))"""
    return f"""
WITH a AS (SELECT pair_id, source, lang, coalesce({bare("query")}, '') AS q0, query IS NULL AS no_q, {body} AS body FROM gremlin_pairs),
b AS (SELECT *, q0 AS q, {code} AS code FROM a),
c AS (SELECT *, {bare("code")} AS bare, {hit("code", _TRAVERSAL)} AS traversal, {swap(swap("code", _ESCAPE, ""), _QUOTED, "S")} AS open FROM b),
d AS (SELECT *, replace(bare, q, '') AS left_, {swap("bare", f"^(?:{_LABELS}){{1,12}}", "")} AS own FROM c),
e AS (SELECT pair_id, source, lang, list_filter([
  CASE WHEN bare = '' OR bare IN ({", ".join(map(text, PLACEHOLDERS))}) THEN 'empty' END,
  CASE WHEN {cut} AND bare <> '' THEN 'truncated' END,
  CASE WHEN {hit("lower(" + swap("code", "^[" + chr(92) + "s" + chr(92) + "p{Z}#/*" + chr(92) + "-" + chr(34) + "'>(" + chr(92) + "[]+", "") + ")", "^(?:" + "|".join(REFUSALS) + ")")} THEN 'refusal' END,
  CASE WHEN q <> '' AND ((contains(bare, q) AND (left_ = '' OR {hit("left_", f"^(?:{_LABELS}){{0,12}}$")})) OR (length(q) >= {PREFIX} AND ({begins("bare")} OR {begins("own")}))) THEN 'copy' END,
  CASE WHEN NOT traversal AND ({hit("open", _SCRIPT)} OR {hit("open", _PROSE)} OR {hit("open", _OTHER)}) THEN 'other_language' END], lambda x: x IS NOT NULL) AS defects FROM d)
"""
