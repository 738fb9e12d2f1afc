"""Traversals written as text, compiled to the builder of `operators.gremlin`; errors come back as text.

A text is cut into signs, read into chains of steps with their modulators, and each step becomes a call of the builder. Step
names are matched without case; nothing is evaluated but the steps listed here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessagraph.errors import GraphError
from tessagraph.graph import PropertyGraph
from tessagraph.operators.gremlin import Anonymous, P, Source, Traversal

#: Rows of a query on elements that names no limit of its own (fixed value).
DEFAULT_LIMIT = 100
_SIGN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\\\]|\\\\.)*'|\"(?:[^\"\\\\]|\\\\.)*\")|(?P<number>-?\d+(?:\.\d+)?)[lLdDfF]?(?![\w.])|(?P<name>[A-Za-z_]\w*)|(?P<sign>[().,;]))", re.S)
#: Builder methods by the name of the step in lower case; steps with modulators or other arguments are handled in `_step`.
_PLAIN = {x.lower().rstrip("_"): x for x in "hasLabel hasId hasNot dedup limit range simplePath out in_ both outE inE bothE outV inV otherV as_ values id label constant identity count fold unfold sum_ max_ min_ mean aggregate store cap".split()}
_TESTS = {"eq": P.eq, "neq": P.neq, "lt": P.lt, "lte": P.lte, "gt": P.gt, "gte": P.gte, "between": P.between, "inside": P.inside, "outside": P.outside, "within": P.within, "without": P.without, "containing": P.containing, "startingwith": P.starting_with, "endingwith": P.ending_with}
_SPACES = {"__", "p", "textp", "order", "t", "scope"}


@dataclass(frozen=True)
class Call:
    """A step: its name in lower case and its arguments (values, names, or chains as tuples of calls)."""

    name: str
    args: tuple = ()


@dataclass(frozen=True)
class Name:
    """A bare word among the arguments, such as desc or id."""

    word: str


def signs(text: str) -> list[tuple[str, str]]:
    """(kind, sign) of a text; typographic quotes count as straight ones."""
    text = text.translate(str.maketrans("‘’“”", "''\"\"")).strip()
    out, at = [], 0
    while at < len(text):
        m = _SIGN.match(text, at)
        if not m:
            raise GraphError(f"unexpected sign {text[at:at + 10]!r} at {at}")
        out.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
        while at < len(text) and text[at].isspace():
            at += 1
    return out


class _Reader:
    def __init__(self, text: str) -> None:
        self.all, self.at = signs(text), 0

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.all[self.at + ahead] if self.at + ahead < len(self.all) else ("end", "")

    def take(self, sign: str) -> None:
        if self.peek() != ("sign", sign):
            raise GraphError(f"{sign!r} expected before {self.peek()[1] or 'the end'!r}")
        self.at += 1

    def chain(self) -> tuple[Call, ...]:
        calls = [self.call()]
        while self.peek() == ("sign", "."):
            self.at += 1
            calls.append(self.call())
        return tuple(calls)

    def call(self) -> Call:
        kind, word = self.peek()
        if kind != "name":
            raise GraphError(f"a step expected before {word or 'the end'!r}")
        self.at += 1
        self.take("(")
        args = []
        while self.peek() != ("sign", ")"):
            if args:
                self.take(",")
            args.append(self.argument())
        self.take(")")
        return Call(word.lower(), tuple(args))

    def argument(self):
        kind, word = self.peek()
        if kind == "text":
            self.at += 1
            return re.sub(r"\\\\(.)", r"\\1", word[1:-1], flags=re.S)
        if kind == "number":
            self.at += 1
            return float(word) if "." in word else int(word)
        if kind == "name" and word.lower() in _SPACES and self.peek(1) == ("sign", "."):
            self.at += 2
            return self.argument()
        if kind == "name" and self.peek(1) != ("sign", "("):
            self.at += 1
            return {"true": True, "false": False}.get(word.lower(), Name(word.lower()))
        return self.chain()


def parse(text: str) -> tuple[Call, ...]:
    """The steps of 'g.V()...' after g; a semicolon may end it."""
    r = _Reader(text)
    if r.peek()[0] != "name" or r.peek()[1].lower() != "g":
        raise GraphError("a query begins with g")
    r.at += 1
    r.take(".")
    calls = r.chain()
    if r.peek() == ("sign", ";"):
        r.at += 1
    if r.peek()[0] != "end":
        raise GraphError(f"nothing expected after the query, but {r.peek()[1]!r}")
    return calls


def _grouped(calls: tuple[Call, ...]) -> list[tuple[Call, list[Call]]]:
    """Steps with the modulators that follow them."""
    out: list[tuple[Call, list[Call]]] = []
    for c in calls:
        if c.name in ("by", "times", "emit") and out:
            out[-1][1].append(c)
        else:
            out.append((c, []))
    return out


def _key(args: tuple):
    """A modulator's argument: a key, id or label, or a sub-traversal."""
    if not args:
        return "id"
    return args[0].word if isinstance(args[0], Name) else _sub(args[0]) if isinstance(args[0], tuple) else args[0]


def _test(arg):
    """A value or a predicate; sub-traversals stay what they are."""
    if isinstance(arg, tuple) and len(arg) == 1 and arg[0].name in _TESTS:
        return _TESTS[arg[0].name](*arg[0].args)
    return _sub(arg) if isinstance(arg, tuple) else arg.word if isinstance(arg, Name) else arg


def _sub(calls: tuple[Call, ...]) -> Anonymous:
    steps = []
    for c, mods in _grouped(calls):
        steps.append(_step(c, mods))
    return Anonymous(tuple(steps))


def _step(c: Call, mods: list[Call]) -> tuple[str, tuple, dict]:
    """(method, arguments, named arguments) of the builder."""
    args = c.args
    if c.name == "has":
        return "has", tuple(_test(a) for a in args), {}
    if c.name == "is":
        return "is_", (_test(args[0]),), {}
    if c.name in ("where", "filter", "not", "and", "or"):
        if c.name == "where" and isinstance(args[-1], tuple) and len(args[-1]) == 1 and args[-1][0].name in ("eq", "neq"):
            other = args[-1][0]
            if len(args) == 2:
                return "where_tags", (args[0], other.args[0], other.name == "eq"), {}
            return ("where_eq" if other.name == "eq" else "where_neq"), other.args, {}
        return {"not": "not_", "or": "or_", "and": "where_all"}.get(c.name, "where"), tuple(_sub(a) for a in args), {}
    if c.name in ("union", "coalesce"):
        return c.name, tuple(_sub(a) for a in args), {}
    if c.name == "order":
        by = mods[0].args if mods else ()
        words = [a.word for a in by if isinstance(a, Name) and a.word in ("asc", "desc", "incr", "decr")]
        keys = [a for a in by if not (isinstance(a, Name) and a.word in ("asc", "desc", "incr", "decr"))]
        return "order", (_key(tuple(keys)) if keys else None,), {"desc": bool(words) and words[0] in ("desc", "decr")}
    if c.name == "project":
        if len(mods) != len(args):
            raise GraphError(f"project() names {len(args)} columns, but {len(mods)} by() follow")
        return "project", (), {a: _key(m.args) for a, m in zip(args, mods)}
    if c.name == "path":
        return "path", tuple(_key(m.args) for m in mods), {}
    if c.name == "groupcount":
        return "groupCount", (_key(mods[0].args if mods else ()),), {}
    if c.name == "repeat":
        times = [m.args[0] for m in mods if m.name == "times"]
        if not times:
            raise GraphError("repeat() needs times()")
        return "repeat", (_sub(args[0]),), {"times": times[0], "emit": any(m.name == "emit" for m in mods)}
    if c.name in ("valuemap", "elementmap"):
        return "valueMap", tuple(a for a in args if isinstance(a, str)), {}
    if c.name == "select":
        return "select", tuple(a.word if isinstance(a, Name) else a for a in args), {}
    if c.name in _PLAIN and not mods:
        return _PLAIN[c.name], tuple(a.word if isinstance(a, Name) else a for a in args), {}
    raise GraphError(f"the step {c.name}() is not known" + (" with by()" if mods else ""))


def ensure_limit(text: str, limit: int = DEFAULT_LIMIT) -> str:
    """The text with a limit at its end, if it reads vertices or edges and names no limit anywhere."""
    low = (text or "").lower()
    reads = re.search(r"(?:^|[^\w])?\.\s*[ve]\s*\(", low)
    return f"{text.rstrip().rstrip(';')}.limit({limit})" if reads and "limit(" not in low else text


def compile_text(g: PropertyGraph, text: str) -> Traversal | DataFrame | PropertyGraph:
    """The traversal of a text: a table where it ends in groupCount(), a graph where it ends in drop()."""
    calls = parse(text)
    first, rest = calls[0], [c for c in calls[1:] if c.name not in ("tolist", "iterate", "toset")]
    if first.name not in ("v", "e"):
        raise GraphError("a query begins with V() or E()")
    ids = tuple(i for i in first.args)
    t = Source(g).V(*ids) if first.name == "v" else Source(g).E(*ids)
    for c, mods in _grouped(tuple(rest)):
        if isinstance(t, DataFrame) and c.name == "limit":
            t = t.orderBy(*t.columns).limit(*c.args)
            continue
        if not isinstance(t, Traversal):
            raise GraphError(f"{c.name}() cannot follow the end of the query")
        if c.name == "next":
            t = t.limit(c.args[0] if c.args else 1)
        elif c.name == "drop":
            t = t.drop()
        else:
            method, args, named = _step(c, mods)
            t = getattr(t, method)(*args, **named)
    return t


def run_text(g: PropertyGraph, text: str, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The rows of a query text: `value`, or the columns of a projection; with a limit where it names none."""
    t = compile_text(g, text if limit is None else ensure_limit(text, limit))
    if isinstance(t, PropertyGraph):
        raise GraphError("drop() changes the graph; use compile_text")
    return t.to_df() if isinstance(t, Traversal) else t


def try_text(g: PropertyGraph, text: str | None, limit: int | None = DEFAULT_LIMIT) -> tuple[DataFrame | None, str]:
    """(rows, '') or (None, what is wrong): for queries that a model wrote."""
    try:
        return run_text(g, text or "", limit), ""
    except Exception as e:  # noqa: BLE001  # whatever the text causes is part of the answer
        return None, str(e).splitlines()[0][:500] if str(e) else type(e).__name__


def check_texts(df: DataFrame, text_col: str) -> DataFrame:
    """`df` with `steps` (names of the steps, null for no query) and `problem` (null if the text can be read)."""
    import pandas as pd

    @F.pandas_udf("steps array<string>, problem string", F.PandasUDFType.SCALAR)
    def run(texts):
        rows = []
        for t in texts:
            try:
                calls = parse(t or "")
                for c, mods in _grouped(calls[1:]):
                    if c.name not in ("tolist", "iterate", "toset", "next", "drop"):
                        _step(c, mods)
                rows.append(([c.name for c in calls], None))
            except (GraphError, TypeError, IndexError, AttributeError) as e:
                rows.append((None, str(e)[:200]))
        return pd.DataFrame(rows, columns=["steps", "problem"])

    return df.withColumn("_c", run(F.col(text_col))).select(*df.columns, "_c.steps", "_c.problem")
