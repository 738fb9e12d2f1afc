"""Plug points for models: text generators, embedders and rerankers as pandas UDFs over injectable functions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StringType


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Unit vectors of signed counts of word hashes: repeatable, without a model."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                out[i, h % dim] += 1 if h >> 63 else -1
            n = np.linalg.norm(out[i])
            if n:
                out[i] /= n
        return out

    return embed


def embed(text: Column, embedder: Callable[[list[str]], np.ndarray], batch: int = 500) -> Column:
    """Vectors of texts, in batches whose order is the rows'."""

    @F.pandas_udf(ArrayType(FloatType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            texts = p.tolist()
            yield pd.Series([v for i in range(0, len(texts), batch) for v in embedder(texts[i : i + batch])])

    return run(text)


def generate(prompt: Column, model: Callable[[str], str]) -> Column:
    """A model's answers; an error becomes its text behind 'error: '."""

    @F.pandas_udf(StringType())
    def run(p: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else model(x)
            except Exception as e:  # noqa: BLE001
                return f"error: {e}"

        return p.map(one)

    return run(prompt)


def rerank_score(question: Column, text: Column, scorer: Callable[[str, str], float]) -> Column:
    @F.pandas_udf(DoubleType())
    def run(q: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([float(scorer(a, b)) for a, b in zip(q, t)], dtype="float64")

    return run(question, text)


def fill(template: str, **columns: Column) -> Column:
    """A prompt with {name} places filled by columns; unknown and missing places are errors."""
    import re

    names = set(re.findall(r"\{(\w+)\}", template))
    if names != set(columns):
        raise ValueError(f"places {sorted(names)} but columns {sorted(columns)}")
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(columns[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


@dataclass
class CannedModel:
    """A fake for tests: answers in turn, and the prompts it saw."""

    answers: list[str]
    seen: list[str] = field(default_factory=list)

    def __call__(self, prompt: str) -> str:
        self.seen.append(prompt)
        return self.answers[(len(self.seen) - 1) % len(self.answers)]


def batch_answers(questions: DataFrame, template: str, model: Callable[[str], str], context: DataFrame | None = None) -> DataFrame:
    """(q, question, answer) for a whole sheet of questions (q, question), with a context (q, context) where there is one."""
    x = questions if context is None else questions.join(context, "q", "left")
    cols = {"query": F.col("question")} | ({} if context is None else {"context": F.col("context")})
    return x.select("q", "question", generate(fill(template, **cols), model).alias("answer"))


@dataclass(frozen=True)
class TextModel:
    """A text generator: `call` from prompt to answer; where a provider streams, `stream` gives the answer piece by piece."""

    call: Callable[[str], str]
    stream: Callable[[str], Iterator[str]] | None = None
    count: Callable[[str], int] = lambda text: len(text.split())
    name: str = "own"

    def __call__(self, prompt: str) -> str:
        return self.call(prompt)

    def pieces(self, prompt: str) -> Iterator[str]:
        """The answer in pieces; in one where the provider does not stream."""
        yield from self.stream(prompt) if self.stream else [self.call(prompt)]

    async def later(self, prompt: str) -> str:
        """The answer without blocking the caller's loop."""
        import asyncio

        return await asyncio.to_thread(self.call, prompt)

    def tokens(self, text: str) -> int:
        return self.count(text)


#: What models are asked for: answers, extraction, and query texts (fixed values).
ROLES = ("chat", "extract", "query")


@dataclass
class Models:
    """Providers by name, and which one plays each role; embedders and rerankers likewise. Nothing here talks to a network itself."""

    providers: dict[str, Callable[[], TextModel]] = field(default_factory=dict)
    roles: dict[str, str] = field(default_factory=dict)
    embedders: dict[str, Callable[[list[str]], np.ndarray]] = field(default_factory=lambda: {"hashing": hashing_embedder()})

    def register(self, name: str, make: Callable[[], TextModel]) -> Models:
        self.providers[name] = make
        return self

    def assign(self, role: str, name: str) -> Models:
        if role not in ROLES or name not in self.providers:
            raise ValueError(f"no role {role!r} or no provider {name!r}")
        self.roles[role] = name
        return self

    def of(self, role: str) -> TextModel:
        """The model of a role; the chat model where the role has none."""
        name = self.roles.get(role) or self.roles.get("chat")
        if name is None:
            raise ValueError(f"no provider for {role!r}")
        return self.providers[name]()

    def embedder(self, name: str = "hashing") -> Callable[[list[str]], np.ndarray]:
        return self.embedders[name]


def answer_sheet(questions: DataFrame, kinds: Mapping[str, Callable[[DataFrame], DataFrame]], preview: int | None = None) -> DataFrame:
    """(q, question, one column per kind): a sheet of questions (q, question) answered in several ways at once; `preview` rows at most.

    kinds: column name -> from (q, question) to (q, .., answer), such as partial calls of `plans.flows.answers`.
    """
    asked = questions if preview is None else questions.orderBy("q").limit(preview)
    out = asked.select("q", "question")
    for name, f in kinds.items():
        out = out.join(f(asked).select("q", F.col("answer").alias(name)), "q", "left")
    return out
