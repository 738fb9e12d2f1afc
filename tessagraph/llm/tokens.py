"""Token counts by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessagraph.llm.arrays import bound_batches

#: Rank file (token in base64 and its rank per line) that every executor can read.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How texts are split before byte pairs are merged (fixed value of these vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoding(path: str):
    """The tokenizer of a rank file; once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text_col: str, keep: dict[str, str], vocabulary: str = VOCABULARY) -> DataFrame:
    """(new names of `keep`..., tokens): columns old -> new, and the tokens of the whole text; null and '' have 0."""
    src = bound_batches(df.select(*[df[a].alias(b) for a, b in keep.items()], df[text_col].alias("_text")))
    names = list(keep.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoding(vocabulary).encode_ordinary
        for b in batches:
            n = pa.array([len(count(t)) if t else 0 for t in b.column("_text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], n], [*names, "tokens"])

    out = src.select(*names, F.lit(0).cast("bigint").alias("tokens")).schema
    return src.mapInArrow(run, out)
