"""Repetition inside single texts: every rule is evaluated once, into a bit mask and measurements."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessagraph.llm.arrays import bound_batches, by_chunks, code_points, kinds

#: Name and threshold of each rule; the i-th sets bit i of `failed` if its measurement is at least the threshold.
RULES = [
    ("passages", 0.30), ("lines", 0.30), ("line_chars", 0.20), ("paragraphs", 0.30), ("paragraph_chars", 0.20), ("sentences", 0.30),
    ("sentence_chars", 0.20), ("five_words", 0.30), ("top_two_words", 0.20), ("one_sign", 0.50),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
#: Letters and digits in the shortest passage that counts as repeated.
PASSAGE = 20
_B = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xC2B2AE3D27D4EB4F)
_SENTENCE_END = "。！？!?；;\n\r"


def _power(b: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(b), n, 1 << 64))


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of all windows of k values, from windows of powers of two."""
    v = (values.astype(np.uint64) + np.uint64(1)) * _C
    v ^= v >> np.uint64(29)
    out, width, base, done = None, 1, v, 0
    while k >> done:
        if k >> done & 1:
            if out is None:
                out, have = base, width
            else:
                n = len(base) - have
                out = out[width : width + n] + base[:n] * _power(_B, have) if n > 0 else base[:0]
                have += width
        if k >> (done + 1):
            n = len(base) - width
            if n <= 0:
                return base[:0]
            base = base[:n] * _power(_B, width) + base[width:]
            width *= 2
        done += 1
    return out[: max(0, len(values) - k + 1)]


def _mixed(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    h = (h ^ (doc.astype(np.uint64) * _B)) * _C
    return h ^ (h >> np.uint64(32))


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(later, first): indices whose key stood earlier, and the earliest index of that key."""
    if len(keys) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    k = keys[order]
    new = np.append(True, k[1:] != k[:-1])
    if new.all():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(k)))
    many = size > 1
    lead = np.minimum.reduceat(order, at)
    group = np.repeat(np.arange(len(at)), size)
    own = many[group]
    idx, first = order[own], lead[group[own]]
    later = idx != first
    return idx[later], first[later]


def _covered(letters: np.ndarray, doc: np.ndarray, n: int, k: int) -> np.ndarray:
    """Letters per text that stand in a window of k letters that stood earlier in the same text."""
    h = window_hashes(letters, k)
    if not len(h):
        return np.zeros(n)
    inside = np.flatnonzero(doc[: len(h)] == doc[k - 1 :])
    later, first = repeats(_mixed(h[inside], doc[inside]))
    later, first = inside[later], inside[first]
    if len(later):
        same = doc[later] == doc[first]
        for i in range(k):  # the hash proposes, the letters decide
            same &= letters[later + i] == letters[first + i]
        later = later[same]
    edge = np.zeros(len(letters) + 1, np.int32)
    np.add.at(edge, later, 1) if len(later) < 1000 else edge.__iadd__(np.bincount(later, minlength=len(edge)).astype(np.int32))
    edge -= np.bincount(later + k, minlength=len(edge)).astype(np.int32)
    return np.bincount(doc, np.cumsum(edge[:-1]) > 0, n)


def _segments(letters_before: np.ndarray, prefix: np.ndarray, inverse: np.ndarray, breaks: np.ndarray, doc_of_break: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(share of segments, share of letters) per text in segments that stood earlier. breaks: sorted text positions."""
    a, b = letters_before[breaks[:-1]], letters_before[breaks[1:]]
    keep = b > a
    a, b, doc = a[keep], b[keep], doc_of_break[:-1][keep]
    if not len(a):
        return np.zeros(n), np.zeros(n)
    h = (prefix[b] - prefix[a]) * inverse[a]
    later, _ = repeats(_mixed(h + (b - a).astype(np.uint64) * _B, doc))
    total, letters = np.bincount(doc, minlength=n), np.bincount(doc, b - a, n)
    return np.bincount(doc[later], minlength=n) / np.maximum(total, 1), np.bincount(doc[later], (b - a)[later], n) / np.maximum(letters, 1)


def measure(texts: list[str], k: int = PASSAGE) -> np.ndarray:
    """One row per text, one column per rule; see `repetition_ledger`."""
    return measured(texts, k)[0]


def measured(texts: list[str], k: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """`measure`, and the letters and digits of each text."""
    n = len(texts)
    codes, starts = code_points([t.lower() for t in texts], 1)
    doc_all = np.repeat(np.arange(n), np.diff(starts))
    is_letter = kinds()[codes] == 1
    letters, doc = codes[is_letter], doc_all[is_letter]
    count = np.bincount(doc, minlength=n)
    out = np.zeros((n, len(RULES)))
    out[:, 0] = _covered(letters, doc, n, k) / np.maximum(count, 1)
    letters_before = np.append(0, np.cumsum(is_letter))
    powers = np.ones(len(letters) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(letters), _B), out=powers[1:])
    inverses = np.ones(len(letters) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(letters), np.uint64(pow(int(_B), -1, 1 << 64))), out=inverses[1:])
    prefix = np.append(np.uint64(0), np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * _C * powers[:-1], dtype=np.uint64))
    line = (codes == 10) | (codes == 13)
    for col, mark in ((1, line), (3, line & np.append(line[1:], False)), (5, np.isin(codes, [ord(c) for c in _SENTENCE_END]) | ((codes == 46) & np.append(~is_letter[1:], True)))):
        mark = mark.copy()
        mark[starts[1:] - 1] = True
        breaks = np.append(0, np.flatnonzero(mark) + 1)
        share, chars = _segments(letters_before, prefix, inverses, breaks, doc_all[np.minimum(breaks, len(codes) - 1)], n)
        out[:, col] = share
        if col + 1 < 7:
            out[:, col + 1] = chars
    first = np.flatnonzero(is_letter & np.append(True, ~is_letter[:-1])) if len(codes) else np.zeros(0, np.int64)
    last = np.flatnonzero(is_letter & np.append(~is_letter[1:], True)) + 1 if len(codes) else first
    a, b = letters_before[first], letters_before[last]
    word = (prefix[b] - prefix[a]) * inverses[a] + (b - a).astype(np.uint64) * _B
    wdoc, size = doc_all[first], b - a
    for col, w in ((7, 5), (8, 2)):
        h = window_hashes(word ^ (word >> np.uint64(31)), w)
        inside = np.flatnonzero(wdoc[: len(h)] == wdoc[w - 1 :]) if len(h) else np.zeros(0, np.int64)
        key = _mixed(h[inside], wdoc[inside]) if len(inside) else np.zeros(0, np.uint64)
        later, lead = repeats(key)
        if w == 5:
            out[:, col] = np.bincount(wdoc[inside[later]], minlength=n) / np.maximum(np.bincount(wdoc[inside], minlength=n), 1)
        elif len(later):
            times = np.bincount(lead, minlength=len(inside))
            top = np.flatnonzero(times)
            span = size[inside[top]] + size[inside[top] + 1]
            np.maximum.at(out[:, col], wdoc[inside[top]], np.minimum(1, (times[top] + 1) * span / np.maximum(count[wdoc[inside[top]]], 1)))
    width = np.maximum(np.diff(starts) - 1, 1)
    pair = doc_all.astype(np.int64) * 0x110000 + codes
    pair = np.sort(pair[(kinds()[codes] != 2) & (codes > 0)])
    if len(pair):
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        np.maximum.at(out[:, 9], pair[at] // 0x110000, np.diff(np.append(at, len(pair))) / width[pair[at] // 0x110000])
    return out, count


def repetition_ledger(df: DataFrame, id_col: str, text_col: str, passage: int = PASSAGE) -> DataFrame:
    """(id, failed, n_letters, measures): the failure bits of RULES and their measurements for each text.

    passages: share of letters and digits inside passages of `passage` or more letters and digits that already stood earlier
    in the text, whatever the case, spacing and punctuation. lines, paragraphs, sentences: share of segments that stood
    earlier, and (.._chars) of their letters; segments without letters don't count. five_words: share of five-word shingles
    that stood earlier. top_two_words: share of letters in the most frequent pair of words that occurs more than once.
    one_sign: share of the most frequent sign that is no whitespace. A null, empty or letterless text measures 0 and fails
    nothing but one_sign. Whole texts are read; nothing is shuffled. Rows with one id come out each for itself.
    """
    src = bound_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")))
    limits = np.array([t for _, t in RULES])
    weights = 1 << np.arange(len(RULES), dtype=np.int64)

    def run(ids: list, texts: list[str]) -> pa.RecordBatch:
        m, letters = measured(texts, passage)
        return pa.RecordBatch.from_pydict({"id": pa.array(ids), "failed": pa.array(((m >= limits) * weights).sum(1)), "n_letters": pa.array(letters), "measures": pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), len(RULES)).cast(pa.list_(pa.float64()))})

    return src.mapInArrow(by_chunks(run, "id", "text"), f"id {dict(src.dtypes)['id']}, failed bigint, n_letters bigint, measures array<double>")


@dataclass(frozen=True)
class Policy:
    """A version of which rules count, and how many of them must fail before a text is dropped."""

    name: str
    version: int
    rules: tuple[str, ...]
    at_least: int = 1

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = [
    Policy("passages_only", 1, ("passages",)),
    Policy("segments", 1, ("lines", "paragraphs", "sentences")),
    Policy("segments", 2, ("line_chars", "paragraph_chars", "sentence_chars", "five_words")),
    Policy("any_rule", 1, tuple(BIT)),
    Policy("two_rules", 1, tuple(BIT), 2),
]


def apply_policies(ledger: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """(policy, version, texts, dropped): what each policy would drop, from the counts per bit mask alone."""
    rows = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    p = F.explode(F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(p.mask).cast("bigint").alias("mask"), F.lit(p.at_least).alias("at_least")) for p in policies]))
    hit = F.bit_count(F.col("failed").bitwiseAND(F.col("p.mask"))) >= F.col("p.at_least")
    return rows.select("failed", "n", p.alias("p")).groupBy("p.policy", "p.version").agg(F.sum("n").alias("texts"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("dropped"))


def ablate(ledger: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """(policy, version, rule, failing, dropped_without, only_by_it): each policy with each of its rules left out.

    failing: texts that fail the rule; dropped_without: texts that the policy drops without it; only_by_it: texts
    that it drops only thanks to the rule. Works on the counts per bit mask, at most 2^rules rows.
    """
    rows = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    each = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit"), F.lit(p.mask).cast("bigint").alias("mask"), F.lit(p.at_least).alias("at_least")) for p in policies for r in p.rules]
    x = rows.select("failed", "n", F.explode(F.array(*each)).alias("p")).select("failed", "n", "p.*")
    own = F.col("failed").bitwiseAND(F.col("bit")) != 0
    with_ = F.bit_count(F.col("failed").bitwiseAND(F.col("mask"))) >= F.col("at_least")
    without = F.bit_count(F.col("failed").bitwiseAND(F.col("mask") - F.col("bit"))) >= F.col("at_least")
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return x.groupBy("policy", "version", "rule").agg(total(own).alias("failing"), total(without).alias("dropped_without"), total(with_ & ~without).alias("only_by_it"))
