import random
from collections import Counter
from itertools import combinations

import pytest

from tessagraph.llm.mixing import mix_sources, warming_schedule
from tessagraph.llm.packing import lower_bound, make_plan, pack
from tessagraph.llm.tokens import encoding, with_token_counts


def bins_of(plan):
    fill, seen = {}, Counter()
    runs = sorted(plan.runs)
    for (size, first, base, each), nxt in zip(runs, [*runs[1:], None]):
        stop = nxt[1] if nxt and nxt[0] == size else plan.used[size]
        assert first == seen[size]
        for r in range(stop - first):
            fill.setdefault(base + r // each, []).append(size)
        seen[size] = stop
    return fill


def best_possible(items, c):
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j in {b: k for k, b in enumerate(bins)}.values():
            if bins[j] + items[i] <= c:
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best


def test_plans_are_valid_and_near_the_best():
    rng = random.Random(1)
    for n in range(400):
        c = rng.choice([7, 10, 23, 100])
        items = [rng.randint(1, c) for _ in range(rng.randint(0, 9 if n < 250 else 300))]
        h = Counter(items)
        plan = make_plan(h, c)
        fill = bins_of(plan)
        assert sorted(x for b in fill.values() for x in b) == sorted(items)
        assert set(fill) == set(range(plan.containers)) and all(sum(b) <= c for b in fill.values())
        assert lower_bound(h, c) <= plan.containers
        if n < 250:
            best = best_possible(items, c)
            assert lower_bound(h, c) <= best <= plan.containers <= best + 1


def test_reduction_alone_is_optimal_for_pairs():
    plan = make_plan({6: 3, 4: 3, 9: 2}, 10)
    assert (plan.containers, plan.fixed) == (5, 5)
    assert make_plan({}, 10).containers == 0 and make_plan({5: 5}, 10).containers == 3


def test_pack_tables(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([0, 3, 40, 99, 100, 101, 250])) for i in range(300)] + [(7, 40), (8, None)]
    items = spark.createDataFrame(rows, "id bigint, tokens bigint")
    packs = spark.createDataFrame([("s", 100), ("s", 100), ("l", 1000), (None, 5), ("bad", 0)], "pack_name string, capacity_tokens int")
    out, summary = pack(items, packs)
    got = out.collect()
    info = {r.pack_name: r for r in summary.collect()}
    assert set(info) == {"s", "l"}
    for name, cap in (("s", 100), ("l", 1000)):
        own = [r for r in got if r.pack_name == name]
        fill = Counter()
        for r in own:
            fill[r.container_id] += r.tokens
        assert max(fill.values()) <= cap and set(fill) <= set(range(info[name].containers))
        assert sum(r.tokens for r in own) == sum(t or 0 for _, t in rows) == info[name].tokens
        assert {i for i, _ in rows} == {r.id for r in own}
        pieces = Counter(r.id for r in own)
        assert all(pieces[i] == max(1, -(-(t or 0) // cap)) for i, t in rows if i not in (7, 8))
    assert pack(items.limit(0), packs)[0].count() == 0
    assert pack(items, packs.limit(0))[0].count() == 0


def test_ranks_of_large_sizes(spark, monkeypatch):
    import tessagraph.llm.packing as packing

    monkeypatch.setattr(packing, "GROUP", 10)
    out, summary = pack(spark.range(95).selectExpr("id", "30L tokens"), spark.createDataFrame([("s", 100)], "pack_name string, capacity_tokens int"))
    assert Counter(Counter(r.container_id for r in out.collect()).values()) == {3: 31, 2: 1}
    assert summary.first().containers == 32


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, s, rng.randint(1, 50)) for i in range(2000) for s in [rng.choice(["a", "a", "a", "b", "c", "x", None])]] + [(5000, "a", None), (5001, "a", 0)]
    df = spark.createDataFrame(docs, "id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("void", 0.1, 5), (None, 0.5, 1), ("a", 0.3, 1)], "source string, target_weight double, max_repeats int")
    training, shares = mix_sources(df, targets)
    rows, sh = training.collect(), {r.source: r for r in shares.collect()}
    most = {"a": 1, "b": 3, "c": 2}
    used = Counter((r.id, r.source) for r in rows)
    assert all(n <= most[s] for (_, s), n in used.items())
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    for s, w in (("a", 0.3), ("b", 0.4), ("c", 0.2)):
        assert sh[s].actual_share == pytest.approx(w / 0.9, abs=0.003)
        assert sh[s].used_tokens == sum(r.tokens for r in rows if r.source == s)
    assert sh["void"].used_tokens == sh["x"].used_tokens == sh[None].used_tokens == 0
    total = sum(r.tokens for r in rows)
    early = [r for r in rows if r.position < total / 4]
    assert sum(r.tokens for r in early if r.source == "c") / sum(r.tokens for r in early) > 0.2 / 0.9
    assert mix_sources(df, targets, total=1000)[0].agg({"tokens": "sum"}).first()[0] == pytest.approx(1000, abs=80)
    assert mix_sources(df.limit(0), targets)[0].count() == 0 and mix_sources(df, targets.limit(0))[0].count() == 0


def test_groups_do_not_change_the_mixture(spark, monkeypatch):
    import tessagraph.llm.mixing as mixing

    df = spark.range(400).selectExpr("id", "if(id % 3 = 0, 'a', 'b') source", "id % 7 + 1 tokens")
    targets = spark.createDataFrame([("a", 0.5, 4), ("b", 0.5, 1)], "source string, target_weight double, max_repeats int")
    want = [tuple(r) for r in mix_sources(df, targets)[0].collect()]
    monkeypatch.setattr(mixing, "GROUP", 7)
    assert [tuple(r) for r in mix_sources(df, targets)[0].collect()] == want


def test_schedule_keeps_means():
    s = warming_schedule({"a": 0.7, "b": 0.2, "c": 0.1})
    assert all(sum(k[i][1] for k in s.values()) == pytest.approx(1) and min(k[i][1] for k in s.values()) >= 0 for i in (0, 1))
    assert {n: round((k[0][1] + k[1][1]) / 2, 9) for n, k in s.items()} == {"a": 0.7, "b": 0.2, "c": 0.1}


def test_token_counts_are_whole_texts(spark):
    from tessagraph.llm.tokens import VOCABULARY

    texts = ["a b", None, "", "中文 text " * 500, "x" * 5000]
    df = spark.createDataFrame([(i, t, "tokens") for i, t in enumerate(texts)], "doc_id int, text string, tokens string")
    enc = encoding(VOCABULARY)
    got = {r.id: r.tokens for r in with_token_counts(df, "text", {"doc_id": "id"}).collect()}
    assert got == {i: len(enc.encode(t)) if t else 0 for i, t in enumerate(texts)}
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts if t)


def test_many_large_packs(spark):
    """More than 2^19 pairs of pack and size."""
    sizes = [131_072, 131_071, 131_000, 1, 72, 65_536, 65_536, 0, 300_000]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id bigint, tokens bigint")
    packs = spark.createDataFrame([(f"p{i}", 131_072) for i in range(5)], "pack_name string, capacity_tokens int")
    rows, summary = (x.collect() for x in pack(items, packs))
    used = Counter()
    for r in rows:
        used[r.pack_name, r.container_id] += r.tokens
    assert max(used.values()) <= 131_072 and len({r.pack_name for r in rows}) == 5
    for s in summary:
        assert sum(v for (p, _), v in used.items() if p == s.pack_name) == sum(sizes) and s.containers == len([k for k in used if k[0] == s.pack_name])
