"""Spellings of one person's or organisation's name: suffix blocking, longest common subsequences, components.

A name is read into a core (surname, or the company's own word) and a facet (formal given names, or the line of business);
readings are compared only if all other fields agree.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessagraph.session import checkpoint, small

#: Short forms of given names (fixed values, common English usage).
SHORT_FORMS = {
    "abigail": "abby gail", "alexander": "alex sasha xander alec", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catalina": "lina cata", "charles": "charlie chuck", "christopher": "chris kit",
    "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "dorothy": "dot dolly dottie", "edward": "ed eddie ted ned", "eleanor": "nora ellie nell", "elizabeth": "liz betty beth lizzie eliza", "frances": "fran frannie", "frederick": "fred freddy freddie",
    "gabriel": "gabe", "gregory": "greg", "harriet": "hattie", "henry": "hank harry", "ignatius": "iggy", "isabella": "bella izzy", "james": "jim jimmy jamie", "jennifer": "jen jenny", "john": "jack johnny", "jonathan": "jon", "joseph": "joe joey", "josephine": "josie jo",
    "katherine": "kate kathy katie kat", "lawrence": "larry", "leonard": "leo lenny len", "margaret": "maggie meg peggy", "matthew": "matt", "maximilian": "max", "michael": "mike mick mickey", "nathaniel": "nat nate", "nicholas": "nick nicky", "octavia": "tavi",
    "patricia": "pat trish patty", "penelope": "penny", "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "richard": "dick rick rich richie", "robert": "bob bobby rob robbie", "samuel": "sam sammy", "steven": "steve", "susan": "sue suzie susie", "theodore": "ted theo teddy", "theresa": "terry tess tessa",
    "thomas": "tom tommy", "ursula": "ulla", "valentina": "tina vale", "victoria": "vicky tori", "vincent": "vince vinny", "wilhelmina": "mina willa", "william": "bill will billy willy liam", "yolanda": "yoli", "zachary": "zach zack",
}
TITLES = set("dr prof professor mr mrs ms miss mx sir dame hon eng ing rev fr lord lady jr sr phd md esq".split())
LEGAL = set("ltd limited inc incorporated corp corporation co company group grp holdings holding hldgs plc llc llp gmbh ag sa bv the and of".split())
#: Lines of business and how they are cut short (fixed values).
BUSINESS = {
    "energy": "enrg", "optics": "opt", "mining": "mng", "chemicals": "chem", "textiles": "txtl", "robotics": "robot", "media": "med", "timber": "tmbr", "software": "sftw", "ceramics": "ceram", "shipping": "shpg",
    "finance": "fin", "insurance": "ins", "pharmaceuticals": "pharma pharm", "logistics": "logist", "travel": "trvl", "aviation": "avn", "printing": "prtg", "foods": "fds food", "instruments": "instr", "bakery": "bkry",
}
FORMAL = {s: sorted(f for f, x in SHORT_FORMS.items() if s in x.split()) for x in SHORT_FORMS.values() for s in x.split()} | {f: [f] for f in SHORT_FORMS}
_LONGEST = sorted((k for k in FORMAL if len(k) >= 4), key=len, reverse=True)
TRADE = {s: b for b, x in BUSINESS.items() for s in [b, *x.split()]}
_PLAIN = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ð": "d", "þ": "th", "ı": "i"})
_NICKNAME = re.compile(r"[\"“”„«»(]")
#: Suffix length of the index; and the ratio of the longest common subsequence from which two cores are one.
SUFFIX, RATIO = 3, 0.75
#: Ratios from which given names that no list has are one, and below which two words are different ones.
GIVEN, WORD = 0.85, 0.5
#: Rows of one kind and field that one task links by itself; larger blocks are indexed across tasks, by suffix and in chunks of PAIRED.
CHUNK, PAIRED = 5_000, 500


def plain(s: str) -> str:
    """Without accents; other letters stay."""
    if s.isascii():
        return s
    return "".join(c for c in unicodedata.normalize("NFKD", s.translate(_PLAIN)) if not unicodedata.combining(c))


def one_slip(a: str, b: str) -> bool:
    """Whether one letter added, left out, changed or swapped with the next turns a into b."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


@lru_cache(1 << 16)
def _given(word: str) -> tuple[str, ...]:
    """Formal names that a word stands for, with one slip allowed in longer words."""
    if word in FORMAL:
        return tuple(FORMAL[word])
    if len(word) < 3:
        return ()
    near = sorted({f for k, v in FORMAL.items() if len(k) >= 4 and k in SHORT_FORMS and one_slip(word, k) for f in v})
    return tuple(near or sorted({f for k, v in FORMAL.items() if len(k) >= 4 <= len(word) and one_slip(word, k) for f in v}))


@lru_cache(1 << 16)
def _trade(word: str) -> str:
    """The line of business of a word, with one slip in longer words; 'legal' for legal forms; '' for others."""
    if word in TRADE:
        return TRADE[word]
    if word in LEGAL:
        return "legal"
    if len(word) >= 4:
        for k, b in TRADE.items():
            if len(k) >= 4 and one_slip(word, k):
                return b
        if any(len(k) >= 5 and one_slip(word, k) for k in LEGAL):
            return "legal"
    return ""


def read_person(name: str) -> tuple[list[str], list[str], str]:
    """(parts of the surname, formal given names, initial): any order of the parts; the initial stands only where no given name does."""
    s = re.sub(r"[\"“”„«»][^\"“”„«»]*[\"“”„«»]|\([^()]*\)", " ", name) if _NICKNAME.search(name) else name
    if not re.search(r"[\s,.]", s.strip()):
        s = re.sub(r"(?<=[^\W\d_])(?=[A-ZÀ-Þ][a-zà-þ])", " ", s)
    s = plain(s)
    head, comma, tail = s.partition(",")
    words = lambda x: [w.lower() for w in re.findall(r"[^\W\d_]+", re.sub(r"['’`-]", "", x))]
    first, last = (words(tail), words(head)) if comma and words(tail) else (words(s), [])
    first = [w for w in first if w not in TITLES] or first
    last = [w for w in last if w not in TITLES] or last
    full = [w for w in first if len(w) > 1]
    initials = [w for w in [*first, *last] if len(w) == 1]
    last = [w for w in last if len(w) > 1]
    if last and full:
        return [*last, *full[1:]], list(_given(full[0])) or [full[0]], ""
    if last:
        return last, [], initials[0] if initials else ""
    if len(full) == 1 and not initials:
        for k in _LONGEST:
            if full[0].startswith(k) and len(full[0]) >= len(k) + 3:
                return [full[0][len(k) :]], FORMAL[k], ""
    if len(full) == 1:
        return full[:1], [], initials[0] if initials else ""
    at = next((i for i, w in enumerate(full) if w in FORMAL), None)
    if at is None:
        at = next((i for i, w in enumerate(full) if _given(w)), None)
    if at is None:
        if initials and first and len(first[0]) == 1:
            return full, [], initials[0]
        at = 0
    if not full:
        return [], [], initials[0] if initials else ""
    return full[:at] + full[at + 1 :], list(_given(full[at])) or [full[at]], ""


def read_company(name: str, city: str | None, hint: str | None = None) -> tuple[list[str], list[str], str]:
    """(own words, lines of business, ''): without legal forms, articles, and the place in brackets.

    `hint` is the line of business from another field, for names that leave it out.
    """
    s = plain(re.sub(r"\([^()]*\)", " ", name)).lower()
    words = [w for w in re.findall(r"[^\W\d_]+", re.sub(r"['’`.]", "", s)) if w]
    kinds = [_trade(w) for w in words]
    core = [w for w, k in zip(words, kinds) if not k]
    place = set(re.findall(r"[^\W\d_]+", plain(city or "").lower()))
    own = [w for w in core if w not in place] or core
    trades = sorted({k for k in kinds if k and k != "legal"})
    if own and not trades and hint:
        trades = sorted({k for k in map(_trade, re.findall(r"[^\W\d_]+", plain(hint).lower())) if k and k != "legal"})
    return own or words, trades if own else [], ""


def read_names(df: DataFrame) -> DataFrame:
    """(id, kind, field, core, parts, facet, initial) of (id, kind, name, field, place, hint); kind 'person' or another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [read_person(n) if k == "person" else read_company(n, p, h) for k, n, p, h in zip(*[b[x].to_pylist() for x in ("kind", "name", "place", "hint")])]
            parts, facet, initial = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_pydict({"id": b["id"], "kind": b["kind"], "field": b["field"], "core": pa.array(["".join(p) for p in parts], pa.string()), "parts": pa.array(parts, pa.list_(pa.string())), "facet": pa.array(facet, pa.list_(pa.string())), "initial": pa.array(initial, pa.string())})

    return df.select("id", "kind", "name", "field", "place", "hint").mapInArrow(run, f"id {dict(df.dtypes)['id']}, kind string, field string, core string, parts array<string>, facet array<string>, initial string")


@lru_cache(1 << 16)
def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    if len(a) < len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & at.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str, least: float = 0.0) -> float:
    """2 * longest common subsequence / sum of lengths; 0 for two empty ones, and where the lengths alone rule out `least`."""
    total = len(a) + len(b)
    if not total or 2 * min(len(a), len(b)) < least * total:
        return 0.0
    return 1.0 if a == b else 2 * lcs(a, b) / total


def same_facet(kind: str, a: list[str], a_initial: str, b: list[str], b_initial: str) -> bool:
    """Whether given names, or lines of business, can be one.

    Known ones must share a formal name; names that no list has are one at a ratio of GIVEN. A person's initial stands for any
    name that begins with it; a company may leave its line of business out.
    """
    if a and b:
        return not set(a).isdisjoint(b) or (kind == "person" and len(a) == len(b) == 1 and a[0] not in FORMAL and b[0] not in FORMAL and ratio(a[0], b[0], GIVEN) >= GIVEN)
    if kind != "person":
        return True
    if not a and not b:
        return a_initial == b_initial
    return any(x.startswith(a_initial or b_initial) for x in a or b)


def likeness(kind: str, a: tuple, b: tuple, least: float) -> float:
    """The ratio of two readings' cores (core, parts, facet, initial) if they can name one entity, else 0.

    Cores of equally many words must agree word by word too, so that a long common word does not hide another one.
    """
    if not same_facet(kind, a[2], a[3], b[2], b[3]):
        return 0.0
    r = ratio(a[0], b[0], least)
    if r < least or (len(a[1]) == len(b[1]) > 1 and any(max(ratio(x, y) for y in b[1]) < WORD for x in a[1])):
        return 0.0
    return r


@F.pandas_udf(DoubleType())
def likenesses(kind: pd.Series, a: pd.DataFrame, b: pd.DataFrame, least: pd.Series) -> pd.Series:
    rows = lambda x: zip(x["core"], x["parts"].map(list), x["facet"].map(list), x["initial"])
    return pd.Series([likeness(k, x, y, r) for k, x, y, r in zip(kind, rows(a), rows(b), least)], dtype="float64")


def link_block(kind: str, rows: list[tuple], least: float, suffix: int = SUFFIX) -> list[tuple]:
    """(id, entity) of the rows (id, core, parts, facet, initial) of one kind and field: `link_names` for a block that fits a task.

    The suffix index is a table of the block: no suffix is discarded, as the block is refined by the other fields already.
    """
    ids: dict[tuple, list] = {}
    for i, core, parts, facet, initial in rows:
        ids.setdefault((core, tuple(parts), tuple(facet), initial), []).append(i)
    nodes = sorted((min(v), k) for k, v in ids.items())
    index: dict[tuple, list[int]] = {}
    for n, (_, (core, _, facet, initial)) in enumerate(nodes):
        for key in {("c", core[-suffix:]), *(("f", f[-suffix:]) for f in facet)}:
            index.setdefault(key, []).append(n)
        for letter in {f[0] for f in facet} if facet and kind == "person" else {initial}:
            index.setdefault(("o", letter), []).append(n)
    closed = [len(k[2]) == 1 for _, k in nodes]
    links: dict[tuple[int, int], float] = {}
    for (tag, _), some in index.items():
        for x, a in enumerate(some):
            for b in some[x + 1 :]:
                if (a, b) not in links and (tag != "o" or not nodes[a][1][2] or not nodes[b][1][2]):
                    links[a, b] = likeness(kind, nodes[a][1], nodes[b][1], least)
    of = list(range(len(nodes)))

    def top(n: int) -> int:
        while of[n] != n:
            of[n] = of[of[n]]
            n = of[n]
        return n

    def unite(pairs) -> None:
        for a, b in pairs:
            x, y = top(a), top(b)
            of[max(x, y)] = min(x, y)

    good = {p: r for p, r in links.items() if r >= least}
    unite(p for p in good if closed[p[0]] and closed[p[1]])
    options: dict[int, dict[int, float]] = {}
    for (a, b), r in good.items():
        for n, to in ((a, b), (b, a)):
            if closed[to] and not closed[n]:
                best = options.setdefault(n, {})
                best[top(to)] = max(best.get(top(to), 0.0), r)
    unite(p for p in good if not closed[p[0]] and not closed[p[1]] and p[0] not in options and p[1] not in options)
    out = []
    for n, (_, key) in enumerate(nodes):
        joined = [e for e, r in options[n].items() if r == max(options[n].values())] if n in options else [top(n)]
        out += [(i, nodes[e][0]) for i in ids[key] for e in joined]
    return out


def candidate_pairs(nodes: DataFrame, suffix: int = SUFFIX, chunk: int = PAIRED) -> DataFrame:
    """(a, b): ids a < b of nodes (node, kind, field, core, facet) of one kind and field that share a suffix of a part.

    The index holds, for the core and each facet, the suffix of the least length (a part that is shorter as a whole): two parts
    that share a longer suffix share that one too. A suffix alone is common, so that every block is refined with the
    kind and the field, which must be equal anyway, and no suffix needs to be discarded. Blocks that are still larger than
    `chunk` are cut into chunks by hash, and each pair of chunks is compared in a group of its own: none is lost. Readings
    without a facet have only their core in the index, which a slip near its end changes; they are compared with all readings
    of their field and initial too.
    """
    part = lambda tag, c: F.concat(F.lit(tag), F.substring(c, -suffix, suffix))
    keys = F.array_distinct(F.concat(F.array(part("c", F.col("core"))), F.transform("facet", lambda f: part("f", f))))
    posts = checkpoint(nodes.select("node", "kind", "field", F.explode(keys).alias("suffix")))
    block = ["kind", "field", "suffix"]
    big = checkpoint(posts.groupBy(*block).agg(F.count("*").alias("n")).filter(F.col("n") > chunk).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")).drop("n"))
    if big.isEmpty():
        posts = posts.withColumn("chunks", F.lit(1))
    else:
        posts = posts.join(F.broadcast(big) if small(big) else big, block, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    posts = posts.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    left = posts.select(*block, F.col("own").alias("i"), other.alias("j"), F.col("node").alias("a"))
    right = posts.select(*block, F.col("own").alias("j"), other.alias("i"), F.col("node").alias("b"))
    found = left.join(right, [*block, "i", "j"]).filter("a < b").select("a", "b")
    return found.unionByName(_open_pairs(nodes, chunk)).distinct()


def _open_pairs(nodes: DataFrame, chunk: int) -> DataFrame:
    """(a, b): readings without a facet beside every reading of their kind and field whose facet can begin with their initial."""
    letters = F.when(F.size("facet") == 0, F.array("initial")).otherwise(F.when(F.col("kind") == "person", F.array_distinct(F.transform("facet", lambda f: F.substring(f, 1, 1)))).otherwise(F.array(F.lit(""))))
    all_ = nodes.select("node", "kind", "field", F.explode(letters).alias("letter"), (F.size("facet") == 0).alias("open"))
    open_ = all_.filter("open").select("kind", "field", "letter", F.col("node").alias("a"))
    on = ["kind", "field", "letter"]
    sized = all_.groupBy(*on).agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"), F.max("open").alias("any")).filter("any").drop("any")
    left = open_.join(sized, on).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    right = all_.join(sized, on).select(*on, F.col("node").alias("b"), F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("j"))
    return left.join(right, [*on, "j"]).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each connected component of edges (a, b), by minima and pointer jumps.

    Each round takes the smallest label among neighbours and then the label of that label; it ends when nothing changes.
    """
    both = checkpoint(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        step = labels.join(near, "a").select("a", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        jump = labels.select(F.col("a").alias("l"), F.col("l").alias("ll"))
        new = checkpoint(step.join(jump, "l", "left").select("a", "old", F.least("l", F.coalesce("ll", "l")).alias("l")))
        labels = new.select("a", "l")
        if new.filter("l <> old").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("l").alias("component"))


def link_names(df: DataFrame, least: float = RATIO, chunk: int = CHUNK) -> DataFrame:
    """(id, entity): rows of df (id, kind, name, field, place, hint) that name one entity share the smallest id as entity.

    Readings with one formal given name or one line of business are linked if it is the same and their cores agree; their
    components are the entities. A reading that leaves it open (an initial, a short form of several names, no line of
    business) joins the entity with the most similar core; if several are equally similar, it comes out with each of them, as
    its name can be read as either. Open readings that agree only among themselves form an entity. Rows with a null name or
    field stand for themselves. Blocks of equal kind and field are linked in one task each, after one shuffle; the blocks
    of more than `chunk` rows, known from counts, go through an index of suffixes across tasks, with the same result.
    """
    usable = df.filter(F.col("name").isNotNull() & F.col("field").isNotNull()).select("id", "kind", "name", "field", "place", "hint").distinct()
    read = checkpoint(read_names(usable))
    kind_of = dict(read.dtypes)["id"]
    block = ["kind", "field"]
    big = checkpoint(read.groupBy(*block).agg(F.count("*").alias("n")).filter(F.col("n") > chunk).select(*block))
    none = big.isEmpty()
    narrow = big if none else F.broadcast(big) if small(big) else big

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*[b[c].to_pylist() for c in ("kind", "field", "id", "core", "parts", "facet", "initial")])

        ids, entities = [], []
        type_ = pa.int64() if kind_of == "bigint" else pa.int32() if kind_of == "int" else pa.string()
        made = lambda: pa.RecordBatch.from_pydict({"id": pa.array(ids, type_), "entity": pa.array(entities, type_)})
        for (kind, _), some in groupby(rows(), key=lambda r: r[:2]):
            for i, e in link_block(kind, [r[2:] for r in some], least):
                ids.append(i)
                entities.append(e)
            if len(ids) > 10_000:
                yield made()
                ids.clear()
                entities.clear()
        if ids:
            yield made()

    few = (read if none else read.join(narrow, block, "left_anti")).repartition(*block).sortWithinPartitions(*block)
    linked = few.mapInArrow(run, f"id {kind_of}, entity {kind_of}")
    if not none:
        linked = linked.unionByName(_link_across(read.join(narrow, block, "left_semi"), least, min(chunk, PAIRED)))
    linked = checkpoint(linked.distinct())
    rest = df.filter(F.col("name").isNull() | F.col("field").isNull()).select("id", F.col("id").alias("entity")).distinct()
    return linked.unionByName(rest.join(linked.select("id").distinct(), "id", "left_anti"))


def _link_across(read: DataFrame, least: float, chunk: int) -> DataFrame:
    """`link_names` for readings of large blocks, by joins."""
    spelled = ["kind", "field", "core", "parts", "facet", "initial"]
    nodes = checkpoint(read.groupBy(*spelled).agg(F.min("id").alias("node")))
    of = read.join(nodes, spelled).select("id", "node")
    info = nodes.select("node", "kind", F.struct("core", "parts", "facet", "initial").alias("read"), (F.size("facet") == 1).alias("closed"))
    side = lambda x: info.select(*[F.col(c).alias(f"{x}_{c}") for c in info.columns]).withColumnRenamed(f"{x}_node", x)
    pairs = candidate_pairs(nodes, chunk=chunk).join(side("a"), "a").join(side("b"), "b")
    scored = pairs.withColumn("ratio", likenesses("a_kind", "a_read", "b_read", F.lit(least))).filter(F.col("ratio") >= least)
    links = checkpoint(scored.select("a", "b", "ratio", "a_closed", "b_closed"))
    firm = components(links.filter("a_closed and b_closed"))
    entity = info.filter("closed").select("node").join(firm, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    loose = links.filter("a_closed and not b_closed").select(F.col("b").alias("node"), F.col("a").alias("to"), "ratio").unionByName(links.filter("b_closed and not a_closed").select(F.col("a").alias("node"), F.col("b").alias("to"), "ratio"))
    options = loose.join(entity.withColumnRenamed("node", "to"), "to").groupBy("node", "component").agg(F.max("ratio").alias("ratio"))
    best = options.groupBy("node").agg(F.max("ratio").alias("best"))
    joined = checkpoint(options.join(best, "node").filter("ratio = best").select("node", "component"))
    taken = joined.select("node").distinct()
    alone = links.filter("not a_closed and not b_closed").join(taken.withColumnRenamed("node", "a"), "a", "left_anti").join(taken.withColumnRenamed("node", "b"), "b", "left_anti")
    found = checkpoint(entity.unionByName(joined).unionByName(components(alone.select("a", "b"))))
    return of.join(found, "node", "left").select("id", F.coalesce("component", "node").alias("entity"))


def entity_pairs(linked: DataFrame) -> DataFrame:
    """(id_a, id_b): all pairs id_a < id_b of one entity."""
    return linked.select(F.col("id").alias("id_a"), "entity").join(linked.select(F.col("id").alias("id_b"), "entity"), "entity").filter("id_a < id_b").select("id_a", "id_b").distinct()
