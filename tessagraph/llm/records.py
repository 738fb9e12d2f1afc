"""Records that are the same but for formatting: commutative multiset hashing with exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessagraph.session import checkpoint, split_join

#: Sums of hashes are taken modulo this prime, so that they cannot overflow.
PRIME = (1 << 61) - 1
#: Stands for a call whose arguments were taken out.
SLOT = "\x01"


def letters_and_digits(c: Column) -> Column:
    """Lower case, only letters and digits; a point between two digits stays, as it belongs to the number."""
    return F.lower(F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}.{SLOT}]|\.(?!\p{{N}})|(?<!\p{{N}})\.", ""))


def _call(name: str) -> str:
    return rf"(?i){r'\s*'.join(name)}\s*\(([^()]*)\)"


def record_fields(df: DataFrame, id_col: str, plain: list[str], listed: dict[str, str]) -> DataFrame:
    """(id, fields): each record as array of 'name=normalised value' strings.

    plain: columns whose whole value is one field. listed: column -> name of a call in it whose listed names may stand in any
    order; the text around the calls is one field, and each name of the i-th call another. A null value is its own
    value, equal only to null. Repeated names count as often as they stand there.
    """
    fields = []
    for c in plain:
        fields.append(F.array(F.coalesce(F.concat(F.lit(f"{c}="), letters_and_digits(F.col(c))), F.lit(f"{c} is null"))))
    for c, call in listed.items():
        rest = letters_and_digits(F.regexp_replace(F.regexp_replace(F.col(c), SLOT, ""), _call(call), SLOT))
        fields.append(F.array(F.coalesce(F.concat(F.lit(f"{c}="), rest), F.lit(f"{c} is null"))))
        calls = F.regexp_extract_all(F.col(c), F.lit(_call(call)), F.lit(1))
        names = F.flatten(F.transform(calls, lambda a, i: F.transform(F.split(a, ","), lambda n: F.concat(F.lit(f"{c}["), i.cast("string"), F.lit("]="), letters_and_digits(n)))))
        fields.append(F.coalesce(F.filter(names, lambda n: ~n.endswith("]=")), F.array().cast("array<string>")))
    return df.select(F.col(id_col).alias("id"), F.concat(*fields).alias("fields"))


def multiset_hash(fields: Column, seed: int) -> Column:
    """Sum of the fields' hashes modulo a prime: the same for any order of the fields, and sensitive to repetition."""
    return F.aggregate(fields, F.lit(0).cast("bigint"), lambda acc, x: (acc + F.pmod(F.xxhash64(F.lit(seed), x), F.lit(PRIME))) % F.lit(PRIME))


def same_multiset(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same elements equally often: by hash sets, and by counts only where elements repeat; sorts nothing."""
    times = lambda xs, y: F.size(F.filter(xs, lambda x: x == y))
    sets = (F.size(a) == F.size(b)) & (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    once = F.size(F.array_distinct(a)) == F.size(a)
    return sets & ((once & (F.size(F.array_distinct(b)) == F.size(b))) | F.forall(F.array_distinct(a), lambda y: times(a, y) == times(b, y)))


def collapse(records: DataFrame, heavy_rows: int = 100_000) -> DataFrame:
    """(first_id, copy_id): for each record that is a copy, the smallest id of its class and its own id.

    records: (id unique, fields array<string>). The table is read and normalised once, into a checkpoint. Classes come from a
    122-bit commutative fingerprint in a hash aggregation with map-side combine, so that a class with a third of all rows
    costs one row per task; joins back to such classes are broadcast after a count. Only rows of classes with copies go
    on; each is compared with its class's first record field by field; rows that fail (a collision of fingerprints) are
    grouped by their very fields instead. Empty input gives an empty result.
    """
    keyed = checkpoint(records.withColumns({"f1": multiset_hash(F.col("fields"), 11), "f2": multiset_hash(F.col("fields"), 23)}))
    classes = checkpoint(keyed.groupBy("f1", "f2").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").withColumn("heavy", F.col("n") >= heavy_rows).drop("n"))
    on = ["f1", "f2"]
    members = checkpoint(split_join(keyed, classes, on, "heavy"))
    firsts = members.filter("id = first_id").select(*on, F.col("fields").alias("first_fields")).join(classes.select(*on, "heavy"), on)
    judged = split_join(members.filter("id <> first_id"), firsts, on, "heavy").withColumn("same", same_multiset(F.col("fields"), F.col("first_fields")))
    judged = checkpoint(judged.select("id", "first_id", "same", F.when(~F.col("same"), F.array_sort("fields")).alias("fields")))
    good = judged.filter("same").select("first_id", F.col("id").alias("copy_id"))
    bad = judged.filter("not same")
    again = bad.join(bad.groupBy("fields").agg(F.min("id").alias("own_first")), "fields").filter("id <> own_first").select(F.col("own_first").alias("first_id"), F.col("id").alias("copy_id"))
    return good.unionByName(again)
