"""Candidate pairs from equal name or address keys: the join is the inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.functions.text import address_key, by_form, normalize_name
from samewise.sources.scratch import stored
from samewise.sources.tables import read_records, to_wide, write_tsv


#: Members of a block on either side that are compared within one cell.
CELL = 512


def with_keys(records: DataFrame, unicode_form: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """entity_id, n, a: the normalized name and the address key, empty if none; and the columns of ``keep``."""
    return by_form(records.filter("entity_id <> ''"), ["business_name", "business_address"], lambda rows, may: rows.select("entity_id", normalize_name(F.col("business_name"), unicode_form and may).alias("n"), address_key(F.col("business_address"), unicode_form and may).alias("a"), *keep))


def blocking_keys(records: DataFrame, unicode_form: bool = True) -> DataFrame:
    """entity_id, key; prefixes keep name and address keys apart, empty keys are dropped."""
    keys = F.array(F.when(F.col("n") != "", F.concat(F.lit("name:"), "n")), F.when(F.col("a") != "", F.concat(F.lit("address:"), "a")))
    return with_keys(records, unicode_form).select("entity_id", F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"))


def key_sets(rows: DataFrame) -> DataFrame:
    """entity_id, names, addresses: all keys of each id, from rows of ``with_keys``."""
    return rows.groupBy("entity_id").agg(*(F.collect_set(F.when(F.col(c) != "", F.col(c))).alias(name) for c, name in (("n", "names"), ("a", "addresses"))))


def _dealt(rows: DataFrame, own: str, other: str, large: DataFrame, n: int) -> DataFrame:
    """Rows of large blocks in one of the block's slices of their side, once for each slice of the other side."""
    key, slices = "_key", lambda side: F.coalesce(F.col(f"_{side}"), F.lit(1))
    out = rows.join(F.broadcast(large), key, "left").withColumn(f"_{own}_slice", F.pmod(F.xxhash64(f"{own}_id"), slices(own)).cast("int"))
    out = out.withColumn(f"_{other}_slice", F.explode(F.sequence(F.lit(0), (slices(other) - 1).cast("int"))))
    return out.drop("_a", "_b").repartition(n, key, "_a_slice", "_b_slice")


def single_keys(rows: DataFrame) -> DataFrame:
    """A row for each key of rows with one name ``n`` and one address key ``a``, empty if none: _key, and _not.

    A pair that shares an address key is left to its name block if its _not are equal.
    """
    n = F.when(F.col("n") != "", F.col("n"))
    keys = F.array(F.struct(F.concat(F.lit("n"), n).alias("_key"), F.lit(None).cast("string").alias("_not")), F.struct(F.when(F.col("a") != "", F.concat(F.lit("a"), "a")).alias("_key"), n.alias("_not")))
    return rows.select("*", F.inline(keys)).filter("_key is not null").drop("n", "a")


def single_key_pairs(left: DataFrame, right: DataFrame, mixed: DataFrame | None = None) -> DataFrame:
    """As ``block_pairs`` for sides with one name ``n`` and one address key ``a`` a row, which costs less for each pair.

    ``mixed``: the names (n) whose blocks are made, all if not given; address blocks are made in any case.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides, counts = {}, []
    for s, rows in (("a", left), ("b", right)):
        rows = single_keys(rows)
        if mixed is not None:
            rows = rows.join(mixed.select(F.concat(F.lit("n"), "n").alias("_key"), F.lit(True).alias("_made")), "_key", "left").filter(F.col("_made") | F.col("_key").startswith("a")).drop("_made")
        counts.append(rows.groupBy("_key").agg(F.count("*").alias(f"_{s}n")))
        sides[s] = rows.select("_key", *(F.col(c).alias(f"{s}_{'id' if c == 'entity_id' else c}") for c in rows.columns if c != "_key"))
    both = counts[0].join(counts[1], "_key").filter(F.col("_an") * F.col("_bn") > CELL * CELL)
    large = both.select("_key", F.ceil(F.col("_an") / CELL).alias("_a"), F.ceil(F.col("_bn") / CELL).alias("_b"))
    out = _dealt(sides["a"], "a", "b", large, n).join(_dealt(sides["b"], "b", "a", large, n), ["_key", "_a_slice", "_b_slice"])
    return out.filter(F.coalesce(F.col("a__not") != F.col("b__not"), F.lit(True))).drop("_key", "_a_slice", "_b_slice", "a__not", "b__not")


def key_lists(left: DataFrame, right: DataFrame) -> DataFrame:
    """a_id, ids: the sorted ids of ``right`` that share a key with each id of ``left``, for sides with one n and a a row; no pair is made.

    A cell's ids of ``right`` are one list, which goes whole to each row of ``left``.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x, y = (single_keys(rows.select("entity_id", "n", "a")) for rows in (left, right))
    counts = [rows.groupBy("_key").agg(F.count("*").alias(name)) for rows, name in ((x, "_an"), (y, "_bn"))]
    both = counts[0].join(counts[1], "_key").filter(F.col("_an") * F.col("_bn") > CELL * CELL)
    large = both.select("_key", F.ceil(F.col("_an") / CELL).alias("_a"), F.ceil(F.col("_bn") / CELL).alias("_b"))
    cell = ["_key", "_a_slice", "_b_slice"]
    x = _dealt(x.toDF("a_id", "_key", "a__not"), "a", "b", large, n)
    y = _dealt(y.toDF("b_id", "_key", "b__not"), "b", "a", large, n).groupBy(*cell, "b__not").agg(F.collect_list("b_id").alias("ids"))
    found = x.join(y, cell).filter(F.coalesce(F.col("a__not") != F.col("b__not"), F.lit(True)))
    return found.groupBy("a_id").agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))


def block_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """a_id, b_id and the further columns of both sides, once for each pair that shares a key.

    Either side has one row per id with its ``names`` and ``addresses``; its further columns are carried along as a_ and b_.
    A pair belongs to its smallest common name, else to its smallest common address, so nothing is made distinct afterwards.
    Large blocks are cut into cells of about ``CELL`` rows a side, each compared by one task; every pair lies in one cell.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides, counts = {}, []
    for s, rows in (("a", left), ("b", right)):
        keys = F.concat(F.transform("names", lambda k: F.concat(F.lit("n"), k)), F.transform("addresses", lambda k: F.concat(F.lit("a"), k)))
        rows = rows.select("*", F.explode(keys).alias("_key"))
        counts.append(rows.groupBy("_key").agg(F.count("*").alias(f"_{s}n")))
        sides[s] = rows.select("_key", *(F.col(c).alias(f"{s}_{'id' if c == 'entity_id' else c}") for c in rows.columns if c != "_key"))
    both = counts[0].join(counts[1], "_key").filter(F.col("_an") * F.col("_bn") > CELL * CELL)
    large = both.select("_key", F.ceil(F.col("_an") / CELL).alias("_a"), F.ceil(F.col("_bn") / CELL).alias("_b"))
    x, y = _dealt(sides["a"], "a", "b", large, n), _dealt(sides["b"], "b", "a", large, n)
    out = x.join(y, ["_key", "_a_slice", "_b_slice"])
    named = F.col("_key").startswith("n")
    first = lambda c: (F.size(f"a_{c}") == 1) | (F.size(f"b_{c}") == 1) | (F.substring("_key", 2, 1 << 30) == F.array_min(F.array_intersect(f"a_{c}", f"b_{c}")))
    out = out.filter((named & first("names")) | (~named & ~F.arrays_overlap("a_names", "b_names") & first("addresses")))
    return out.drop("_key", "_a_slice", "_b_slice", *(f"{s}_{c}" for s in "ab" for c in ("names", "addresses")))


def candidate_pairs(source1: DataFrame, others: DataFrame, unicode_form: bool = True, max_block_size: int | None = None) -> DataFrame:
    """Distinct pairs that share a key.

    Blocks are not capped unless ``max_block_size`` is given, which drops the pairs of larger blocks.
    """
    left, right = (with_keys(side, unicode_form) for side in (source1, others))
    if max_block_size:
        for c in ("n", "a"):
            over = right.filter(F.col(c) != "").select("entity_id", c).distinct().groupBy(c).count().filter(F.col("count") > max_block_size).select(c, F.lit(True).alias("_over"))
            right = right.join(over, c, "left").withColumn(c, F.when(F.col("_over"), "").otherwise(F.col(c))).drop("_over")
    return block_pairs(key_sets(left), key_sets(right)).toDF("source1_entity_id", "candidate_entity_id")


def run_blocking(spark, source1: str, source2: str, source3: str, out: str) -> int:
    """Read, block, write the sorted long pair file; returns the number of pairs."""
    pairs = stored(candidate_pairs(read_records(spark, source1), read_records(spark, [source2, source3])))
    write_tsv(pairs.orderBy("source1_entity_id", "candidate_entity_id").toDF("source1_id", "candidate_id"), out)
    return pairs.count()


def candidate_lists(pairs: DataFrame) -> DataFrame:
    return to_wide(pairs, "candidate_entity_ids")
