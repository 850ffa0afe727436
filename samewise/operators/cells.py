"""Counts of pairs by the Jaccard of their words, block by block; large blocks are compared as arrays, in cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.operators.blocking import single_keys
from samewise.operators.metrics import reached

#: Pairs of a block from which it is compared as arrays; members of a cell on either side.
LARGE, CELL = 20_000, (2048, 4096)


def similar_of_cell(left, right):
    """(row of ``left``, rows of ``right``, their Jaccards) of two Arrow tables with words and _not, for what shares a word."""
    import numpy as np
    import pyarrow as pa

    def codes(column, of):
        x, y = (t.column(column).combine_chunks() for t in (left, right))
        both = pa.concat_arrays([of(x), of(y)]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        return both[: len(of(x))], both[len(of(x)) :]

    words, ends = [], []
    for t in (left, right):
        lists = t.column("words").combine_chunks()
        ends.append(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]))
    words = codes("words", lambda x: x.flatten())
    apart = codes("_not", lambda x: x)
    lengths = np.diff(ends[1])
    order = np.argsort(words[1], kind="stable")
    holders = np.repeat(np.arange(len(lengths)), lengths)[order]
    n_words = int(max(words[0].max(initial=-1), words[1].max(initial=-1))) + 1
    starts = np.searchsorted(words[1][order], np.arange(n_words + 1))
    for i in range(left.num_rows):
        own = words[0][ends[0][i] : ends[0][i + 1]]
        if not len(own):
            continue
        both = np.bincount(np.concatenate([holders[starts[w] : starts[w + 1]] for w in own.tolist()]), minlength=len(lengths))
        at = np.flatnonzero(both)
        if apart[0][i] >= 0:
            at = at[apart[1][at] != apart[0][i]]
        yield i, at, both[at] / (len(own) + lengths[at] - both[at])


def steps_of_cell(left, right, grid: tuple[int, ...]):
    """(row of ``left``, k, n) of two Arrow tables with words, _not and size: n members of ``right`` reach k > 0 thresholds of ``grid``."""
    import numpy as np

    sizes, thresholds = right.column("size").to_numpy(), np.array(sorted(grid)) / 100.0
    rows, ks, ns = [], [], []
    for i, at, score in similar_of_cell(left, right):
        k = np.searchsorted(thresholds, score, side="right")
        n = np.bincount(k, weights=sizes[at], minlength=1).astype(np.int64)  # whole numbers, exact as doubles
        n[0] = 0
        some = np.flatnonzero(n)
        rows.append(np.full(len(some), i))
        ks.append(some)
        ns.append(n[some])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]).astype(np.int64) for x in (rows, ks, ns))


def _blocks(left: DataFrame, right: DataFrame, columns: list[str], compare, schema: str) -> tuple[DataFrame, DataFrame]:
    """The pairs of small blocks, with a_ and b_ ``columns`` (entity_id as id), and what ``compare`` gives for the cells of large ones."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x, y = (single_keys(side).select("_key", *columns) for side in (left, right))
    count = lambda rows, name: rows.groupBy("_key").agg(F.count("*").alias(name))
    shared = count(x, "_an").join(count(y, "_bn"), "_key")
    slices = lambda c, most: F.when(F.col("_an") * F.col("_bn") > LARGE, F.ceil(F.col(c) / most)).otherwise(0).cast("int")
    shared = shared.select("_key", slices("_an", CELL[0]).alias("_a"), slices("_bn", CELL[1]).alias("_b"))
    x, y = (side.join(shared, "_key") for side in (x, y))
    few = [side.filter("_a = 0").select("_key", *(F.col(c).alias(f"{s}_{'id' if c == 'entity_id' else c}") for c in columns)) for s, side in (("a", x), ("b", y))]
    small = few[0].join(few[1], "_key").filter(F.coalesce(F.col("a__not") != F.col("b__not"), F.lit(True)))
    cell = ("_key", "_a_slice", "_b_slice")

    def dealt(side, own, other):
        rows = side.filter("_a > 0").withColumn(f"{own}_slice", F.pmod(F.xxhash64("entity_id"), F.col(own)).cast("int"))
        rows = rows.withColumn(f"{other}_slice", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        # Names by side, as both sides come from one table.
        return rows.select(*(F.col(c).alias(f"{own}_{c}") for c in (*cell, *columns))).repartition(n, *(f"{own}_{c}" for c in cell)).groupBy(*(f"{own}_{c}" for c in cell))

    def of_cell(a, b):
        return compare(*(t.select(t.column_names[-len(columns) :]).rename_columns(columns) for t in (a, b)))

    return small, dealt(x, "_a", "_b").cogroup(dealt(y, "_b", "_a")).applyInArrow(of_cell, schema)


def pair_steps(left: DataFrame, right: DataFrame, grid: tuple[int, ...]) -> DataFrame:
    """a_id, k, f: for each row of ``left`` the sizes, summed, of those of ``right`` that share a key and reach k > 0 thresholds.

    Sides have entity_id (long), n and a (keys, empty if none), words, bits and size. Rows may repeat an a_id and k; thresholds are over 0.
    No pair is made where a block is large: a cell's counts of shared words come from the lists of the rows that hold a word.
    """

    def compare(a, b):
        import pyarrow as pa

        if not (a.num_rows and b.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in ("a_id", "k", "f")})
        rows, k, f = steps_of_cell(a, b, grid)
        return pa.table({"a_id": a.column("entity_id").combine_chunks().take(pa.array(rows)), "k": pa.array(k), "f": pa.array(f)})

    small, large = _blocks(left, right, ["entity_id", "_not", "words", "size"], compare, "a_id long, k long, f long")
    # Thresholds are looked up for groups of pairs, as it costs more than to count shared words.
    small = small.groupBy("a_id", F.size(F.array_intersect("a_words", "b_words")).alias("both"), F.size("a_words").alias("x"), F.size("b_words").alias("y")).agg(F.sum("b_size").alias("f"))
    small = small.filter("both > 0").select("a_id", reached(F.col("both") / (F.col("x") + F.col("y") - F.col("both")), grid).cast("long").alias("k"), "f").filter("k > 0")
    return small.unionByName(large)


def half_lists(left: DataFrame, right: DataFrame) -> DataFrame:
    """a_id, ids: the sorted ids of ``right`` that share a key with each row of ``left`` and half of all words of both.

    Sides have n and a (keys, empty if none), words and entity_id, for ``left`` a long. No pair is made where a block is large.
    """

    def compare(a, b):
        import numpy as np
        import pyarrow as pa

        ids, lists = (t.column("entity_id").combine_chunks() for t in (a, b))
        found = [(i, at[score >= 0.5]) for i, at, score in similar_of_cell(a, b)] if a.num_rows and b.num_rows else []
        found = [(i, at) for i, at in found if len(at)]
        ends = np.cumsum([0, *(len(at) for _, at in found)]).astype(np.int32)
        at = np.concatenate([np.zeros(0, np.int64), *(at for _, at in found)]).astype(np.int64)
        return pa.table({"a_id": ids.take(pa.array([i for i, _ in found], pa.int64())).cast(pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends), lists.take(pa.array(at)).cast(pa.string()))})

    small, large = _blocks(left, right, ["entity_id", "_not", "words"], compare, "a_id long, ids array<string>")
    both, either = F.size(F.array_intersect("a_words", "b_words")), F.size("a_words") + F.size("b_words")
    small = small.filter((both > 0) & (3 * both >= either)).select("a_id", F.array("b_id").alias("ids"))
    return small.unionByName(large).groupBy("a_id").agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))


def shared_key_count(rows: DataFrame) -> DataFrame:
    """total: the pairs of different sides (``first`` or not) that share a key n or a, without making them."""
    parts = []
    for keys, sign in ((("n",), 1), (("a",), 1), (("n", "a"), -1)):
        some = rows.filter(" and ".join(f"{k} <> ''" for k in keys)).groupBy(*keys).agg(F.count_if("first").alias("x"), F.count_if(~F.col("first")).alias("y"))
        parts.append(some.agg((sign * F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0))).alias("t")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(F.sum("t").alias("total"))
