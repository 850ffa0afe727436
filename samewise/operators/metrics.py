"""Entity-level F0.5, its macro average, pairwise scores and the threshold sweep in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

S1, CAND = "source1_entity_id", "candidate_entity_id"
#: Thresholds in hundredths.
COARSE, FINE = tuple(range(10, 91, 5)), tuple(range(5, 96))


def _rate(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def with_f05(df: DataFrame) -> DataFrame:
    """precision, recall, f0_5 from tp, fp, fn; nothing true and nothing predicted is perfect."""
    p, r = _rate(F.col("tp"), F.col("tp") + F.col("fp")), _rate(F.col("tp"), F.col("tp") + F.col("fn"))
    none = (F.col("tp") + F.col("fp") + F.col("fn")) == 0
    df = df.withColumn("precision", F.when(none, 1.0).otherwise(p)).withColumn("recall", F.when(none, 1.0).otherwise(r))
    down = 0.25 * F.col("precision") + F.col("recall")
    return df.withColumn("f0_5", F.when(down > 0, 1.25 * F.col("precision") * F.col("recall") / down).otherwise(0.0))


def entity_metrics(universe: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall, f0_5 for each id of ``universe``; predictions for others are ignored."""
    t = truth.select(S1, CAND).distinct().withColumn("t", F.lit(1))
    p = predicted.select(S1, CAND).distinct().withColumn("p", F.lit(1))
    both = t.join(p, [S1, CAND], "full").groupBy(S1).agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    return of_counts(universe, both)


def of_counts(universe: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``entity_metrics``, from tp, fp and fn of the ids that have any."""
    counted = universe.select(S1).distinct().join(counts, S1, "left")
    return with_f05(counted.select(S1, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("tp", "fp", "fn"))))


def macro_f05(entities: DataFrame) -> DataFrame:
    """One row: means, totals, singletons and their errors."""
    single = F.col("tp") + F.col("fn") == 0
    return entities.agg(
        F.coalesce(F.avg("f0_5"), F.lit(0.0)).alias("macro_f0_5"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("tp", "fp", "fn")),
        F.count("*").alias("total_entities"),
        F.count_if(single).alias("singleton_count"),
        F.count_if(single & (F.col("fp") > 0)).alias("singleton_errors"),
        F.coalesce(F.sum(F.col("tp") + F.col("fp")), F.lit(0)).alias("predicted_matches"),
        F.coalesce(F.sum(F.col("tp") + F.col("fn")), F.lit(0)).alias("true_matches"),
    )


def macro_breakdown(entities: DataFrame) -> DataFrame:
    m = macro_f05(entities)
    right = F.when(F.col("singleton_count") > 0, 1 - F.col("singleton_errors") / F.col("singleton_count")).otherwise(F.when(F.col("total_entities") > 0, 1.0).otherwise(0.0))
    return m.select(F.col("macro_f0_5").alias("macro_f05"), "total_entities", "singleton_count", right.alias("singleton_accuracy"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, grid: tuple[int, ...] = COARSE, universe: DataFrame | None = None) -> DataFrame:
    """threshold, macro_f0_5 and counts for each threshold; the universe is the ids with predictions unless given.

    A pair counts at every threshold up to its score: it is turned into one row of
    per-threshold counts, so the data is read and shuffled once, whatever the grid.
    """
    ids = (scored if universe is None else universe).select(S1).distinct()
    t = truth.select(S1, CAND).distinct().withColumn("t", F.lit(1))
    judged = scored.select(S1, CAND, "score").join(t, [S1, CAND], "full").join(ids, S1, "left_semi")
    taken = lambda i: F.coalesce(F.col("score") >= grid[i] / 100.0, F.lit(False))
    true = F.col("t").isNotNull()
    counts = [f(i) for i in range(len(grid)) for f in (lambda i: F.count_if(taken(i) & true).alias(f"tp{i}"), lambda i: F.count_if(taken(i) & ~true).alias(f"fp{i}"))]
    by_id = judged.groupBy(S1).agg(F.count_if(true).alias("n_true"), *counts)
    return _by_threshold(ids.join(by_id, S1, "left"), grid)


def reached(score: Column, grid: tuple[int, ...]) -> Column:
    """How many thresholds of ``grid`` a score reaches."""
    return sum(((score >= k / 100.0).cast("int") for k in grid), F.lit(0))


def sweep_of_steps(steps: DataFrame, truth_counts: DataFrame, ids: DataFrame, grid: tuple[int, ...] = COARSE) -> DataFrame:
    """As ``threshold_sweep`` over ``ids``, from the numbers t and f of true and false pairs by id and ``reached`` thresholds k.

    ``truth_counts`` has the number ``n_true`` of true pairs of each id.
    """
    order = sorted(grid)
    sums = [F.sum(F.when(F.col("k") > order.index(k), F.col(c))).alias(f"{c}p{i}") for i, k in enumerate(grid) for c in "tf"]
    return _by_threshold(ids.select(S1).distinct().join(truth_counts, S1, "left").join(steps.groupBy(S1).agg(*sums), S1, "left"), grid)


def _by_threshold(counted: DataFrame, grid: tuple[int, ...]) -> DataFrame:
    full, steps = counted.na.fill(0), F.array(*(F.lit(k / 100.0) for k in grid))
    points = F.arrays_zip(steps.alias("threshold"), F.array(*(F.col(f"tp{i}") for i in range(len(grid)))).alias("tp"), F.array(*(F.col(f"fp{i}") for i in range(len(grid)))).alias("fp"))
    rows = full.select("n_true", F.explode(points).alias("x")).select("x.threshold", "x.tp", "x.fp", (F.col("n_true") - F.col("x.tp")).alias("fn"))
    return with_f05(rows).groupBy("threshold").agg(F.avg("f0_5").alias("macro_f0_5"), F.sum(F.col("tp") + F.col("fp")).alias("predicted_match_count"), F.sum("fp").alias("false_positive_count"), F.sum("fn").alias("false_negative_count"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the best score, the largest threshold of ties."""
    return sweep.orderBy(F.desc(F.round("macro_f0_5", 9)), F.desc("threshold")).limit(1)


def pairwise_scores(labelled: DataFrame, cut: float = 0.5) -> DataFrame:
    """precision, recall, f0_5 over pairs with label and score."""
    hit, true = F.col("score") >= cut, F.col("label") == 1
    return with_pairwise(labelled.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn")))


def with_pairwise(counts: DataFrame) -> DataFrame:
    p, r = _rate(F.col("tp"), F.col("tp") + F.col("fp")), _rate(F.col("tp"), F.col("tp") + F.col("fn"))
    down = 0.25 * p + r
    return counts.select("*", p.alias("precision"), r.alias("recall"), F.when(down > 0, 1.25 * p * r / down).otherwise(0.0).alias("f0_5"))


def recall_ceiling(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """true_pairs, found_pairs and their ratio."""
    c = candidates.select(S1, CAND).distinct().withColumn("c", F.lit(1))
    counted = truth.select(S1, CAND).distinct().join(c, [S1, CAND], "left").agg(F.count("*").alias("true_pairs"), F.count("c").alias("found_pairs"))
    return counted.withColumn("recall", _rate(F.col("found_pairs"), F.col("true_pairs")))
