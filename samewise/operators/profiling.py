"""Profiles of records, ground truth and their overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

S1, CAND = "source1_entity_id", "candidate_entity_id"


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, rows, missing, share of null or blank cells."""
    blank = lambda c: F.count_if(F.trim(F.coalesce(F.col(c), F.lit(""))) == "")
    wide = df.agg(F.count("*").alias("rows"), *(blank(c).alias(c) for c in columns))
    long = wide.select("rows", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns))).alias("x"))
    return long.select("x.column", "rows", "x.missing", (F.col("x.missing") / F.greatest("rows", F.lit(1))).alias("share"))


def duplicate_ids(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_ids"), F.count_if(F.col("n") > 1).alias("repeated_ids"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.expr("sum(n) over ()"))


def length_stats(df: DataFrame, column: str, words: bool = False) -> DataFrame:
    """min, max, mean, median, deviation, quartiles and high percentiles of characters or words, exact."""
    text = F.coalesce(F.col(column), F.lit(""))
    n = F.size(F.filter(F.split(text, "[ \\t\\n\\r\\x0b\\f]+"), lambda w: w != "")) if words else F.length(text)
    q = lambda p: F.percentile("len", F.lit(p))
    return df.select(n.alias("len")).agg(F.min("len").cast("long").alias("min_len"), F.max("len").cast("long").alias("max_len"), F.avg("len").alias("mean_len"), q(0.5).alias("median_len"), F.stddev("len").alias("std_len"), q(0.25).alias("q1"), q(0.75).alias("q3"), q(0.95).alias("p95"), q(0.99).alias("p99"))


def extremes(df: DataFrame, column: str) -> DataFrame:
    """The shortest value that is not blank and the longest; ties by value."""
    kept = df.filter(F.trim(F.coalesce(column, F.lit(""))) != "")
    return kept.agg(F.min(F.struct(F.length(column).alias("n"), F.col(column).alias("v")))["v"].alias("shortest"), F.min(F.struct((-F.length(column)).alias("n"), F.col(column).alias("v")))["v"].alias("longest"))


def match_histogram(universe: DataFrame, truth: DataFrame) -> DataFrame:
    """matches, entities: how many source ids have how many matches, none included."""
    per = universe.select(S1).join(truth, S1, "left").groupBy(S1).agg(F.count(CAND).alias("matches"))
    return per.groupBy("matches").agg(F.count("*").alias("entities"))


def matches_per_source(truth: DataFrame) -> DataFrame:
    return truth.groupBy(F.substring(CAND, 1, 2).alias("src")).agg(F.count("*").alias("pairs"), F.countDistinct(CAND).alias("matched_ids"))


def id_set_difference(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Ids only in a, and only in b."""
    x, y = a.select(F.col(key_a).alias("id")).distinct(), b.select(F.col(key_b).alias("id")).distinct()
    count = lambda p, q, name: p.join(q, "id", "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return count(x, y, "only_first").unionByName(count(y, x, "only_second"))


def unknown_truth_ids(truth: DataFrame, records: DataFrame) -> DataFrame:
    return truth.select(F.col(CAND).alias("entity_id")).distinct().join(records.select("entity_id"), "entity_id", "left_anti").agg(F.count("*").alias("unknown_ids"))


def coverage(records: DataFrame, truth: DataFrame) -> DataFrame:
    """By source: records, matched records and the share of distractors."""
    known = truth.select(F.col(CAND).alias("entity_id")).distinct().withColumn("m", F.lit(1))
    counted = records.join(known, "entity_id", "left").groupBy(F.substring("entity_id", 1, 2).alias("src")).agg(F.count("*").alias("n"), F.count("m").alias("matched"))
    return counted.withColumn("distractor_rate", 1 - F.col("matched") / F.col("n"))


def new_values(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` in b that a lacks."""
    return b.select(column).distinct().join(a.select(column).distinct(), column, "left_anti")


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """name, rows, columns and bytes of Parquet tables, by name."""
    out = None
    for name, path in paths.items():
        df, target = spark.read.parquet(path), spark._jvm.org.apache.hadoop.fs.Path(path)
        size = target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"), F.lit(size).cast("long").alias("bytes"))
        out = row if out is None else out.unionByName(row)
    return out


def match_stats(universe: DataFrame, truth: DataFrame) -> DataFrame:
    """Entities, singletons and their share, pairs, mean, median and most matches of an entity."""
    per = universe.select(S1).join(truth, S1, "left").groupBy(S1).agg(F.count(CAND).alias("n"))
    single = F.count_if(F.col("n") == 0)
    return per.agg(F.count("*").alias("entities"), single.alias("singletons"), (single / F.greatest(F.count("*"), F.lit(1))).alias("singleton_share"), F.sum("n").alias("pairs"), F.avg("n").alias("mean_matches"), F.percentile("n", F.lit(0.5)).alias("median_matches"), F.max("n").alias("max_matches"))
