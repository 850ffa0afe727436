"""Reading and writing the record, pair and match files; the records view of the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.functions.text import stripped

RECORD = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"
PAIR = "source1_entity_id string, candidate_entity_id string"
#: Characters of a text that are tried first for its words.
HEAD = 512
PREDICTION = PAIR + ", label string, score string"
#: Cells that a typed reader takes for missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_tsv(spark: SparkSession, path: str | list[str], schema: str, na_tokens: tuple[str, ...] = ()) -> DataFrame:
    """Tab-separated file with a header and doubled quotes; null cells become empty, ``na_tokens`` null."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    for c in df.columns:
        df = df.withColumn(c, F.when(F.col(c).isin(*na_tokens), None).otherwise(F.col(c)) if na_tokens else F.coalesce(c, F.lit("")))
    return df


def read_records(spark: SparkSession, path: str | list[str], typed: bool = False) -> DataFrame:
    return read_tsv(spark, path, RECORD, NA_TOKENS if typed else ())


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Candidate pairs from a file of two columns, by position."""
    return read_tsv(spark, path, PAIR)


def union_sources(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out


def truth_lists(wide: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """source1_entity_id, ids: trimmed, without blanks and repeats; only ids in ``keep`` if given.

    Of several rows for one id the last one in the order of the file counts.
    """
    missing = {"source1_entity_id", "matched_entity_ids"} - set(wide.columns)
    if missing:
        raise ValueError(f"ground truth lacks {sorted(missing)}")
    ids = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), stripped), lambda x: (x != "") & (x != "nan")))
    rows = wide.select(stripped(F.col("source1_entity_id")).alias("source1_entity_id"), ids.alias("ids"), F.monotonically_increasing_id().alias("_pos"))
    out = rows.groupBy("source1_entity_id").agg(F.max_by("ids", "_pos").alias("ids"))
    return out if keep is None else out.join(keep.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")


def to_long(lists: DataFrame) -> DataFrame:
    return lists.select("source1_entity_id", F.explode("ids").alias("candidate_entity_id"))


def to_wide(pairs: DataFrame, name: str = "candidate_entity_ids") -> DataFrame:
    """One row per source id, its ids in ascending order, comma-joined."""
    return pairs.groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_list("candidate_entity_id")), ",").alias(name))


def read_ordered_ids(spark: SparkSession, path: str) -> DataFrame:
    """pos, source1_entity_id: the first column by position, in file order, repeats kept.

    Positions are those of one file; of several files each file's rows stay together.
    """
    lines = spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(path)
    first = F.trim(F.col(f"`{lines.columns[0]}`"))
    return lines.select(F.monotonically_increasing_id().alias("pos"), first.alias("source1_entity_id")).filter("source1_entity_id <> ''")


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Header and one row per line; empty and null cells stay empty."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to a CSV log, which is made with the first; every part has the header."""
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as business records: words 1-4 the name, 5-14 the address; ``truth_key`` is words 15-40."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Words after the 40th stay in one piece, which nothing reads; the first piece may be empty.
    words = lambda t: F.filter(F.split(t, "[ \\t\\n\\r\\x0b\\f]+", 42), lambda w: w != "")
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    # The first 40 words are whole where a 41st begins in the text's head; other texts are cut whole.
    cut = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")).withColumn("w", words(F.substring("text", 1, HEAD)))
    cut = cut.withColumn("w", F.when(F.size("w") > 40, F.col("w")).otherwise(words(F.col("text"))))
    return cut.select(
        F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        part(1, 4).alias("business_name"),
        part(5, 10).alias("business_address"),
        F.col("lang").alias("country"),
        part(15, 26).alias("truth_key"),
    )


def of_source(r: DataFrame, *numbers: int) -> DataFrame:
    return r.filter(F.substring("entity_id", 2, 1).isin(*map(str, numbers)))


def true_pairs(r: DataFrame) -> DataFrame:
    """Pairs of source 1 with sources 2 and 3 whose truth keys are equal and not empty."""
    known = r.filter("truth_key <> ''")
    left = of_source(known, 1).select(F.col("entity_id").alias("source1_entity_id"), "truth_key")
    right = of_source(known, 2, 3).select(F.col("entity_id").alias("candidate_entity_id"), "truth_key")
    return left.join(right, "truth_key").select("source1_entity_id", "candidate_entity_id")
