"""Error types and categories as ordered decision lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions.text import last_pin, safe_string

NEEDED = ("source1_entity_id", "candidate_entity_id", "score", "prediction", "ground_truth_label")


def error_type() -> Column:
    p, t = F.col("prediction"), F.col("ground_truth_label")
    return F.when((p == 1) & (t == 0), "FP").when((p == 0) & (t == 1), "FN").otherwise("correct")


def false_positive_category(n1: Column, n2: Column, a1: Column, a2: Column, c1: Column, c2: Column, name: Column, address: Column) -> Column:
    """``name`` and ``address``: ratios of the lower-cased texts."""
    low = F.lower
    return (
        F.when((c1 != "") & (c2 != "") & (low(c1) != low(c2)), "country_mismatch")
        .when(name > 80, "similar_name")
        .when((a1 != "") & (a2 != "") & (address > 90), "same_address")
        .when((n1 != "") & (n2 != "") & ((F.length(n1) < 5) | (F.length(n2) < 5)), "common_or_short_name")
        .otherwise("other")
    )


def category_of_equal_names(n1: Column, n2: Column, c1: Column, c2: Column) -> Column:
    """``false_positive_category`` where lower-cased countries differ or names do not, which needs no ratio; else null."""
    return F.when((c1 != "") & (c2 != "") & (c1 != c2), "country_mismatch").when(n1 == n2, "similar_name")


def false_negative_category(n1: Column, n2: Column, a1: Column, a2: Column, name: Column, ordered: Column) -> Column:
    """``name``, ``ordered``: ratios of the lower-cased names, as they are and with sorted words."""
    x, y = F.lower(n1), F.lower(n2)
    s, t = sim.tokens(x), sim.tokens(y)
    within = (F.size(F.array_except(s, t)) == 0) | (F.size(F.array_except(t, s)) == 0)
    one_pin = last_pin(a1).isNull() != last_pin(a2).isNull()
    p, q = F.lower(a1), F.lower(a2)
    part = (p.contains(q) | q.contains(p)) & (F.abs(F.length(p) - F.length(q)) > 5)
    return (
        F.when((n1 == "") | (n2 == "") | (a1 == "") | (a2 == ""), "missing_field")
        .when((F.size(s) != F.size(t)) & within, "abbreviation")
        .when((ordered > 85) & (name < 85), "spelling_variation")
        .when(one_pin, "missing_pin")
        .when(part, "partial_address")
        .when(name > 70, "transliteration")
        .otherwise("other")
    )


def error_cases(predictions: DataFrame, records: DataFrame) -> DataFrame:
    """Predictions with both records, error_type, category and, for errors, similarities."""
    if missing := set(NEEDED) - set(predictions.columns):
        raise ValueError(f"predictions lack {sorted(missing)}")
    text = lambda c: safe_string(F.col(c)).alias(c)
    clean = records.select("entity_id", *map(text, ("business_name", "business_address", "country")))
    out = predictions.select(*NEEDED)
    for i, key in ((1, NEEDED[0]), (2, NEEDED[1])):
        out = out.join(clean.toDF(key, f"name{i}", f"address{i}", f"country{i}"), key, "left")
    fields = [f"{k}{i}" for i in (1, 2) for k in ("name", "address", "country")]
    out = out.select(*NEEDED, *(F.coalesce(c, F.lit("")).alias(c) for c in fields)).withColumn("error_type", error_type())
    n1, a1, c1, n2, a2, c2 = map(F.col, fields)
    wrong = F.col("error_type") != "correct"
    only = lambda x: F.when(wrong, F.lower(x))  # noqa: E731  correct pairs cost no comparison
    out = out.withColumns({"_name": sim.indel_ratio(only(n1), only(n2)), "_address": sim.indel_ratio(only(a1), only(a2)), "_sorted": sim.token_sort_ratio(only(n1), only(n2))})
    name, address, ordered = F.col("_name"), F.col("_address"), F.col("_sorted")
    kind = F.when(F.col("error_type") == "FP", false_positive_category(n1, n2, a1, a2, c1, c2, name, address)).when(F.col("error_type") == "FN", false_negative_category(n1, n2, a1, a2, name, ordered)).otherwise("N/A")
    return out.select(*NEEDED, *fields, "error_type", kind.alias("category"), F.when(wrong, name).alias("name_similarity"), F.when(wrong, address).alias("address_similarity"), (c1 == c2).alias("country_match"))


def error_rates(cases: DataFrame) -> DataFrame:
    """Counts of each error type and their shares of all pairs."""
    fp, fn = F.count_if(F.col("error_type") == "FP"), F.count_if(F.col("error_type") == "FN")
    n = F.greatest(F.count("*"), F.lit(1))
    return cases.agg(F.count("*").alias("pairs"), fp.alias("false_positives"), fn.alias("false_negatives"), (fp / n).alias("fp_rate"), (fn / n).alias("fn_rate"))


def category_counts(cases: DataFrame) -> DataFrame:
    return ordered_counts(cases.filter("error_type <> 'correct'").groupBy("error_type", "category").agg(F.count("*").alias("n")))


def ordered_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy("error_type", F.desc("n"), "category")


def report(cases: DataFrame, examples: int = 5) -> str:
    """Rates, categories by frequency and the first wrong pairs with their names."""
    r = error_rates(cases).first()
    counts = category_counts(cases).collect()
    lines = ["Errors", f"pairs: {r.pairs}", f"false positives: {r.false_positives} ({r.fp_rate:.4f})", f"false negatives: {r.false_negatives} ({r.fn_rate:.4f})"]
    for kind, title in (("FP", "false positives"), ("FN", "false negatives")):
        lines += ["", f"Categories of {title}:", *(f"  {c.category}: {c.n}" for c in counts if c.error_type == kind)]
    lines += ["", "Examples:"]
    for c in cases.filter("error_type <> 'correct'").orderBy("error_type", *NEEDED[:2]).limit(examples).collect():
        lines += [f"  {c.error_type} {c.category} {c[0]} {c[1]} {c.score:.4f}", f"    {c.name1} | {c.name2}"]
    return "\n".join(lines)
