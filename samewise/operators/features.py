"""The 31 pair features, in their fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions.text import core_name, feature_text, last_pin, safe_string
from samewise.operators import tfidf
from samewise.sources.scratch import stored

#: Feature names in order.
FEATURES = [
    "name_norm_levenshtein",
    "name_rapidfuzz_levenshtein",
    "name_jaro_winkler",
    "name_token_similarity",
    "name_token_set_similarity",
    "name_token_sort_similarity",
    "name_token_jaccard",
    "name_tfidf_cosine",
    "name_exact_norm_match",
    "name_exact_core_match",
    "name_len_diff",
    "name_norm_len_diff",
    "addr_norm_levenshtein",
    "addr_token_similarity",
    "addr_token_set_similarity",
    "addr_token_sort_similarity",
    "addr_token_jaccard",
    "addr_tfidf_cosine",
    "addr_exact_norm_match",
    "addr_pin_exact_match",
    "addr_pin_missing",
    "addr_len_diff",
    "addr_norm_len_diff",
    "country_exact_match",
    "country_missing_s1",
    "country_missing_cand",
    "name_missing_s1",
    "name_missing_cand",
    "addr_missing_s1",
    "addr_missing_cand",
    "source_pair_indicator",
]
IDS, FIELDS = ("source1_entity_id", "candidate_entity_id"), ("name", "addr")


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def prepared(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """id and, for name, addr and country, the trimmed text; normalized texts where features need them; the columns of ``keep``."""
    raw = records.select(*keep, F.col("entity_id").alias("id"), safe_string(F.col("business_name")).alias("name"), safe_string(F.col("business_address")).alias("addr"), safe_string(F.col("country")).alias("country"))
    return raw.select("*", feature_text(F.col("name")).alias("name_n"), feature_text(F.col("addr")).alias("addr_n"))


def enriched(pairs: DataFrame, source1: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs with both records' texts, prefixed a_ and b_; an unknown id gives empty texts."""
    out = pairs.select(*IDS)
    for side, key, records in (("a", IDS[0], source1), ("b", IDS[1], others)):
        texts = prepared(records)
        texts = texts.select(F.col("id").alias(key), *(F.col(c).alias(f"{side}_{c}") for c in texts.columns if c != "id"))
        out = out.join(texts, key, "left")
    return out.select(*IDS, *(F.coalesce(c, F.lit("")).alias(c) for c in out.columns if c not in IDS))


def source_indicator(candidate_id: Column) -> Column:
    two, three = candidate_id.contains("S2") | candidate_id.startswith("2"), candidate_id.contains("S3") | candidate_id.startswith("3")
    return F.when(two, 1.0).when(three, 2.0).otherwise(0.0)


def _used(records: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    return prepared(records.join(pairs.select(F.col(key).alias("entity_id")).distinct(), "entity_id", "left_semi"))


def _counts(texts: DataFrame) -> DataFrame:
    """field, id, term, tf of both fields of prepared records."""
    both = [tfidf.term_counts(texts.select("id", F.col(f"{f}_n").alias("text"))).withColumn("field", F.lit(f)) for f in FIELDS]
    return both[0].unionByName(both[1])


def _fit(texts: DataFrame, counts: DataFrame, size: int) -> dict[str, DataFrame]:
    n = texts.count()
    return {f: stored(tfidf.vocabulary_of(counts.filter(F.col("field") == f), n, size)) for f in FIELDS}


def _prepared_for(source1: DataFrame, others: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored: the records that occur in pairs, with ``first`` for source 1, and their term counts."""
    one, other = _used(source1, pairs, IDS[0]), _used(others, pairs, IDS[1])
    texts = stored(one.withColumn("first", F.lit(True)).unionByName(other.withColumn("first", F.lit(False))))
    return texts, stored(_counts(texts))


def fit_vocabularies(source1: DataFrame, others: DataFrame, pairs: DataFrame, size: int = 10_000) -> dict[str, DataFrame]:
    """Vocabularies by field over the source-1 records and candidates that occur in pairs, stored."""
    return _fit(*_prepared_for(source1, others, pairs), size)


def fit_transform(pairs: DataFrame, source1: DataFrame, others: DataFrame, size: int = 10_000) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The pairs' features with vocabularies fitted on them, and the vocabularies."""
    pairs = stored(pairs.select(*IDS))
    texts, counts = _prepared_for(source1, others, pairs)
    vocabularies = _fit(texts, counts, size)
    return _features(pairs, texts, counts, vocabularies), vocabularies


#: Similarities without a built-in, of names and (x_) of addresses.
KERNELS = ("indel", "jaro_winkler", "token_set", "token_sort", "cosine", "x_indel", "x_token_set", "x_token_sort", "x_cosine")


def _kernels(a, b, at, aw, bt, bw, x, y, xt, xw, yt, yw):
    """All similarities without a built-in, in one pass over the pairs; equal pairs of texts are compared once."""
    import pandas as pd

    def of(p, q, names):
        done = {}
        for k in zip(p, q, strict=True):
            if k not in done:
                s, t = k
                done[k] = [sim.indel(s, t) / 100, *([sim.jaro_winkler_one(s, t)] if names else []), sim.token_set(s, t) / 100, sim.token_sort(s, t) / 100] if s and t else [0.0] * (3 + names)
            yield done[k]

    rows = zip(of(a, b, True), of(x, y, False), zip(at, aw, bt, bw, strict=True), zip(xt, xw, yt, yw, strict=True), strict=True)
    return pd.DataFrame([(*n, tfidf.dot(*v), *m, tfidf.dot(*w)) for n, m, v, w in rows], columns=list(KERNELS), dtype=float)


def pair_features(pairs: DataFrame, source1: DataFrame, others: DataFrame, vocabularies: dict[str, DataFrame] | None) -> DataFrame:
    """The pair's ids and 31 doubles; NaN and infinities become 0.

    Records that occur in pairs are prepared once, with their TF-IDF rows, and joined to the pairs by id.
    """
    if vocabularies is None:
        raise ValueError("fit the vocabularies first")
    return _features(pairs, *_prepared_for(source1, others, pairs), vocabularies)


def _features(pairs: DataFrame, texts: DataFrame, counts: DataFrame, vocabularies: dict[str, DataFrame]) -> DataFrame:
    rows = texts
    for f in FIELDS:
        rows = rows.join(tfidf.vectors_of(counts.filter(F.col("field") == f), vocabularies[f]).toDF("id", f"{f}_t", f"{f}_w"), "id", "left")
    rows = stored(rows)
    # Comparing is the work here, so small inputs are dealt out too; both ids, as one id may have many pairs.
    e = pairs.select(*IDS).repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *IDS)
    for side, key in (("a", IDS[0]), ("b", IDS[1])):
        own = rows.filter(F.col("first") == (side == "a"))
        e = e.join(own.select(F.col("id").alias(key), *(F.col(c).alias(f"{side}_{c}") for c in own.columns if c not in ("id", "first"))), key, "left")
    e = e.select(*IDS, *(c if c.endswith(("_t", "_w")) else F.coalesce(c, F.lit("")).alias(c) for c in e.columns if c not in IDS))
    e = e.withColumn("k", F.pandas_udf(_kernels, ", ".join(f"{k} double" for k in KERNELS))("a_name_n", "b_name_n", "a_name_t", "a_name_w", "b_name_t", "b_name_w", "a_addr_n", "b_addr_n", "a_addr_t", "a_addr_w", "b_addr_t", "b_addr_w"))
    c = F.col
    a, b, x, y = c("a_name_n"), c("b_name_n"), c("a_addr_n"), c("b_addr_n")
    names, addresses = (a != "") & (b != ""), (x != "") & (y != "")
    pins = last_pin(c("a_addr")), last_pin(c("b_addr"))
    core_a, core_b = core_name(a), core_name(b)
    k = lambda n: c(f"k.{n}")
    name = [sim.levenshtein_similarity(a, b), k("indel"), k("jaro_winkler"), k("indel"), k("token_set"), k("token_sort"), sim.token_jaccard(a, b), k("cosine"), _flag(a == b), _flag((core_a == core_b) & (core_a != "")), sim.length_difference(c("a_name"), c("b_name")), sim.length_difference(a, b)]
    addr = [sim.levenshtein_similarity(x, y), k("x_indel"), k("x_token_set"), k("x_token_sort"), sim.token_jaccard(x, y), k("x_cosine"), _flag(x == y), _flag(pins[0] == pins[1]), _flag(pins[0].isNull() | pins[1].isNull()), sim.length_difference(c("a_addr"), c("b_addr")), sim.length_difference(x, y)]
    countries = F.lower("a_country"), F.lower("b_country")
    rest = [_flag((countries[0] == countries[1]) & (countries[0] != "")), *(_flag(c(f"{s}_{f}") == "") for f in ("country", "name", "addr") for s in "ab"), source_indicator(c(IDS[1]))]
    values = [F.when(names, v).otherwise(0.0) for v in name] + [F.when(addresses, v).otherwise(0.0) for v in addr] + rest
    finite = [F.when(F.isnan(v) | F.abs(v).isin(float("inf")), 0.0).otherwise(F.coalesce(v.cast("double"), F.lit(0.0))).alias(f) for f, v in zip(FEATURES, values, strict=True)]
    return e.select(*IDS, *finite)
