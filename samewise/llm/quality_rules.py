"""Quality rules with cutoffs learned per language and source; DataFrame functions only.

Measures of each text are written once. For every (lang, source) group mergeable
quantile sketches (``percentile_approx``, Greenwald-Khanna summaries, partially
aggregated in every task) give the median and quartiles of each measure; a row is rejected
where a measure lies beyond its group's fence: the upper quartile plus ``SPREADS`` times
the distance between quartiles, and at least ``LEAST`` above the quartile. The cutoffs are then joined
to the measures, never to the texts.

Null texts have no words and fail the base rule. A null lang or source is a group
of its own. Null and repeated ids are kept; equal measures meet equal cutoffs. Very long texts are measured whole, as arrays of their words in
one row. Only doc_id, text, lang and source are read; columns of any other name are not. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import saved

#: White space between words: tab to carriage return, and space.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Fence: quartile distances beyond the upper quartile, and the least such distance by measure.
SPREADS = 3.0
LEAST = {"symbol_share": 0.05, "dup_line_share": 0.25, "repeat_share": 0.10, "upper_share": 0.15, "mark_share": 0.15, "word_length": 6.0}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are hashed to 64 bits. Only texts with a repeated window sort them;
    then each repeated window covers its three words, less what the window before covers.
    """
    return F.expr(f"""
        CASE WHEN size({words}) < 4 THEN 0L ELSE
          CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN 0L ELSE
            aggregate(
              array_sort(transform(
                filter(
                  transform(_sorted, (s, i) -> named_struct('at', s.at, 'again',
                    (i > 0 AND _sorted[i - 1].h = s.h) OR (i < size(_sorted) - 1 AND _sorted[i + 1].h = s.h))),
                  s -> s.again),
                s -> s.at)),
              named_struct('covered', 0L, 'upto', -1),
              (acc, at) -> named_struct('covered', acc.covered + least(3, at + 2 - acc.upto), 'upto', at + 2),
              acc -> acc.covered)
          END
        END""")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of the contract and the shares the cutoffs are for."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang"), F.col("source"), text.alias("_text"))
    base = base.withColumn("_words", words_of(F.col("_text"))).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.length(_without(x, SPACE)) > 0))
    windows = F.expr("CASE WHEN size(_words) < 4 THEN array() ELSE transform(sequence(1, size(_words) - 2), i -> xxhash64(_words[i - 1], _words[i], _words[i + 1])) END")
    base = base.withColumn("_windows", windows.cast("array<bigint>"))
    sorted_windows = F.expr("CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN NULL ELSE array_sort(transform(_windows, (h, i) -> named_struct('h', h, 'at', i))) END")
    base = base.withColumn("_sorted", sorted_windows)
    n = F.size("_words").cast("long")
    counted = base.select(
        "doc_id",
        "lang",
        "source",
        n.alias("n_words"),
        F.length(_without(F.col("_text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeated_words("_words").alias("n_repeat_words"),
        (F.length("_text") - F.length(F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        (F.length("_text") - F.length(_without(F.col("_text"), "!?"))).cast("long").alias("n_marks"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return counted.select(
        "*",
        share("n_symbols", "n_words").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_marks", "n_words").alias("mark_share"),
        share("word_chars", "n_words").alias("word_length"),
    )


def cutoffs(measured: DataFrame, spreads: float = SPREADS) -> DataFrame:
    """lang, source and a cutoff ``max_<measure>`` for each measure."""
    quartiles = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.75)), 1000).alias(m) for m in LEAST]
    found = measured.groupBy("lang", "source").agg(*quartiles)
    fence = lambda m: F.col(m)[1] + F.greatest(F.lit(spreads) * (F.col(m)[1] - F.col(m)[0]), F.lit(LEAST[m]))
    return found.select("lang", "source", *(fence(m).alias(f"max_{m}") for m in LEAST))


def apply_rules(docs: DataFrame, spreads: float = SPREADS) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept."""
    measured = saved(measures(docs), "measures")
    limits = cutoffs(measured, spreads).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"])
    joined = measured.join(limits, same)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for m in LEAST:
        within = within & (F.col(m) <= F.col(f"max_{m}"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & within).alias("kept"), *LEAST)
