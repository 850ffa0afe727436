"""Document quality by Bradley-Terry ranking of preference pairs.

Labelled documents form pairs (good, bad). A linear score of text features is
fitted so that the logistic loss of the score difference is least, which is the
Bradley-Terry model with features. The cut is the quantile of the
scores at the share of bad labels, over all labelled rows outside the held-out third; a logistic
curve around it maps scores to 0..1.

The weights are fitted on at most ``FIT_ROWS`` labelled rows, those with the smallest hashes of
their ids, and ``FIT_PAIRS`` pairs; the cut, features and scores cover every row. Null texts are
empty and scored like any; rows with a null id are scored but never learned
from. Of several labels of an id the lowest counts. Without labels of both kinds every score
is 0.5, which accepts. Very long texts are measured whole, in memory of their own size. Repeated rows are scored alike, equal scores on
the same side of the cut. Columns other than doc_id and text are not inputs, whatever their names; ``keep_good`` passes them on. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import id_remainder, saved

FIT_ROWS, FIT_PAIRS = 20_000, 100_000
#: Ranges of a round of the search for the cut.
BUCKETS = 4096
FEATURES = ("word_length", "log_words", "upper", "symbols", "marks", "digits", "other", "top_word", "adjacent_repeats", "distinct_words", "bars", "repeated_lines", "log_line_words", "marked_words", "long_words")
_SYMBOLS, _MARKS, _PLAIN = (str.maketrans("", "", s) for s in ("#*$%&<>", "!?", " \n,."))
_UPPER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]")


def features(text: str) -> list[float]:
    """Shares and means of a whole text, in the order of FEATURES."""
    import math
    from collections import Counter

    words, chars = text.split(), max(1, len(text))
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    squeezed = len("".join(words))
    plain = len(text.translate(_PLAIN))
    symbols = len(text) - len(text.translate(_SYMBOLS))
    marks = len(text) - len(text.translate(_MARKS))
    letters = sum(map(str.isalpha, counts)) if counts else 0
    return [
        squeezed / n,
        math.log1p(len(words)),
        len(_UPPER.findall(text)) / chars,
        symbols / n,
        marks / n,
        len(_DIGIT.findall(text)) / chars,
        plain / chars,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(counts) / n,
        counts["|"] / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))),
        1 - letters / max(1, len(counts)),
        sum(len(w) > 25 for w in counts) / n,
    ]


@dataclass(frozen=True)
class PairwiseModel:
    weights: tuple[float, ...]
    middle: tuple[float, ...]
    spread: tuple[float, ...]
    cut: float
    slope: float

    def raw(self, x):
        import numpy as np

        return np.clip((np.asarray(x, dtype=float).reshape(-1, len(self.weights)) - self.middle) / self.spread, -8, 8) @ np.asarray(self.weights)

    def score(self, raw: Column) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.least(self.slope * (raw - F.lit(self.cut)), F.lit(30.0)), F.lit(-30.0))))


def fit_pairs(x, good, n_pairs: int = FIT_PAIRS, ridge: float = 1e-3, seed: int = 7) -> PairwiseModel:
    """Newton's method on the pairs' mean logistic loss with a ridge."""
    import numpy as np

    x, good = np.asarray(x, dtype=float), np.asarray(good, dtype=bool)
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(x) or good.all() or not good.any():
        return PairwiseModel((0.0,) * k, (0.0,) * k, (1.0,) * k, 0.0, 1.0)
    middle, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - middle) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(np.flatnonzero(good), n_pairs)] - z[rng.choice(np.flatnonzero(~good), n_pairs)]
    w = np.zeros(k)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = -(d * (1 - p)[:, None]).mean(0) + ridge * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / n_pairs + ridge * np.eye(k), grad)
        w = w - step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(z @ w)
    # The quantile at the share of bad labels, midway between its neighbours.
    i = int((~good).sum())
    return PairwiseModel(tuple(w), tuple(middle), tuple(spread), float((raw[i - 1] + raw[i]) / 2), 1.0)


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    @F.pandas_udf("array<double>")
    def of(texts):
        import pandas as pd

        return pd.Series([features(t or "") for t in texts])

    return docs.withColumn("_features", of(F.coalesce(F.col(text_col), F.lit(""))))


def middle_of_ranks(raw: DataFrame, i: int, n: int) -> float:
    """Midway between the values of rank i - 1 and i, from 0, of the n in column ``raw``; 0 < i < n.

    Each round counts the values in ``BUCKETS`` equal ranges and goes on in the one that holds rank i, so the
    driver never sees more than the buckets, whatever the rows and ties; the ranks are exact.
    """
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    below = 0
    while low < high:
        bucket = F.least(F.floor((F.col("raw") - F.lit(low)) / F.lit(high - low) * BUCKETS), F.lit(BUCKETS - 1))
        within = raw.filter(F.col("raw").between(low, high)).groupBy(bucket.alias("bucket"))
        for r in within.agg(F.count("*").alias("rows"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("bucket").collect():
            if below + r.rows > i:
                low, high = r.low, r.high
                break
            below += r.rows
    before = low if below < i else raw.filter(F.col("raw") < low).agg(F.max("raw")).first()[0]
    return (before + low) / 2


def fit_weights(docs: DataFrame, marks: DataFrame, rows: int = FIT_ROWS) -> PairwiseModel:
    """Learn from a sample of the labelled rows outside the held-out third. docs: doc_id (long), text.

    The sample is cut by ids first, so features are computed for its rows alone.
    """
    hashed = docs.withColumn("_hash", F.xxhash64("doc_id"))
    learn = hashed.filter(id_remainder(F.col("doc_id"), 3) != 1).join(marks, "doc_id")
    cut = learn.select("_hash").orderBy("_hash").limit(rows).agg(F.max("_hash")).first()[0]
    if cut is None:
        return fit_pairs([], [])
    sample = with_features(learn.filter(F.col("_hash") <= cut)).select("_hash", "doc_id", "_features", "quality")
    fitted = sample.orderBy("_hash", "doc_id", "_features").limit(rows).select("_features", "quality").collect()
    return fit_pairs([r[0] for r in fitted], [r[1] == 1 for r in fitted])


def fit_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (), rows: int = FIT_ROWS) -> tuple[PairwiseModel, DataFrame]:
    """The model, and doc_id, raw and _row (the columns ``keep``) of every row, saved.

    Raw scores are computed once, before the labels are joined, so no text is shuffled for the cut.
    """
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    model = fit_weights(ids, marks, rows)

    @F.pandas_udf("double")
    def raw(texts):
        import pandas as pd

        return pd.Series(model.raw([features(t) for t in texts]) if len(texts) else [], dtype=float)

    row = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row")] if keep else []
    scored = saved(docs.select(docs["doc_id"].cast("long").alias("doc_id"), raw(F.coalesce(docs["text"], F.lit(""))).alias("raw"), *row), "scored")
    if any(model.weights):
        learn = saved(scored.filter(id_remainder(F.col("doc_id"), 3) != 1).join(marks, "doc_id").select("raw", (F.col("quality") != 1).alias("bad")), "labelled")
        n, bad = learn.agg(F.count("*"), F.count_if("bad")).first()
        model = replace(model, cut=middle_of_ranks(learn, bad, n))
    return model, scored


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model, scored = fit_quality(docs, labels)
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), model.score(F.col("raw")).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is 0.5 or more, all columns as they are."""
    model, scored = fit_quality(docs, labels, tuple(docs.columns))
    return scored.filter(model.score(F.col("raw")) >= 0.5).select("_row.*")
