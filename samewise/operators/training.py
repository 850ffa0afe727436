"""Labels, splits, guards and classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samewise.operators.features import FEATURES

S1, CAND = "source1_entity_id", "candidate_entity_id"


def label_pairs(pairs: DataFrame, universe: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 if true, else 0; every source id must be known."""
    if not pairs.join(universe.select(S1), S1, "left_anti").isEmpty():
        raise ValueError("pairs name source ids that the ground truth lacks")
    t = truth.select(S1, CAND).distinct().withColumn("t", F.lit(1))
    return pairs.join(t, [S1, CAND], "left").withColumn("label", F.col("t").isNotNull().cast("int")).drop("t")


def check_pair_ids(pairs: DataFrame) -> None:
    """Pairs have both id columns and at least one row."""
    if {S1, CAND} - set(pairs.columns):
        raise ValueError("pairs lack id columns")
    if pairs.isEmpty():
        raise ValueError("no pairs")


def check_split(parts: DataFrame) -> None:
    """Both parts have rows and share no source id."""
    n, fit, both = parts.groupBy(S1).agg(F.countDistinct("split").alias("k"), F.max("split").alias("s")).agg(F.count("*"), F.count_if(F.col("s") == "train"), F.count_if(F.col("k") > 1)).first()
    if both:
        raise ValueError("source ids are in both parts of the split")
    if not fit or fit == n:
        raise ValueError("empty train or validation split")


def check_columns(df: DataFrame, columns: list[str]) -> None:
    """The ids and then the features, in order."""
    if df.columns != [S1, CAND, *columns]:
        raise ValueError("feature columns differ from the expected ones")


def check_pairs(labelled: DataFrame) -> None:
    check_pair_ids(labelled)
    n, different, low, high = labelled.agg(F.count("*"), F.countDistinct(S1, CAND), F.min("label"), F.max("label")).first()
    if not n or n != different or low == high:
        raise ValueError("no pairs" if not n else "duplicate pairs" if n != different else "only one class")


def grouped_split(pairs: DataFrame, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Pairs with ``split``, as ``split_ids`` has it for their source ids."""
    return pairs.join(split_ids(pairs.select(S1).distinct(), share, seed), S1)


def split_ids(ids: DataFrame, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Distinct source ids with ``split``: the first floor(share * groups) of them by md5(seed:id) are train.

    Ranks come from a range-partitioned count, not from one task holding all groups.
    """
    groups = ids.select(S1).withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), S1).cast("binary")))
    bucket = F.conv(F.substring("h", 1, 3), 16, 10).cast("int")
    buckets = groups.groupBy(bucket.alias("bucket")).count()
    before = buckets.select("bucket", F.expr("sum(count) over (order by bucket) - count").alias("before"), F.expr("sum(count) over ()").alias("n"))
    ranked = groups.withColumn("bucket", bucket).withColumn("k", F.expr("row_number() over (partition by bucket order by h, source1_entity_id)")).join(before, "bucket")
    train = F.col("before") + F.col("k") <= F.floor(F.lit(share) * F.col("n"))
    return ranked.select(S1, F.when(train, "train").otherwise("validation").alias("split"))


def dev_sample(source1: DataFrame, others: DataFrame, truth: DataFrame, n: int = 20) -> DataFrame:
    """For the first n source ids with matches: the smallest true id as positive, the smallest source-2 id as negative."""
    first = source1.select(F.col("entity_id").alias(S1)).orderBy(S1).limit(n)
    positive = truth.join(first, S1, "left_semi").groupBy(S1).agg(F.min(CAND).alias(CAND)).withColumn("label", F.lit(1))
    lowest = others.filter(F.col("entity_id").startswith("S2")).agg(F.min("entity_id").alias(CAND))
    negative = positive.select(S1).join(F.broadcast(lowest), F.lit(True)).withColumn("label", F.lit(0))
    return positive.unionByName(negative).groupBy(S1, CAND).agg(F.max("label").alias("label"))


def class_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("label").agg(F.count("*").alias("n"))


def check_matrix(features: DataFrame, columns: list[str]) -> None:
    """Numeric, no NaN, no infinities."""
    for f in features.select(*columns).schema:
        if not isinstance(f.dataType, T.NumericType):
            raise ValueError(f"{f.name} is not numeric")
    bad = features.agg(*(F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).alias(c) for c in columns)).first()
    if any(bad):
        raise ValueError(f"missing or infinite values: {[c for c in columns if bad[c]]}")


def newton_logistic(features: DataFrame, columns: list[str], weights: tuple[float, float], max_iterations: int = 1000):
    """Coefficients and intercept that minimize the weighted logistic loss plus half the coefficients' squares."""
    import numpy as np

    k = len(columns) + 1

    def sums_at(w):
        def of(batches):
            import pyarrow as pa

            total = np.zeros(1 + k + k * k)
            for batch in batches:
                of = lambda c, b=batch: b.column(c).to_numpy(zero_copy_only=False).astype(float)
                x = np.column_stack([*map(of, columns), np.ones(batch.num_rows)])
                y = of("label")
                c, z = np.where(y == 1, weights[1], weights[0]), x @ w
                p = np.exp(-np.logaddexp(0, -z))
                hessian = (x * (c * p * (1 - p))[:, None]).T @ x
                total += np.concatenate([[(c * np.logaddexp(0, np.where(y == 1, -z, z))).sum()], x.T @ (c * (p - y)), hessian.ravel()])
            yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]})

        return of

    return newton(features.select(*columns, "label"), k, sums_at, max_iterations)


def newton(rows: DataFrame, k: int, sums_at, max_iterations: int = 1000):
    """Coefficients and intercept, ``k`` in all, at the minimum of a loss plus half the coefficients' squares.

    ``sums_at(w)`` maps Arrow batches of ``rows`` to one row: loss, gradient and Hessian at ``w``, in one list.
    Newton's method with step halving, one distributed pass a step. Spark's own solver works on columns
    scaled to unit deviation, where the penalty of nearly constant columns makes L-BFGS slow or stop at the start.
    """
    import warnings

    import numpy as np

    def of_all(w):
        total = np.sum([r.sums for r in rows.mapInArrow(sums_at(w), "sums array<double>").collect()], axis=0)
        ridge = np.append(np.ones(k - 1), 0.0)
        return total[0] + (ridge * w * w).sum() / 2, total[1 : 1 + k] + ridge * w, total[1 + k :].reshape(k, k) + np.diag(ridge)

    w, step = np.zeros(k), None
    loss, grad, hessian = of_all(w)
    for _ in range(max_iterations):
        if step is None:
            step = -np.linalg.solve(hessian, grad)
            if -grad @ step <= 1e-16 * (1 + loss):
                break
        at = of_all(w + step)
        if at[0] > loss + 1e-12 * (1 + loss):
            step = step / 2
            continue
        w, step = w + step, None
        loss, grad, hessian = at
    else:
        warnings.warn(f"not converged after {max_iterations} passes", stacklevel=2)
    return w[:-1], float(w[-1])


def _logistic_model(spark, coefficients, intercept: float):
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.util import Identifiable

    uid = f"LogisticRegression_{Identifiable().uid.rpartition('_')[2]}"
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(uid, _py2java(spark.sparkContext, Vectors.dense(coefficients)), intercept)
    return LogisticRegressionModel(java)


def fit_classifier(features: DataFrame, columns: list[str], kind: str = "logistic", seed: int = 42, trees: int = 100, max_iterations: int = 1000):
    """A fitted pipeline on balanced class weights; needs two classes in ``label``."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # Fitting passes over the rows many times.
    features = features.select(*columns, "label").persist()
    check_matrix(features, columns)
    counts = {r.label: r.n for r in class_distribution(features).collect()}
    if len(counts) < 2:
        raise ValueError("only one class")
    n = sum(counts.values())
    assembler, weights = VectorAssembler(inputCols=columns, outputCol="features"), (n / (2 * counts[0]), n / (2 * counts[1]))
    if kind == "logistic":
        model = PipelineModel([assembler, _logistic_model(features.sparkSession, *newton_logistic(features, columns, weights, max_iterations))])
    elif kind == "forest":
        learner = RandomForestClassifier(weightCol="_weight", numTrees=trees, maxDepth=12, seed=seed)
        model = Pipeline(stages=[assembler, learner]).fit(features.withColumn("_weight", F.when(F.col("label") == 1, weights[1]).otherwise(weights[0])))
    else:
        raise ValueError(f"unknown model {kind}")
    features.unpersist()
    return model


def fit_packed(packed: DataFrame):
    """As the logistic ``fit_classifier``, on rows of ``class_features.packed_pairs`` as often as they count; they are stored and finite."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    from samewise.operators import class_features

    def totals(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            t = class_features.numbers_of(batch.column(0), "i4", 4).sum(0, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"ones": [int(t[0] + t[2])], "zeros": [int(t[1] + t[3])]})

    rows = packed.filter("fit")
    counts = rows.select("times").mapInArrow(totals, "ones long, zeros long").agg(F.sum("zeros"), F.sum("ones")).first()
    if not all(counts):
        raise ValueError("only one class")
    weights = tuple(sum(counts) / (2 * n) for n in counts)
    found = newton(rows.select("x", "times"), len(FEATURES) + 1, class_features.sums_of_packed(weights))
    return PipelineModel([VectorAssembler(inputCols=FEATURES, outputCol="features"), _logistic_model(packed.sparkSession, *found)])


def score(model, features: DataFrame) -> DataFrame:
    """The rows with ``score``, the probability of class 1, and ``prediction`` at 0.5.

    Rows may have the log odds of a logistic model as ``margin``, taken once for equal rows; it is used in place of the features.
    """
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.functions import vector_to_array

    if isinstance(model.stages[-1], LogisticRegressionModel):
        # As an expression, which costs less for each row than vectors.
        terms = zip(model.stages[0].getInputCols(), model.stages[-1].coefficients.tolist(), strict=True)
        margin = F.col("margin") if "margin" in features.columns else sum((F.col(c) * F.lit(w) for c, w in terms), F.lit(float(model.stages[-1].intercept)))
        score = 1 / (1 + F.exp(-margin))
        known = F.when(score.isNull() | F.isnan(score), F.raise_error(F.lit("missing or infinite values")).cast("double")).otherwise(score)
        return features.withColumn("score", known).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    out = model.transform(features).withColumn("score", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction", "probability").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def experiment_record(spark, record: dict) -> DataFrame:
    """One row describing a fit, for an append-only log; columns in the record's order."""
    kinds = {str: "string", int: "long", float: "double"}
    return spark.createDataFrame([tuple(record.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in record.items()))
