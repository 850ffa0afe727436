"""Whole runs: training with its records and predictions, threshold choice, error files, inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.operators import errors, features, metrics, submission, training
from samewise.plans import artifacts, linkage
from samewise.sources import tables
from samewise.sources.scratch import stored

S1, CAND = "source1_entity_id", "candidate_entity_id"
#: The models that a run fits and the names of their folders.
MODELS = {"logistic_regression": "logistic", "random_forest": "forest"}


def train(spark: SparkSession, pairs: DataFrame, source1: DataFrame, others: DataFrame, truth_lists: DataFrame, out: str, log: str, seed: int = 42, trees: int = 100) -> dict[str, dict]:
    """Fit both models on 80 % of the source ids, save them, their records and validation predictions; returns the records.

    truth_lists: source1_entity_id, ids. Vocabularies are fitted on the training pairs only.
    """
    universe, truth = truth_lists.select(S1), tables.to_long(truth_lists)
    training.check_pair_ids(pairs)
    labelled = stored(training.label_pairs(pairs.select(S1, CAND), universe, truth))
    training.check_pairs(labelled)
    parts = stored(labelled.join(training.grouped_split(labelled.select(S1, CAND), 0.8, seed).select(S1, CAND, "split"), [S1, CAND]))
    training.check_split(parts)
    fit, held = (parts.filter(F.col("split") == s).drop("split") for s in ("train", "validation"))
    vocabularies = features.fit_vocabularies(source1, others, fit)
    artifacts.save_vocabularies(vocabularies, out)
    x, y = (stored(features.pair_features(p, source1, others, vocabularies).join(p, [S1, CAND])) for p in (fit, held))
    training.check_columns(x.drop("label"), features.FEATURES)
    sizes = {s: p.agg(F.countDistinct(S1), F.count("*"), F.sum("label")).first() for s, p in (("train", fit), ("validation", held))}
    positive = sizes["train"][2] + sizes["validation"][2]
    records = {}
    for name, kind in MODELS.items():
        model = training.fit_classifier(x, features.FEATURES, kind, seed=seed, trees=trees)
        artifacts.save_model(model, out, name)
        scored = stored(training.score(model, y).select(S1, CAND, "label", "score"))
        quality = metrics.pairwise_scores(scored).first()
        records[name] = {
            "model": name,
            "random_seed": seed,
            "train_entities": sizes["train"][0],
            "validation_entities": sizes["validation"][0],
            "train_pairs": sizes["train"][1],
            "validation_pairs": sizes["validation"][1],
            "positive_pairs": positive,
            "negative_pairs": sizes["train"][1] + sizes["validation"][1] - positive,
            "feature_count": len(features.FEATURES),
            "validation_precision": quality.precision,
            "validation_recall": quality.recall,
            "validation_f0_5": quality.f0_5,
        }
        tables.append_log(training.experiment_record(spark, records[name]), log)
        tables.write_tsv(scored, f"{out}/val_predictions_{name}", single=True)
    return records


def choose_threshold(spark: SparkSession, predictions: DataFrame, truth: DataFrame, csv: str, json: str, fine: bool = False) -> tuple[float, float]:
    """Sweep thresholds over the source ids with predictions, write the sweep and the best one; returns it and its score."""
    sweep = stored(metrics.threshold_sweep(predictions, truth, metrics.FINE if fine else metrics.COARSE))
    rows = sweep.select("threshold", "macro_f0_5", "predicted_match_count", "false_positive_count", "false_negative_count")
    rows.coalesce(1).sortWithinPartitions("threshold").write.mode("overwrite").option("header", True).csv(csv)
    best = metrics.best_threshold(sweep).first()
    threshold, score = (best.threshold, best.macro_f0_5) if best else (0.5, -1.0)
    artifacts.save_json(spark, {"threshold": threshold, "metric": "macro_f0_5", "selection": "fast_validation_sample", "best_macro_f0_5": score}, json)
    return threshold, score


def analyse_errors(spark: SparkSession, predictions: DataFrame, records: DataFrame, tsv: str, txt: str) -> str:
    """Write the wrong pairs and the report; returns the report. predictions: as ``errors.error_cases`` needs them."""
    cases = stored(errors.error_cases(predictions, records))
    tables.write_tsv(cases.filter("error_type <> 'correct'"), tsv, single=True)
    text = errors.report(cases)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(txt)
    return text


def infer(spark: SparkSession, source1: DataFrame, others: DataFrame, ordered: DataFrame, models: str, out: str, threshold: float | None = None, check: bool = True) -> DataFrame | None:
    """Block, score with the saved model and write both list files; returns the checks of the files.

    The logistic model is taken, or else the forest; ``threshold`` goes before the saved one, which goes before 0.5.
    """
    name = next((m for m in MODELS if artifacts.exists(spark, f"{models}/{m}")), None)
    if name is None:
        raise FileNotFoundError(f"no model in {models}")
    cut = linkage.chosen_threshold(threshold, artifacts.load_json(spark, f"{models}/threshold.json"))
    matcher = linkage.ClassifierMatches(artifacts.load_model(models, name), artifacts.load_vocabularies(spark, models), cut)
    linkage.run_pipeline(source1, others, ordered, linkage.BlockingCandidates(), matcher, out)
    return submission.check_files(spark, source1, others, f"{out}/matching", f"{out}/candidates") if check else None
