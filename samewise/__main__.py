"""Command line: python -m samewise block | train | evaluate | errors | infer."""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="samewise", description="Record linkage on Spark.")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, sources: bool = True) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=text)
        for n in (1, 2, 3) if sources else ():
            c.add_argument(f"--source{n}", required=True)
        return c

    block = command("block", "write candidate pairs")
    block.add_argument("--out", required=True)
    train = command("train", "fit and save both models")
    train.add_argument("--pairs", help="candidate pairs (TSV); not needed with --dev")
    train.add_argument("--truth", required=True)
    train.add_argument("--out", required=True)
    train.add_argument("--log", required=True)
    train.add_argument("--seed", type=int, default=42)
    train.add_argument("--dev", action="store_true", help="train on a small sample of pairs")
    evaluate = command("evaluate", "choose a threshold", sources=False)
    evaluate.add_argument("--predictions", required=True)
    evaluate.add_argument("--truth", required=True)
    evaluate.add_argument("--csv", required=True)
    evaluate.add_argument("--json", required=True)
    evaluate.add_argument("--fine", action="store_true")
    errors = command("errors", "write the wrong pairs and a report")
    errors.add_argument("--predictions", required=True)
    errors.add_argument("--threshold", type=float, default=0.5)
    errors.add_argument("--tsv", required=True)
    errors.add_argument("--txt", required=True)
    infer = command("infer", "write the list files with saved models")
    infer.add_argument("--models", required=True)
    infer.add_argument("--out", required=True)
    infer.add_argument("--threshold", type=float)
    infer.add_argument("--no-check", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from samewise.operators import blocking, training
    from samewise.plans import runs
    from samewise.sources import tables

    spark = SparkSession.builder.appName("samewise").getOrCreate()
    predictions = lambda: tables.read_tsv(spark, a.predictions, tables.PREDICTION).withColumns({"label": F.col("label").cast("int"), "score": F.col("score").cast("double")})
    truth = lambda: tables.truth_lists(tables.read_tsv(spark, a.truth, tables.TRUTH))
    sources = lambda: (tables.read_records(spark, a.source1), tables.read_records(spark, [a.source2, a.source3]))
    if a.command == "block":
        print(blocking.run_blocking(spark, a.source1, a.source2, a.source3, a.out), "pairs")
    elif a.command == "train":
        one, others = sources()
        lists = truth()
        if not a.dev and not a.pairs:
            raise SystemExit("--pairs or --dev is needed")
        pairs = training.dev_sample(one, others, tables.to_long(lists)).select("source1_entity_id", "candidate_entity_id") if a.dev else tables.read_pairs(spark, a.pairs)
        for record in runs.train(spark, pairs, one, others, lists, a.out, a.log, a.seed).values():
            print(record)
    elif a.command == "evaluate":
        print(*runs.choose_threshold(spark, predictions(), tables.to_long(truth()), a.csv, a.json, a.fine))
    elif a.command == "errors":
        one, others = sources()
        judged = predictions().select("source1_entity_id", "candidate_entity_id", "score", (F.col("score") >= a.threshold).cast("int").alias("prediction"), F.col("label").alias("ground_truth_label"))
        print(runs.analyse_errors(spark, judged, tables.union_sources(one, others), a.tsv, a.txt))
    else:
        one, others = sources()
        checks = runs.infer(spark, one, others, tables.read_ordered_ids(spark, a.source1), a.models, a.out, a.threshold, not a.no_check)
        for r in checks.collect() if checks else ():
            print(r.check, r.violations)


if __name__ == "__main__":
    main()
