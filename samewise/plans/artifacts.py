"""Fitted vocabularies, models and thresholds as folders that a later session can load."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from samewise.operators.features import FIELDS


def save_vocabularies(vocabularies: dict[str, DataFrame], folder: str) -> None:
    for field in FIELDS:
        vocabularies[field].coalesce(1).write.mode("overwrite").parquet(f"{folder}/vocabulary-{field}")


def load_vocabularies(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {field: spark.read.parquet(f"{folder}/vocabulary-{field}") for field in FIELDS}


def save_model(model, folder: str, name: str) -> None:
    model.write().overwrite().save(f"{folder}/{name}")


def load_model(folder: str, name: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{folder}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_json(spark: SparkSession, value: dict, path: str) -> None:
    """One JSON object, indented, in a folder of one text file."""
    spark.createDataFrame([(json.dumps(value, indent=4),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict | None:
    """The object, or None if there is no such folder."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())) if exists(spark, path) else None
