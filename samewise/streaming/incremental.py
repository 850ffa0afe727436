"""Linking new source-1 records as they arrive against a stored key table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from samewise.operators.blocking import blocking_keys


def link_stream(records: DataFrame, keys: DataFrame, out: str, checkpoint: str):
    """Start a query that appends candidate pairs of each micro-batch to ``out``.

    ``keys`` (entity_id, key) is static. The batch id is part of the path, so a
    batch that runs again after a failure replaces what it wrote.
    """
    stored = keys.distinct().withColumnRenamed("entity_id", "candidate_entity_id")

    def link(batch: DataFrame, batch_id: int) -> None:
        new = blocking_keys(batch).withColumnRenamed("entity_id", "source1_entity_id")
        pairs = new.join(stored, "key").select("source1_entity_id", "candidate_entity_id").distinct()
        pairs.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return records.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).start()
