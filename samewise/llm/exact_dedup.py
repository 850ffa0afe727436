"""Exact duplicates by exchanging Golomb-coded fingerprints, then comparing bytes.

1. Each partition of the documents sends every owner of a fingerprint range its
   sorted distinct fingerprints, Golomb-coded.
2. Owners merge what they got and answer each partition with a bitmap over what
   it sent: which fingerprints another row has too.
3. Partitions go through their rows again; a row whose bit is set, or whose
   fingerprint is not among those the partition sent (the input was cut up
   differently the second time), is a suspect. Only suspects' texts are
   shuffled, pre-aggregated in each task, and grouped by their bytes.

So the result never rests on fingerprints, and copies of one text, however many,
meet as one partial row per task.

Texts are equal when identical after lower-casing A-Z; a null text is empty. The
row with the largest id stays; of repeated rows with that id one stays; null ids
are the smallest. An empty table gives an empty result. Further columns, whatever
their names, pass through ``deduplicate`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samewise.llm import golomb
from samewise.llm.common import ascii_lower, read_file, saved, shared_folder, write_file

#: Bits of a fingerprint, of which a chance match only makes one more suspect; rows whose fingerprints an owner merges.
BITS, OWNED = 48, 2_000_000


def _fingerprints(texts):
    import numpy as np
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(t.as_buffer() or b"") >> (64 - BITS) for t in texts), dtype=np.int64, count=len(texts))


def _answer_duplicates(lists, doubled):
    """For each ascending list: a bit for each value, set if it is in another list or doubled in its own."""
    import numpy as np

    values, counts = np.unique(np.concatenate([*lists, *doubled]), return_counts=True)
    again = values[counts > 1]
    return [np.packbits(np.isin(x, again, assume_unique=True)).tobytes() for x in lists]


def owners_for(docs: DataFrame) -> int:
    """As many owners as the session has shuffle partitions, and more where an owner would get over OWNED rows."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // OWNED))


def suspects(docs: DataFrame, text: str, owners: int) -> DataFrame:
    """``docs`` with ``_uid`` (unique), ``_suspect`` and ``_norm``, written to the shared folder."""
    import pyarrow as pa

    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "bitmaps")
    normal = docs.withColumn("_norm", ascii_lower(F.coalesce(F.col(text), F.lit(""))))
    sent = pa.schema([("owner", pa.int32()), ("part", pa.int64()), ("coded", pa.binary()), ("doubled", pa.binary())])

    def send(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        found = [_fingerprints(batch.column(0)) for batch in batches]
        if not found:
            return
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        ends = np.searchsorted(values, [(o + 1 << BITS) // owners for o in range(owners)])
        rows = []
        for o, (i, j) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if j > i:
                own = values[i:j]
                rows.append((o, TaskContext.get().partitionId(), golomb.encode(own), golomb.encode(own[counts[i:j] > 1])))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), sent, strict=True)], schema=sent)

    def own(table):
        import pyarrow as pa

        coded = table.column("coded").to_pylist()
        bits = _answer_duplicates([golomb.decode(c) for c in coded], [golomb.decode(c) for c in table.column("doubled").to_pylist()])
        return pa.Table.from_arrays([table.column("part"), table.column("owner"), pa.array(coded, pa.binary()), pa.array(bits, pa.binary())], names=["part", "owner", "coded", "bits"])

    def keep(batches):
        """A file for each partition: the fingerprints it sent that others have too, and how many it sent."""
        import numpy as np
        import pyarrow as pa

        part, known, again = None, [], []

        def close():
            arrays = [np.sort(np.concatenate(x)).astype("<i8") for x in (known, again)]
            return write_file(f"{folder}/part-{part:08d}.bin", [len(arrays[0]).to_bytes(8, "little"), *(a.tobytes() for a in arrays)])

        n = 0
        for batch in batches:
            for p, coded, bits in zip(*(batch.column(c).to_pylist() for c in ("part", "coded", "bits")), strict=True):
                if p != part:
                    n += part is not None and close() > 0
                    part, known, again = p, [], []
                values = golomb.decode(coded)
                known.append(values)
                again.append(values[np.unpackbits(np.frombuffer(bits, np.uint8))[: len(values)].astype(bool)])
        if part is not None:
            n += close() > 0
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    exchange = normal.select(F.col("_norm").cast("binary")).mapInArrow(send, "owner int, part long, coded binary, doubled binary")
    answers = exchange.groupBy("owner").applyInArrow(own, "part long, owner int, coded binary, bits binary")
    answers.repartition("part").sortWithinPartitions("part", "owner").mapInArrow(keep, "n long").agg(F.sum("n")).collect()

    def mark(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        data, uid = read_file(f"{folder}/part-{part:08d}.bin"), part << 36
        n = int.from_bytes(data[:8], "little") if data else 0
        known, again = (np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<i8", -1, 8 + 8 * n)) if data else (np.zeros(0, "<i8"),) * 2
        for batch in batches:
            values = _fingerprints(batch.column("_norm"))
            suspect = np.isin(values, again) | ~np.isin(values, known)
            row = pa.array(np.arange(uid, uid + batch.num_rows))
            uid += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, row, pa.array(suspect)], names=[*batch.schema.names, "_uid", "_suspect"])

    rows = normal.withColumn("_norm", F.col("_norm").cast("binary"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_uid", T.LongType()), T.StructField("_suspect", T.BooleanType())])
    marked = rows.mapInArrow(mark, schema)
    return saved(marked.withColumn("_sha", F.sha2("_norm", 256)).withColumn("_norm", F.when(F.col("_suspect"), F.col("_norm"))), "suspects")


def _classes(marked: DataFrame) -> DataFrame:
    """_sha, keep (struct of id and uid) and size of each class of suspects.

    The text itself is the grouping key, so rows are one class only if their
    bytes are equal; the digest then names the class to its members.
    """
    texts = marked.filter("_suspect").groupBy("_sha", "_norm")
    return texts.agg(F.max(F.struct("_id", "_uid")).alias("keep"), F.count("*").alias("size")).drop("_norm")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    owners = owners or owners_for(docs)
    marked = suspects(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", owners).drop("_text")
    alone = marked.filter("not _suspect").select(F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"))
    among = marked.filter("_suspect").select("_id", "_uid", "_sha")
    found = among.join(_classes(marked), "_sha").select(F.col("_id").alias("doc_id"), F.col("keep._id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("keep._uid") == F.col("_uid")).alias("kept"), F.col("_sha").alias("text_sha256"))
    return alone.unionByName(found)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    owners = owners or owners_for(docs)
    row = docs.select(F.col(id_col).alias("_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    marked = suspects(row, f"_row.{text_col}", owners)
    stay = _classes(marked).select(F.col("keep._uid").alias("_uid"))
    kept = marked.filter("_suspect").join(stay, "_uid", "left_semi")
    return marked.filter("not _suspect").unionByName(kept).select("_row.*")
