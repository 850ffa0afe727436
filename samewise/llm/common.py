"""Shared plumbing: document columns, the shared scratch folder, small files in it."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z and their lower-case forms, for case folding that leaves other letters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Folders named since the innermost ``scratch_removed`` began.
_named: list[str] | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of the documents table; a null text counts as empty."""
    return id_and_text(read_table(spark, sf_dir, "documents"))


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only where the setting is missing (local sessions, as in tests) a temporary
    folder is made and put into the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="samewise-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/samewise-{what}-{uuid.uuid4().hex}"
    if _named is not None:
        _named.append(path)
    return path


@contextlib.contextmanager
def scratch_removed(spark: SparkSession):
    """Folders named within are deleted at the end; the yielded list may be used to keep some."""
    global _named
    outer, _named = _named, []
    try:
        yield _named
    finally:
        own, _named = _named, outer
        remove(spark, own)


def saved(df: DataFrame, what: str, scratch: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage and survives lost executors.

    ``scratch`` gets the path, for ``remove`` once nothing reads the table any more.
    """
    path = shared_folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows in what is run (not only planned) within."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``shared_folder`` named, and empty the list."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    paths.clear()


def file_system(uri: str):
    """The pyarrow filesystem of a URI or plain path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, parts) -> int:
    """Write byte strings to a file that appears under its name only when complete.

    A retried or speculative task writes the same bytes again under the same name.
    """
    files, path = file_system(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    own, size = f"{path}.{uuid.uuid4().hex}.part", 0
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    files.move(own, path)
    return size


def read_file(uri: str) -> bytes | None:
    """The bytes of a file, or None if it does not exist."""
    files, path = file_system(uri)
    try:
        with files.open_input_file(path) as f:
            return f.read()
    except FileNotFoundError:
        return None
