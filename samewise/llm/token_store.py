"""Token-id files: one zstandard frame per document, with a seek table at the end.

A shard holds, in order: a frame for each document (its ids, little-endian, with
zstandard's own checksum), a skippable frame with the documents' ids, and the
seek table of the public seekable-zstandard format: for each frame its
compressed size, its size and the low 32 bits of the XXH64 of its content. A
reader fetches the last bytes of a shard and then only the frames it wants.

Null texts count as empty, so such a document holds only its end id. Null ids
come first. Repeated ids are kept, in the order of their texts' hashes, then
texts. An empty table gives no shard. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import file_system, id_and_text, shared_folder, write_file

#: Bytes of text in a shard, beyond what the session's number of shuffle partitions makes of a small input.
SHARD_BYTES = 256 << 20

#: Fixed values of the zstandard frame formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_END = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
NO_ID = -(2**63)
_HEAD, _TAIL = struct.Struct("<II"), struct.Struct("<IBI")


def shard_parts(documents: Iterator[tuple[int | None, bytes]], width: int, level: int = 3) -> Iterator[bytes]:
    """The bytes of a shard, from (id, ids as bytes of ``width`` each)."""
    import numpy as np
    import xxhash
    import zstandard

    pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
    names, entries = [], []
    for doc_id, ids in documents:
        frame = pack(ids)
        names.append(NO_ID if doc_id is None else doc_id)
        entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        yield frame
    index = struct.pack("<B", width) + pack(np.asarray(names, dtype="<i8").tobytes())
    index = _HEAD.pack(SKIPPABLE_INDEX, len(index)) + index
    entries.append((len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
    yield index
    table = np.asarray(entries, dtype="<u4").tobytes() + _TAIL.pack(len(entries), 0x80, SEEKABLE_END)
    yield _HEAD.pack(SKIPPABLE_SEEK, len(table)) + table


class Shard:
    """Random access to one shard."""

    def __init__(self, uri: str):
        import numpy as np
        import zstandard

        files, path = file_system(uri)
        self.file, self.unpack = files.open_input_file(path), zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        n, _, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != SEEKABLE_END:
            raise ValueError(f"no seek table at the end of {uri}")
        table = np.frombuffer(self.file.read_at(12 * n, size - _TAIL.size - 12 * n), dtype="<u4").reshape(n, 3)
        self.entries = table[:-1]
        self.offsets = np.concatenate([[0], np.cumsum(table[:-1, 0], dtype=np.int64)])
        index = self.file.read_at(int(table[-1, 0]), int(self.offsets[-1]))[_HEAD.size :]
        self.width = index[0]
        self.doc_ids = np.frombuffer(self.unpack(index[1:]), dtype="<i8")

    def ids(self, i: int) -> bytes:
        """Document i's ids, as little-endian unsigned 32-bit bytes; only its frame is read."""
        import numpy as np
        import xxhash

        data = self.unpack(self.file.read_at(int(self.entries[i, 0]), int(self.offsets[i])), max_output_size=int(self.entries[i, 1]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.entries[i, 2]:
            raise ValueError(f"checksum of frame {i} differs")
        return data if self.width == 4 else np.frombuffer(data, dtype="<u2").astype("<u4").tobytes()

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int = 50_257, folder: str | None = None) -> str:
    """Encode whole texts and write shards in ascending id order; returns the folder.

    Rows are range-partitioned by id (and text hash, which splits an id that many
    rows share); shard names ascend with the ranges, and their number grows with the bytes of text. Ids take two bytes if
    ``vocabulary`` allows. ``folder/manifest`` lists the shards with their first and last doc_id.
    """
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from samewise.llm.token_cache import encoder

        shard, counts, ends = TaskContext.get().partitionId(), [0, 0], [None, None]
        encode, end, kind = encoder(tokenizer).encode_arrow, np.array([end_id], "<u4"), "<u2" if width == 2 else "<u4"

        def encoded():
            for batch in batches:
                for i in range(0, batch.num_rows, 512):
                    part = batch.slice(i, 512)
                    doc_ids = part.column(0).to_pylist()
                    ends[:] = ends[0] if counts[0] else doc_ids[0], doc_ids[-1]
                    for doc_id, ids in zip(doc_ids, encode(part.column(1)), strict=True):
                        counts[0] += 1
                        counts[1] += len(ids) + 1
                        yield doc_id, np.concatenate([ids, end]).astype(kind).tobytes()

        rows = encoded()
        if (first := next(rows, None)) is None:
            return
        path = f"{folder}/shard-{shard:08d}.zst"

        def chain():
            yield first
            yield from rows

        size = write_file(path, shard_parts(chain(), width))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "path": [path], "n_docs": pa.array([counts[0]], pa.int64()), "n_tokens": pa.array([counts[1]], pa.int64()), "n_bytes": pa.array([size], pa.int64()), "first_id": pa.array(ends[:1], pa.int64()), "last_id": pa.array(ends[1:], pa.int64())})

    texts = id_and_text(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    ordered = texts.withColumn("hash", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    ordered.drop("hash").mapInArrow(write, "shard long, path string, n_docs long, n_tokens long, n_bytes long, first_id long, last_id long").write.parquet(f"{folder}/manifest")
    return folder


def read_tokens(spark, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit bytes).

    With ``doc_ids`` only those documents' frames are read and decompressed, and only shards whose range may hold them opened.
    """
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                shard = Shard(path)
                lengths = shard.entries[:, 1].astype(np.int64) // shard.width
                starts = before + np.cumsum(lengths) - lengths
                rows, held = [], 0
                for i, doc_id in enumerate(shard.doc_ids.tolist()):
                    if wanted is None or doc_id in wanted:
                        rows.append((None if doc_id == NO_ID else doc_id, int(starts[i]), int(lengths[i]), shard.ids(i)))
                        held += len(rows[-1][3])
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                shard.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    # One row for each shard: the running total over shards is a small window.
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = F.expr("sum(n_tokens) over (order by shard) - n_tokens")
    shards = manifest.select("shard", "path", "first_id", "last_id", before.alias("before"))
    tasks = max(1, manifest.count())
    if wanted:  # the window has seen all shards; null ids stand first
        few = sorted(wanted) if len(wanted) <= 1000 else [min(wanted), max(wanted)]
        reach = (F.col("last_id") >= few[0]) & (F.coalesce("first_id", F.lit(NO_ID)) <= few[-1])
        shards = shards.filter(reach & (F.exists(F.array(*map(F.lit, few)), lambda x: x.between(F.coalesce("first_id", F.lit(NO_ID)), F.col("last_id"))) if len(wanted) <= 1000 else F.lit(True)))
    return shards.repartitionByRange(tasks, "shard").select("path", "before").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
