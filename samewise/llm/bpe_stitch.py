"""Byte-level BPE by ranks, in overlapping chunks, and decoding by joining raw bytes.

A text is cut into chunks that overlap their neighbours by a window on
either side. A chunk is pre-tokenised on its own, from two starts in each
overlap; where both runs put a boundary after a letter or digit and before white
space, they have resynchronised, and every later pre-token is that of the whole
text. Both neighbours see the same window and so find the same cut. Pieces
between cuts are encoded apart. If an overlap holds no such boundary, the
neighbours pass their raw text on and it is encoded when the document is joined.

Every text goes this way; one chunk has nothing to stitch. The chunks of a text of over ``SPREAD`` of them are dealt
out over tasks, those of other texts stay in theirs.

Null texts count as empty (no ids). Repeated rows give repeated results; null ids
are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import id_and_text

_loaded: dict[str, Bpe] = {}
#: Chunks of a text that stay in one task.
SPREAD = 64
CODED = "doc_id long, n_tokens long, ids binary, decoded binary"


class Bpe:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.resume = regex.compile(r"[\p{L}\p{N}]\s")

    def bytes_of(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def boundaries(self, text: str, start: int, end: int) -> set[int]:
        return {m.start() for m in self.pattern.finditer(text, start, end)}

    def cut(self, text: str, at: int, overlap: int) -> int | None:
        """The first place from ``at`` on where runs from ``at - overlap`` and from ``at`` agree."""
        end = min(len(text), at + overlap)
        left, right = self.boundaries(text, max(0, at - overlap), end), self.boundaries(text, at, end)
        for m in self.resume.finditer(text, at, end):
            if m.start() + 1 in left and m.start() + 1 in right:
                return m.start() + 1
        return None


    def piece(self, text: str, k: int, n: int, chunk: int, overlap: int) -> tuple[bytes | None, str | None]:
        """Chunk k of n: its own piece as ids if both ends resynchronise, else as raw text. text: the chunk with its overlaps."""
        from array import array

        own = overlap if k and k * chunk >= overlap else k * chunk
        head = self.cut(text, own, overlap) if k else 0
        tail = self.cut(text, own + chunk, overlap) if k < n - 1 else len(text)
        part = text[own if head is None else head : own + chunk if tail is None else tail]
        if head is None or tail is None:
            return None, part
        return array("I", self.encode(part)).tobytes(), None

    def stitched(self, pieces) -> bytes:
        """Ids of a text from its pieces in order; neighbouring raw ones are encoded as one."""
        from array import array

        done, raw = [], []
        for ids, part in [*pieces, (b"", None)]:
            if part is not None:
                raw.append(part)
                continue
            if raw:
                done.append(array("I", self.encode("".join(raw))).tobytes())
                raw = []
            done.append(ids)
        return b"".join(done)


def chunks_of(text: str, chunk: int, overlap: int):
    """(number, chunks in all, text with both overlaps) of each chunk."""
    n = max(1, -(-len(text) // chunk))
    for k in range(n):
        yield k, n, text[max(0, k * chunk - overlap) : (k + 1) * chunk + overlap]


def bpe(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, ranks: str, chunk: int = 1 << 12, overlap: int = 1 << 9, spread: int = SPREAD) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit bytes), decoded (raw bytes)."""
    import pyarrow as pa

    coded = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def rows(encoder, doc_ids, ids):
        import numpy as np
        import pyarrow as pa

        numbers = [np.frombuffer(x, "<u4").tolist() for x in ids]
        return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(map(len, numbers), pa.int64()), pa.array(ids, pa.binary()), pa.array(map(encoder.bytes_of, numbers), pa.binary())], schema=coded)

    def together(batches):
        from samewise.llm.shingles import slices

        encoder = bpe(ranks)
        for batch in batches:
            for part in slices(batch, "text", 1000):
                ids = [encoder.stitched(encoder.piece(x, k, n, chunk, overlap) for k, n, x in chunks_of(t, chunk, overlap)) for t in part.column(1).to_pylist()]
                yield rows(encoder, part.column(0), ids)

    def deal(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = hashlib.sha256(text.encode()).hexdigest()
                for k, n, part in chunks_of(text, chunk, overlap):
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc_id], pa.int64()), "key": [key], "k": pa.array([k], pa.int32()), "n": pa.array([n], pa.int32()), "piece": [part]})

    def pieces(batches):
        import pyarrow as pa

        encoder = bpe(ranks)
        for batch in batches:
            found = [encoder.piece(x, k, n, chunk, overlap) for k, n, x in zip(*(batch.column(c).to_pylist() for c in ("k", "n", "piece")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "k")), pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], names=["doc_id", "key", "k", "ids", "raw"])

    def join(batches):
        encoder = bpe(ranks)
        for batch in batches:
            for doc_id, copies, parts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copies", "parts")), strict=True):
                row = rows(encoder, [doc_id], [encoder.stitched((p["ids"], p["raw"]) for p in sorted(parts, key=lambda p: p["k"]))])
                for _ in range(copies):
                    yield row

    texts = id_and_text(docs)
    is_long = F.length("text") > chunk * spread
    dealt = texts.filter(is_long).mapInArrow(deal, "doc_id long, key string, k int, n int, piece string").repartition("doc_id", "key", "k")
    found = dealt.mapInArrow(pieces, "doc_id long, key string, k int, ids binary, raw string")
    once = found.groupBy("doc_id", "key", "k").agg(F.count("*").alias("copies"), F.first("ids").alias("ids"), F.first("raw").alias("raw"))
    parts = once.groupBy("doc_id", "key").agg(F.max("copies").alias("copies"), F.collect_list(F.struct("k", "ids", "raw")).alias("parts"))
    return texts.filter(~is_long).mapInArrow(together, CODED).unionByName(parts.mapInArrow(join, CODED))
