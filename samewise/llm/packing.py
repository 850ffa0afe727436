"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacity.

A document longer than a window is first cut into full windows; what is left over
of it is packed whole. Pieces are dealt evenly over tasks, sorted by falling
length in the JVM, and streamed through the packer, which holds only the lengths
of its open sequences. A task of n pieces leaves about one window unfilled.

Null texts count as empty: one piece with the end id. Null and repeated ids are
kept; equal lengths are ordered by id, start and content. An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import id_and_text


class CapacityTree:
    """Open sequences by remaining capacity; a segment tree over the capacities counts them."""

    def __init__(self, window: int):
        self.window, self.leaves = window, 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        if capacity:
            self.open[capacity].append(sequence)
            self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The open sequence with the least remaining capacity of at least ``length``, and that capacity."""
        node = self.leaves + length
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return self.open[capacity].pop(), capacity


class BestFit:
    """Places for lengths that come in falling order: (sequence, offset)."""

    def __init__(self, window: int):
        self.window, self.tree, self.sequences = window, CapacityTree(window), 0

    def place(self, length: int) -> tuple[int, int]:
        sequence, capacity = self.tree.take(length) or (self.sequences, self.window)
        self.sequences += capacity == self.window
        self.tree.put(capacity - length, sequence)
        return sequence, self.window - capacity


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int, vocabulary: int) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian; two bytes each if the vocabulary allows)."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
    kind = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"

    def pieces(batches):
        import numpy as np
        import pyarrow as pa

        from samewise.llm.token_cache import encoder

        encode, end = encoder(tokenizer).encode_arrow, np.array([end_id], "<u4")
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part, rows = batch.slice(i, 512), []
                for doc_id, coded in zip(part.column(0).to_pylist(), encode(part.column(1)), strict=True):
                    ids = np.concatenate([coded, end]).astype(kind)
                    rows += [(doc_id, s, len(ids[s : s + window]), len(ids), ids[s : s + window].tobytes()) for s in range(0, len(ids), window)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return id_and_text(docs).mapInArrow(pieces, "doc_id long, start long, length int, doc_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, vocabulary: int = 49_408) -> DataFrame:
    """Each piece with its ids (unsigned 32-bit bytes), sequence_id and offset in the sequence."""
    import pyarrow as pa

    cut = tokenized_pieces(docs, tokenizer, end_id, window, vocabulary)
    kind = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        packer, base = BestFit(window), TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            places = [packer.place(n) for n in lengths]
            ids = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(lengths, pa.int64()), batch.column("doc_tokens"), pa.array(ids, pa.binary()), pa.array([base + s for s, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())], schema=schema)

    # Round-robin: no key, so no hot group; Spark sorts rows first, so a retried task deals them alike.
    dealt = cut.hint("rebalance").sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids")
    return dealt.mapInArrow(place, "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long")
