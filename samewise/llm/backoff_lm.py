"""Language-model scores by a weighted backoff automaton over n-grams of order up to three.

With a history h seen c(h) times, p(w | h) = (c(h w) + mu p(w | h')) / (c(h) + mu), where h' is h without its first token and
p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)). As an automaton: a state for each token seen and for each pair of tokens seen at least
``LEAST_HISTORY`` times; from a state, an arc for each token seen after it, weighted log10 p(w | h); and a failure
arc to the state of h', weighted log10 (mu / (c(h) + mu)), at last to the root, whose arcs weigh log10 p(w). A text is scored in one
traversal from left to right that carries the state. The state after a token is the longest suffix
that is one, so the traversals of all texts of a block are done as arrays.

Counts come from every training text. A task cuts its rows into blocks of bounded
size, whatever the texts or repeated rows, and writes each as a file of token numbers. A block sends owners of hash ranges its distinct tokens and pairs with
its own training counts, packed; owners add them up and answer each block with
the totals of what it sent. Then it asks in the same way for the triples whose first two tokens are a state. A block then holds the part of the automaton that its
own texts can reach. So no vocabulary is ever gathered in one place, and a
frequent n-gram is one entry per block. Messages are at most as many as n-grams sent.

Tokens are named by 64-bit hashes. Null texts are empty: one end token. Rows with a null id train and
are not held out. Repeated rows count each time. A very long text is a block of its own. An empty table gives an empty
result. Other columns are not read, whatever their names. The rows must come in the same order when a lost task is run again, as
from files; otherwise an error says so.
"""

from __future__ import annotations

import json
import math
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import id_and_text, id_remainder, read_file, saved, shared_folder, write_file

#: Bytes of text in a block, prior weight, additive smoothing of single tokens (fixed by the contract), least count of a pair that is a state.
BLOCK_BYTES, MU, ADD, LEAST_HISTORY = 8 << 20, 5.0, 0.1, 2
#: The end token's hash.
END = 0x9D39247E33776D41


class BackoffAutomaton:
    """Weights of arcs by numbers of tokens, pairs and triples; a pair is numbered by its two tokens, a triple by pair and token.

    ``singles``, ``pairs``, ``triples``: training counts by number. ``left``, ``right``: tokens of each pair, ascending; ``first``, ``last``: pair and token of each triple.
    """

    def __init__(self, singles, pairs, triples, left, right, first, last, total: int, distinct: int, mu: float = MU):
        import numpy as np

        singles, pairs, triples = (np.asarray(x, dtype=float) for x in (singles, pairs, triples))
        norm = total + ADD * (distinct + 1)
        p1 = (singles + ADD) / norm
        p2 = (pairs + mu * p1[right]) / (singles[left] + mu)
        key = lambda a, b: (np.asarray(a, dtype=np.int64) << 32) | np.asarray(b, dtype=np.int64)
        second = np.searchsorted(key(left, right), key(np.asarray(right)[first], last))  # the pair of a triple's last two tokens
        self.root = np.log10(p1)
        self.fail1, self.fail2 = np.log10(mu / (singles + mu)), np.log10(mu / (pairs + mu))
        # From a token's state: an arc for pairs seen, else its failure arc, then the root's. Unseen tokens are no states.
        self.arc1 = np.where(singles[left] > 0, np.where(pairs > 0, np.log10(p2), self.fail1[left] + self.root[right]), self.root[right])
        p3 = (triples + mu * 10 ** self.arc1[second]) / (pairs[first] + mu)
        # From a pair's state: an arc for triples seen, else its failure arc to the last token's state.
        self.arc2 = np.where(triples > 0, np.log10(p3), self.fail2[first] + self.arc1[second])
        self.state2 = pairs >= LEAST_HISTORY

    def walk(self, tokens, pair_at, triple_at, pair_before):
        """Weight of each step of the traversals: the arc from the state that the tokens before have led to.

        ``pair_at``: number of the pair that ends at a token, -1 at a text's first; ``triple_at`` likewise, -1 at its first two;
        ``pair_before``: the pair that ends at the token before.
        """
        import numpy as np

        steps = self.root[tokens]
        second = pair_at >= 0
        steps[second] = self.arc1[pair_at[second]]
        third = np.flatnonzero(triple_at >= 0)
        third = third[self.state2[pair_before[third]]]
        steps[third] = self.arc2[triple_at[third]]
        return steps


def mixed_pair(a, b):
    import numpy as np

    from samewise.llm.shingles import mix

    return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b ^ np.uint64(0x5851F42D4C957F2D)))


class Block:
    """Texts as token numbers (in the order of their hashes), and the distinct pairs and triples in them."""

    def __init__(self, doc_ids, known, held_out, lengths, hashes, flat):
        import numpy as np

        self.doc_ids, self.known, self.held_out, self.lengths, self.hashes, self.flat = doc_ids, known, held_out, lengths, hashes, flat.astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        self.starts = starts
        place = np.arange(len(flat)) - np.repeat(starts, lengths)
        self.second, self.third = place >= 1, place >= 2
        self.pair_at = np.full(len(flat), -1, dtype=np.int64)
        at = np.flatnonzero(self.second)
        self.pairs, self.pair_at[at] = np.unique((self.flat[at - 1] << 32) | self.flat[at], return_inverse=True)
        self.pair_before = np.concatenate([np.full(1, -1), self.pair_at[:-1]])
        self.left, self.right = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        self.pair_hashes = mixed_pair(hashes[self.left], hashes[self.right])

    @classmethod
    def of(cls, table) -> Block:
        import numpy as np

        from samewise.llm.shingles import hashed_words

        words, counts = hashed_words(table.column("text").combine_chunks() if hasattr(table.column("text"), "combine_chunks") else table.column("text"))
        lengths = counts + 1
        ends = np.cumsum(lengths) - 1
        all_hashes, is_word = np.full(int(lengths.sum()), END, dtype=np.uint64), np.ones(int(lengths.sum()), dtype=bool)
        is_word[ends] = False
        all_hashes[is_word] = words
        hashes, flat = np.unique(all_hashes, return_inverse=True)
        ids = table.column("doc_id")
        return cls(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), table.column("held_out").to_numpy(zero_copy_only=False), lengths, hashes, flat)

    def pack(self) -> bytes:
        import numpy as np
        import zstandard

        parts = [self.doc_ids.astype("<i8"), self.known.astype("u1"), self.held_out.astype("u1"), self.lengths.astype("<i8"), self.hashes.astype("<u8"), self.flat.astype("<u4")]
        head = json.dumps([[x.dtype.str, len(x)] for x in parts]).encode()
        return zstandard.compress(struct.pack("<I", len(head)) + head + b"".join(np.ascontiguousarray(x).tobytes() for x in parts), 1)

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        import numpy as np
        import zstandard

        raw = zstandard.decompress(data)
        at = 4 + struct.unpack_from("<I", raw)[0]
        parts = []
        for kind, n in json.loads(raw[4:at]):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        ids, known, held_out, lengths, hashes, flat = parts
        return cls(ids, known.astype(bool), held_out.astype(bool), lengths, hashes, flat)

    def trained(self):
        """For each token whether its text is for training."""
        import numpy as np

        return np.repeat(~self.held_out, self.lengths)

    def grams(self):
        """Hashes of tokens and pairs ascending, the order that sorts them, and their training counts in it."""
        import numpy as np

        # The lowest bit tells tokens from pairs.
        both = np.concatenate([self.hashes | np.uint64(1), self.pair_hashes & ~np.uint64(1)])
        order, train = np.argsort(both, kind="stable"), self.trained()
        counts = np.concatenate([np.bincount(self.flat[train], minlength=len(self.hashes)), np.bincount(self.pair_at[train & self.second], minlength=len(self.pairs))])
        return both[order], order, counts[order]

    def ask_triples(self, pair_totals):
        """As ``grams`` for the triples whose first two tokens are a state; keeps ``first`` and ``last`` of each and ``triple_at``."""
        import numpy as np

        at = np.flatnonzero(self.third)
        at = at[pair_totals[self.pair_before[at]] >= LEAST_HISTORY]
        keys, number = np.unique((self.pair_before[at] << 32) | self.flat[at], return_inverse=True)
        self.first, self.last = keys >> 32, keys & 0xFFFFFFFF
        self.triple_at = np.full(len(self.flat), -1, dtype=np.int64)
        self.triple_at[at] = number
        hashes = mixed_pair(self.pair_hashes[self.first] + np.uint64(3), self.hashes[self.last]) & ~np.uint64(1)
        order, train = np.argsort(hashes, kind="stable"), self.trained()[at]
        return hashes[order], order, np.bincount(number[train], minlength=len(keys))[order]


def packed_hashes(hashes, low: int) -> bytes:
    """Ascending hashes as gaps from ``low``, of six bytes each where that is enough."""
    import numpy as np

    gaps = np.diff(hashes, prepend=np.uint64(low))
    if gaps.max(initial=0) >> np.uint64(48):
        return b"\x08" + gaps.astype("<u8").tobytes()
    return b"\x06" + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_hashes(data: bytes, low: int):
    import numpy as np

    width = data[0]
    gaps = np.zeros((len(data) // width, 8), dtype=np.uint8)
    gaps[:, :width] = np.frombuffer(data, np.uint8, -1, 1).reshape(-1, width)
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64) + np.uint64(low)


def low_of(owner: int, owners: int) -> int:
    """The least hash of an owner's range."""
    return -(-(owner << 32) // owners) << 32


def _small(counts) -> bytes:
    import zstandard

    wide = counts.size and counts.max() > 255
    return zstandard.compress(counts.astype("<i8" if wide and counts.max() >> 31 else "<i4" if wide else "u1").tobytes() + (b"\x08" if wide and counts.max() >> 31 else b"\x04" if wide else b"\x01"), 1)


def _large(data: bytes):
    import numpy as np
    import zstandard

    raw = zstandard.decompress(data)
    return np.frombuffer(raw[:-1], {8: "<i8", 4: "<i4", 1: "u1"}[raw[-1]]).astype(np.int64)


REQUEST = "owner int, block string, hashes binary, counts binary"


def _requests(block: str, hashes, counts, owners: int):
    """A row for each owner that the block has hashes for."""
    import numpy as np
    import pyarrow as pa

    owner = (((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)])
    ends = np.append(starts[1:], len(owner))[: len(starts)]
    names = owner[starts].tolist()
    packed = [packed_hashes(hashes[i:j], low_of(o, owners)) for o, i, j in zip(names, starts.tolist(), ends.tolist(), strict=True)]
    small = [_small(counts[i:j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.Table.from_arrays([pa.array(names, pa.int32()), pa.array([block] * len(names), pa.string()), pa.array(packed, pa.binary()), pa.array(small, pa.binary())], names=["owner", "block", "hashes", "counts"])


def _added_up(requests: DataFrame, owners: int) -> DataFrame:
    """block, owner, totals of what the block sent to the owner, and on one row of an owner n and v: the sum of its tokens' counts and how many have one."""

    def add_up(table):
        import numpy as np
        import pyarrow as pa

        owner = table.column("owner")[0].as_py()
        asked = [unpacked_hashes(x, low_of(owner, owners)) for x in table.column("hashes").to_pylist()]
        grams, at = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.zeros(len(grams), dtype=np.int64)
        np.add.at(totals, at, np.concatenate([_large(c) for c in table.column("counts").to_pylist()]))
        tokens = totals[(grams & np.uint64(1)) == 1]
        ends, n = np.cumsum([len(a) for a in asked]), len(asked)
        answers = [_small(totals[x]) for x in np.split(at, ends[:-1])]
        stats = [[int(tokens.sum())] + [0] * (n - 1), [int((tokens > 0).sum())] + [0] * (n - 1)]
        return pa.Table.from_arrays([table.column("block"), table.column("owner"), pa.array(answers, pa.binary()), *(pa.array(s, pa.int64()) for s in stats)], names=["block", "owner", "totals", "n", "v"])

    return requests.groupBy("owner").applyInArrow(add_up, "block string, owner int, totals binary, n long, v long")


def _totals(answers, n: int, order):
    """Totals by number from a block's answers, which hold them in the order of hashes."""
    import numpy as np

    rows = sorted(zip(answers.column("owner").to_pylist(), answers.column("totals").to_pylist(), strict=True))
    found = np.concatenate([np.zeros(0, np.int64), *(_large(t) for _, t in rows)])
    if len(found) != n:
        raise ValueError("the documents came in another order when a task was run again; write them to files first")
    totals = np.zeros(n, dtype=np.int64)
    totals[order] = found
    return totals


def score_documents(docs: DataFrame, held_out_of: int = 10, block_bytes: int = BLOCK_BYTES, mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    import pyarrow as pa

    spark = docs.sparkSession
    texts = id_and_text(docs).withColumn("held_out", F.coalesce(id_remainder(F.col("doc_id"), held_out_of) == 0, F.lit(False)))
    size = texts.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    owners = max(1, math.ceil(size / block_bytes))
    folder = shared_folder(spark, "blocks")

    def send(batches):
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        from samewise.llm.shingles import slices

        part, held, bytes_held, number = TaskContext.get().partitionId(), [], 0, 0

        def close():
            block = Block.of(pa.Table.from_batches(held).combine_chunks())
            data = block.pack()
            name = f"{part:08d}-{number:06d}-{xxhash.xxh3_128_hexdigest(data)}"
            write_file(f"{folder}/{name}", [data])
            hashes, _, counts = block.grams()
            yield from _requests(name, hashes, counts, owners).to_batches()

        for batch in batches:
            for piece in slices(batch, "text", 1 << 16, max(1, block_bytes // 8)):
                own = piece.column("text").nbytes
                if held and bytes_held + own > block_bytes:
                    yield from close()
                    held, bytes_held, number = [], 0, number + 1
                held.append(piece)
                bytes_held += own
        if held:
            yield from close()

    answers = saved(_added_up(texts.mapInArrow(send, REQUEST), owners), "totals")
    total, distinct = (x or 0 for x in answers.agg(F.sum("n"), F.sum("v")).first())

    def ask(table):
        name = table.column("block")[0].as_py()
        block = Block.unpack(read_file(f"{folder}/{name}"))
        _, order, _ = block.grams()
        totals = _totals(table, len(order), order)
        hashes, _, counts = block.ask_triples(totals[len(block.hashes) :])
        return _requests(name, hashes, counts, owners)

    asked = answers.select("block", "owner", "totals")
    more = saved(_added_up(asked.groupBy("block").applyInArrow(ask, REQUEST), owners), "totals")
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(single, triple):
        import numpy as np
        import pyarrow as pa

        block = Block.unpack(read_file(f"{folder}/{single.column('block')[0].as_py()}"))
        _, order, _ = block.grams()
        totals = _totals(single, len(order), order)
        singles, pairs = totals[: len(block.hashes)], totals[len(block.hashes) :]
        hashes, order, _ = block.ask_triples(pairs)
        triples = _totals(triple, len(hashes), order)
        # Every token but the end has a successor, so a token's count is its count as a history.
        automaton = BackoffAutomaton(singles, pairs, triples, block.left, block.right, block.first, block.last, total, distinct, mu)
        steps = automaton.walk(block.flat, block.pair_at, block.triple_at, block.pair_before)
        sums = lambda x: np.add.reduceat(x, block.starts)
        n = len(block.lengths)
        return pa.Table.from_arrays([pa.array(block.doc_ids, pa.int64(), mask=~block.known), pa.array(block.held_out), pa.array(block.lengths), pa.array(sums((singles > 0)[block.flat].astype(np.int64))), pa.array(np.full(n, total)), pa.array(sums(automaton.root[block.flat])), pa.array(sums(steps))], schema=out)

    both = asked.groupBy("block").cogroup(more.select("block", "owner", "totals").groupBy("block"))
    # The tables and block files that the result is computed from stay until the caller removes them.
    return both.applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
