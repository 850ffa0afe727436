"""Similarity join of documents on word n-grams (Jaccard), by parity sketches.

Texts with equal shingle sets form a class; only one representative of each
class takes part. A set is hashed into segments: each shingle falls into one, and a segment is the
XOR of the hashes of its shingles. The XOR of two documents' segments is that
of the symmetric difference D of their sets, so they differ in at most |D| segments. For sizes
a <= c, a Jaccard of at least t means c <= a / t and |D| <= a (1 - t) / t. Documents are joined by
size band; a band has one segment more than the largest |D| in it plus some spare
ones, so linked documents agree on all but |D| of them. If at most the spare ones of a
document are empty, a linked one shares a segment with it that is
not empty, and that is the join key. Spare segments are chosen by the load of the band's smallest sets; where a
small set may leave more of them empty by chance, the band has several hash functions, of which one must suffice. A document for which none
does (at most about ``RARE`` of a band's documents) also joins by its empty segments.
Sets of a band without room for a difference are linked only if equal, so they send no keys.

Candidates of a key are first the pairs with its smallest member. Their folded
sketches, one bit for each shingle and two to four bits of room for it, must be near enough, then the sets themselves are compared. Where a
key's members still belong to several components, they are dealt out in blocks, and
sketches of block pairs are compared within a task, which sends only the nearest pairs that would join components, a forest first
and more of them only where those turn out not to be linked. So a large group of near copies costs about as
many pairs as it has members, and no link between different components is lost.

Null texts are empty; they and texts without words have no shingles and link with nothing.
Null ids are kept as rows with a null component. Repeated ids
share a component, since a component is named by ids. Empty tables give an empty result. Very long texts are taken whole:
keys and sketches grow with the set. Columns other than doc_id and text are not read, whatever their names; ``one_of_each`` passes them on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import arrow_rows, id_and_text, remove, saved
from samewise.llm.components import connected_components, merged_components

#: Least bits of a folded sketch; most members of a block and bytes of its sketches.
LEAST_BITS, BLOCK, BLOCK_BYTES = 512, 1024, 1 << 20
#: Rows of an Arrow batch: of texts, and of block pairs, each of which may be some megabytes.
TEXT_ROWS, BLOCK_ROWS = 2000, 16
#: Share of a band's smallest sets that may have to join by empty segments; hash functions of a band at most; least load of a segment.
RARE, SEEDS, LOAD = 1e-6, 8, 1.5
#: Pairs that a block pair sends for two components, round by round.
WIDTHS = (1, None)
#: Keys that a member of an open group carries, so that pairs sharing several are sent by one of them.
CARRIED, NO_KEY = 8, (1 << 63) - 1


@lru_cache(maxsize=4096)
def empties_beyond(n: int, segments: int, spare: int) -> float:
    """Chance that ``n`` elements leave more than ``spare`` of the segments empty, or a bound of it."""
    if segments <= 64:
        filled = [1.0] + [0.0] * segments
        for _ in range(n):
            filled = [0.0] + [filled[k] * k / segments + filled[k - 1] * (segments - k + 1) / segments for k in range(1, segments + 1)]
        return min(1.0, sum(filled[: max(0, segments - spare)]))
    # Empty segments are negatively associated, so a Poisson tail of their mean bounds them (Chernoff).
    mean = segments * (1 - 1 / segments) ** n
    more = spare + 1
    return 1.0 if more <= mean else math.exp(more - mean - more * math.log(more / mean))


@dataclass(frozen=True)
class Bands:
    """Size bands for a Jaccard of at least percent / 100."""

    percent: int

    def largest_difference(self, a: int) -> int:
        """Most elements in which a set of ``a`` differs from one that is linked and not smaller."""
        return a * (100 - self.percent) // self.percent

    def edges(self, upto: int) -> list[int]:
        out = [1]
        while out[-1] <= upto:
            out.append(out[-1] * 100 // self.percent + 1)
        return out

    @lru_cache(maxsize=4096)  # noqa: B019
    def plan(self, first: int, end: int) -> tuple[int, int, int]:
        """(segments, spare, hash functions) of the band whose smaller members have ``first`` to ``end`` - 1 elements."""
        d = self.largest_difference(end - 1)
        best = None
        for seeds in range(1, SEEDS + 1):
            low, high = 0, max(2, math.ceil(first / LOAD) - d - 1)
            if empties_beyond(first, d + 1 + high, high) ** seeds > RARE:
                continue
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if empties_beyond(first, d + 1 + middle, middle) ** seeds <= RARE else (middle + 1, high)
            if best is None or seeds * (d + 1 + low) < best[2] * best[0]:
                best = (d + 1 + low, low, seeds)
        return best or (d + 2, 1, 1)


def keys_of(hashes, bands: Bands, edges: list[int]):
    """The join keys of one set (ascending hashes), for its own band and, as a larger member, the one below."""
    import numpy as np

    from samewise.llm.shingles import mix

    out = []
    b = int(np.searchsorted(edges, len(hashes), side="right")) - 1
    places = {0: (hashes, mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))}
    for band in (b, b - 1):
        if band < 0 or not bands.largest_difference(edges[band + 1] - 1):
            continue
        segments, spare, seeds = bands.plan(edges[band], edges[band + 1])
        fewest, salt = segments, np.uint64(band << 40)
        for seed in range(seeds):
            if seed not in places:
                x = np.sort(mix(hashes + np.uint64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1)))
                places[seed] = x, mix(x)
            x, values = places[seed]
            # The segment from the high half, which ascends.
            segment = ((x >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            number = segment[starts] + salt + np.uint64(seed << 32)
            out.append(mix(np.bitwise_xor.reduceat(values, starts) + mix(number)))
            fewest = min(fewest, segments - len(starts))
            if seed == 0:
                empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), segment[starts], assume_unique=True)
        if fewest > spare:
            out.append(mix(mix(empty + salt)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def folded(hashes) -> bytes:
    """A bit for each shingle, XORed into at least twice as many places, a power of two."""
    import numpy as np

    from samewise.llm.shingles import mix

    bits = max(LEAST_BITS, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits((np.bincount((mix(hashes) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def fold_to(sketches, words: int):
    """Rows of sketches folded to fewer words: the sketch of the same set with fewer places."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def distances(x: list[bytes], y: list[bytes]):
    """Hamming distance of each two sketches, the longer one folded."""
    import numpy as np

    out = np.zeros(len(x), dtype=np.int64)
    sizes = np.array([[len(a), len(b)] for a, b in zip(x, y, strict=True)]).reshape(-1, 2) // 8
    for m, n in {tuple(s) for s in sizes.tolist()}:
        at = np.flatnonzero((sizes[:, 0] == m) & (sizes[:, 1] == n))
        a, b = (np.frombuffer(b"".join([z[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1) for z in (x, y))
        out[at] = np.bitwise_count(fold_to(a, min(m, n)) ^ fold_to(b, min(m, n))).sum(axis=1, dtype=np.int64)
    return out


def near(distance, nx, ny, bands: Bands):
    """Whether sizes and the sketches' distance allow a link."""
    import numpy as np

    small, large = np.minimum(nx, ny), np.maximum(nx, ny)
    return (large * bands.percent <= small * 100) & (small > 0) & (distance * bands.percent <= small * (100 - bands.percent))


def linked(x, y, percent: int) -> bool:
    import numpy as np

    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both) and both > 0


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, n, digest (128 bits naming the shingle set), sketch; of equal sets in a task only the first has a sketch."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])

    def sketch(batches):
        import pyarrow as pa
        import xxhash

        from samewise.llm.shingles import Shingler, slices

        of, seen = Shingler(size).of_batch, set()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, hashes in zip(part.column(0).to_pylist(), of(part.column(1)), strict=True):
                    digest = xxhash.xxh3_128_digest(hashes.tobytes())
                    rows.append((doc_id, len(hashes), digest, folded(hashes) if len(hashes) and digest not in seen else None))
                    if len(seen) < 1 << 18:
                        seen.add(digest)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return texts.mapInArrow(sketch, "doc_id long, n long, digest binary, sketch binary")


def _keyed(texts: DataFrame, size: int, bands: Bands) -> DataFrame:
    """key, id; of equal sets in a task only the first sends its keys."""
    import pyarrow as pa

    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])

    def emit(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        from samewise.llm.shingles import Shingler, slices

        of, edges, seen = Shingler(size).of_batch, bands.edges(1), set()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, ids, held = [], [], 0
                for doc_id, hashes in zip(part.column(0).to_pylist(), of(part.column(1)), strict=True):
                    digest = xxhash.xxh3_128_digest(hashes.tobytes())
                    if not len(hashes) or digest in seen:
                        continue
                    if len(seen) < 1 << 18:
                        seen.add(digest)
                    if len(hashes) >= edges[-1]:
                        edges = bands.edges(len(hashes))
                    keys.append(keys_of(hashes, bands, edges))
                    ids.append(np.full(len(keys[-1]), doc_id, dtype=np.int64))
                    held += len(keys[-1])
                    if held > 1 << 18:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], schema=schema)
                        keys, ids, held = [], [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], schema=schema)

    return texts.mapInArrow(emit, "key long, id long")


def _groups(keyed: DataFrame) -> DataFrame:
    """(grp, member) for ids that share a key; equal groups of a task once."""
    import pyarrow as pa

    schema = pa.schema([("grp", pa.int64()), ("member", pa.int64())])

    def emit(batches):
        import numpy as np
        import pyarrow as pa

        from samewise.llm.shingles import mix

        seen: set[int] = set()

        def of(key, ids):
            """Rows of complete groups."""
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            names = np.add.reduceat(mix(ids.astype(np.uint64)), starts).view(np.int64)
            take = sizes > 1
            for g in np.flatnonzero(take).tolist():
                if (name := int(names[g])) in seen:
                    take[g] = False
                elif len(seen) < 1 << 20:
                    seen.add(name)
            rows = np.repeat(take, sizes)
            return np.repeat(names, sizes)[rows], ids[rows]

        def batch_of(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

        none = np.zeros(0, dtype=np.int64)
        key, ids, wide = none, none, None
        for batch in batches:
            more, more_ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if wide is not None:  # a group too wide to hold back goes on under its key
                n = int(np.searchsorted(more, wide, side="right"))
                if n:
                    yield batch_of(np.full(n, wide), more_ids[:n])
                more, more_ids = more[n:], more_ids[n:]
                wide = None if len(more) else wide
            key, ids = np.concatenate([key, more]), np.concatenate([ids, more_ids])
            if not len(key):
                continue
            at = int(np.searchsorted(key, key[-1]))
            if at:
                yield batch_of(*of(key[:at], ids[:at]))
            key, ids = key[at:], ids[at:]
            if len(key) >= 1 << 14:
                wide = int(key[0])
                yield batch_of(key, ids)
                key, ids = none, none
        if len(key):
            yield batch_of(*of(key, ids))

    return keyed.repartition("key").sortWithinPartitions("key", "id").mapInArrow(emit, "grp long, member long")


def joining_pairs(ids, components, n, sketches, sides, bands: Bands, width: int | None, carried=None, own: int = 0):
    """Pairs (a, b) of near members, one on each side, that would join components.

    At most ``width`` pairs for a forest's edge, the nearest ones; None: every near pair of different components.
    ``sides``: true for the left side; a member may be on one side only unless all are on both (``sides`` None).
    ``carried``: for each member some of its groups, ascending, filled up with the largest number; of pairs that carry a
    common one, only those whose least one is ``own`` count.
    """
    import numpy as np

    order = np.argsort(ids, kind="stable")
    ids, components, n = ids[order], components[order], n[order]
    carried = None if carried is None else carried[order]
    words = min(len(s) for s in sketches) // 8
    folds = np.concatenate([fold_to(np.frombuffer(sketches[i], np.uint64).reshape(1, -1), words) for i in order.tolist()])
    left = np.arange(len(ids)) if sides is None else np.flatnonzero(sides[order])
    right = np.arange(len(ids)) if sides is None else np.flatnonzero(~sides[order])
    rows, columns, far = [], [], []
    for k, i in enumerate(left.tolist()):
        to = right[k + 1 :] if sides is None else right
        to = to[components[to] != components[i]]
        if not len(to):
            continue
        d = np.bitwise_count(folds[to] ^ folds[i]).sum(axis=1, dtype=np.int64)
        ok = near(d, n[i], n[to], bands)
        if carried is not None and ok.any():
            at = np.flatnonzero(ok)
            common = np.isin(carried[to[at]], carried[i]) & (carried[to[at]] < NO_KEY)
            least = carried[to[at], common.argmax(axis=1)]
            ok[at] = ~common.any(axis=1) | (least == own)
        rows.append(np.full(int(ok.sum()), i))
        columns.append(to[ok])
        far.append((d[ok] << 20) // np.maximum(1, np.minimum(n[i], n[to[ok]])))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, columns, far = map(np.concatenate, (rows, columns, far))
    if width is not None:
        nearest = np.argsort(far, kind="stable")
        rows, columns = rows[nearest], columns[nearest]
        label = {c: c for c in np.unique(components).tolist()}
        taken, keep = {}, np.zeros(len(rows), dtype=bool)
        own, other = components[rows].tolist(), components[columns].tolist()

        def root(c):
            while label[c] != c:
                label[c] = c = label[label[c]]
            return c

        open_labels = len(label)
        for e, (a, b) in enumerate(zip(own, other, strict=True)):
            if open_labels == 1 and width == 1:
                break
            between = (a, b) if a < b else (b, a)
            if taken.get(between, 0) and taken[between] < width:
                taken[between] += 1
                keep[e] = True
            elif (x := root(a)) != (y := root(b)):
                label[max(x, y)] = min(x, y)
                open_labels -= 1
                taken[between] = 1
                keep[e] = True
        rows, columns = rows[keep], columns[keep]
    a, b = ids[rows], ids[columns]
    return np.minimum(a, b), np.maximum(a, b)


def _pairs_of_blocks(members: DataFrame, bands: Bands, width: int | None) -> DataFrame:
    """Pairs (a, b) of a group's members in different components whose sketches are near.

    members: grp, id, component, n, sketch, carried. Members are dealt out in blocks; a row holds
    two blocks of a group, at most about 2 * BLOCK members or 2 * BLOCK_BYTES of sketches, and is compared in a task.
    """
    import pyarrow as pa

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x, y = row["x"] or [], row["y"] or []
                both = [*x, *y]
                take = lambda name: np.array([p[name] for p in both], dtype=np.int64)  # noqa: E731, B023
                sides = None if row["i"] == row["j"] else np.arange(len(both)) < len(x)
                carried = np.array([[*p["carried"], *[NO_KEY] * (CARRIED - len(p["carried"]))] for p in both], dtype=np.int64)
                a, b = joining_pairs(take("id"), take("component"), take("n"), [p["sketch"] for p in both], sides, bands, width, carried, row["grp"])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    member = F.struct("id", "component", "n", "sketch", "carried")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("sketch")) / BLOCK_BYTES)).cast("int")
    sized = members.join(members.groupBy("grp").agg(blocks.alias("blocks")), "grp")
    placed = sized.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Block k meets every block: the lower number is the row's i.
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    rows = met.select("grp", i.alias("i"), j.alias("j"), (F.col("own") == i).alias("first"), member.alias("m"))
    pairs = rows.groupBy("grp", "i", "j").agg(F.collect_list(F.when(F.col("first"), F.col("m"))).alias("x"), F.collect_list(F.when(~F.col("first"), F.col("m"))).alias("y"))
    return pairs.select("grp", "i", "j", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked; texts: id, text."""

    def verify(batches):
        import pyarrow as pa

        from samewise.llm.shingles import Shingler, slices

        of, last, own = Shingler(size).of_batch, None, None
        for batch in batches:
            for part in slices(batch, "y"):
                a, x, keep = part.column("a").to_pylist(), part.column("x"), []
                for k, y in enumerate(of(part.column("y"))):
                    if a[k] != last:
                        last, own = a[k], of(x.slice(k, 1))[0]
                    keep.append(linked(own, y, percent))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    both = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _near_pairs(pairs: DataFrame, info: DataFrame, bands: Bands) -> DataFrame:
    """The pairs whose sizes and sketches allow a link."""

    @F.pandas_udf("boolean")
    def allowed(x, y, nx, ny):
        import pandas as pd

        return pd.Series(near(distances(x.tolist(), y.tolist()), nx.to_numpy(), ny.to_numpy(), bands))

    fits = F.greatest("na", "nb") * bands.percent <= F.least("na", "nb") * 100
    of = lambda side: info.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(fits).filter(allowed("sa", "sb", "na", "nb")).select("a", "b")


def _joined(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Saved tables: sketches of every row, members (doc_id, id of its class), links (a, b) found and components of classes."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return _steps(docs, size, percent)


def _steps(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    spark, bands, texts, scratch = docs.sparkSession, Bands(percent), id_and_text(docs), []
    sketched = saved(_sketched(texts, size), "sketches")
    some = sketched.filter("n > 0 and doc_id is not null")
    # Nodes are classes of equal sets, named by their smallest id.
    info = saved(some.groupBy("digest", "n").agg(F.min("doc_id").alias("id"), F.first("sketch", ignorenulls=True).alias("sketch")), "classes", scratch)
    member = saved(some.select("doc_id", "digest", "n").join(info.select("digest", "n", "id"), ["digest", "n"]).select("doc_id", "id"), "members")
    shared = saved(_groups(_keyed(texts.filter("doc_id is not null").withColumnRenamed("doc_id", "id"), size, bands)), "groups", scratch)
    ids = shared.join(member.withColumnRenamed("doc_id", "any"), F.col("member") == F.col("any")).select("grp", "id").distinct()
    # Members of groups of two or more but the smallest, a.
    lead = ids.groupBy("grp").agg(F.min("id").alias("a"))
    members = saved(ids.join(lead, "grp").filter("id <> a"), "groups", scratch)
    tested = saved(_near_pairs(members.select("a", F.col("id").alias("b")).distinct(), info, bands), "pairs", scratch)
    needed = members.select("id").unionByName(members.select(F.col("a").alias("id"))).distinct()
    nodes = saved(texts.withColumnRenamed("doc_id", "id").join(needed, "id", "left_semi"), "texts", scratch)
    links = saved(_verified(tested, nodes, size, percent), "links")
    found = saved(connected_components(links), "components")
    # Keys whose other members are not yet in one component. Pairs with the smallest member are done.
    for width in WIDTHS:
        placed = members.join(found, "id", "left").select("grp", "id", F.coalesce("component", "id").alias("component"))
        open_groups = placed.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("grp")
        rest = saved(placed.join(open_groups, "grp", "left_semi"), "open", scratch)
        carried = rest.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("grp")), 1, CARRIED).alias("carried"))
        with arrow_rows(spark, BLOCK_ROWS):
            nearest = saved(_pairs_of_blocks(rest.join(info.select("id", "n", "sketch").join(carried, "id"), "id"), bands, width), "pairs", scratch)
        more = saved(nearest.join(tested, ["a", "b"], "left_anti"), "pairs", scratch)
        if more.isEmpty():
            if nearest.isEmpty():  # no near pair of different components is left
                break
            continue
        new = saved(_verified(more, nodes, size, percent), "links")
        tested = tested.unionByName(more)
        if not new.isEmpty():
            links = links.unionByName(new)
            found = saved(merged_components(found, new), "components")
    remove(spark, scratch)
    return sketched, member, links, found


def links_between_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(a, b): the links found, between representatives of equal sets; and (doc_id, id): the representative of each document.

    The links join every component; pairs within one that is already joined are not all compared.
    """
    _, member, links, _ = _joined(docs, size, percent)
    return links, member


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    sketched, member, _, found = _joined(docs, size, percent)
    node_of = member.join(found, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id")).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sketched.select("doc_id", F.col("n").alias("n_shingles")).join(node_of, "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those linked, over any steps, to a smaller id."""
    gone = similar_documents(docs, size, percent).filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
