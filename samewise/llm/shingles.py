"""Words of many texts as 64-bit hashes, and word shingles as sorted distinct hashes; whole batches as arrays."""

from __future__ import annotations

from collections.abc import Iterator

#: Words longer than this many bytes are hashed one by one.
_LONG = 256


def mix(x):
    """The 64-bit finaliser of splitmix64, on an array."""
    import numpy as np

    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch, column: str, rows: int = 512, size: int = 4 << 20) -> Iterator:
    """The batch in slices of at most ``rows`` rows and about ``size`` bytes of ``column``."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(at, upto - at)
        at = upto


def bytes_of(texts, padding: int = 32):
    """(bytes of all texts and ``padding`` zeros, where each begins and the end) of an Arrow string array without nulls."""
    import numpy as np
    import pyarrow as pa

    texts = texts.cast(pa.string())
    if not len(texts):
        return np.zeros(padding, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    low, ends = int(ends[0]), ends - ends[0]
    data = np.zeros(int(ends[-1]) + padding, dtype=np.uint8)
    if ends[-1]:
        data[: ends[-1]] = np.frombuffer(texts.buffers()[2], np.uint8)[low : low + int(ends[-1])]
    return data, ends


def hashed_words(texts):
    """(hash of each word, how many words each text has); A-Z lower-cased, words are runs without ASCII white space."""
    import numpy as np
    import xxhash

    data, ends = bytes_of(texts)
    n = int(ends[-1])
    lower, space = np.arange(256, dtype=np.uint8), np.zeros(256, dtype=bool)
    lower[0x41:0x5B] += 32
    space[[0x20, *range(0x09, 0x0E)]] = True
    data[:n] = lower[data[:n]]
    word = np.zeros(n + 1, dtype=bool)
    word[:n] = ~space[data[:n]]
    new_text = np.zeros(n + 1, dtype=bool)
    new_text[ends] = True
    after_word = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~after_word | new_text))
    stops = np.flatnonzero(after_word & (~word | new_text))
    size = stops - starts
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    left = np.flatnonzero(size <= _LONG)
    at = 0
    while len(left):
        have = np.minimum(size[left] - at, 8)
        mask = np.where(have == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * (have % 8)).astype(np.uint64)) - np.uint64(1))
        h[left] = mix(h[left] * np.uint64(0xD6E8FEB86659FD93) + (words[starts[left] + at] & mask))
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i]].tobytes())
    return h, np.diff(np.searchsorted(starts, ends))


class Shingler:
    """Shingles of ``size`` words; lower-cases A-Z; words are runs without ASCII white space.

    Fewer words make one shingle of the whole sequence; no words, no shingles.
    A shingle is its hash; at 64 bits two shingles of a pair of texts agree by
    chance about once in 10**13 such pairs.
    """

    def __init__(self, size: int):
        self.size = size

    def _chain(self, h, n: int, k: int):
        import numpy as np

        out = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        return out

    def of_batch(self, texts) -> list:
        """Sorted distinct shingles of each text of an Arrow string array without nulls."""
        import numpy as np

        h, counts = hashed_words(texts)
        grams = self._chain(h, max(0, len(h) - self.size + 1), self.size)
        out, at = [], 0
        for n in counts.tolist():
            if n >= self.size:
                x = np.sort(grams[at : at + n - self.size + 1])
                out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
            else:
                out.append(self._chain(h[at : at + n], 1 if n else 0, n))
            at += n
        return out

    def __call__(self, text: str):
        import pyarrow as pa

        return self.of_batch(pa.array([text], pa.string()))[0]
