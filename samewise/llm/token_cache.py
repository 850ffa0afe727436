"""Whole-text encoding with the tokenizers library, remembering what it has encoded.

For the two kinds of tokenizers known here, some places in a text always end a pre-token,
and merges never cross a pre-token's border: before a space between two characters
that are not white space; between an ASCII letter and a sign after it; on either side of a
line feed between two visible ASCII characters. A text is cut there into segments, and the library need encode
each different segment only once. Segments of a batch are found and looked up as arrays, in a hash table
whose keys are the segments' bytes themselves, so no answer rests on a hash. Texts with other uses of spaces, texts that
hold the string of a special token, and all texts of other kinds of tokenizers are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array

_ODD_SPACES = re.compile(r" \s|\s ")
#: White space beyond ASCII, which may stand next to a space.
_RARE_SPACES = [c for c in map(chr, range(128, 0x3001)) if c.isspace()]
_BATCH, _JOINED = 4096, 128
#: A word that parts others when many are encoded as one text.
_BETWEEN = "~"
#: Signs that never share a pre-token with an ASCII letter before them.
_TAIL = b".,!?;:#*$%&"
#: Bytes of a key; its last byte holds the segment's length. Longer segments are kept in a dictionary.
_KEY = 23
#: The pre-tokenizers known to end a pre-token at a space, and the steps before the second.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ("NFC", "Replace", "Lowercase")
_loaded: dict[str, ChunkEncoder] = {}


def kind_of(spec: dict) -> str | None:
    """``bytes`` or ``words`` for a tokenizer file whose texts may be cut into segments, else None."""
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])) or spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
        return None
    steps, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if normal is None and BYTE_LEVEL.items() <= steps.items():
        return "bytes"
    first, *rest = steps.get("pretokenizers") or [{}]
    split = first.get("type") == "Split" and first["pattern"] == {"Regex": WORD_PATTERN} and first["behavior"] == "Removed" and first["invert"]
    plain = [s["type"] == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"] for s in rest]
    known = normal and [n["type"] for n in normal.get("normalizers", [])] == [*WORD_NORMALIZERS] and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
    return "words" if split and plain == [True] and known and spec["model"]["end_of_word_suffix"] == "</w>" else None


class SegmentTable:
    """Open addressing from segments of at most _KEY bytes, as three 64-bit words, to numbers of entries."""

    def __init__(self, slots: int):
        import numpy as np

        self.bits = max(4, (slots - 1).bit_length())
        self.keys, self.value = [np.zeros(1 << self.bits, dtype=np.uint64) for _ in range(3)], np.full(1 << self.bits, -1, dtype=np.int32)

    def _slots(self, key):
        import numpy as np

        h = key[0] * np.uint64(0x9E3779B97F4A7C15) + (key[1] ^ (key[1] >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) + key[2] * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(32))) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key):
        """The entry of each key, or -1."""
        import numpy as np

        slot, out = self._slots(key), np.full(len(key[0]), -1, dtype=np.int64)
        left = np.arange(len(slot))
        while len(left):
            at = slot[left]
            value = self.value[at]
            same = (self.keys[0][at] == key[0][left]) & (self.keys[1][at] == key[1][left]) & (self.keys[2][at] == key[2][left]) & (value >= 0)
            out[left[same]] = value[same]
            left = left[~same & (value >= 0)]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, key, values) -> None:
        """Keys that are not in the table and differ from each other; it grows so that half of it stays free."""
        import numpy as np

        taken = np.flatnonzero(self.value >= 0)
        if 2 * (len(taken) + len(values)) > 1 << self.bits:
            key, values = [np.concatenate([a[taken], b]) for a, b in zip(self.keys, key, strict=True)], np.concatenate([self.value[taken], values])
            self.__init__(4 * len(values))
        slot, left = self._slots(key), np.arange(len(key[0]))
        while len(left):
            at = slot[left]
            free = np.flatnonzero(self.value[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = left[free[first]]
            for own, new in zip(self.keys, key, strict=True):
                own[slot[won]] = new[won]
            self.value[slot[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)


class ChunkEncoder:
    """Texts to ids as little-endian unsigned 32-bit numbers; ``limit`` bounds the segments remembered."""

    def __init__(self, path: str, limit: int = 1 << 20):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind, self.limit = kind_of(spec), limit
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        # Classes of bytes: 1 ASCII letter, 2 sign of _TAIL, 4 visible ASCII, 8 white space.
        self.classes = np.zeros(256, dtype=np.uint8)
        for c in range(128):
            self.classes[c] = chr(c).isalpha() + 2 * (c in _TAIL) + 4 * (0x21 <= c <= 0x7E) + 8 * chr(c).isspace()
        if self.kind:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            # Ids that begin a segment (bytes), or end a pre-token (words).
            self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.edge[[i for t, i in vocabulary.items() if (t.startswith("Ġ") if self.kind == "bytes" else t.endswith("</w>"))]] = True
            self.between = np.frombuffer(next(self._encode([f" {_BETWEEN}"])), "<u4")
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.table, self.wide = SegmentTable(2 * self.limit), {}
        self.n, self.used = 0, 0
        self.offset, self.length, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    def _encode(self, texts: list[str]):
        for i in range(0, len(texts), _BATCH):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + _BATCH], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _segments(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment; many that begin with a space are one text, parted where ids tell that one begins or ends."""
        found: dict[str, bytes] = {}
        spaced = [s for s in segments if s[0] == " " and len(s) > 1]
        if self.kind == "bytes":
            self._joined(spaced, "", found)
        else:
            self._joined([s for s in spaced if s.isascii() and s[1:].isalpha()], "", found)
            self._joined([s for s in spaced if s not in found], f" {_BETWEEN}", found)
        rest = [s for s in segments if s not in found]
        found.update(zip(rest, self._encode(rest), strict=True))
        return [found[s] for s in segments]

    def _joined(self, words: list[str], by: str, found: dict[str, bytes]) -> None:
        import numpy as np

        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        for group, ids in zip(groups, self._encode([by.join(g) for g in groups]), strict=True):
            numbers = np.frombuffer(ids, "<u4")
            if by:
                stops = np.append(np.flatnonzero(numbers == self.between[0]), len(numbers))
                starts = np.append(0, stops[:-1] + 1)
            elif self.kind == "bytes":
                starts = np.flatnonzero(self.edge[numbers])
                stops = np.append(starts[1:], len(numbers))
            else:
                stops = np.flatnonzero(self.edge[numbers]) + 1
                starts = np.append(0, stops[:-1])
            if len(starts) == len(group) and len(self.between) == 1:
                found.update(zip(group, [ids[a:b] for a, b in zip((4 * starts).tolist(), (4 * stops).tolist(), strict=True)], strict=True))
            else:  # a word holds the mark itself
                found.update(zip(group, self._encode(group), strict=True))

    def _remember(self, segments: list[bytes]):
        """Numbers of new entries for segments."""
        import numpy as np

        coded = self._segments([s.decode() for s in segments])
        lengths, ids = np.fromiter(map(len, coded), np.int64, len(coded)) // 4, np.frombuffer(b"".join(coded), "<u4")
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(coded) > len(self.offset):
            self.offset, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.offset, self.length))
        numbers = np.arange(self.n, self.n + len(coded))
        self.ids[self.used : self.used + len(ids)] = ids
        self.offset[numbers], self.length[numbers] = self.used + np.cumsum(lengths) - lengths, lengths
        self.n, self.used = self.n + len(coded), self.used + len(ids)
        return numbers

    def _entries(self, data, starts, ends):
        """The entry of each segment data[start:end]; data has _KEY + 1 bytes more."""
        import numpy as np

        words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
        size = ends - starts
        key = []
        for i in range(3):
            have = np.clip(size - 8 * i, 0, 8 if i < 2 else 7)
            mask = np.where(have == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * (have % 8)).astype(np.uint64)) - np.uint64(1))
            key.append(words[starts + 8 * i] & mask)
        key[2] |= np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
        entry = np.full(len(starts), -1, dtype=np.int64)
        narrow = np.flatnonzero(size <= _KEY)
        entry[narrow] = self.table.find([k[narrow] for k in key])
        new = narrow[entry[narrow] < 0]
        if len(new):
            own = [k[new] for k in key]
            order = np.lexsort(own)
            differs = np.concatenate([[True], np.any([k[order][1:] != k[order][:-1] for k in own], axis=0)])
            first = new[order[differs]]
            numbers = self._remember([data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            self.table.add([k[first] for k in key], numbers)
            entry[new[order]] = numbers[np.cumsum(differs) - 1]
        wide = np.flatnonzero(size > _KEY)
        if len(wide):
            texts = [data[a:b].tobytes() for a, b in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True)]
            if unseen := list(dict.fromkeys(t for t in texts if t not in self.wide)):
                self.wide.update(zip(unseen, self._remember(unseen).tolist(), strict=True))
            entry[wide] = [self.wide[t] for t in texts]
        return entry

    def encode_arrow(self, texts) -> list:
        """An array of ids for each text of an Arrow string array without nulls."""
        import numpy as np
        import pyarrow as pa

        if not self.kind:
            return [np.frombuffer(x, "<u4") for x in self._encode(texts.to_pylist())]
        if self.n > self.limit or self.used > 16 * self.limit or len(self.wide) > self.limit >> 4:
            self.forget()
        texts = texts.cast(pa.string())
        if not len(texts):
            return []
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        low, ends = int(ends[0]), ends - ends[0]
        starts, stops, n = ends[:-1], ends[1:], int(ends[-1])
        data = np.zeros(n + _KEY + 9, dtype=np.uint8)
        if n:
            data[:n] = np.frombuffer(texts.buffers()[2], np.uint8)[low : low + n]
        kind = self.classes[data]
        filled = starts < stops
        first = np.zeros(n + 1, dtype=bool)
        first[starts] = True
        space = data[:n] == 0x20
        # Spaces at an end of a text or next to other ASCII white space.
        lone = np.zeros(n, dtype=bool)
        if n:
            at = np.flatnonzero(space)
            lone[at] = first[at] | first[at + 1] | (kind[at - 1] & 8 > 0) | (kind[at + 1] & 8 > 0)
        odd = np.zeros(len(texts), dtype=bool)
        odd[np.searchsorted(stops, np.flatnonzero(lone), side="right")] = True
        raw = data[:n].tobytes()
        if any(c.encode() in raw for c in _RARE_SPACES) or any(s.encode() in raw for s in self.specials):
            for i, t in enumerate(texts.to_pylist()):
                odd[i] |= any(s in t for s in self.specials) or _ODD_SPACES.search(t) is not None
        none = np.zeros(2, dtype=np.uint8)
        before, before2, kind = np.concatenate([none[:1], kind])[:n], np.concatenate([none, kind])[:n], kind[:n]
        feed, fed = data[:n] == 0x0A, np.concatenate([none[:1], data])[:n] == 0x0A
        cut = space | ((kind & 2 > 0) & (before & 1 > 0)) | (feed & (before & 4 > 0)) | (fed & (before2 & 4 > 0) & (kind & 4 > 0))
        cut |= first[:n]
        # A line feed is parted from what follows only if what precedes it is in the same text.
        two = np.flatnonzero(first[:n]) + 1
        two = two[two < n]
        cut[two] &= ~fed[two] | space[two] | first[two]
        places = np.flatnonzero(cut)
        entries = self._entries(data, places, np.append(places[1:], n)) if n else np.zeros(0, np.int64)
        lengths = self.length[entries]
        ends = np.cumsum(lengths)
        flat = self.ids[np.repeat(self.offset[entries] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        ends = np.append(0, ends)
        a, b = ends[np.searchsorted(places, starts)], ends[np.searchsorted(places, stops)]
        out = [flat[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        whole = np.flatnonzero(odd & filled).tolist()
        for i, ids in zip(whole, self._encode([texts[i].as_py() for i in whole]), strict=True):
            out[i] = np.frombuffer(ids, "<u4")
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        import pyarrow as pa

        return [x.tobytes() for x in self.encode_arrow(pa.array(texts, pa.string()))]


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]
