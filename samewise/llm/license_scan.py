"""License notices in texts: exact phrases by words, and short notices with a few edits.

A notice that may have e edits is split into e + 1 seeds; by the pigeonhole
principle one seed is in the text unchanged. An Aho-Corasick automaton finds the
seeds, and the regex library's bounded-error matching verifies the notice in the
stretch around each and reports its span and edits (in characters). Of finds that overlap, the one with
the fewest edits stays; of those the longest notice, then the first in the list.

Text is lower-cased (A-Z) and its words, runs of ASCII letters and digits and
of all other characters beyond ASCII, are joined by single spaces; spans are in
words. Null texts are empty, with no words and no finds. Repeated rows, null ids
and an empty table give corresponding rows; other columns are not read.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame

from samewise.llm.common import id_and_text

#: Phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license version 3": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "all rights reserved": "proprietary",
}
#: Bytes that are not part of a word, after lower-casing.
_SPACES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SPAN = "label string, notice string, edits int, first_word long, last_word long"


def edits_of(notice: str) -> int:
    """Edits a notice may have: one in twelve characters."""
    return max(1, len(notice) // 12)


def seeds_of(notice: str) -> list[tuple[int, str]]:
    """edits + 1 parts of the notice, each with its place."""
    k = edits_of(notice) + 1
    cuts = [len(notice) * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, notices: dict[str, str], phrases: dict[str, str]):
        import ahocorasick
        import regex

        self.phrases = {f" {p} ".encode(): label for p, label in phrases.items()}
        self.notices, by_seed = list(notices.items()), {}
        for i, (notice, _) in enumerate(self.notices):
            for at, seed in seeds_of(notice):
                by_seed.setdefault(seed, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for seed, places in by_seed.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()
        # Whole words only, so that a notice does not begin or end within one.
        self.patterns = [regex.compile(rf"(?b)(?<= )(?:{regex.escape(n)}){{e<={edits_of(n)}}}(?= )") for n, _ in self.notices]

    def words(self, text: str) -> bytes:
        """The words, each with a space on both sides."""
        return b" " + b" ".join(text.encode().lower().translate(_SPACES).split()) + b" "

    def exact(self, line: bytes) -> list[tuple[int, int, str]]:
        """(first word, words, label) of each place of a phrase."""
        found = []
        for phrase, label in self.phrases.items():
            at, word, counted = line.find(phrase), 0, 0
            while at >= 0:  # words are counted on from the last place, so many places cost one pass
                word, counted = word + line.count(b" ", counted, at), at
                found.append((word, phrase.count(b" ") - 1, label))
                at = line.find(phrase, at + 1)
        return found

    def fuzzy(self, line: bytes) -> list[tuple[str, str, int, int, int]]:
        """(label, notice, edits, first word, last word), the best at each place: finds do not overlap."""
        text, near = line.decode(), {}
        for end, (size, places) in self.seeds.iter(text):
            for i, at in places:
                near.setdefault(i, set()).add(end + 1 - size - at)
        found = []
        for i, starts in near.items():
            notice, label = self.notices[i]
            e, done, word, counted = edits_of(notice), -1, 0, 0
            for start in sorted(starts):
                if start < done:
                    continue
                a, b = max(0, start - e - 1), start + len(notice) + e + 1
                if m := self.patterns[i].search(text, a, min(len(text), b)):
                    # A later window may reach back before the last match.
                    word += text.count(" ", counted, m.start()) if m.start() >= counted else -text.count(" ", m.start(), counted)
                    counted, done = m.start(), m.end()
                    found.append((label, notice, sum(m.fuzzy_counts), word - 1, word - 1 + m.group().count(" ")))
        rank = {n: i for i, (n, _) in enumerate(self.notices)}
        kept: list[tuple[str, str, int, int, int]] = []
        starts: list[int] = []
        for x in sorted(found, key=lambda x: (x[2], -len(x[1]), rank[x[1]], x[3])):
            k = bisect.bisect_right(starts, x[4])  # the last kept find that begins no later than this one ends
            if not k or kept[k - 1][4] < x[3]:
                k = bisect.bisect_left(starts, x[3])
                starts.insert(k, x[3])
                kept.insert(k, x)
        return kept


_loaded: dict[tuple, Scanner] = {}


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``score`` is 1 with an exact phrase, else the best notice's share of unedited
    characters, else 0. ``spans`` lists the notices found.
    """
    notices, phrases = notices or NOTICES, phrases or PHRASES
    import pyarrow as pa

    span = pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def scan(batches):
        key = (*notices.items(), *phrases.items())
        scanner = _loaded.setdefault(key, None) or Scanner(notices, phrases)
        _loaded[key] = scanner
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                line = scanner.words(text)
                exact, fuzzy = scanner.exact(line), scanner.fuzzy(line)
                starts = [f for f, _, _ in exact]
                base = {label for _, _, label in exact}
                best = max((1 - e / len(n) for _, n, e, _, _ in fuzzy), default=0.0)
                rows.append((doc_id, max(0, line.count(b" ") - 1) if len(line) > 2 else 0, len(exact), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {f[0] for f in fuzzy})), 1.0 if base else best, [dict(zip(("label", "notice", "edits", "first_word", "last_word"), f, strict=True)) for f in fuzzy]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return id_and_text(docs).mapInArrow(scan, f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")
