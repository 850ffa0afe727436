"""Personal data: fixed patterns, then identifiers found by bootstrapped contexts.

Spans of the fixed patterns are seeds with score 1. Words that hold a digit or an @, and runs of
neighbouring words with digits, are instances; those assigned to a name such as ``token`` and long words of mixed letters and digits are
seeds too, with score ``LIKELY``, but only patterns claim them. The words next to an instance and its shape make patterns: (left words, shape), (shape, right
word) and (left words, right word). What a fixed pattern matched and dropped has the last one only, so its shape never speaks for it. Patterns and instances form a bipartite graph.
Spark scores it iteratively: a pattern's confidence is the mean score of its
instances, damped for few of them; an instance's score is the noisy-or of its patterns'
confidences, and at least its score as a seed; instances found in a round support patterns in the next. Then the patterns of high confidence claim
the instances that no fixed pattern knows, as kind ``id``; of nested ones the outermost counts.

Only distinct (pattern, instance) pairs enter the graph and patterns are summed by partial aggregation,
so a frequent word makes many edges but no gathered group. Offsets
count code points; ends are exclusive. Null texts are empty. Null and repeated ids are kept: spans
belong to a row. Equal scores need no order. Very long texts are read in one pass. An empty table gives an empty result. Further columns pass through ``redact`` untouched.
"""

from __future__ import annotations

import bisect
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samewise.llm.common import id_and_text, saved

#: Kinds in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone", "id")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs that start where digits start: no scan is repeated over a long run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Words with a digit or an @; possessive from the word's start on, so each word is read once.
_WORD = re.compile(r"(?<![^\s\"'=:,;()<>\[\]{}])[^\s\"'=:,;()<>\[\]{}\d@]*+[\d@][^\s\"'=:,;()<>\[\]{}]*+")
_ANY_WORD, _LETTER = re.compile(r"\S+"), re.compile(r"\w")
_GAP = re.compile(r"[^\S\n]?[()\[\]]?[^\S\n]?")
#: Every run of at most LONGEST_RUN neighbouring words is an instance, and every whole run.
LONGEST_RUN = 6
#: Names whose assigned values are seeds, their score, the least length of such a value and of a mixed word.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "access-key", "auth_key", "ssn")
LIKELY, LEAST_VALUE, LEAST_MIXED = 0.9, 6, 20
_ASSIGNED = re.compile(r"(?:^|[^a-z])(?:" + "|".join(NAMES) + r")[\"']? ?[=:] ?[\"']?$")
#: Words before an instance that a pattern goes back over signs for; runs of one kind in a shape that is written out.
BACK, RUNS = 3, 6
#: Patterns need this many different seeds or instances of this score, and this confidence.
LEAST_KNOWN, CONFIDENT, ROUNDS, DAMPING = 5, 0.6, 3, 2.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str):
    """The pattern's leftmost matches, found from each @ outwards, so long runs cost one pass."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_matches(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """(start, end, kind) by start, then kind in the order of KINDS; and the matches that fail their test, by start."""
    spans, dropped = [(a, b, "email") for a, b in emails(text)] if "@" in text else [], []

    def add(m, kind, holds):
        if holds:
            spans.append((*m.span(), kind))
        else:
            dropped.append(m.span())

    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            add(m, "ip", all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if len(digits) >= 14:
                add(m, "card", len(digits) <= 19 and luhn(digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                add(m, "phone", 10 <= len(_DIGIT.findall(m.group())) <= 15)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))), sorted(dropped)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    return base_matches(text)[0]


def shape_of(word: str) -> str:
    """Runs of lower-case letters, upper-case letters and digits as a, A and 0; other signs as they are.

    With more than RUNS such runs only their kinds, other signs and the length's order are told.
    """
    shape = re.sub(r"[0-9]+", "0", re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", word.replace("0", "1"))))
    if sum(map(shape.count, "aA0")) <= RUNS and len(shape) <= 4 * RUNS:
        return shape
    return f"~{''.join(sorted(set(shape)))}{len(word).bit_length()}"


def is_mixed(word: str) -> bool:
    """A long word of ASCII letters and digits that change often, as in keys and hashes."""
    return len(word) >= LEAST_MIXED and word.isascii() and word.isalnum() and shape_of(word).startswith("~") and not word.isdigit()


def _opened(text: str, a: int, b: int) -> int:
    """``a``, or the place of the bracket before it if that is closed within the run."""
    close = {"(": ")", "[": "]"}.get(text[a - 1 : a])
    return a - 1 if close and close in text[a:b] else a


def instances(text: str, spans: list[tuple[int, int, str]], dropped: list[tuple[int, int]] = ()) -> list[tuple[int, int, bool, float, list[str]]]:
    """(start, end, is a span, score as a seed, patterns) of each identifier-like word or run and each span."""
    covered = _merged((a, b) for a, b, _ in spans)
    places, runs, next_span = {(a, b): True for a, b, _ in spans}, [], 0
    for m in _WORD.finditer(text):
        a = m.start()
        word = m.group().rstrip(".!?&*$%#|")
        b = a + len(word)
        while next_span < len(covered) and covered[next_span][1] <= a:
            next_span += 1
        if not any(map(str.isalnum, word)) or next_span < len(covered) and covered[next_span][0] < b:
            continue
        if runs and a - runs[-1][-1][1] <= 3 and a > runs[-1][-1][1] and _GAP.fullmatch(text, runs[-1][-1][1], a):
            runs[-1].append((a, b))
        else:
            runs.append([(a, b)])
    for run in runs:
        for i, (a, _) in enumerate(run):
            places.update(((_opened(text, a, b), b), False) for _, b in run[i : i + LONGEST_RUN])
        places[_opened(text, run[0][0], run[-1][1]), run[-1][1]] = False
    if not places:
        return []
    words = [m.span() for m in _ANY_WORD.finditer(text)]
    starts, refused = [a for a, _ in words], _merged(dropped)
    refused_ends, found = [b for _, b in refused], []
    for (a, b), known in sorted(places.items()):
        k = bisect.bisect_left(starts, a) - 1  # the last word that begins before a
        left = []
        while k >= 0 and len(left) < BACK and not any(_LETTER.search(w) for w in left):
            left.append(text[words[k][0] : min(a, words[k][1])].lower())
            k -= 1
        k = bisect.bisect_right(starts, b) - 1  # the word that b is in, or else the next one
        if k < 0 or words[k][1] <= b:
            k += 1
        after = text[max(b, words[k][0]) : words[k][1]].lower() if k < len(words) else "$"
        before, word = " ".join(reversed(left)) or "^", text[a:b]
        k = bisect.bisect_right(refused_ends, a)
        if not known and k < len(refused) and refused[k][0] < b:
            found.append((a, b, False, 0.0, [f"B {before} {after}"]))
            continue
        likely = not known and (is_mixed(word) or b - a >= LEAST_VALUE and _ASSIGNED.search(before[-40:]) is not None)
        shape = shape_of(word)
        found.append((a, b, known, 1.0 if known else LIKELY if likely else 0.0, [f"L {before} {shape}", f"R {shape} {after}", f"B {before} {after}"]))
    return found


def _merged(ranges) -> list[list[int]]:
    """Ranges in ascending order with overlapping ones as one."""
    out: list[list[int]] = []
    for a, b in ranges:
        if out and a < out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _pattern_hash(pattern: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(pattern) >> 1


def find_personal_data(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with _uid, _base (spans of the fixed patterns) and _seen (instances and their patterns), saved."""
    import pyarrow as pa

    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    one = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("score", pa.float64()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    added = "_uid long, _base array<struct<start:int,end:int,kind:string>>, _seen array<struct<start:int,end:int,seed:boolean,score:double,instance:bigint,patterns:array<bigint>>>"

    def find(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from samewise.llm.shingles import slices

        uid = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in slices(whole, "_text"):
                base, seen = [], []
                for text in batch.column("_text").to_pylist():
                    spans, dropped = base_matches(text)
                    base.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in spans])
                    seen.append([{"start": a, "end": b, "seed": seed, "score": score, "instance": _pattern_hash(text[a:b]), "patterns": [_pattern_hash(p) for p in patterns]} for a, b, seed, score, patterns in instances(text, spans, dropped)])
                row = np.arange(uid, uid + batch.num_rows)
                uid += batch.num_rows
                names = [n for n in batch.schema.names if n != "_text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(row), pa.array(base, pa.list_(span)), pa.array(seen, pa.list_(one))], names=[*names, "_uid", "_base", "_seen"])

    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(added).fields])
    return saved(rows.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(find, schema), "personal")


def pattern_edges(found: DataFrame) -> DataFrame:
    """Distinct (pattern, instance) of the whole table, with the instance's greatest score as a seed there."""
    seen = found.select(F.explode("_seen").alias("s")).select("s.instance", "s.score", F.explode("s.patterns").alias("pattern"))
    return seen.groupBy("pattern", "instance").agg(F.max("score").alias("seed"))


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, confidence for the patterns trusted after ``rounds`` rounds."""
    edges = saved(edges, "edges")
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("score"))
    scores = seeds
    for _ in range(rounds):
        scored = edges.join(scores, "instance")
        patterns = scored.groupBy("pattern").agg((F.sum("score") / (F.count("*") + F.lit(DAMPING))).alias("confidence"), F.count_if(F.col("score") >= CONFIDENT).alias("known"))
        patterns = saved(patterns.filter(F.col("known") >= LEAST_KNOWN), "patterns")
        claims = edges.join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))))).alias("claim"))
        scores = saved(seeds.join(claims, "instance", "left").select("instance", F.greatest("score", F.coalesce("claim", F.lit(0.0))).alias("score")), "scores")
    return patterns.filter(F.col("confidence") >= CONFIDENT).select("pattern", "confidence")


def claimed_spans(found: DataFrame) -> DataFrame:
    """_uid, start, end of the instances that no fixed pattern knows and confident patterns claim, outermost ones only."""
    trusted = confident_patterns(pattern_edges(found))
    unknown = found.select("_uid", F.explode("_seen").alias("s")).filter("not s.seed").select("_uid", "s.start", "s.end", F.explode("s.patterns").alias("pattern"))
    claims = unknown.join(trusted.select("pattern"), "pattern").select("_uid", "start", "end").distinct()
    before = Window.partitionBy("_uid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return claims.withColumn("_reach", F.max("end").over(before)).filter("_reach is null or end > _reach").drop("_reach")


def _with_claims(found: DataFrame) -> DataFrame:
    """``found`` with _spans: base and claimed spans by start, then kind as in KINDS."""
    claims = claimed_spans(found).groupBy("_uid").agg(F.collect_list(F.struct("start", "end", F.lit("id").alias("kind"))).alias("_more"))
    doubtful = F.exists("_seen", lambda s: ~s["seed"])
    joined = found.filter(doubtful).join(claims, "_uid", "left").select(*found.columns, F.concat("_base", F.coalesce("_more", F.array().cast("array<struct<start:int,end:int,kind:string>>"))).alias("_spans"))
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    tidy = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.filter(~doubtful).withColumn("_spans", F.col("_base")).unionByName(joined.withColumn("_spans", tidy))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of fixed patterns) and spans (all), arrays of start, end, kind."""
    found = find_personal_data(id_and_text(docs).withColumnRenamed("text", "_t"), "_t").drop("_t")
    return _with_claims(found).select("doc_id", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def masked(text: str, spans) -> str:
    """``text`` with each span replaced by its kind; overlapping spans become one, named by the first."""
    out, done = [], 0
    for s in spans:
        if s["start"] >= done:
            out += [text[done : s["start"]], f"<{s['kind']}>"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with personal data replaced in ``text``; ``n_chars``, where there is one, follows the text."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    found = _with_claims(find_personal_data(row, "_row.text"))

    @F.pandas_udf("string")
    def mask(texts, spans):
        import pandas as pd

        return pd.Series([t if t is None or not len(s) else masked(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    touched = F.size("_spans") > 0
    clean = found.filter(~touched).select("_row.*")
    changed = found.filter(touched).withColumn("_new", mask(F.col("_row.text"), F.col("_spans")))
    columns = [F.col("_new").alias(c) if c == "text" else F.length("_new").cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return clean.unionByName(changed.select(*columns))
