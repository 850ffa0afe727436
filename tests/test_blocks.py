"""The block join in cells and the counts by classes, against plain loops and the pairs."""

import itertools

from samewise.operators import blocking, cells
from samewise.plans import registry
from samewise.sources import tables


def test_cells_hold_each_pair_once(spark, monkeypatch):
    """Blocks larger than a cell, ids with several rows and pairs that share both keys."""
    monkeypatch.setattr(blocking, "CELL", 3)
    rows = [(f"S{1 + i % 3}-{i}", f"name {i % 2}", f"street {i % 5}", "US") for i in range(60)]
    rows += [("S1-0", "name 1", "street 9", "US"), ("S2-1", "name 0", "", "US"), ("S1-99", "", "", "US")]
    r = spark.createDataFrame(rows, tables.RECORD)
    got = [tuple(x) for x in blocking.candidate_pairs(tables.of_source(r, 1), tables.of_source(r, 2, 3)).collect()]
    want = {(a[0], b[0]) for a, b in itertools.product(rows, rows) if a[0][1] == "1" != b[0][1] and (a[1] and a[1] == b[1] or a[2] and a[2] == b[2])}
    assert len(got) == len(set(got)) and set(got) == want
    plan = blocking.candidate_pairs(tables.of_source(r, 1), tables.of_source(r, 2, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "_a_slice" in plan and "_b_slice" in plan


def test_counts_by_classes_make_no_pairs_of_copies(spark, tmp_path):
    """Copies: all pair queries that only count agree with the pairs, and compare one pair of classes for each text."""
    text = "alpha beta gamma delta one two three four five six seven eight nine ten {} " + " ".join(f"w{i}" for i in range(30))
    docs = [(i, text.format(i % 2), "en") for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    d = registry._Data(spark, str(tmp_path))
    pairs = d.labelled.collect()
    assert len(pairs) == 30 * 60 and d.class_pairs.count() == 1
    rates = registry.QUERIES["error_rates"](spark, str(tmp_path)).first()
    wrong = sum(p.score >= 0.5 and not p.label for p in pairs), sum(p.score < 0.5 and p.label for p in pairs)
    assert (rates.pairs, rates.false_positives, rates.false_negatives) == (len(pairs), *wrong)


def test_single_keys_make_the_pairs_of_the_block_join(spark, monkeypatch):
    """One name and one address key a row, some empty, in cells; and only the blocks of some names."""
    monkeypatch.setattr(blocking, "CELL", 3)
    rows = [(f"S{1 + i % 3}-{i}", f"n{i % 4}" if i % 7 else "", f"a{i % 5}" if i % 6 else "") for i in range(80)]
    both = spark.createDataFrame(rows, "entity_id string, n string, a string")
    sides = [tables.of_source(both, 1), tables.of_source(both, 2, 3)]
    got = [tuple(x) for x in blocking.single_key_pairs(*sides).collect()]
    shares = lambda x, y, names: x[1] and x[1] == y[1] and x[1] in names or x[2] and x[2] == y[2] and (not x[1] or x[1] != y[1])
    want = lambda names: {(x[0], y[0]) for x, y in itertools.product(rows, rows) if x[0][1] == "1" != y[0][1] and shares(x, y, names)}
    assert len(got) == len(set(got)) and set(got) == want({"n0", "n1", "n2", "n3"})
    some = blocking.single_key_pairs(*sides, spark.createDataFrame([("n1",)], "n string")).collect()
    assert {tuple(x) for x in some} == want({"n1"})


def test_words_of_the_head_are_those_of_the_text(spark, tmp_path):
    """Texts whose first 40 words end before, at and after the head, with white space around."""
    texts = [None, "", " \n", "x", " a\tb  c ", "w " * 500, "é" * 600 + " b c", " ".join("k" * n for n in range(1, 60)), " " * 520 + "late words"]
    texts += [" ".join(["y" * 12] * 39 + ["z" * n, "end", "more"]) for n in range(1, 9)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in tables.records(spark, str(tmp_path)).collect():
        w = (texts[int(r.entity_id.split("-")[1])] or "").split()
        assert (r.business_name, r.business_address, r.truth_key) == (" ".join(w[:4]), " ".join(w[4:14]), " ".join(w[14:40]))


def test_steps_of_large_and_small_blocks(spark, monkeypatch):
    """Against a plain loop: numbers of pairs by thresholds reached, with blocks on either side of the line and several cells."""
    import random
    from collections import Counter

    rng = random.Random(5)
    rows = [(i, i % 2 == 0, rng.choice(["", "p", "q", "r"]), rng.choice(["", "s", "t"]), [f"w{k}" for k in sorted(rng.sample(range(9), rng.randint(0, 7)))], rng.randint(1, 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "entity_id long, first boolean, n string, a string, words array<string>, size long")
    grid, want = (10, 50, 60, 100), Counter()
    for x, y in itertools.product(rows, rows):
        if x[1] and not y[1] and (x[2] and x[2] == y[2] or x[3] and x[3] == y[3]):
            u, v = set(x[4]), set(y[4])
            score = len(u & v) / len(u | v) if u and v else 0.0
            want[x[0], sum(score >= g / 100 for g in grid)] += y[5]
    want = {k: n for k, n in want.items() if k[1]}
    for line, size in ((0, (5, 7)), (400, (8, 100)), (10**9, (5, 7))):
        monkeypatch.setattr(cells, "LARGE", line)
        monkeypatch.setattr(cells, "CELL", size)
        got = Counter()
        for r in cells.pair_steps(df.filter("first"), df.filter("not first"), grid).collect():
            got[r.a_id, r.k] += r.f
        assert got == want
    pairs = sum(bool(x[1] and not y[1] and (x[2] and x[2] == y[2] or x[3] and x[3] == y[3])) for x, y in itertools.product(rows, rows))
    assert cells.shared_key_count(df).first().total == pairs


def test_key_lists_are_the_pairs_by_left_row(spark, monkeypatch):
    """Lists made without pairs, in cells, against a plain loop; some keys are empty or on one side only."""
    monkeypatch.setattr(blocking, "CELL", 3)
    rows = [(f"S{1 + i % 3}-{i}", f"n{i % 4}" if i % 7 else "", f"a{i % 5}" if i % 6 else "") for i in range(80)] + [("S1-90", "own", "own"), ("S1-91", "", "")]
    both = spark.createDataFrame(rows, "entity_id string, n string, a string")
    got = blocking.key_lists(tables.of_source(both, 1), tables.of_source(both, 2, 3))
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]
    shares = lambda x, y: y[0][1] != "1" and any(x[k] and x[k] == y[k] for k in (1, 2))
    want = {x[0]: sorted(y[0] for y in rows if shares(x, y)) for x in rows if x[0][1] == "1"}
    assert {r.a_id: r.ids for r in got.collect()} == {k: v for k, v in want.items() if v}


def test_half_lists_of_large_and_small_blocks(spark, monkeypatch):
    """Against a plain loop, with blocks on either side of the line and several cells."""
    import random

    rng = random.Random(6)
    rows = [(i, rng.choice(["", "p", "q"]), rng.choice(["", "s", "t"]), [f"w{k}" for k in sorted(rng.sample(range(9), rng.randint(0, 7)))]) for i in range(90)]
    df = spark.createDataFrame(rows, "entity_id long, n string, a string, words array<string>")
    close = lambda u, v: u and v and 2 * len(u & v) >= len(u | v)
    shares = lambda x, y: x[1] and x[1] == y[1] or x[2] and x[2] == y[2]
    want = {x[0]: sorted(str(y[0]) for y in rows[40:] if shares(x, y) and close(set(x[3]), set(y[3]))) for x in rows[:40]}
    for line, size in ((0, (5, 7)), (10**9, (5, 7))):
        monkeypatch.setattr(cells, "LARGE", line)
        monkeypatch.setattr(cells, "CELL", size)
        got = cells.half_lists(df.filter("entity_id < 40"), df.filter("entity_id >= 40").withColumn("entity_id", df.entity_id.cast("string")))
        assert {r.a_id: r.ids for r in got.collect()} == {k: v for k, v in want.items() if v}


def test_error_categories_by_classes(spark, tmp_path, monkeypatch):
    """Copies, names that differ in one block, other countries and lost fields: counts of classes against those of the pairs."""
    import random

    rng = random.Random(8)
    heads = ["ab cd ef gh", "Ab cd, ef gh", "ab cd ef gi", "zz yy xx ww", "a b c d"]
    tails = ["one two three four five six seven eight nine ten", "one two three four five six seven eight nine eleven", "One two three, four five six seven eight nine ten", "p q r s t u v w x 12345"]
    ends = [" ".join(f"w{i}" for i in range(26)), " ".join(f"v{i}" for i in range(26)), ""]
    docs = [(i, f"{rng.choice(heads)} {rng.choice(tails)} {rng.choice(ends)}", rng.choice(["en", "en", "EN", "fr", None])) for i in range(150)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in registry.QUERIES["error_categories"](spark, str(tmp_path)).collect()]
    made = []
    monkeypatch.setattr(registry._Data, "repeated", True)
    monkeypatch.setattr(registry.errors, "error_cases", lambda *a, f=registry.errors.error_cases: made.append(1) or f(*a))
    want = [tuple(r) for r in registry.QUERIES["error_categories"](spark, str(tmp_path)).collect()]
    assert made == [1] and got == want and len({r[:2] for r in want}) > 3


def test_error_categories_make_no_pairs_of_copies(spark, tmp_path, monkeypatch):
    """Each record is one of three copies; the pairs that are compared are of classes."""
    text = "alpha beta gamma delta one two three four five six seven eight nine ten {} " + " ".join(f"w{i}" for i in range(30))
    spark.createDataFrame([(i, text.format(i % 2), "en") for i in range(90)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(registry.errors, "error_cases", None)
    rows = registry.QUERIES["error_categories"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("FP", "similar_name", 900)]


def _made_up(spark, tmp_path, n=140, seed=9):
    """Documents with copies, names and addresses that differ little, long ones, codes, empty fields and several countries."""
    import random

    rng = random.Random(seed)
    heads = ["ab cd ef gh", "Ab cd, ef inc", "ab cd ef inc", "zz yy xx ww", "é è à ü"]
    tails = ["one two three four five six seven eight nine ten", "one two three four five six seven eight nine eleven", "One two-three, four five six two eight nine ten", "p q r s t u v w x 12345", "é è ü " + " ".join("longword" * 2 + str(i) for i in range(7)), "!!! ??? é è ü é è ü é è"]
    ends = [" ".join(f"w{i}" for i in range(26)), " ".join(f"v{i}" for i in range(26)), ""]
    docs = [(i, f"{rng.choice(heads)} {rng.choice(tails)} {rng.choice(ends)}", rng.choice(["en", "en", "EN", "fr", None])) for i in range(n)]
    spark.createDataFrame([*docs, (n, None, "en"), (n + 1, "ab", None), (n + 2, "ab", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")


def test_features_by_classes_are_those_of_the_pairs(spark, tmp_path, monkeypatch):
    """In cells and in one block, with full and cut classes; the pairs themselves are not compared."""
    _made_up(spark, tmp_path)
    with monkeypatch.context() as m:
        m.setattr(registry._Data, "repeated", True)
        want = sorted(tuple(r) for r in registry.QUERIES["pair_features"](spark, str(tmp_path)).collect())
    monkeypatch.setattr(registry.features, "fit_transform", None)
    for cell, members, chunk in ((3, 2, 5), (512, 64, 10_000)):
        for name, size in (("CELL", cell), ("MEMBERS", members), ("CHUNK", chunk)):
            monkeypatch.setattr(registry.class_features, name, size)
        got = sorted(tuple(r) for r in registry.QUERIES["pair_features"](spark, str(tmp_path)).collect())
        assert len(got) > 1000 and [x[:2] for x in got] == [x[:2] for x in want]
        assert all(abs(p - q) < 2e-6 for x, y in zip(got, want, strict=True) for p, q in zip(x[2:], y[2:], strict=True))


def test_bulk_similarities_are_the_plain_ones():
    import random

    import numpy as np

    from samewise.functions import similarity as sim
    from samewise.operators import bulk
    from samewise.operators.class_features import _distance

    rng = random.Random(3)
    words = ["".join(rng.choice("abc1") for _ in range(rng.randint(1, 14))) for _ in range(25)]
    left, right = [[" ".join(rng.choice(words) for _ in range(rng.randint(0, 22))) for _ in range(30)] for _ in "ab"]
    right += left[:5]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
    for k, got in enumerate(zip(*bulk.Comparison(left, right)(i, j), strict=True)):
        a, b = left[i[k]], right[j[k]]
        if a and b:
            u, v = set(a.split()), set(b.split())
            assert np.allclose(got, (1 - _distance(a, b) / max(len(a), len(b)), sim.indel(a, b) / 100, sim.token_set(a, b) / 100, sim.token_sort(a, b) / 100, len(u & v) / len(u | v)), atol=1e-12)


def test_scores_by_classes_are_those_of_the_pairs(spark, tmp_path, monkeypatch):
    """The same labels, splits and scores as from all pairs, which are not compared."""
    _made_up(spark, tmp_path, 240)
    with monkeypatch.context() as m:
        m.setattr(registry._Data, "repeated", True)
        want = sorted(tuple(r) for r in registry.QUERIES["model_scores"](spark, str(tmp_path)).collect())
    monkeypatch.setattr(registry.features, "fit_transform", None)
    monkeypatch.setattr(registry.class_features, "MEMBERS", 2)
    df = registry.QUERIES["model_scores"](spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.collect())
    assert len(got) > 3000 and [x[:4] for x in got] == [x[:4] for x in want] and len({x[2:4] for x in got}) == 4
    assert all(abs(x[4] - y[4]) < 1e-6 and (x[5] == y[5] or abs(x[4] - 0.5) < 1e-6) for x, y in zip(got, want, strict=True))


def test_class_pairs_are_scored_before_they_are_expanded(spark, tmp_path):
    """The log odds are taken of rows of class pairs; the features are not made for the pairs of records."""
    _made_up(spark, tmp_path, 120)
    df = registry.QUERIES["model_scores"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "odds_of(" in plan and "lists_of(" not in plan and "addr_norm_levenshtein" not in plan
    assert plan.index("Generate explode") < plan.index("odds_of(")  # the plan's root comes first


def test_true_pairs_by_source_and_packed_numbers():
    import numpy as np
    import pyarrow as pa

    from samewise.operators import class_features

    a = [[dict(truth=1, train=True), dict(truth=1, train=True), dict(truth=None, train=True)], [dict(truth=2, train=False)], [dict(truth=2, train=True)]]
    b = [[dict(truth=1, source=1.0), dict(truth=2, source=2.0)], [dict(truth=None, source=1.0)], [dict(truth=2, source=2.0), dict(truth=2, source=2.0)]]
    left = pa.table({"members": pa.array(a, pa.list_(pa.struct([("truth", pa.int64()), ("train", pa.bool_())])))})
    right = pa.table({"members": pa.array(b, pa.list_(pa.struct([("truth", pa.int64()), ("source", pa.float64())])))})
    of, fit = class_features._true_pairs(left, right)
    i, j = (x.ravel() for x in np.meshgrid(range(3), range(3), indexing="ij"))
    want = [[sum(x["train"] and y["source"] == s and (x["truth"] == y["truth"] and x["truth"] is not None) == true for x in a[p] for y in b[q]) for s in (1.0, 2.0) for true in (True, False)] for p, q in zip(i, j, strict=True)]
    assert of(i, j).tolist() == want and fit.tolist() == [True, False, True]
    column = pa.array([np.arange(k, dtype="f8").tobytes() for k in (2, 4, 0, 6)], pa.binary())
    assert class_features.numbers_of(column.slice(1), "f8", 2).tolist() == [[0, 1], [2, 3], [0, 1], [2, 3], [4, 5]]
    assert class_features.numbers_of(column[:0], "f8", 2).shape == (0, 2)


def test_lengths_are_taken_once_a_record(spark):
    plan = registry.QUERIES["length_diffs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "length(" not in plan.split("Join")[0] and "length(" in plan


def test_equal_texts_need_no_lengths(spark):
    from pyspark.sql import functions as F

    from samewise.functions import similarity as sim

    df = spark.createDataFrame([("", ""), ("ab", "ab"), ("ab", "ac"), (None, ""), (None, "a"), (None, None)], "a string, b string").select(sim.levenshtein_similarity(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in df.collect()] == [1.0, 1.0, 0.5, 1.0, None, None]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "WHEN (a" in plan and "WHEN ((greatest" not in plan
