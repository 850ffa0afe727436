"""Golden tables, metric fixtures and properties of the linkage operators."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions import text as tx
from samewise.operators import blocking, errors, features, metrics, submission, training
from samewise.plans import linkage
from samewise.sources import tables

S1, CAND = metrics.S1, metrics.CAND
# Names and addresses with what they become.
NAMES = [
    ("  << Orelee's Barbershop, Inc...  ", "orelee's barbershop inc"),
    ("Pvt. EFS Print Ventures Ltd.", "pvt efs print ventures ltd"),
    ("B+ Retail Inc & Co.", "b+ retail inc co"),
    ("-- Holloway Peak Inc Seafood --", "holloway peak inc seafood"),
    ("  << Team  École & Co., Ltd... ", "team école co ltd"),
    ("Fractales Amis Groupe S.A.S. - Nouvelle-Aquitaine", "fractales amis groupe s a s nouvelle aquitaine"),
    ("L'Étoile du Nord SARL", "l'étoile du nord sarl"),
    ("राम--मार्केटिंग   (प्राइवेट)  लिमिटेड", "राम मार्केटिंग प्राइवेट लिमिटेड"),
    ("  ಪ್ರೈವೇಟ್ ಲಿಮಿಟೆಡ್   ಬೆಂಗಳೂರು  ", "ಪ್ರೈವೇಟ್ ಲಿಮಿಟೆಡ್ ಬೆಂಗಳೂರು"),
    ("తెలుగు ఎంటర్‌ప్రైజెస్ (ఇండియా)", "తెలుగు ఎంటర్ప్రైజెస్ ఇండియా"),
    ("", ""),
    ("ＡＢＣ　Ｌｔｄ", "abc ltd"),
    (None, ""),
    ("   ", ""),
]
ADDRESSES = [
    ("  << 1795 Westchester Drive,, High Point , NC...  ", "1795 westchester drive, high point, nc", None),
    ("17560 Ellis Road, Tahlequah, OK 74464", "17560 ellis road, tahlequah, ok 74464", "74464"),
    ("17560 Ellis Road, Tahlequah, OK", "17560 ellis road, tahlequah, ok", None),
    ("1 Ivanhoe Ave, PO Box 6009, Cincinnati, Ohio 45206-1234", "1 ivanhoe ave, po box 6009, cincinnati, ohio 45206-1234", "45206"),
    ("63 R. DE DIEPPE, 59000 LILLE, Hauts-de-France", "63 r de dieppe, 59000 lille, hauts-de-france", "59000"),
    ("175 Boulevard du Président Franklin Roosevelt, Bordeaux, Nouvelle-Aquitaine", "175 boulevard du président franklin roosevelt, bordeaux, nouvelle-aquitaine", None),
    ("5 bis Rue Pierre Dignac, 33260 La Teste-de-Buch", "5 bis rue pierre dignac, 33260 la teste-de-buch", "33260"),
    ("केएच नं. -570/13, नई दिल्ली, पश्चिम दिल्ली, दिल्ली - 110041", "केएच नं 570/13, नई दिल्ली, पश्चिम दिल्ली, दिल्ली 110041", "110041"),
    ("ಡೋರ್ ನಂ. 183, 41ನೇ ಕ್ರಾಸ್, ಬೆಂಗಳೂರು 560082, ಕರ್ನಾಟಕ", "ಡೋರ್ ನಂ 183, 41ನೇ ಕ್ರಾಸ್, ಬೆಂಗಳೂರು 560082, ಕರ್ನಾಟಕ", "560082"),
    ("సర్వే నం. 83/1, రాయదుర్గం, హైదరాబాద్, తెలంగాణ", "సర్వే నం 83/1, రాయదుర్గం, హైదరాబాద్, తెలంగాణ", None),
    ("Prestige Falcon City, Kanakapura Main Road, Flat No. 51262, Bangalore", "prestige falcon city, kanakapura main road, flat no 51262, bangalore", None),
    (None, "", None),
    ("   ", "", None),
]


def test_names(spark):
    got = spark.createDataFrame([(a,) for a, _ in NAMES], "a string").select(tx.normalize_name(F.col("a"))).collect()
    assert [r[0] for r in got] == [b for _, b in NAMES]


def test_addresses_and_codes(spark):
    got = spark.createDataFrame([(a,) for a, *_ in ADDRESSES], "a string").select(tx.normalize_address(F.col("a")), tx.postal_code(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(b, c) for _, b, c in ADDRESSES]


def test_composition_of_rows_that_need_it(spark):
    cells = ["ＡＢＣ　Ｌｔｄ", "Café", "Cafe\u0301", "plain", "ﬁ x", None, "½", "Ångström É"]
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(cells)], "i int, a string")
    got = tx.by_form(frame, ["a"], lambda rows, may: rows.select("i", tx.normalize_name(F.col("a"), may).alias("n"))).orderBy("i").collect()
    whole = frame.select("i", tx.normalize_name(F.col("a")).alias("n")).orderBy("i").collect()
    assert got == whole and [r.n for r in got] == ["abc ltd", "café", "café", "plain", "fi x", "", "1 2", "ångström é"]


def test_missing_cells(spark):
    cells = spark.createDataFrame([("\t",), (" x\u00a0",), (None,)], "a string").select(tx.safe_string(F.col("a"))).collect()
    assert [r[0] for r in cells] == ["", "x", ""]


def test_address_key_needs_no_normalized_address(spark):
    df = spark.createDataFrame([(a,) for a, *_ in ADDRESSES], "a string")
    x = df.select(tx.address_key(F.col("a")).alias("x"), F.regexp_replace(F.lower(tx.normalize_address(F.col("a"))), "[^a-z0-9]+", "").alias("y")).collect()
    assert all(r.x == r.y for r in x)


def test_last_pin(spark):
    cases = [("11 12345 x 654321", "654321"), ("a12345", None), ("११००४१ x", "११००४१"), (None, None), ("1234567", None)]
    got = spark.createDataFrame([(a,) for a, _ in cases], "a string").select(tx.last_pin(F.col("a"))).collect()
    assert [r[0] for r in got] == [b for _, b in cases]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_kernels():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(12))) for _ in "ab")
        assert sim.lcs_length(a, b) == slow_lcs(a, b)
        for k in (sim.indel, sim.token_sort, sim.token_set):
            assert 0 <= k(a, b) <= 100 and k(a, b) == pytest.approx(k(b, a))
    assert sim.indel("", "") == 100 and sim.token_set("a b", "b") == 100 and sim.token_set("", "a") == 0
    assert sim.jaro_winkler_one("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)


RECORDS = [
    ("S1-1", "Amazon Inc", "123 Amazon Way, Seattle WA 98109", "US"),
    ("S1-2", "Google LLC", "1600 Amphitheatre Pkwy, Mountain View CA 94043", "US"),
    ("S2-1", "Amazon.com Inc.", "123 Amazon Way, Seattle 98109", "US"),
    ("S3-1", "Alphabet (Google)", "1600 Amphitheatre, CA", "USA"),
]


def frames(spark):
    r = spark.createDataFrame(RECORDS, tables.RECORD)
    return tables.of_source(r, 1), tables.of_source(r, 2, 3)


def test_features(spark):
    ones, others = frames(spark)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-2", "S2-unknown")], tables.PAIR)
    got = {r[S1] + r[CAND]: r for r in features.pair_features(pairs, ones, others, features.fit_vocabularies(ones, others, pairs)).collect()}
    a = got["S1-1S2-1"]
    want = {"name_norm_levenshtein": 0.714286, "name_rapidfuzz_levenshtein": 0.833333, "name_token_sort_similarity": 0.833333, "name_token_set_similarity": 1, "name_token_jaccard": 2 / 3, "name_exact_norm_match": 0, "name_exact_core_match": 0, "name_len_diff": 5, "name_norm_len_diff": 4, "addr_norm_levenshtein": 0.903226, "addr_token_similarity": 0.949153, "addr_token_set_similarity": 1, "addr_token_jaccard": 5 / 6, "addr_pin_exact_match": 1, "addr_pin_missing": 0, "addr_len_diff": 3, "addr_norm_len_diff": 3, "country_exact_match": 1, "source_pair_indicator": 1}
    for k, v in want.items():
        assert a[k] == pytest.approx(v, abs=1e-6), k
    b = got["S1-2S3-1"]
    assert b.name_token_jaccard == pytest.approx(1 / 3) and (b.addr_pin_exact_match, b.addr_pin_missing, b.country_exact_match, b.source_pair_indicator) == (0, 1, 0, 2)
    c = got["S1-2S2-unknown"]
    assert c.name_missing_cand == c.addr_missing_cand == c.country_missing_cand == 1 and c.name_tfidf_cosine == 0 and c.addr_pin_missing == 0
    assert list(a.asDict()) == [S1, CAND, *features.FEATURES]
    with pytest.raises(ValueError, match="fit"):
        features.pair_features(pairs, ones, others, None)


def test_blocking_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"S{1 + i % 3}-{i}", rng.choice(["Acme", "acme.", "Beta co", "", None]), rng.choice(["1 Main", "1-main", "22 Oak", "é", None]), "US") for i in range(60)]
    r = spark.createDataFrame(rows, tables.RECORD)
    got = blocking.candidate_pairs(tables.of_source(r, 1), tables.of_source(r, 2, 3)).collect()
    name = lambda x: (x or "").lower().replace(".", "")
    addr = lambda x: "".join(c for c in (x or "").lower() if c.isascii() and c.isalnum())
    want = {(a[0], b[0]) for a, b in itertools.product(rows, rows) if a[0][1] == "1" != b[0][1] and (name(a[1]) and name(a[1]) == name(b[1]) or addr(a[2]) and addr(a[2]) == addr(b[2]))}
    assert {tuple(x) for x in got} == want and len(got) == len(want)


TRUTH = [("S1_1", "S2_1"), ("S1_2", "S2_2"), ("S1_2", "S3_2")]
SCORED = [("S1_1", "S2_1", 0.9), ("S1_2", "S2_2", 0.8), ("S1_2", "S3_2", 0.4), ("S1_3", "S2_3", 0.6)]


def test_sweep(spark):
    truth, scored = spark.createDataFrame(TRUTH, tables.PAIR), spark.createDataFrame(SCORED, tables.PAIR + ", score double")
    sweep = metrics.threshold_sweep(scored, truth)
    got = {round(r.threshold * 100): tuple(r)[1:] for r in sweep.collect()}
    want = {10: (0.666667, 4, 1, 0), 45: (0.611111, 3, 1, 1), 65: (0.944444, 2, 0, 1), 80: (0.944444, 2, 0, 1), 85: (0.666667, 1, 0, 2)}
    assert len(got) == 17 and all(got[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    best = metrics.best_threshold(sweep).first()
    assert best.threshold == 0.8
    ids = scored.select(S1)
    for t in (45, 65):
        one = metrics.macro_f05(metrics.entity_metrics(ids, truth, scored.filter(f"score >= {t / 100}"))).first()
        assert one.macro_f0_5 == pytest.approx(got[t][0])


def test_metrics_fixture(spark):
    truth = [("S1-0001", "S2-0010"), ("S1-0002", "S2-0020"), ("S1-0003", "S3-0030"), ("S1-0004", "S3-0040")]
    ids = spark.createDataFrame([(f"S1-000{i}",) for i in range(1, 6)], S1 + " string")
    e = metrics.entity_metrics(ids, spark.createDataFrame(truth, tables.PAIR), spark.createDataFrame([*truth[:3], ("S1-9", "S2-1")], tables.PAIR))
    b = metrics.macro_breakdown(e).first()
    assert tuple(b) == (pytest.approx(0.8), 5, 1, 1.0)
    none = metrics.macro_breakdown(e.limit(0)).first()
    assert tuple(none) == (0.0, 0, 0, 0.0)


def test_error_categories(spark):
    rows = [("a", "b", "Acme", "Acme", "", "", "US", "UK", 1, 0, "country_mismatch"), ("c", "d", "Acme Corp", "Acme Corp Inc", "", "", "US", "US", 1, 0, "similar_name"), ("e", "f", "Acme Corp", "", "", "", "", "", 0, 1, "missing_field"), ("g", "h", "Acme Corp", "Acme Corp", "123 Main St 90210", "123 Main St", "US", "US", 0, 1, "missing_pin"), ("i", "j", "x", "x", "", "", "US", "US", 1, 1, "N/A")]
    r = spark.createDataFrame([x for a, b, n, m, p, q, c, d, *_ in rows for x in ((a, n, p, c), (b, m, q, d))], tables.RECORD)
    p = spark.createDataFrame([(x[0], x[1], 0.5, x[8], x[9]) for x in rows], tables.PAIR + ", score double, prediction int, ground_truth_label int")
    cases = errors.error_cases(p, r)
    assert {c[S1]: c.category for c in cases.collect()} == {x[0]: x[10] for x in rows}
    assert tuple(errors.error_rates(cases).first()) == (5, 2, 2, 0.4, 0.4) and "missing_pin" in errors.report(cases)
    with pytest.raises(ValueError, match="lack"):
        errors.error_cases(p.drop("score"), r)


def test_files_round_trip(spark, tmp_path):
    path = f"{tmp_path}/r.tsv"
    with open(path, "w") as f:
        f.write('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"x ""y"" z"\t\tUS\nS1-2\tNA\ta\nS1-1\tdup\tb\tFR\n')
    rows = tables.read_records(spark, path).collect()
    assert [tuple(r) for r in rows] == [("S1-1", 'x "y" z', "", "US"), ("S1-2", "NA", "a", ""), ("S1-1", "dup", "b", "FR")]
    assert tables.read_records(spark, path, typed=True).collect()[1].business_name is None
    assert [r[1] for r in tables.read_ordered_ids(spark, path).orderBy("pos").collect()] == ["S1-1", "S1-2", "S1-1"]
    wide = spark.createDataFrame([("S1-1 ", " S2-1, S2-2,,S2-1"), ("S1-2", "")], tables.TRUTH)
    assert [tuple(r) for r in tables.truth_lists(wide).collect()] == [("S1-1", ["S2-1", "S2-2"]), ("S1-2", [])]
    with pytest.raises(ValueError, match="lacks"):
        tables.truth_lists(wide.drop("matched_entity_ids"))


class Fixed(linkage.CandidateGenerator, linkage.MatchModel):
    def __init__(self, candidates, matches):
        self.candidates, self.matches = candidates, matches

    def generate_candidates(self, source1, others):
        return self.candidates

    def predict_matches(self, pairs, source1, others):
        return self.matches


def test_pipeline_files(spark, tmp_path):
    ids = [f"S1-000{i}" for i in range(1, 6)]
    ones = spark.createDataFrame([(i, "n", "a", "US") for i in ids], tables.RECORD)
    others = spark.createDataFrame([(i, "n", "a", "US") for i in ("S2-0010", "S2-0020", "S3-0030", "S3-0040")], tables.RECORD)
    candidates = spark.createDataFrame([("S1-0001", "S2-0010"), ("S1-0001", "S3-0040"), ("S1-0002", "S2-0020"), ("S1-0003", "S3-0030"), ("S1-0004", "S3-0040")], tables.PAIR)
    matches = candidates.filter(f"{CAND} <> 'S3-0040'")
    ordered = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], f"pos long, {S1} string")
    plug = Fixed(candidates, matches)
    linkage.run_pipeline(ones, others, ordered, plug, plug, str(tmp_path))
    part = next((tmp_path / "matching").glob("part-*"))
    assert part.read_text() == f"{S1}\tmatched_entity_ids\nS1-0001\tS2-0010\nS1-0002\tS2-0020\nS1-0003\tS3-0030\nS1-0004\t\nS1-0005\t\n"
    checks = {r.check: r.violations for r in submission.check_files(spark, ones, others, f"{tmp_path}/matching", f"{tmp_path}/candidates").collect()}
    assert len(checks) == 15 and not any(checks.values())
    with open(part, "a") as f:
        f.write("S1-0006\tS2-0010\tmore\n")
    (tmp_path / "matching" / f".{part.name}.crc").unlink()
    checks = {r.check: r.violations for r in submission.check_files(spark, ones, others, f"{tmp_path}/matching", f"{tmp_path}/none").collect()}
    assert checks == {"matched_entity_ids_header": 0, "matched_entity_ids_columns": 1, "candidate_entity_ids_exists": 1}
    lists = spark.createDataFrame([("S1-0001", "S2-0010,S2-0010,X-1"), ("S1-0001", "")], f"{S1} string, matched_entity_ids string")
    bad = {r.check: r.violations for r in submission.check_rows(ones, others, lists, lists.withColumnRenamed("matched_entity_ids", "candidate_entity_ids").limit(0)).collect()}
    assert bad["matched_no_repeats"] == 1 and bad["matched_prefix"] == 1 and bad["matched_unique_ids"] == 1 and bad["matched_row_count"] == 3 and bad["matches_in_candidates"] == 2


def test_training(spark, tmp_path):
    rng = random.Random(0)
    rows = [(f"S1-{i // 2}", f"S2-{i}", i % 2, i % 2 + rng.gauss(0, 0.4), 1.0) for i in range(200)]
    x = spark.createDataFrame(rows, tables.PAIR + ", label int, f double, g double")
    training.check_pairs(x)
    split = training.grouped_split(x)
    sizes = {r.split: r.n for r in split.groupBy("split").agg(F.countDistinct(S1).alias("n")).collect()}
    assert sizes == {"train": 80, "validation": 20}
    for kind in ("logistic", "forest"):
        scored = training.score(training.fit_classifier(x, ["f", "g"], kind, trees=10), x)
        assert metrics.pairwise_scores(scored).first().f0_5 > 0.8
    with pytest.raises(ValueError, match="only one class"):
        training.fit_classifier(x.filter("label = 1"), ["f"])
    with pytest.raises(ValueError, match="infinite"):
        training.check_matrix(x.withColumn("f", F.lit(float("nan"))), ["f"])
    with pytest.raises(ValueError, match="duplicate"):
        training.check_pairs(x.unionByName(x))
    for k in (1, 2):
        tables.append_log(training.experiment_record(spark, {"model": "logistic", "seed": k, "f0_5": 0.9}), f"{tmp_path}/log")
    assert sorted(map(tuple, spark.read.option("header", True).csv(f"{tmp_path}/log").collect())) == [("logistic", "1", "0.9"), ("logistic", "2", "0.9")]
    with pytest.raises(ValueError, match="empty train"):
        training.check_split(split.filter("split = 'train'"))
    with pytest.raises(ValueError, match="both parts"):
        training.check_split(split.unionByName(split.withColumn("split", F.lit("train"))))
    with pytest.raises(ValueError, match="columns differ"):
        training.check_columns(x.drop("label"), ["g", "f"])


def test_train_save_load_and_infer(spark, tmp_path, capsys):
    """The command line from files to checked list files; models are loaded from their folders."""
    from samewise import __main__ as cli

    rng, rows, truth = random.Random(2), {1: [], 2: [], 3: []}, []
    for i in range(60):
        name, street = f"firm {rng.choice('abcdef')}{i}", f"{i} {rng.choice(['oak', 'elm'])} road"
        rows[1].append((f"S1-{i}", name, street, "US"))
        rows[2].append((f"S2-{i}", name, street if i % 2 else f"{i} other lane", "US"))
        rows[3].append((f"S3-{i}", f"{name} shop", street, rng.choice(["US", "FR"])))
        rows[2].append((f"S2-x{i}", name, f"{rng.randrange(10**6)} far way", "IN"))
        truth.append((f"S1-{i}", f"S2-{i},S3-{i}"))
    path = {n: f"{tmp_path}/s{n}.tsv" for n in rows} | {"truth": f"{tmp_path}/truth.tsv"}
    for n, x in rows.items():
        with open(path[n], "w") as f:
            f.write("\n".join("\t".join(r) for r in [("entity_id", "business_name", "business_address", "country"), *x]) + "\n")
    with open(path["truth"], "w") as f:
        f.write("\n".join("\t".join(r) for r in [("source1_entity_id", "matched_entity_ids"), *truth]) + "\n")
    sources = [x for n in rows for x in (f"--source{n}", path[n])]
    models = f"{tmp_path}/models"
    cli.main(["block", *sources, "--out", f"{tmp_path}/pairs"])
    assert capsys.readouterr().out.strip() == "180 pairs"
    from samewise.plans import runs

    fit = runs.train
    runs.train = lambda *a: fit(*a, trees=5)
    try:
        cli.main(["train", *sources, "--pairs", f"{tmp_path}/pairs", "--truth", path["truth"], "--out", models, "--log", f"{tmp_path}/log"])
    finally:
        runs.train = fit
    log = spark.read.option("header", True).csv(f"{tmp_path}/log")
    assert log.count() == 2 and len(log.columns) == 12 and {r.train_entities for r in log.collect()} == {"48"}
    predictions = f"{models}/val_predictions_logistic_regression"
    cli.main(["evaluate", "--predictions", predictions, "--truth", path["truth"], "--csv", f"{tmp_path}/sweep", "--json", f"{models}/threshold.json", "--fine"])
    from samewise.plans import artifacts

    saved = artifacts.load_json(spark, f"{models}/threshold.json")
    assert list(saved) == ["threshold", "metric", "selection", "best_macro_f0_5"] and saved["best_macro_f0_5"] > 0.9
    assert spark.read.option("header", True).csv(f"{tmp_path}/sweep").count() == 91
    cli.main(["errors", *sources, "--predictions", predictions, "--threshold", "0.5", "--tsv", f"{tmp_path}/wrong", "--txt", f"{tmp_path}/report"])
    assert "Categories of false negatives:" in "\n".join(r.value for r in spark.read.text(f"{tmp_path}/report").collect())
    capsys.readouterr()
    cli.main(["infer", *sources, "--models", models, "--out", f"{tmp_path}/out"])
    checks = dict(line.rsplit(" ", 1) for line in capsys.readouterr().out.strip().splitlines())
    assert len(checks) == 15 and set(checks.values()) == {"0"}
    with pytest.raises(FileNotFoundError):
        cli.main(["infer", *sources, "--models", f"{tmp_path}/none", "--out", f"{tmp_path}/out"])


def test_fit_transform_and_guards(spark):
    ones, others = frames(spark)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1")], tables.PAIR)
    x, vocabularies = features.fit_transform(pairs, ones, others)
    again = features.pair_features(pairs, ones, others, vocabularies)
    assert sorted(x.collect()) == sorted(again.collect())
    training.check_columns(x, features.FEATURES)
    with pytest.raises(ValueError, match="no pairs"):
        training.check_pair_ids(pairs.limit(0))


def test_truth_keeps_the_last_row_and_invalid_bytes_are_replaced(spark, tmp_path):
    wide = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-1", "S2-3\t")], tables.TRUTH).coalesce(1)
    assert sorted(tuple(r) for r in tables.truth_lists(wide).collect()) == [("S1-1", ["S2-3"]), ("S1-2", ["S2-2"])]
    (tmp_path / "bad.tsv").write_bytes(b"entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\xff\tb\tUS\n")
    assert tables.read_records(spark, f"{tmp_path}/bad.tsv").first().business_name == "a\ufffd"
    both = tables.union_sources(*frames(spark))
    assert both.count() == 4


def test_stream(spark, tmp_path):
    from samewise.streaming.incremental import link_stream

    ones, others = frames(spark)
    extra = spark.createDataFrame([("S2-9", "amazon inc", "", "US")], tables.RECORD)
    ones.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ones.schema).parquet(f"{tmp_path}/in")
    q = link_stream(stream, blocking.blocking_keys(others.unionByName(extra)), f"{tmp_path}/out", f"{tmp_path}/check")
    q.processAllAvailable()
    q.stop()
    assert [(r[S1], r[CAND]) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("S1-1", "S2-9")]


def test_model_scores(spark, monkeypatch):
    """The scores of the registered query are those of the converged model: the only point where the gradient is zero."""
    import numpy as np

    from samewise.plans import registry

    seen, score = [], training.score
    monkeypatch.setattr(training, "score", lambda model, x: seen.append(x) or score(model, x))
    got = {(r[S1], r[CAND]): r for r in registry.QUERIES["model_scores"](spark, "/root/testdata/sf0.001").collect()}
    rows = seen[0].collect()
    assert len(got) == len(rows) and {r.split for r in rows} == {"train", "validation"}
    x = np.array([[r[c] for c in features.FEATURES] for r in rows], dtype=float)
    y, p = (np.array([getattr(got[r[S1], r[CAND]], c) for r in rows]) for c in ("label", "score"))
    train = np.array([r.split == "train" for r in rows])
    n, ones = train.sum(), y[train].sum()
    excess = np.where(y == 1, n / (2 * ones), n / (2 * (n - ones))) * (p - y) * train
    z = -x @ (excess @ x)  # at the optimum the coefficients are -(excess @ x)
    intercept = np.median(np.log(p / (1 - p)) - z)
    assert abs(excess.sum()) < 1e-6 and abs(p - 1 / (1 + np.exp(-z - intercept))).max() < 1e-6
    assert all(got[r[S1], r[CAND]].prediction == (got[r[S1], r[CAND]].score >= 0.5) for r in rows)
