from __future__ import annotations

import difflib
import json
import math
import os
import random
import re
import struct
import threading
import unicodedata
import urllib.error
import urllib.request

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kindred import cli, service
from kindred.functions import normalize as N
from kindred.functions import similarity as S
from kindred.operators import blocking, evaluate
from kindred.operators.features import FEATURES, labelled, pair_features, with_features
from kindred.operators.validate import is_valid, validate_files, violations
from kindred.plans import fixtures, oracles, queries
from kindred.plans.classifier import PairClassifier, in_validation, split_entities
from kindred.plans.resolve import resolve_by_rule, results_view, run_pipeline, score_pairs, spine
from kindred.sources import generator, sinks, tables

SOURCE1 = """Blue Horizon Medical Devices Inc|1200 Beacon Street, Boston, MA 02116|US
Rolls-Royce Aerospace Technologies PLC|Kings Place, 90 York Way, London N1 9FX|United Kingdom
Air Liquide Technologies International|75 Quai d'Orsay, Paris 75007|France
Dassault Systemes Software Solutions SE|10 Rue Marcel Dassault, Velizy-Villacoublay 78140|France
Tech Mahindra Business Services Pvt Ltd|Sharda Centre, Erandwane, Pune 411004|India
Falcon Robotics & Automation Co|500 West Madison Street, Chicago, IL 60661|US
Harbor View Shipping & Freight Corp|200 Seaport Boulevard, Boston, MA 02210|US
Wipro Digital Solutions Private Limited|Doddakannelli, Sarjapur Road, Bengaluru 560035|India
Reliance Retail Enterprises Limited|Maker Chambers IV, Nariman Point, Mumbai 400021|India
Larsen & Toubro Engineering Corporation|L&T House, Ballard Estate, Mumbai 400001|India
Apex Logistics and Supply Chain LLC|450 North Michigan Avenue, Chicago, IL 60611|US
Golden Gate Hospitality Management LLC|99 Geary Street, San Francisco, CA 94108|US"""
SOURCE2 = """Blue Horizon Medical Devices Inc|1200 Beacon Street, Boston, MA 02116|US
Rolls-Royce Aerospace PLC|Kings Place, 90 York Way, London N1 9FX|United Kingdom
Dassault Systemes Software Solutions SE|10 Rue Marcel Dassault, Velizy-Villacoublay 78140|France
Falcon Robotics Automation Co|500 West Madison Street, IL 60661|US
Harbor View Shipping & Freight Corp|200 Seaport Boulevard, Boston, MA 02210|US
Wipro Solutions Private Limited|Doddakannelli, Sarjapur Rd, Bengaluru 560035|
Larsen Toubro Engineering Corporation|L&T House, Ballard Estate, Mumbai 400001|India
Apex Logistics and Supply Chain LLC|450 North Michigan Avenue, Chicago, IL 60611|
Golden Gate Hospitality Management LLC|99 Geary Street, CA 94108|US
Apex Global Technologies|102 Market St, San Francisco, CA|US
Blue Horizon Healthcare|1250 Beacon St, Boston, MA|US
Infosys BPO Services|Electronics City Phase 2, Bengaluru|India
Siemens Healthineers AG|Henkestrasse 127, Erlangen|Germany
Sanofi Consumer Healthcare|54 Rue La Boetie, Paris|France"""
SOURCE3 = """Rolls-Royce Aerospace Technologies PLC|Kings Place, 90 York Way, London N1 9FX|United Kingdom
Dassault Systemes Software Solutions SE|10 Rue Marcel Dassault, Velizy-Villacoublay 78140|France
Harbor View Shipping & Freight Corp|200 Seaport Boulevard, Boston, MA 02210|US
Apex Global Technologies Intl|102 Market St, San Francisco, CA|US
Blue Horizon Healthcare Intl|1250 Beacon St, Boston, MA|US
Infosys BPO Services Intl|Electronics City Phase 2, Bengaluru|India
Siemens Healthineers AG Intl|Henkestrasse 127, Erlangen|Germany
Sanofi Consumer Healthcare Intl|54 Rue La Boetie, Paris|France"""
#: Candidates of the sample by number; the target's source and number.
GOLDEN = {1: "2.1 2.11 3.5", 2: "2.2 3.1", 3: "2.10 3.4 3.8", 4: "2.3 3.2", 5: "2.6", 6: "2.4", 7: "2.5 3.3", 8: "2.6", 9: "", 10: "2.7", 11: "2.8 2.10 3.4", 12: "2.9 2.10 3.4"}
MATCHES = {1: "2.1", 2: "2.2 3.1", 3: "", 4: "2.3 3.2", 5: "", 6: "2.4", 7: "2.5 3.3", 8: "2.6", 9: "", 10: "2.7", 11: "2.8", 12: "2.9"}


def target(x: str) -> str:
    s, n = x.split(".")
    return f"S{s}_TST_{int(n):04d}"


def raw(spark, k: int, text: str, split: str = "TST"):
    rows = [(f"S{k}_{split}_{i:04d}", *line.split("|")) for i, line in enumerate(text.split("\n"), 1)]
    return spark.createDataFrame(rows, f"{'entity_id' if k == 1 else 'record_id'} string, business_name string, business_address string, country string")


@pytest.fixture(scope="module")
def sample(spark):
    s1, s2, s3 = (N.preprocess(raw(spark, k, t), f"source{k}").cache() for k, t in ((1, SOURCE1), (2, SOURCE2), (3, SOURCE3)))
    return s1, s2.unionByName(s3).cache()


def pairs_of(golden):
    return {(f"S1_TST_{k:04d}", target(x)) for k, v in golden.items() for x in v.split()}


def test_golden_candidates(sample):
    got = {(r.s1_id, r.target_id) for r in blocking.candidates(*sample, cap=80).collect()}
    assert got == pairs_of(GOLDEN)
    by_tfidf = {(r.s1_id, r.target_id) for r in blocking.tfidf_pairs(*sample).collect()}
    assert {("S1_TST_0003", "S2_TST_0010"), ("S1_TST_0003", "S3_TST_0004"), ("S1_TST_0005", "S2_TST_0006")} <= by_tfidf


def test_rule_matches_and_outputs(spark, sample):
    s1, t = sample
    m = resolve_by_rule(s1, t, 0.8)
    got = {(r.s1_id, r.target_id) for r in m.collect()}
    assert pairs_of(MATCHES) <= got <= pairs_of(GOLDEN)
    found = blocking.candidates(s1, t, cap=80)
    matching, candidate = sinks.matching_output(spine(s1), m), sinks.candidate_output(spine(s1), found, m)
    assert matching.count() == 12 and {r.candidate_entity_ids for r in candidate.where("source1_entity_id = 'S1_TST_0009'").collect()} == {"[]"}
    three = [raw(spark, k, x) for k, x in ((1, SOURCE1), (2, SOURCE2), (3, SOURCE3))]
    assert is_valid(violations(matching, candidate, *three))
    assert {r.check for r in violations(candidate.toDF("a", "b"), candidate, *three).collect()} == {"V3"}
    view = results_view(three[0], matching)
    assert view.count() == 12 and view.where(F.size("matches") == 0).count() >= 3


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Tech Mahindra Business Services Pvt Ltd", "tech mahindra business serv pvt ltd"),
        ("Juniper BioPharma Laboratories L.L.C.", "juniper biopharma laboratories llc"),
        ("Falcon Robotics & Automation Co", "falcon robotics and automation co"),
        ("s.a.r.l. X", "sar l x"),
        ("Rolls-Royce PLC", "rolls royce plc"),
        ("Größe  Société ﬁn_x", "große societe fin x"),
        ("", ""),
        (None, ""),
    ],
)
def test_names(spark, name, want):
    r = N.preprocess(spark.createDataFrame([("1", name)], "id string, name string"), "source2").first()
    assert r.norm_name == want and r.missing_name == int(want == "") and r.missing_address == r.missing_country == 1


@pytest.mark.parametrize(
    ("address", "want", "numbers"),
    [
        ("Kings Place, 90 York Way, London N1 9FX", "kings pl 90 york way london n1 9fx", ["90"]),
        ("St.Louis", "stlouis", []),
        ("P.O. Box 7", "pobox 7", ["7"]),
        ("L&T House", "l t house", []),
        ("12 st. x 007", "12 st x 007", ["12", "007"]),
    ],
)
def test_addresses(spark, address, want, numbers):
    r = N.preprocess(spark.createDataFrame([("1", address)], "id string, street string"), "source2").first()
    assert (r.norm_address, r.numeric_tokens) == (want, numbers)


def test_countries_and_roles(spark):
    rows = spark.createDataFrame([("U.S.A.",), ("in",), ("- US",), ("Great  Britain",), ("Japan",)], "nation string")
    assert [r.norm_country for r in N.preprocess(rows, "s").select("norm_country").collect()] == ["us", "india", " us", "united kingdom", "japan"]
    assert N.discover_roles(["Record_ID", "legal_name", "x_street", "country_code"]) == {"id": "Record_ID", "name": "legal_name", "address": "x_street", "country": "country_code"}
    assert N.discover_roles(["a", "country_name"]) == {"id": "a", "name": "country_name", "country": "country_name"}


def test_similarities(spark):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 15))) for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert S.lcs_length(a, b) == table[-1][-1]
        assert S.lcs_length(a, b) >= sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks())
    df = spark.createDataFrame([("", "", [], []), ("ab", "abc", ["a"], []), ("acme global tech corp", "acme tech global", ["b", "a"], ["a", "b"]), ("", "x", [], ["1"])], "a string, b string, x array<string>, y array<string>")
    got = df.select(S.indel(F.col("a"), F.col("b")).alias("i"), S.ngram_jaccard(F.col("a"), F.col("b")).alias("n"), S.numeric_overlap(F.col("x"), F.col("y"))[0].alias("o"), *[c.alias(f"t{k}") for k, c in enumerate(S.token_overlap(F.col("x"), F.col("y")))]).collect()
    assert [(r.i, r.n, r.o) for r in got[:2]] == [(1.0, 1.0, 0.5), (0.8, 0.0, 0.0)] and abs(got[2].i - 22 / 37) < 1e-12
    assert [(r.t0, r.t1, r.t2) for r in got] == [(1.0, 1.0, 0.0), (0.0, 0.0, 0.0), (1.0, 1.0, 2.0), (0.0, 0.0, 0.0)] and got[3].i == 0.0


def test_features_bounds(sample):
    s1, t = sample
    f = pair_features(blocking.candidates(s1, t), s1, t)
    assert f.columns == ["s1_id", "target_id", *FEATURES] and f.count() == 22
    for r in f.collect():
        assert all(0 <= r[c] <= 1 for c in FEATURES if "diff" not in c and "common" not in c)
    assert pair_features(blocking.candidates(s1, t.where("false")), s1, t).count() == 0


def test_caps(spark):
    t = N.preprocess(spark.createDataFrame([(f"S2_{i:04d}", f"Zephyr unit{i}") for i in range(230)], "id string, name string"), "source2")
    one = N.preprocess(spark.createDataFrame([("S1_1", "Zephyr other")], "id string, name string"), "source1")
    assert blocking.key_pairs(one, t, only="first").count() == blocking.FIRST_SAMPLE
    assert blocking.key_pairs(one, t, only="prefix").count() == blocking.key_pairs(one, t, only="token").count() == 0
    assert {r.target_id for r in blocking.candidates(one, t, cap=5, top_k=1).collect()} == {f"S2_{i:04d}" for i in range(5)}


def test_metrics(spark):
    scored = spark.createDataFrame([("a", "x", 0.9, 1), ("a", "y", 0.31, 0), ("b", "z", 0.95, 0), ("c", "w", 0.2, 1)], "s1_id string, target_id string, prob double, label int")
    m = evaluate.pair_metrics(scored, 0.5).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (1, 1, 1, 1) and m.f05 == 0.5
    curve = {round(r.threshold, 2): r for r in evaluate.threshold_curve(scored).collect()}
    assert len(curve) == 66
    for t, r in curve.items():
        w = evaluate.pair_metrics(scored, t).first()
        assert (r.tp, r.fp, r.fn, r.tn) == (w.tp, w.fp, w.fn, w.tn), t
    assert evaluate.best_threshold(evaluate.threshold_curve(scored.where("false"))).first().threshold == 0.3
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1_id string")
    truth = spark.createDataFrame([("a", "x"), ("c", "w"), ("b", None)], "s1_id string, target_id string")
    e = evaluate.entity_metrics(ids, truth, scored.where("prob >= 0.5"), 0.5).first()
    assert (e.total_s1, e.true_singletons, e.correct_singletons, e.tp, e.fp, e.fn, e.exact_entity_accuracy) == (4, 2, 1, 1, 1, 1, 0.5)
    s = evaluate.status_counts(ids, scored.where("prob >= 0.3")).first()
    assert (s["all"], s.matched, s.singletons, s.multi) == (4, 2, 2, 1)
    assert evaluate.filter_status(evaluate.match_counts(ids, scored), "multi").count() == 1
    assert evaluate.class_balance(scored).first().scale_pos == 1.0


def test_ground_truth_and_ids(spark):
    lists = spark.createDataFrame([("a ", "[x, y]"), ("b", "[]"), ("c", None), ("d", "x;'z'")], "id string, Matched_Entity_IDs string")
    got = {(r.s1_id, r.target_id) for r in tables.ground_truth(lists).collect()}
    assert got == {("a", "x"), ("a", "y"), ("b", None), ("c", None), ("d", "x"), ("d", "z")}
    pairs = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "nan")], "s string, t string")
    assert {(r.s1_id, r.target_id) for r in tables.ground_truth(pairs).collect()} == {("a", "x"), ("b", None)}
    assert {r.id for r in tables.entity_ids(spark.createDataFrame([("q", " 1 "), ("r", None), ("s", "1")], "x string, my_id string")).collect()} == {"1"}


def test_files_and_whole_run(spark, tmp_path):
    clean = spark.createDataFrame([(i, *SOURCE1.split("\n")[i % 12].split("|")) for i in range(12)] + [(100 + i, f"Unit{i} Works{i * 7} Corporation", f"{i + 100} Main{i} Street, Town{i}, {10000 + i}", "US") for i in range(60)], "key long, name string, address string, country string")
    extra = spark.createDataFrame([(i, f"Other{i} Firm{i}", f"{i} Side Road", "France") for i in range(5)], "key long, name string, address string, country string")
    for split, folder in (("TRN", "train"), ("TST", "test")):
        parts = generator.build_split(clean, extra, split, 7 if split == "TRN" else 8)
        for k in (1, 2, 3):
            sinks.write_tsv(parts[f"source{k}"], f"{tmp_path}/{folder}/{folder}_source{k}.tsv")
        ids = parts["source1"].select(F.col("entity_id").alias("s1_id"))
        sinks.write_tsv(sinks.matching_output(ids, parts["truth"]), f"{tmp_path}/{folder}/{folder}_ground_truth.tsv")
        assert parts["source3"].where("business_name like '% Intl'").count() >= 5
    out = run_pipeline(spark, f"{tmp_path}/train", f"{tmp_path}/test", f"{tmp_path}/out")
    assert out["validation_passed"] is True and out["candidate_recall"] > 0.9 and out["metrics"]["val_f05"] > 0.8
    assert out["counts"] == {"train_source1": 72, "train_truth": 72, "test_source1": 72} | {k: v for k, v in out["counts"].items() if "1" not in k and "truth" not in k} and out["counts"]["test_targets"] == out["counts"]["test_source2"] + out["counts"]["test_source3"]
    for name in ("matching_results", "candidate_pairs"):  # one file, one row an entity, in input order
        with open(f"{tmp_path}/out/{name}.tsv") as f:
            written = [line.split("\t")[0] for line in f][1:]
        assert written == [r.entity_id for r in tables.read_tsv(spark, f"{tmp_path}/test/test_source1.tsv", order=True).orderBy("row_order").collect()]
    truth = tables.ground_truth(tables.read_tsv(spark, f"{tmp_path}/test/test_ground_truth.tsv")).where("target_id is not null")
    found = tables.ground_truth(tables.read_tsv(spark, f"{tmp_path}/out/matching_results.tsv")).where("target_id is not null")
    assert found.intersect(truth).count() > 0.8 * max(found.count(), truth.count())
    assert validate_files(spark, f"{tmp_path}/none", f"{tmp_path}/out/candidate_pairs.tsv", f"{tmp_path}/test").first().check == "V1"
    report = tables.read_report(spark, f"{tmp_path}/out/experiment_report.json").first()
    assert report.test_s1_count == 72 and len(report.top_features) == 5 and len(report.threshold_curve) == 20
    with open(f"{tmp_path}/out/experiment_report.json") as f:
        plain = json.load(f)
    assert list(plain) == ["val_candidate_recall", "best_threshold", "val_precision", "val_recall", "val_f05", "val_singleton_accuracy", "test_s1_count", "test_resolved_matches", "test_singletons", "top_features", "threshold_curve"]
    assert list(plain["threshold_curve"][0]) == ["threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "f05"] and isinstance(plain["top_features"][0][1], float)
    (tmp_path / "broken.json").write_text("{broken")
    for path in ("none.json", "broken.json"):
        r = tables.read_report(spark, f"{tmp_path}/{path}").first()
        assert (r.val_candidate_recall, r.best_threshold, r.val_precision, r.val_recall, r.val_f05, r.val_singleton_accuracy) == (0.968, 0.62, 0.965, 0.88, 0.941, 1.0) and r.threshold_curve is None
    service_answers(spark, tmp_path, report)
    cli_answers(spark, tmp_path)
    assert tables.read_tsv_or_empty(spark, f"{tmp_path}/none.tsv", ("a", "b")).columns == ["a", "b"]


def service_answers(spark, tmp_path, report):
    s = service.Service(spark, f"{tmp_path}/train", f"{tmp_path}/test", f"{tmp_path}/out")
    status, answer = s.handle("GET", "/api/results?x=1")
    assert status == 200 and len(answer["results"]) == 72 and answer["report"]["best_threshold"] == report.best_threshold
    assert set(answer["results"][0]) == {"source1_entity_id", "name", "address", "country", "matches"} and any(r["matches"] for r in answer["results"])
    body = json.dumps({"entity_a": {"name": "Acme Global Corp", "address": "1 Main St", "country": "US"}, "entity_b": {"name": "Acme Global Corporation", "address": "1 Main Street", "country": "USA"}}).encode()
    with service.server(s, 0) as http:
        threading.Thread(target=http.serve_forever, daemon=True).start()
        url = f"http://127.0.0.1:{http.server_address[1]}/api"
        with urllib.request.urlopen(urllib.request.Request(f"{url}/test-match", body), timeout=120) as r:
            match = json.load(r)
        with pytest.raises(urllib.error.HTTPError) as e:
            urllib.request.urlopen(urllib.request.Request(f"{url}/test-match", b"no json"), timeout=120)
        http.shutdown()
    assert list(match["features"]) == list(FEATURES) and match["is_match"] and match["threshold"] == report.best_threshold and abs(match["probability"] - 1 / (1 + math.exp(-4.2))) < 1e-9
    assert e.value.code == 400 and s.handle("GET", "/x")[0] == 404
    empty = service.Service(spark, "", f"{tmp_path}/test", f"{tmp_path}/nothing").handle("GET", "/api/results")[1]
    assert empty["report"]["best_threshold"] == 0.62 and len(empty["results"]) == 72 and not any(r["matches"] for r in empty["results"])
    assert service.Service(spark, "/none", "/none", f"{tmp_path}/o2").handle("POST", "/api/run-pipeline")[0] == 500


def cli_answers(spark, tmp_path):
    files = ["--matching", f"{tmp_path}/out/matching_results.tsv", "--candidate", f"{tmp_path}/out/candidate_pairs.tsv", "--test-dir", f"{tmp_path}/test"]
    assert cli.main(["validate", *files]) == 0
    lines = (tmp_path / "out/matching_results.tsv").read_text().splitlines()
    (tmp_path / "short.tsv").write_text("\n".join(lines[:-1]))
    assert cli.main(["validate", "--matching", f"{tmp_path}/short.tsv", *files[2:]]) == 1
    args = cli.parser().parse_args(["run", "--random-seed", "7", "--skip-validation"])
    assert (args.train_dir, args.test_dir, args.output_dir, args.random_seed, args.skip_validation) == ("dataset/train", "dataset/test", "output", 7, True)


def test_last_row_of_a_repeated_id_wins(spark):
    rows = [("a", "[z, y]"), ("b", "[x]"), ("a", "[b]"), ("b", None)]
    lists = spark.createDataFrame(rows, "id string, matched_ids string").coalesce(1)
    want = {("a", "b"), ("b", None)}
    assert {(r.s1_id, r.target_id) for r in tables.ground_truth(lists).collect()} == want
    placed = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id string, matched_ids string, row_order long").repartition(3)
    assert {(r.s1_id, r.target_id) for r in tables.ground_truth(placed).collect()} == want
    records = spark.createDataFrame([("1", "first name", 1), ("1", "second name", 2), ("2", "other", 3)], "id string, name string, row_order long")
    a = N.preprocess(records, "source1").repartition(3)
    t = N.preprocess(spark.createDataFrame([("9", "second name", 5), ("9", "none", 4)], "id string, name string, row_order long"), "source2").repartition(3)
    pairs = spark.createDataFrame([("1", "9"), ("2", "9"), ("1", "x")], "s1_id string, target_id string")
    got = {(r.s1_id, r.target_id): r.name_exact for r in pair_features(pairs, a, t).collect()}
    assert got == {("1", "9"): 1.0, ("2", "9"): 0.0}
    assert blocking.compatible(pairs, a, t).count() == 2


def test_blocker(sample):
    s1, t = sample
    with pytest.raises(ValueError):
        blocking.MultiPassBlocker().block_entity(s1)
    b = blocking.MultiPassBlocker(max_candidates_per_entity=80).fit_targets(t)
    lists, pairs = b.generate_candidate_pairs(s1)
    assert {(r.s1_id, r.target_id) for r in pairs.collect()} == pairs_of(GOLDEN)
    assert {r.s1_id: r.target_ids for r in lists.collect()} == {f"S1_TST_{k:04d}": sorted(map(target, v.split())) for k, v in GOLDEN.items()}
    one = s1.where("id = 'S1_TST_0002'")
    assert {r.target_id for r in b.block_entity(one).collect()} == {target("2.2"), target("3.1")}


RULES = {
    "corporation": "corp", "corp": "corp", "incorporated": "inc", "inc": "inc", "limited": "ltd", "ltd": "ltd", "private": "pvt", "pvt": "pvt", "pte": "pvt", "llc": "llc", "l.l.c.": "llc", "llp": "llp", "l.l.p.": "llp", "company": "co", "co": "co",
    "gmbh": "gmbh", "sa": "sa", "s.a": "sa", "sarl": "sarl", "bv": "bv", "b.v": "bv", "plc": "plc", "enterprises": "ent", "technologies": "tech", "technology": "tech", "tech": "tech", "solutions": "soln", "solution": "soln", "services": "serv",
    "service": "serv", "international": "intl", "intl": "intl", "group": "grp", "holdings": "hldg", "l.l.c": "llc", "corp.x": "corpx",
}
ADDRESSES = {
    "street": "st", "st": "st", "road": "rd", "rd": "rd", "avenue": "ave", "ave": "ave", "boulevard": "blvd", "blvd": "blvd", "drive": "dr", "dr": "dr", "lane": "ln", "ln": "ln", "floor": "fl", "flr": "fl", "fl": "fl", "suite": "ste", "ste": "ste",
    "apartment": "apt", "apt": "apt", "building": "bldg", "bldg": "bldg", "highway": "hwy", "hwy": "hwy", "parkway": "pkwy", "pkwy": "pkwy", "court": "ct", "ct": "ct", "place": "pl", "pl": "pl", "square": "sq", "sq": "sq", "circle": "cir", "cir": "cir",
    "number": "no", "num": "no", "no": "no", "p.o. box": "pobox", "po box": "pobox", "p o box": "pobox", "post  office box": "pobox",
}


def test_every_rule_has_its_fixed_text(spark):
    rows = [(f"n{i}", f"Acme {w} x", "") for i, w in enumerate(RULES)] + [(f"a{i}", "", f"7 {w.upper()} x") for i, w in enumerate(ADDRESSES)]
    got = {r.id: r.norm_name or r.norm_address for r in N.preprocess(spark.createDataFrame(rows, "id string, name string, address string"), "s").collect()}
    assert {w: got[f"n{i}"] for i, w in enumerate(RULES)} == {w: f"acme {x} x" for w, x in (RULES | {"l.l.c.": "llc", "l.l.p.": "llp"}).items()}
    assert {w: got[f"a{i}"] for i, w in enumerate(ADDRESSES)} == {w: f"7 {x} x" for w, x in ADDRESSES.items()}


def plain_fold(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c))


def plain_name(text):
    x = re.sub(r"\s*\+\s*", " and ", re.sub(r"\s*&\s*", " and ", plain_fold(text).lower()))
    for pattern, short in oracles._NAME_RULES:
        x = re.sub(rf"\b{pattern}\b", short, x)
    return " ".join(re.sub(r"[-_]", " ", re.sub(r"[^\w\s-]", " ", x)).split())


def plain_address(text):
    x = plain_fold(text).lower()
    for pattern, short in oracles._ADDRESS_RULES:
        x = re.sub(rf"\b{pattern}\b", short, x)
    return " ".join(re.sub(r"[^\w\s]", " ", x).split())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_unicode_fold_of_whole_texts_equals_plain_python(spark):
    texts = {f"S{r.doc_id}": r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.queries()["unicode_fold"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts) > 100
    for r in got:
        text = texts[f"S{int(r.id[3:])}"]
        assert (r.norm_name, r.norm_address) == (plain_name(text), plain_address(text)), r.id
    assert sum(not (t or "").isascii() for t in texts.values()) > 20


def spark_hash(*values):
    """xxhash64 of a row: each value is hashed with the hash so far as seed."""
    xxhash = pytest.importorskip("xxhash")
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, Int) else "<q", v)
        h = xxhash.xxh64_intdigest(data, h & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


class Int(int):
    """A 32-bit integer."""


def test_split_equals_plain_hashes(spark):
    ids = [f"S1_{i:08d}" for i in range(500)]
    train, val = split_entities(spark.createDataFrame([(i,) for i in ids], "s1_id string"))
    assert {r.s1_id for r in val.collect()} == {i for i in ids if spark_hash(i, Int(42)) % 5 == 0}
    assert {r.s1_id for r in train.collect()} == {i for i in ids if spark_hash(i, Int(42)) % 5}


def test_noise_equals_plain_python(spark):
    rows = [(i, *SOURCE1.split("\n")[i % 12].split("|")) for i in range(400)]

    def draw(*key, what):
        return spark_hash(*key, Int(42), what) % 2**30 / 2**30

    def short(text, pairs):
        for a, b in pairs:
            text = text.replace(a, b)
        return text

    want = {}
    for k, name, address, country in rows:
        m = draw(k, what="plan")
        for source in [] if m < 0.2 else [2] if m < 0.6 else [3] if m < 0.8 else [2, 3]:
            key = (k, Int(source))
            words, r = name.split(), draw(*key, what="name")
            n = name
            if r < 0.25:
                n = short(name, (("Corporation", "Corp"), ("Incorporated", "Inc"), ("Limited", "Ltd"), ("Private Limited", "Pvt. Ltd."), ("LLC", "L.L.C.")))
            elif r < 0.45:
                n = name.replace(" & ", " and ") if " & " in name else name.replace(" and ", " & ")
            elif r < 0.60 and len(words) > 2:
                at = math.floor(draw(*key, what="word") * (len(words) - 2)) + 1
                n = " ".join(w for i, w in enumerate(words) if i != at)
            elif r < 0.75 and len(name) > 4:
                at = math.floor(draw(*key, what="letter") * max(len(name) - 5, 1)) + 2
                n = name[:at] + name[at].lower() + name[at + 1 :]
            r, parts = draw(*key, what="address"), address.split(",")
            a = address
            if r < 0.30:
                a = short(address, (("Street", "St."), ("Avenue", "Ave"), ("Boulevard", "Blvd"), ("Road", "Rd"), ("Suite", "Ste"), ("Floor", "Fl")))
            elif r < 0.55:
                a = ",".join(parts[:1] + parts[2:]) if len(parts) > 2 else address
            elif r < 0.70:
                a = address.lower()
            want[k, source] = (n, a, "" if draw(*key, what="country") < 0.1 else country)
    got = generator.noisy_records(spark.createDataFrame(rows, "key long, name string, address string, country string"), 42).collect()
    assert {(r.key, r.source): (r.name, r.address, r.country) for r in got} == want and len(want) > 300


def test_balanced_weights():
    balance = Row(positives=10, negatives=90, scale_pos=5.0)
    assert PairClassifier()._weight(balance) == 5.0 and PairClassifier(balanced=True)._weight(balance) == 9.0


def test_classifier(spark, sample, tmp_path):
    s1, t = sample
    good = spark.createDataFrame(sorted(pairs_of(MATCHES)), "s1_id string, target_id string").withColumn("y", F.lit(1))
    f = pair_features(blocking.candidates(s1, t), s1, t).join(good, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("y", F.lit(0))).drop("y")
    with pytest.raises(ValueError):
        PairClassifier().predict_proba(f)
    assert PairClassifier().importances() == {}
    m = PairClassifier(rounds=5).fit(f)
    probs = {(r.s1_id, r.target_id): r.prob for r in m.predict_proba(f).collect()}
    assert all((p >= 0.5) == (k in pairs_of(MATCHES)) for k, p in probs.items()) and abs(sum(m.importances().values()) - 1) < 1e-6
    m.save(f"{tmp_path}/model")
    again = {(r.s1_id, r.target_id): r.prob for r in PairClassifier.load(f"{tmp_path}/model").predict_proba(f).collect()}
    assert again == probs
    a, b = split_entities(spark.range(1000).select(F.col("id").cast("string").alias("s1_id")))
    assert a.count() + b.count() == 1000 and 140 < b.count() < 260


def test_score_pairs(spark):
    body = json.dumps({"entity_a": {"name": "Acme Global Corp", "address": "1 Main St", "country": "US"}, "entity_b": {"name": "Acme Global Corporation", "address": "1 Main Street", "country": "USA"}})
    r = score_pairs(tables.parse_requests(spark.createDataFrame([(body,), ("{}",)], "request string"))).orderBy("name_exact").collect()
    assert r[1].is_match and r[1].composite_sim == 1.0 and r[0].missing_c_addr == 1.0 and r[1].is_source2 == 1.0


def test_stream(spark, sample, tmp_path):
    from kindred.streaming.match import stream_key_pairs

    s1, t = sample
    s1.write.parquet(f"{tmp_path}/in")
    q = stream_key_pairs(spark.readStream.schema(s1.schema).parquet(f"{tmp_path}/in"), t).writeStream.format("memory").queryName("pairs_now").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = {(r.s1_id, r.target_id, r["pass"]) for r in stream_key_pairs(s1, t).collect()}
    assert want and {(r.s1_id, r.target_id, r["pass"]) for r in spark.table("pairs_now").collect()} == want


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query", ["feat_token_overlap", "feat_all", "composite_score", "feat_ngram"])
def test_feature_queries_do_not_shuffle_pairs(spark, query):
    """records meet at their keys; pairs are not dealt out by their ids."""
    plan = queries.queries()[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and not re.findall(r"Exchange hashpartitioning\((?:s1_id|target_id)#.*", plan)


def test_records_that_meet_at_keys_are_the_compatible_pairs(spark):
    """Each pair once, with the last record of a repeated id, and the features of the plain path."""
    s1, t = fixtures.sides(fixtures.repeated(spark, SF))
    got = queries.key_features(s1, t)
    want = pair_features(queries.key_candidates(s1, t), s1, t).select(got.columns)
    rounded = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    got = rounded(got)
    assert got and got == rounded(want)


def test_gram_numbers_tell_grams_apart(spark):
    texts = [("abcabc", "bcabca"), ("é🎉é🎉x", "🎉é🎉"), ("ab", "abc"), ("", "abc"), ("日本語テ", "日本語ト")]
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(texts, "a string, b string")
    for n in (2, 3):
        x = df.select(S.ngram_jaccard(a, b, n).alias("x"), S.ngram_jaccard(a, b, n, (S.gram_codes(a, n), S.gram_codes(b, n))).alias("y"), F.size(S.gram_codes(a, n)).alias("k"), F.size(S.ngrams(a, n)).alias("m")).collect()
        assert all(r.x == r.y and r.k == r.m for r in x)


def plain_neighbours(s1, targets, k, least):
    """TF-IDF neighbours of (id, name) pairs, by dictionaries."""
    from collections import Counter
    from math import log, sqrt

    def tf(name):
        padded = [f" {w} " for w in name.split(" ")]
        return Counter(w[i : i + n] for w in padded for n in (2, 3, 4) for i in range(len(w) - n + 1))

    df = Counter(g for _, name in targets for g in tf(name))

    def unit(name):
        v = {g: c * (log((1 + len(targets)) / (1 + df[g])) + 1) for g, c in tf(name).items() if g in df}
        length = sqrt(sum(x * x for x in v.values()))
        return {g: x / length for g, x in v.items()}

    known, out = [(i, unit(name)) for i, name in targets], set()
    for i, name in s1:
        v = unit(name)
        sims = sorted((-round(sum(x * t[g] for g, x in v.items() if g in t), 6), j) for j, t in known if v.keys() & t.keys())
        out |= {(i, j, -sim) for sim, j in sims[:k] if -sim >= least}
    return out


def test_neighbours_of_names_that_share_their_grams(spark, monkeypatch):
    """equal to plain dictionaries, in blocks, with ties and names of several targets; what is written grows with names, not with the pairs that share grams."""
    first, second, third = ("red", "blue", "old ring", "é🎉 ring", "red red"), ("gear", "bolt", "anvil"), ("brand 1", "brand 12", "brand 3 tech corp", "x")
    names = [f"{a} {b} {c}" for a in first for b in second for c in third]
    s1 = [(f"S1_{i:04d}", n) for i, n in enumerate([*names, "", "qqq", names[0]])]
    targets = [(f"S2_{(i * 37) % 1000:04d}", n) for i, n in enumerate([*names, *names[::3], *names[::3], *names[::3], *names[::3], "ring"])]
    frame = lambda rows, source: spark.createDataFrame([(i, n, source) for i, n in rows], "id string, norm_name string, source string")
    written, cut = [], blocking.cut
    monkeypatch.setattr(blocking, "cut", lambda *x: written.append(cut(*x)) or written[-1])
    monkeypatch.setattr(blocking, "NAMES", 25, raising=False)
    got = {tuple(r) for r in blocking.tfidf_pairs(frame(s1, "source1"), frame(targets, "source2"), 7).collect()}
    plain = [(i, n or "unknown") for i, n in s1]
    assert got == plain_neighbours(plain, targets, 7, blocking.LEAST_COSINE) and len(got) > 400
    assert max(w.count() for w in written) <= 7 * len(s1)


def test_neighbours_of_a_repeated_id_are_those_of_its_last_name(spark):
    rows = [("S1_1", "red gear", "source1", 1), ("S1_1", "blue bolt", "source1", 2)], [("S2_1", "blue bolt", "source2", 1), ("S2_2", "blue bolt", "source2", 1), ("S2_2", "red gear", "source2", 2)]
    s1, t = (spark.createDataFrame(r, "id string, norm_name string, source string, row_order int") for r in rows)
    assert [(r.s1_id, r.target_id, r.sim) for r in blocking.tfidf_pairs(s1, t).collect()] == [("S1_1", "S2_1", 1.0)]


def test_neighbours_among_no_records(spark):
    none = spark.createDataFrame([], "id string, norm_name string, source string")
    one = spark.createDataFrame([("S1_1", "red gear", "source1")], none.schema)
    assert not blocking.tfidf_pairs(one, none).collect() and not blocking.tfidf_pairs(none, one).collect()


@pytest.mark.parametrize("cap", [2, 80])
def test_candidates_of_frequent_names(spark, cap):
    """equal to the plain path, also for repeated ids; pairs are dealt out once, by s1_id."""
    s1, t = fixtures.sides(fixtures.repeated(spark, SF))
    same = s1.where("id < 'S1_00000030'").withColumn("norm_name", F.lit("red gear")).withColumn("norm_country", F.when(F.col("id") < "S1_00000015", "us").otherwise("india"))
    s1 = s1.unionByName(same.withColumn("id", F.concat("id", F.lit("x"))))
    t = t.unionByName(same.withColumn("id", F.concat(F.lit("S2_"), F.substring("id", 4, 8), F.lit("x"))).withColumn("source", F.lit("source2")))
    got = blocking.candidates(s1, t, cap)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"Exchange hashpartitioning\((?:s1_id#\d+, target_id|target_id).*", plan)
    every = {(r.s1_id, r.target_id) for r in blocking.compatible(blocking.key_pairs(s1, t), s1, t).unionByName(blocking.tfidf_pairs(s1, t), allowMissingColumns=True).collect()}
    of = {}
    for a, b in sorted(every):
        of.setdefault(a, []).append(b)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(a, b) for a, bs in of.items() for b in bs[:cap]}


def test_resolving_normalises_names_once(spark):
    """F8: features read the records that were written for blocking; nothing above them is normalised or joined a second time."""
    found = queries.flagship(spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "regexp_replace" not in plan and found.columns == ["source1_entity_id", "matched_entity_ids"]


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """A folder with a part table of a few parts and their copies under other keys, of which names and addresses repeat."""
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 8")
    folder = str(tmp_path_factory.mktemp("copies"))
    part.crossJoin(spark.range(100).select((F.col("id") * 90_000).alias("more"))).withColumn("p_partkey", F.col("p_partkey") + F.col("more")).drop("more").dropDuplicates(["p_partkey"]).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


def by_sql(folder, sql):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view part as select * from '{folder}/part.parquet/*.parquet'")
    return sorted(map(tuple, con.execute(sql).fetchall()))


def test_resolving_keeps_every_candidate(spark, copies):
    """an entity with more than 80 candidates keeps all that match, as the SQL without a cap does."""
    got = sorted(map(tuple, queries.queries()["resolve"](spark, copies).collect()))
    assert max(text.count("S") for _, text in got) > 80
    assert got == by_sql(copies, oracles.oracle_sql()["resolve"])


def test_equal_records_are_compared_once(spark, copies, monkeypatch):
    """copies form classes, of which pairs are made; split into parts and dealt out, they are the SQL's pairs."""
    monkeypatch.setattr(blocking, "IDS", 3, raising=False)
    monkeypatch.setattr(blocking, "PROBES", 2, raising=False)
    s1, t = fixtures.sides(fixtures.biz_once(spark, copies))
    classes = blocking.compatible_classes(s1, t)
    n = classes.agg(F.sum(F.size("s1_ids") * F.size("target_ids"))).first()[0]
    monkeypatch.setattr(blocking, "IDS", 1000, raising=False)
    assert blocking.compatible_classes(s1, t).count() * 5 < n
    want = by_sql(copies, oracles.oracle_sql()["composite_score"])
    got = blocking.each_pair(with_features(classes).select("s1_ids", "target_ids", *[F.round(c, 6) for c in ("composite_sim", "min_sim", "max_sim", "harmonic_sim")]))
    assert n == len(want) and sorted(map(tuple, got.collect())) == want


def test_counted_pairs_are_the_pairs(spark, copies, tmp_path):
    """rows of the training stand for all pairs, by features, label and side of the split."""
    few = str(tmp_path)
    spark.read.parquet(f"{copies}/part.parquet").where("p_partkey % 90000 in (2, 6)").write.parquet(f"{few}/part.parquet")
    s1, t = fixtures.sides(fixtures.biz_once(spark, few))
    truth = fixtures.biz_truth(spark, few)
    classes = with_features(blocking.compatible_classes(s1, t, truth))
    rows = blocking.counted_pairs(classes, in_validation, FEATURES).persist()
    plain = labelled(queries.key_features(s1, t), truth).withColumn("validation", in_validation(F.col("s1_id"))).persist()
    count = lambda df, n: sorted(map(tuple, df.groupBy("validation", "label", "composite_sim", "name_lev").agg(n.cast("long")).collect()))
    assert count(rows, F.sum("times")) == count(plain, F.count("*")) and rows.count() * 5 < plain.count()
    assert evaluate.class_balance(rows).first() == evaluate.class_balance(plain).first()
    pairs = lambda df: sorted(map(tuple, df.select("s1_id", "target_id", "label").collect()))
    assert pairs(blocking.each_pair(classes)) == pairs(plain)
