"""Whole runs: resolve two tables, train and evaluate, score single pairs, show results."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.normalize import discover_roles, preprocess
from kindred.functions.similarity import sigmoid_score
from kindred.operators import evaluate
from kindred.operators.blocking import candidates, compatible_classes, each_pair, recall, tfidf_pairs
from kindred.operators.evaluate import input_counts
from kindred.operators.features import labelled, pair_features, with_features
from kindred.operators.validate import is_valid, validate_files
from kindred.sources.sinks import candidate_output, matching_output, write_text, write_tsv
from kindred.sources.tables import CURVE, ROW_ORDER, ground_truth, id_list, read_tsv

from .classifier import PairClassifier, split_entities

DEFAULT_THRESHOLD = 0.62


def sources(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The record tables of sources 1, 2 and 3, with the place of each row in its file."""
    return tuple(preprocess(read_tsv(spark, f"{folder}/{split}_source{k}.tsv", order=True), f"source{k}") for k in (1, 2, 3))


def spine(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("id").alias("s1_id"), *[c for c in s1.columns if c == ROW_ORDER])


def rule_matches(s1: DataFrame, targets: DataFrame, threshold: float) -> DataFrame:
    """resolve_by_rule(), a pair that is found by keys and by TF-IDF twice. Every candidate is scored; key pairs by classes of equal records."""
    score = sigmoid_score(F.col("composite_sim")).alias("prob")
    alike = with_features(compatible_classes(s1, targets)).select("s1_ids", "target_ids", score).where(F.col("prob") >= threshold)
    near = pair_features(tfidf_pairs(s1, targets), s1, targets).select("s1_id", "target_id", score).where(F.col("prob") >= threshold)
    return each_pair(alike).unionByName(near)


def resolve_by_rule(s1: DataFrame, targets: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(s1_id, target_id, prob) of candidates whose calibrated composite similarity reaches the threshold; no training, and no cap on the candidates of an entity."""
    return rule_matches(s1, targets, threshold).dropDuplicates(["s1_id", "target_id"])


def run_pipeline(spark: SparkSession, train_dir: str, test_dir: str, output_dir: str, seed: int = 42, skip_validation: bool = False, single_files: bool = True) -> dict:
    """Trains on the training files, chooses the threshold on held-out entities, resolves the test files, writes results (in input order) and report, checks them.

    single_files: each result is one file, as the report always is; otherwise a folder of files in order, for results that one task should not write.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return held[-1]

    try:
        return _run(spark, train_dir, test_dir, output_dir, seed, skip_validation, single_files, hold)
    finally:
        for df in held:
            df.unpersist()


def _run(spark: SparkSession, train_dir: str, test_dir: str, output_dir: str, seed: int, skip_validation: bool, single_files: bool, hold: Callable[[DataFrame], DataFrame]) -> dict:
    s1, s2, s3 = map(hold, sources(spark, train_dir, "train"))
    targets = s2.unionByName(s3)
    truth = hold(ground_truth(read_tsv(spark, f"{train_dir}/train_ground_truth.tsv", order=True)))
    counts = {f"train_{k}": n for k, n in input_counts(s1, s2, s3, truth).collect()}
    train_ids, val_ids = split_entities(spine(s1), seed)
    found = candidates(s1, targets, cap=80)
    covered = recall(found, truth, val_ids).first()
    positives = truth.where("target_id is not null").join(train_ids, "s1_id", "left_semi").select("s1_id", "target_id")
    pairs = found.union(positives).distinct()
    features = hold(labelled(pair_features(pairs, s1, targets), truth))
    train, val = features.join(train_ids, "s1_id", "left_semi"), features.join(val_ids, "s1_id", "left_semi")
    model = PairClassifier(seed).fit(train, val)
    scored = hold(model.predict_proba(val))
    curve = hold(evaluate.threshold_curve(scored))
    best = evaluate.best_threshold(curve).first()
    by_entity = evaluate.entity_metrics(val_ids, truth, scored.where(F.col("prob") >= best.threshold), best.threshold).first().asDict()
    top = list(model.importances().items())[:5]
    model.fit(features)  # the threshold stays that of the first model

    t1, t2, t3 = map(hold, sources(spark, test_dir, "test"))
    counts |= {f"test_{k}": n for k, n in input_counts(t1, t2, t3).collect()}
    test_targets = t2.unionByName(t3)
    found = hold(candidates(t1, test_targets, cap=80))
    matches = hold(model.predict_proba(pair_features(found, t1, test_targets)).where(F.col("prob") >= best.threshold).select("s1_id", "target_id"))
    paths = {k: f"{output_dir}/{k}.tsv" for k in ("matching_results", "candidate_pairs")}
    write_tsv(matching_output(spine(t1), matches), paths["matching_results"], ROW_ORDER, single_files)
    write_tsv(candidate_output(spine(t1), found, matches), paths["candidate_pairs"], ROW_ORDER, single_files)
    status = evaluate.status_counts(spine(t1), matches).first()
    report = {
        "val_candidate_recall": covered.candidate_recall, "best_threshold": best.threshold, "val_precision": best.precision, "val_recall": best.recall, "val_f05": best.f05,
        "val_singleton_accuracy": by_entity["singleton_accuracy"], "test_s1_count": status["all"], "test_resolved_matches": status["total_matches"], "test_singletons": status["singletons"],
        "top_features": [[k, v] for k, v in top],
        "threshold_curve": [{c: r[c] for c in CURVE} for r in curve.orderBy("threshold").limit(20).collect()],
    }
    write_text(spark, json.dumps(report, indent=2), f"{output_dir}/experiment_report.json")
    ok = None
    if not skip_validation:
        ok = is_valid(validate_files(spark, paths["matching_results"], paths["candidate_pairs"], test_dir))
    return {"validation_passed": ok, "metrics": report, "entity_metrics": by_entity, "candidate_recall": covered.candidate_recall, "counts": counts, **paths}


def score_pairs(requests: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Of (entity_a, entity_b) structs of name, address, country: the features, probability, threshold and is_match. Side b counts as source2."""
    r = requests.withColumn("_id", F.monotonically_increasing_id()) if "_id" not in requests.columns else requests
    both = r.select(F.explode(F.array(*[F.struct(F.col("_id").cast("string").alias("id"), F.lit(s).alias("side"), *[F.col(f"entity_{k}.{c}").alias(c) for c in ("name", "address", "country")]) for k, s in (("a", "source1"), ("b", "source2"))])).alias("e")).select("e.*")
    n = preprocess(both, F.col("side"))
    fields = [c for c in n.columns if c != "id"]
    pairs = n.groupBy("id").agg(*[F.max(F.when(F.col("source") == s, F.struct(*fields))).alias(k) for k, s in (("a", "source1"), ("b", "source2"))])
    f = with_features(pairs).withColumn("probability", sigmoid_score(F.col("composite_sim")))
    return f.withColumn("threshold", F.lit(float(threshold))).withColumn("is_match", F.col("probability") >= F.col("threshold"))


def results_view(s1_raw: DataFrame, matching: DataFrame) -> DataFrame:
    """Matches of each source-1 row beside its raw fields; rows without a result have no matches. A column row_order stays."""
    order = [c for c in s1_raw.columns if c == ROW_ORDER]
    roles = discover_roles([c for c in s1_raw.columns if c != ROW_ORDER])
    info = s1_raw.select(*order, *[(F.coalesce(F.col(f"`{roles[k]}`"), F.lit("")) if k in roles else F.lit("")).alias(n) for k, n in (("id", "source1_entity_id"), ("name", "name"), ("address", "address"), ("country", "country"))])
    return info.join(matching, "source1_entity_id", "left").select("source1_entity_id", "name", "address", "country", id_list(F.col("matched_entity_ids")).alias("matches"), *order)
