"""Queries over the derived record tables: one for each operator of the engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.similarity import sigmoid_score
from kindred.operators import blocking, evaluate
from kindred.operators.features import FEATURES, labelled, last_records, with_features
from kindred.operators.validate import summary, violations
from kindred.scratch import cut
from kindred.sources import generator, sinks, tables

from . import fixtures
from .classifier import PairClassifier, in_validation, split_entities
from .resolve import results_view, rule_matches, score_pairs, spine

Query = Callable[[SparkSession, str], DataFrame]
THRESHOLD = 0.62


def _on_records(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(fixtures.biz(s, d))


def _block(name: str, records: Callable[[SparkSession, str], DataFrame] = fixtures.biz) -> Query:
    return lambda s, d: (lambda s1, t: blocking.key_pairs(s1, t, only=name).select("s1_id", "target_id"))(*fixtures.sides(records(s, d)))


def _on_sides(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(*fixtures.sides(fixtures.biz(s, d)))


def key_candidates(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Compatible key pairs: what the feature queries work on."""
    return blocking.compatible(blocking.key_pairs(s1, targets), s1, targets).select("s1_id", "target_id")


def key_features(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """pair_features() of the key candidates, without a shuffle of pairs."""
    return blocking.each_pair(with_features(blocking.compatible_classes(s1, targets)))


def _features(*columns: str) -> Query:
    def q(s1: DataFrame, t: DataFrame) -> DataFrame:
        return blocking.each_pair(with_features(blocking.compatible_classes(s1, t)).select("s1_ids", "target_ids", *[F.round(c, 6).alias(c) for c in columns]))

    return lambda s, d: q(*fixtures.sides(fixtures.biz_once(s, d)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, target_id, prob, label): key candidates with a score that needs no training, rounded."""
    s1, t = fixtures.sides(fixtures.biz(spark, sf_dir))
    f = key_features(s1, t).select("s1_id", "target_id", F.round(sigmoid_score(F.col("composite_sim")), 6).alias("prob"))
    return labelled(f, fixtures.biz_truth(spark, sf_dir))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where(F.col("prob") >= THRESHOLD).select("s1_id", "target_id", "prob")


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.biz_raw(spark, sf_dir).where("source = 'source1'").select(F.col("id").alias("s1_id"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth as a file of lists would have it."""
    return sinks.per_entity(_spine(spark, sf_dir), fixtures.biz_truth(spark, sf_dir), "matched_entity_ids")


def candidate_lists(s: SparkSession, d: str) -> DataFrame:
    s1, t = fixtures.sides(fixtures.biz(s, d))
    return sinks.candidate_output(spine(s1), key_candidates(s1, t), matches(s, d))


def broken_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of result tables with seeded faults: entities missing, repeated and unknown, matches repeated, unknown and not among candidates."""
    raw = fixtures.biz_raw(spark, sf_dir)
    good = truth_lists(spark, sf_dir).withColumn("k", F.substring("source1_entity_id", 4, 8).cast("int"))
    ids, text = F.col("source1_entity_id"), F.col("matched_entity_ids")
    wrong = F.when(F.col("k") % 97 == 3, F.concat(F.lit("[S2_00000000, S2_00000000]"))).otherwise(text)
    m = good.where("k % 101 <> 5").select(F.when(F.col("k") % 103 == 7, F.concat(F.lit("X"), ids)).otherwise(ids).alias("source1_entity_id"), wrong.alias("matched_entity_ids"))
    m = m.union(good.where("k % 107 = 9").select(ids, text))
    c = good.select(ids, F.when(F.col("k") % 89 == 2, "[]").otherwise(text).alias("candidate_entity_ids"))
    part = lambda n: raw.where(f"source = 'source{n}'").select("id")
    return violations(m, c, part(1), part(2), part(3))


def gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of equal features, label and side of the split are one row of the training, which stands for all of them by its number of pairs."""
    s1, t = fixtures.sides(fixtures.biz_once(spark, sf_dir))
    classes = cut(with_features(blocking.compatible_classes(s1, t, fixtures.biz_truth(spark, sf_dir))))  # read for the training and for the scores
    rows = cut(blocking.counted_pairs(classes, in_validation, FEATURES))
    model = PairClassifier().fit(rows.where("not validation").drop("validation"), rows.where("validation").drop("validation"))
    return blocking.each_pair(model.predict_proba(classes).select("s1_ids", "s1_true", "target_ids", "prob")).select("s1_id", "target_id", "label", "prob")


def truth_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth as lists, a third of the entities with an earlier, wrong list; the place is in row_order."""
    good = truth_lists(spark, sf_dir).withColumn("row_order", F.lit(2))
    early = good.where("cast(substring(source1_entity_id, 4, 8) as int) % 3 = 0").withColumn("matched_entity_ids", F.lit("[S9_1, S9_2]")).withColumn("row_order", F.lit(1))
    return tables.ground_truth(good.unionByName(early).orderBy(F.xxhash64("source1_entity_id", "row_order")))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fixtures.biz(spark, sf_dir)
    return evaluate.input_counts(*[n.where(f"source = 'source{k}'") for k in (1, 2, 3)], fixtures.biz_truth(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True pairs as JSON requests."""
    raw = fixtures.biz_raw(spark, sf_dir)
    side = lambda k: F.struct(F.col("raw_name").alias("name"), F.col("raw_address").alias("address"), F.col("raw_country").alias("country")).alias(k)
    a = raw.where("source = 'source1'").select("k", side("entity_a"))
    b = raw.where("source <> 'source1'").select("k", F.col("id").alias("_id"), side("entity_b"))
    parsed = a.join(b, "k").select("_id", F.to_json(F.struct("entity_a", "entity_b")).alias("request"))
    return parsed.select("_id", F.from_json("request", tables.REQUEST).alias("r")).select("_id", "r.entity_a", "r.entity_b")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of all passes and TF-IDF, features, calibrated score, matches of each entity. Records are written first: blocking and features read them, and names are normalised once."""
    s1, t = map(blocking.written, fixtures.sides(fixtures.biz_once(spark, sf_dir)))
    return sinks.matching_output(spine(s1.select("id")), rule_matches(s1, t, THRESHOLD))


def queries() -> dict[str, Query]:
    text = lambda c: F.array_join(c, " ").alias(c)
    blocks = {"exact": "block_exact", "first": "block_first_token", "number": "block_numeric", "address": "block_address"}
    return {
        "norm_name": _on_records(lambda n: n.select("id", "norm_name", F.size("name_tokens").cast("long").alias("n_tokens"))),
        "norm_address": _on_records(lambda n: n.select("id", "norm_address")),
        "norm_country": _on_records(lambda n: n.select("id", "norm_country")),
        "numeric_tokens": _on_records(lambda n: n.select("id", text("numeric_tokens"))),
        "missing_flags": _on_records(lambda n: n.select("id", "missing_name", "missing_address", "missing_country")),
        "preprocess": _on_records(lambda n: n.select("id", "source", "raw_name", "raw_address", "raw_country", "norm_name", text("name_tokens"), "norm_address", text("addr_tokens"), text("numeric_tokens"), "norm_country")),
        "unicode_fold": lambda s, d: fixtures.doc(s, d).select("id", "norm_name", "norm_address", "norm_country"),
        "entity_ids": lambda s, d: tables.entity_ids(fixtures.biz_raw(s, d).select("id")),
        "ground_truth_list": lambda s, d: tables.ground_truth(truth_lists(s, d)),
        "ground_truth_pairs": lambda s, d: tables.ground_truth(fixtures.biz_truth(s, d)),
        "ground_truth_last": truth_twice,
        "last_records": lambda s, d: last_records(fixtures.repeated(s, d)).select("id", "r.norm_name", "r.norm_address", "r.norm_country"),
        "input_counts": counts,
        **{name: _block(p) for p, name in blocks.items()},
        **{name: _block(p, fixtures.coded) for p, name in (("prefix", "block_prefix3"), ("token", "block_token"))},
        "pool_sizes": _on_sides(lambda s1, t: blocking.pool_sizes(t)),
        "block_country_filter": _on_sides(key_candidates),
        "block_passes": _on_sides(lambda s1, t: blocking.key_pairs(s1, t).select("s1_id", "target_id", F.array_join("passes", ",").alias("passes"))),
        "block_tfidf_topk": _on_sides(blocking.tfidf_pairs),
        "block_union_cap": _on_sides(lambda s1, t: blocking.candidates(s1, t, cap=80)),
        "candidate_recall": lambda s, d: _rounded(blocking.recall(key_candidates(*fixtures.sides(fixtures.biz(s, d))), fixtures.biz_truth(s, d), _spine(s, d))),
        "candidate_stats": lambda s, d: _rounded(evaluate.candidate_stats(_spine(s, d), key_candidates(*fixtures.sides(fixtures.biz(s, d))))),
        "feat_token_overlap": _features("name_exact", "name_token_exact", "name_jaccard", "name_overlap", "name_common_tokens", "addr_exact", "addr_jaccard", "addr_overlap", "addr_common_tokens"),
        "feat_ngram": _features("name_ngram2", "name_ngram3", "addr_ngram3"),
        "feat_indel": _features("name_lev", "addr_lev"),
        "feat_numeric": _features("num_overlap", "num_common_count"),
        "feat_country": _features("country_match", "country_conflict", "missing_s1_addr", "missing_c_addr", "is_source2", "is_source3"),
        "feat_length": _features("name_len_diff", "name_len_ratio", "addr_len_diff"),
        "composite_score": _features("composite_sim", "min_sim", "max_sim", "harmonic_sim"),
        "feat_all": _features(*FEATURES),
        "sigmoid_score": scored,
        "label_attach": lambda s, d: labelled(key_candidates(*fixtures.sides(fixtures.biz(s, d))), fixtures.biz_truth(s, d)),
        "pair_metrics": lambda s, d: _rounded(evaluate.pair_metrics(scored(s, d), THRESHOLD)),
        "threshold_curve": lambda s, d: _rounded(evaluate.threshold_curve(scored(s, d))),
        "best_threshold": lambda s, d: _rounded(evaluate.best_threshold(evaluate.threshold_curve(scored(s, d)))),
        "entity_metrics": lambda s, d: _rounded(evaluate.entity_metrics(_spine(s, d), fixtures.biz_truth(s, d), matches(s, d), THRESHOLD)),
        "class_balance": lambda s, d: _rounded(evaluate.class_balance(scored(s, d))),
        "status_counts": lambda s, d: evaluate.status_counts(_spine(s, d), matches(s, d)),
        "match_status": lambda s, d: evaluate.match_counts(_spine(s, d), matches(s, d)),
        "matching_output": lambda s, d: sinks.matching_output(_spine(s, d), matches(s, d)),
        "candidate_output": candidate_lists,
        "results_view": lambda s, d: results_view(
            fixtures.biz_raw(s, d).where("source = 'source1'").select("id", F.col("raw_name").alias("name"), F.col("raw_address").alias("address"), F.col("raw_country").alias("country")), truth_lists(s, d)
        ).withColumn("matches", F.array_join("matches", ",")),
        "validate_violations": broken_results,
        "validate_summary": lambda s, d: summary(truth_lists(s, d)),
        "score_pair": lambda s, d: score_pairs(requests(s, d), THRESHOLD).select("id", *[F.round(c, 6).alias(c) for c in ("composite_sim", "probability", "threshold")], "is_match"),
        "split_entities": lambda s, d: (lambda a, b: a.withColumn("side", F.lit("train")).unionByName(b.withColumn("side", F.lit("validation"))))(*split_entities(_spine(s, d))),
        "synthetic_noise": lambda s, d: generator.noisy_records(fixtures.biz_raw(s, d).where("source = 'source1'").select(F.col("k").alias("key"), F.col("raw_name").alias("name"), F.col("raw_address").alias("address"), F.col("raw_country").alias("country")), 42),
        "gbt_score": gbt_score,
        "resolve": flagship,
    }
