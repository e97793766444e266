"""Integrity checks of result tables, as a table of violations (check, id, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.tables import entity_ids, id_list, read_tsv

MATCH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]
SCHEMA = "check string, id string, detail string"


def _rows(df: DataFrame, check: str, id_: str, detail) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(id_).cast("string").alias("id"), F.lit(detail).alias("detail") if isinstance(detail, str) else detail.cast("string").alias("detail"))


def violations(matching: DataFrame, candidate: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """All violations; no rows mean that the tables are valid. The names of the checks are those of the design notes (V3 to V9)."""
    spark = matching.sparkSession
    bad = [(c, None, f"columns are {df.columns}") for c, df, want in (("V3", matching, MATCH_COLUMNS), ("V6", candidate, CANDIDATE_COLUMNS)) if df.columns != want]
    if bad:
        return spark.createDataFrame(bad, SCHEMA)
    ids = entity_ids(s1)
    known = entity_ids(s2).union(entity_ids(s3)).distinct()
    m = matching.select(F.trim(F.col(MATCH_COLUMNS[0])).alias("s1"), id_list(F.col(MATCH_COLUMNS[1])).alias("ids"))
    c = candidate.select(F.trim(F.col(CANDIDATE_COLUMNS[0])).alias("s1"), id_list(F.col(CANDIDATE_COLUMNS[1])).alias("ids")).where("s1 is not null")
    out = [_rows(m.where("s1 is null"), "V4", "s1", "missing id")]
    for check, df, also in (("V4", m.where("s1 is not null"), "V5"), ("V7", c, "V7")):
        out.append(_rows(df.groupBy("s1").count().where("count > 1"), check, "s1", "repeated id"))
        out.append(_rows(ids.join(df, ids.id == df.s1, "left_anti"), also, "id", "missing entity"))
        out.append(_rows(df.select("s1").distinct().join(ids, F.col("s1") == ids.id, "left_anti"), also, "s1", "unknown entity"))
    each = m.select("s1", F.explode("ids").alias("t"))
    out.append(_rows(each.groupBy("s1", "t").count().where("count > 1"), "V8", "s1", F.col("t")))
    pairs = each.distinct()
    out.append(_rows(pairs.join(known, pairs.t == known.id, "left_anti"), "V9", "s1", F.concat(F.lit("unknown match "), F.col("t"))))
    listed = c.select("s1", F.explode("ids").alias("t")).distinct()
    out.append(_rows(pairs.join(listed, ["s1", "t"], "left_anti"), "V9", "s1", F.concat(F.lit("no candidate "), F.col("t"))))
    return reduce(DataFrame.unionByName, out)


def validate_files(spark: SparkSession, matching: str, candidate: str, test_dir: str) -> DataFrame:
    """violations() of files; a file that can't be read is V1 (results) or V2 (sources)."""
    paths = [("V1", matching), ("V1", candidate), *[("V2", f"{test_dir}/test_source{k}.tsv") for k in (1, 2, 3)]]
    tables, bad = [], []
    for check, p in paths:
        try:
            tables.append(read_tsv(spark, p))
        except AnalysisException as e:
            bad.append((check, None, f"{p}: {e.getCondition()}"))
    return spark.createDataFrame(bad, SCHEMA) if bad else violations(*tables)


def summary(matching: DataFrame) -> DataFrame:
    """One row of a valid table of matches: entities, total_matches, singletons, multi_matches."""
    n = F.size(id_list(F.col(MATCH_COLUMNS[1])))
    return matching.agg(F.count("*").alias("entities"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_matches"), F.count_if(n == 0).alias("singletons"), F.count_if(n > 1).alias("multi_matches"))


def is_valid(found: DataFrame) -> bool:
    return found.isEmpty()
