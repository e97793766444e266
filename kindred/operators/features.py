"""The 29 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import similarity as S

#: Names of the features, in order (fixed values).
FEATURES = (
    "name_exact",
    "name_token_exact",
    "name_jaccard",
    "name_overlap",
    "name_common_tokens",
    "name_lev",
    "name_ngram2",
    "name_ngram3",
    "name_len_diff",
    "name_len_ratio",
    "addr_exact",
    "addr_jaccard",
    "addr_overlap",
    "addr_common_tokens",
    "addr_lev",
    "addr_ngram3",
    "addr_len_diff",
    "num_overlap",
    "num_common_count",
    "country_match",
    "country_conflict",
    "missing_s1_addr",
    "missing_c_addr",
    "is_source2",
    "is_source3",
    "composite_sim",
    "min_sim",
    "max_sim",
    "harmonic_sim",
)
FIELDS = ("source", "norm_name", "name_tokens", "norm_address", "addr_tokens", "numeric_tokens", "norm_country")
#: Gram sets that a record can have, made once for each record: name, text and width.
GRAMS = {"name_grams2": ("norm_name", 2), "name_grams3": ("norm_name", 3), "addr_grams3": ("norm_address", 3)}


def composite(name: Column, addr: Column, country: Column) -> Column:
    return 0.55 * name + 0.35 * addr + 0.10 * country


def country_agreement(a: Column, b: Column) -> tuple[Column, Column]:
    """(match, conflict): 1/0 if equal, 0/1 if not, 0.5/0 if one is unknown."""
    unknown = (a == "") | (b == "")
    return F.when(unknown, 0.5).when(a == b, 1.0).otherwise(0.0), F.when(unknown | (a == b), 0.0).otherwise(1.0)


def with_features(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs with struct columns a and b of record fields, with_grams() or not: their other columns and the features."""
    ready = set(GRAMS) <= set(pairs.schema[a].dataType.names) & set(pairs.schema[b].dataType.names)
    f = lambda side, k: F.col(f"{side}.{k}")
    keep = [c for c in pairs.columns if c not in (a, b)]
    # the two Python columns are evaluated once, below everything that uses them
    x = pairs.withColumns({"_nl": S.indel(f(a, "norm_name"), f(b, "norm_name")), "_al": S.indel(f(a, "norm_address"), f(b, "norm_address"))})
    nl, al = F.col("_nl"), F.col("_al")
    yes = lambda c: c.cast("double")
    ln = [F.char_length(f(s, "norm_name")) for s in (a, b)]
    la = [F.char_length(f(s, "norm_address")) for s in (a, b)]
    name = S.token_overlap(f(a, "name_tokens"), f(b, "name_tokens"))
    addr = S.token_overlap(f(a, "addr_tokens"), f(b, "addr_tokens"))
    num = S.numeric_overlap(f(a, "numeric_tokens"), f(b, "numeric_tokens"))
    match, conflict = country_agreement(f(a, "norm_country"), f(b, "norm_country"))
    jaccard = lambda g: S.ngram_jaccard(f(a, GRAMS[g][0]), f(b, GRAMS[g][0]), GRAMS[g][1], (f(a, g), f(b, g)) if ready else None)
    values = (
        yes((f(a, "norm_name") != "") & (f(a, "norm_name") == f(b, "norm_name"))),
        yes((F.size(f(a, "name_tokens")) > 0) & (f(a, "name_tokens") == f(b, "name_tokens"))),
        *name, nl, jaccard("name_grams2"), jaccard("name_grams3"),
        yes(F.abs(ln[0] - ln[1])), F.least(*ln) / F.greatest(*ln, F.lit(1)),
        yes((f(a, "norm_address") != "") & (f(a, "norm_address") == f(b, "norm_address"))),
        *addr, al, jaccard("addr_grams3"), yes(F.abs(la[0] - la[1])), *num, match, conflict,
        yes(f(a, "norm_address") == ""), yes(f(b, "norm_address") == ""), yes(f(b, "source").contains("2")), yes(f(b, "source").contains("3")),
        composite(nl, al, match), F.least(nl, al), F.greatest(nl, al), 2 * nl * al / (nl + al + 1e-6),
    )
    return x.select(*keep, *[v.alias(k) for k, v in zip(FEATURES, values, strict=True)])


def with_grams(records: DataFrame) -> DataFrame:
    """records with the sets GRAMS."""
    return records.select("*", *[S.gram_codes(F.col(c), n).alias(k) for k, (c, n) in GRAMS.items()])


def last_records(records: DataFrame) -> DataFrame:
    """(id, r: its fields) of each id once: the last of its rows, by source and row_order if there is such a column, else as the rows come."""
    order = F.col("row_order") if "row_order" in records.columns else F.monotonically_increasing_id()
    one = records.select("id", F.struct(F.col("source").alias("s"), order.alias("o")).alias("place"), F.struct(*FIELDS).alias("r"))
    return one.groupBy("id").agg(F.max_by("r", "place").alias("r"))


def record_pairs(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1_id, target_id, a, b): ids and the records; a pair with an unknown id is left out, and the last record of a repeated id counts."""
    side = lambda df, i, k: last_records(df).select(F.col("id").alias(i), F.col("r").alias(k))
    return pairs.select("s1_id", "target_id").join(side(s1, "s1_id", "a"), "s1_id").join(side(targets, "target_id", "b"), "target_id").select("s1_id", "target_id", "a", "b")


def pair_features(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1_id, target_id) and the features of every pair whose two ids are known."""
    return with_features(record_pairs(pairs, s1, targets))


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 if they are in the truth, else 0."""
    t = truth.where("target_id is not null").select("s1_id", "target_id").distinct().withColumn("_y", F.lit(1))
    return pairs.join(t, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("_y", F.lit(0))).drop("_y")
