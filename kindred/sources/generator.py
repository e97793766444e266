"""Synthetic sources: a clean table becomes three, with noise, gaps and distractors. Every draw is a hash of key and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is replaced in names and addresses (fixed values).
NAME_SHORT = (("Corporation", "Corp"), ("Incorporated", "Inc"), ("Limited", "Ltd"), ("Private Limited", "Pvt. Ltd."), ("LLC", "L.L.C."))
ADDRESS_SHORT = (("Street", "St."), ("Avenue", "Ave"), ("Boulevard", "Blvd"), ("Road", "Rd"), ("Suite", "Ste"), ("Floor", "Fl"))


def draw(key: Column, seed: int, what: str) -> Column:
    """A number in [0, 1)."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(what)), F.lit(1 << 30)) / float(1 << 30)


def _replaced(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def noisy_name(name: Column, key: Column, seed: int) -> Column:
    """A quarter get short legal forms; a fifth swap "&" and "and"; some lose an inner token or get one letter lower-cased; the rest stay."""
    r = draw(key, seed, "name")
    words = F.split(name, r"\s+")
    inner = F.floor(draw(key, seed, "word") * (F.size(words) - 2)).cast("int") + 1
    shorter = F.array_join(F.filter(words, lambda w, i: i != inner), " ")
    at = F.floor(draw(key, seed, "letter") * F.greatest(F.char_length(name) - 5, F.lit(1))).cast("int") + 3
    lowered = F.concat(F.substr(name, F.lit(1), at - 1), F.lower(F.substr(name, at, F.lit(1))), F.substr(name, at + 1))
    swapped = F.when(name.contains(" & "), F.replace(name, F.lit(" & "), F.lit(" and "))).otherwise(F.replace(name, F.lit(" and "), F.lit(" & ")))
    return F.when(r < 0.25, _replaced(name, NAME_SHORT)).when(r < 0.45, swapped).when((r < 0.60) & (F.size(words) > 2), shorter).when((r < 0.75) & (F.char_length(name) > 4), lowered).otherwise(name)


def noisy_address(address: Column, key: Column, seed: int) -> Column:
    """Nearly a third are abbreviated; a quarter lose the second part between commas; some are lower-cased."""
    r = draw(key, seed, "address")
    parts = F.split(address, ",")
    fewer = F.when(F.size(parts) > 2, F.array_join(F.filter(parts, lambda p, i: i != 1), ",")).otherwise(address)
    return F.when(r < 0.30, _replaced(address, ADDRESS_SHORT)).when(r < 0.55, fewer).when(r < 0.70, F.lower(address)).otherwise(address)


def match_plan(key: Column, seed: int) -> Column:
    """The noisy sources that hold an entity: none (a fifth), 2 (two fifths), 3 (a fifth), or both."""
    m = draw(key, seed, "plan")
    return F.when(m < 0.20, F.array().cast("array<int>")).when(m < 0.60, F.array(F.lit(2))).when(m < 0.80, F.array(F.lit(3))).otherwise(F.array(F.lit(2), F.lit(3)))


def noisy_records(clean: DataFrame, seed: int = 42) -> DataFrame:
    """(key, source, name, address, country) of the noisy copies of (key, name, address, country); a tenth lack their country."""
    copies = clean.withColumn("source", F.explode(match_plan(F.col("key"), seed)))
    key = F.struct("key", "source")
    blank = F.when(draw(key, seed, "country") < 0.1, "").otherwise(F.col("country"))
    return copies.select("key", "source", noisy_name(F.col("name"), key, seed).alias("name"), noisy_address(F.col("address"), key, seed).alias("address"), blank.alias("country"))


def build_split(clean: DataFrame, distractors: DataFrame, split: str = "TRN", seed: int = 42) -> dict[str, DataFrame]:
    """source1, source2, source3 and truth of a split. distractors: (key, name, address, country) rows of both noisy sources that match nothing; those of source 3 end in " Intl"."""
    id_ = lambda s, k: F.concat(F.lit(f"S{s}_{split}_"), k.cast("string"))
    noisy = noisy_records(clean, seed)
    out = {"source1": clean.select(id_(1, F.col("key")).alias("entity_id"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country")}
    for s in (2, 3):
        own = noisy.where(F.col("source") == s).select(F.col("key").cast("string").alias("key"), "name", "address", "country")
        extra = distractors.select(F.concat(F.lit("D"), F.col("key").cast("string")).alias("key"), F.concat("name", F.lit(" Intl" if s == 3 else "")).alias("name"), "address", "country")
        out[f"source{s}"] = own.unionByName(extra).select(id_(s, F.col("key")).alias("record_id"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country")
    out["truth"] = noisy.select(id_(1, F.col("key")).alias("s1_id"), F.concat(F.lit("S"), F.col("source").cast("string"), F.lit(f"_{split}_"), F.col("key").cast("string")).alias("target_id"))
    return out
