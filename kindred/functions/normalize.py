"""Normalisation of names, addresses and countries, and the record table."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules, in the order they apply (fixed values): the pattern of a whole word, and its short form.
NAME_RULES = (
    (r"corporation", "corp"),
    (r"corp\.?", "corp"),
    (r"incorporated", "inc"),
    (r"inc\.?", "inc"),
    (r"limited", "ltd"),
    (r"ltd\.?", "ltd"),
    (r"private", "pvt"),
    (r"pvt\.?", "pvt"),
    (r"pte\.?", "pvt"),
    (r"llc\.?", "llc"),
    (r"l\.l\.c\.?", "llc"),
    (r"llp\.?", "llp"),
    (r"l\.l\.p\.?", "llp"),
    (r"company", "co"),
    (r"co\.?", "co"),
    (r"gmbh", "gmbh"),
    (r"sa", "sa"),
    (r"s\.a\.?", "sa"),
    (r"sarl", "sarl"),
    (r"s\.a\.r\.l\.?", "sarl"),
    (r"bv", "bv"),
    (r"b\.v\.?", "bv"),
    (r"plc", "plc"),
    (r"enterprises", "ent"),
    (r"technologies", "tech"),
    (r"technology", "tech"),
    (r"tech\.?", "tech"),
    (r"solutions", "soln"),
    (r"solution", "soln"),
    (r"services", "serv"),
    (r"service", "serv"),
    (r"international", "intl"),
    (r"intl\.?", "intl"),
    (r"group", "grp"),
    (r"holdings", "hldg"),
)
ADDRESS_RULES = (
    (r"street", "st"),
    (r"st\.?", "st"),
    (r"road", "rd"),
    (r"rd\.?", "rd"),
    (r"avenue", "ave"),
    (r"ave\.?", "ave"),
    (r"boulevard", "blvd"),
    (r"blvd\.?", "blvd"),
    (r"drive", "dr"),
    (r"dr\.?", "dr"),
    (r"lane", "ln"),
    (r"ln\.?", "ln"),
    (r"floor", "fl"),
    (r"flr\.?", "fl"),
    (r"fl\.?", "fl"),
    (r"suite", "ste"),
    (r"ste\.?", "ste"),
    (r"apartment", "apt"),
    (r"apt\.?", "apt"),
    (r"building", "bldg"),
    (r"bldg\.?", "bldg"),
    (r"highway", "hwy"),
    (r"hwy\.?", "hwy"),
    (r"parkway", "pkwy"),
    (r"pkwy\.?", "pkwy"),
    (r"court", "ct"),
    (r"ct\.?", "ct"),
    (r"place", "pl"),
    (r"pl\.?", "pl"),
    (r"square", "sq"),
    (r"sq\.?", "sq"),
    (r"circle", "cir"),
    (r"cir\.?", "cir"),
    (r"number", "no"),
    (r"num\.?", "no"),
    (r"no\.?", "no"),
    (r"p\.?\s*o\.?\s*box", "pobox"),
    (r"post\s+office\s+box", "pobox"),
)
#: Country texts after normalisation and the name they stand for (fixed values).
COUNTRIES = {
    "us": ("usa", "united states", "united states of america", "u s a", "u s"),
    "india": ("ind", "in", "republic of india"),
    "united kingdom": ("uk", "u k", "great britain"),
    "france": ("fra", "fr"),
    "germany": ("deu", "de"),
    "canada": ("can", "ca"),
    "australia": ("aus", "au"),
}


@F.pandas_udf(T.StringType())
def _fold(texts: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        return t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return texts.map(one)


def fold(c: Column, ascii_only: bool = False) -> Column:
    """NFKD without combining marks; null becomes empty. ascii_only: the caller knows that nothing is to be folded, and all stays in the JVM."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return c if ascii_only else _fold(c)


def apply_rules(c: Column, table: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, rf"(?U)\b{rule[0]}\b", rule[1]), table, c)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def name_tokens(folded: Column) -> Column:
    """Tokens of a folded name; the normalised name is their join by spaces."""
    x = F.lower(folded)
    for sign in ("&", r"\+"):
        x = F.regexp_replace(x, rf"(?U)\s*{sign}\s*", " and ")
    x = apply_rules(x, NAME_RULES)
    x = F.regexp_replace(x, r"(?U)[^\p{L}\p{N}_\s-]", " ")
    return tokens(F.regexp_replace(x, "[-_]", " "))


def numeric_tokens(text: Column) -> Column:
    """All numbers that stand alone, as texts, in order."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\b\d+\b"), F.lit(0))


def address_tokens(folded: Column) -> Column:
    return tokens(F.regexp_replace(apply_rules(F.lower(folded), ADDRESS_RULES), r"(?U)[^\p{L}\p{N}_\s]", " "))


def country(folded: Column) -> Column:
    """Normalised country; aliases become one name, others pass through. White space is trimmed before punctuation goes."""
    x = F.regexp_replace(F.lower(folded), r"(?U)^\s+|\s+$", "")
    x = F.regexp_replace(F.regexp_replace(x, r"(?U)[^\p{L}\p{N}_\s]", ""), r"(?U)\s+", " ")
    alias = F.create_map(*[F.lit(v) for name, texts in COUNTRIES.items() for t in texts for v in (t, name)])
    return F.coalesce(F.try_element_at(alias, x), x)


#: Headers for each role (fixed values): exact names in order of preference, then parts of names.
ROLES = {
    "id": (("id", "entity_id", "record_id", "business_id", "source_id", "source1_id", "source2_id", "source3_id"), ("id",)),
    "name": (("name", "business_name", "company_name", "entity_name", "title", "legal_name"), ("name",)),
    "address": (("address", "business_address", "street_address", "location", "full_address", "addr"), ("addr", "street")),
    "country": (("country", "country_code", "nation", "country_name"), ("country", "nation")),
}


def discover_roles(columns: list[str]) -> dict[str, str]:
    """The column of each role; only the id falls back on the first column, other roles may be absent."""
    low = [(c.lower().strip(), c) for c in columns]
    out = {}
    for role, (exact, parts) in ROLES.items():
        hit = next((c for e in exact for k, c in reversed(low) if k == e), None) or next((c for k, c in low if any(p in k for p in parts)), None)
        if hit is None and role == "id" and columns:
            hit = columns[0]
        if hit is not None:
            out[role] = hit
    return out


def preprocess(df: DataFrame, source: str | Column, ascii_only: bool = False) -> DataFrame:
    """The record table: raw and normalised fields, tokens, and flags of missing fields; a column row_order stays."""
    order = [c for c in df.columns if c == "row_order"]
    roles = discover_roles([c for c in df.columns if c != "row_order"])
    raw = lambda role: F.coalesce(F.col(f"`{roles[role]}`").cast("string"), F.lit("")) if role in roles else F.lit("")
    source = F.lit(source) if isinstance(source, str) else source
    x = df.select(
        F.trim(F.coalesce(F.col(f"`{roles['id']}`").cast("string"), F.lit("nan"))).alias("id"), source.alias("source"), raw("name").alias("raw_name"), raw("address").alias("raw_address"), raw("country").alias("raw_country"), *order
    )
    x = x.select("*", *[fold(F.col(f"raw_{k}"), ascii_only).alias(f"_{k}") for k in ("name", "address", "country")])
    x = x.select("*", name_tokens(F.col("_name")).alias("name_tokens"), address_tokens(F.col("_address")).alias("addr_tokens"), numeric_tokens(F.lower("_address")).alias("numeric_tokens"), country(F.col("_country")).alias("norm_country"))
    x = x.withColumn("norm_name", F.array_join("name_tokens", " ")).withColumn("norm_address", F.array_join("addr_tokens", " "))
    flags = [(F.col(f"norm_{k}") == "").cast("int").alias(f"missing_{k}") for k in ("name", "address", "country")]
    return x.select("id", "source", "raw_name", "raw_address", "raw_country", "norm_name", "name_tokens", "norm_address", "addr_tokens", "numeric_tokens", "norm_country", *flags, *order)
