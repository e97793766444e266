"""Quality rules: fixed base rules, and adaptive limits from mergeable quantile sketches.

measure() counts each text. sketch() summarises each ratio by language and source as counts over
logarithmic buckets of relative width RELATIVE: such sketches merge by adding counts, so they are
pre-aggregated before the shuffle, and the sketches of a language or of all rows are merged from them.
Texts that fail the base rules stay out of the sketches. limits() reads quantiles from the sketches;
judge() joins them to the counts and filters.

The limit of a ratio is its upper quantile plus a multiple of the distance to its lower one (see RULES); no
limit holds a fixed value. Quantiles of a language are averaged with those of all rows, and quantiles of a source
within it with those of the language, by their numbers of rows against PRIOR; so small groups lean on
larger ones without a switch. A text over a limit is dropped if the ratio rests on EVIDENCE occurrences or more:
one sign in a source that has none yet says nothing.

Defined results: a null text has no words and counts of 0, and fails the base rule. Null languages and
sources form groups of their own. A group in which every text fails the base rules has no limits. Texts of any
length are counted whole; a slice of texts is held at once, a longer text alone. Repeated rows are judged each for itself.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

SPACE = b" \t\n\x0b\x0c\r"
TRAILING = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
REPEAT_WINDOW = 5

RELATIVE = 0.02
GAMMA = (1 + RELATIVE) / (1 - RELATIVE)
PRIOR = 200
EVIDENCE = 3
#: By ratio: lower and upper quantile, and how many of their distances the limit lies beyond the upper one. Rare events
#: need a high quantile, word lengths have a spread of their own.
RULES = {"symbols": (0.5, 0.9, 2.0), "repeats": (0.5, 0.99, 0.5), "dup_lines": (0.5, 0.99, 0.5), "long_words": (0.25, 0.75, 5.0)}
#: What a ratio counts.
COUNTED = {"symbols": "n_symbols", "repeats": "n_repeat_words", "dup_lines": "n_dup_lines", "long_words": "n_words"}


def repeat_words(texts: list[list[bytes]], window: int = REPEAT_WINDOW) -> np.ndarray:
    """For each text (as words), the words inside windows that occur twice or more in it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(sizes.sum())
    out = np.zeros(len(texts), np.int64)
    if n < window:
        return out
    ids = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, n).view(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    m = n - window + 1
    h = doc[:m].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(window):
        h = (h ^ ids[k : m + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:m] == doc[window - 1 :])
    h = h[inside]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    starts = inside[twice]
    for k in range(window):
        covered[starts + k] = True
    return np.bincount(doc[covered], minlength=len(texts))


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    counts = ", ".join(f"{c} long" for c in COUNTS)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows: dict[str, list[int]] = {c: [] for c in COUNTS}
        repeats, run, size = [], [], 0
        for t in base.utf8(b["text"]):
            w = t.split()
            run.append(w)
            size += len(t)
            if size > 2 << 20:
                repeats.append(repeat_words(run))
                run, size = [], 0
            lines = [x for x in t.split(b"\n") if x.strip(SPACE)]
            for c, v in zip(COUNTS, (len(w), len(t.translate(None, SPACE + TRAILING)), len(t) - len(t.translate(None, SYMBOLS)), len(lines) - len(set(lines)), 0, len(lines)), strict=True):
                rows[c].append(v)
        repeats.append(repeat_words(run))
        rows["n_repeat_words"] = np.concatenate(repeats)
        return pa.RecordBatch.from_arrays([b["doc_id"], b["lang"], b["source"], *[pa.array(rows[c], pa.int64()) for c in COUNTS]], ["doc_id", "lang", "source", *COUNTS])

    return base.map_arrow(base.texts_of(documents, "doc_id", "text", "lang", "source"), fn, f"doc_id long, lang string, source string, {counts}")


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "repeats": F.col("n_repeat_words") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "long_words": F.col("word_chars") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): bucket is null for 0, else ceil(log_GAMMA(ratio))."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("v")) for k, v in ratios().items()])).alias("x")
    bucket = F.when(F.col("x.v") > 0, F.ceil(F.log("x.v") / float(np.log(GAMMA))).cast("int"))
    return measured.where(~base_failed()).select("lang", "source", each).groupBy("lang", "source", F.col("x.ratio").alias("ratio"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """Merges the sketches by the named columns: of each ratio its rows and the two quantiles of its rule."""
    merged = sketches.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "ratio")
    below = F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first()))
    merged = merged.select(*by, "ratio", "bucket", below.alias("below"), F.sum("n").over(group).alias("rows"))
    value = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    level = lambda i: F.coalesce(*[F.when(F.col("ratio") == k, F.lit(r[i])) for k, r in RULES.items()])
    at = [F.min(F.when(F.col("below") >= level(i) * F.col("rows"), value)).alias(k) for i, k in enumerate(("low", "high"))]
    return merged.groupBy(*by, "ratio").agg(F.max("rows").alias("rows"), *at)


def leaning(own: DataFrame, wider: DataFrame, *on: str) -> DataFrame:
    """own quantiles averaged with those of the wider group, weighted by rows against PRIOR."""
    o, w = own.alias("o"), wider.alias("w")
    same = F.col("o.ratio") == F.col("w.ratio")
    for c in on:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"w.{c}"))
    mean = lambda k: ((F.col("o.rows") * F.col(f"o.{k}") + PRIOR * F.col(f"w.{k}")) / (F.col("o.rows") + PRIOR)).alias(k)
    return o.join(w, same).select(*[F.col(f"o.{c}") for c in own.columns if c not in ("low", "high")], mean("low"), mean("high"))


def limits(sketches: DataFrame) -> DataFrame:
    """One row for each language and source, with an upper limit for each ratio."""
    by_lang = leaning(quantiles(sketches, "lang"), quantiles(sketches))
    q = leaning(quantiles(sketches, "lang", "source"), by_lang, "lang")
    beyond = F.coalesce(*[F.when(F.col("ratio") == k, F.lit(r[2])) for k, r in RULES.items()])
    q = q.select("lang", "source", "ratio", (F.col("high") + beyond * (F.col("high") - F.col("low"))).alias("limit"))
    return q.groupBy("lang", "source").agg(*[F.max(F.when(F.col("ratio") == k, F.col("limit"))).alias(f"max_{k}") for k in RULES])


def judge(measured: DataFrame, limit: DataFrame) -> DataFrame:
    """measured with base_failed, the limits of its group, failed (the ratios over their limits, comma-joined) and kept."""
    over = [F.when((v > F.col(f"max_{k}")) & (F.col(COUNTED[k]) >= EVIDENCE), F.lit(k)) for k, v in ratios().items()]
    by = limit.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = measured.join(by, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_lang", "of_source")
    return joined.withColumn("base_failed", base_failed()).withColumn("failed", F.concat_ws(",", *over)).withColumn("kept", ~F.col("base_failed") & (F.col("failed") == ""))


def digest(documents: DataFrame) -> DataFrame:
    """The contract columns and the limits. The counts are written once; the sketches and the filter read them."""
    measured = base.cut(measure(documents))
    return judge(measured, limits(sketch(measured))).select("doc_id", *COUNTS[:-1], "base_failed", "kept", "failed", *[f"max_{k}" for k in RULES])
