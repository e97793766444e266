"""Language identification by nearest centroids of TF-IDF byte n-grams.

A text is the vector of log(1 + count) * idf over hashed byte bigrams and trigrams of its letters, of
length 1. Each language has up to CLUSTERS centroids, found by spherical k-means on at most SAMPLE texts
of it (the bound of the fitted sample; texts are chosen by a hash of their id). Document frequencies are
counted over all texts to learn from. The language of the most similar centroid by cosine is predicted;
a text whose cosine is below the language's floor is rejected. The floor is calibrated on every FOLDS-th text of the sample,
which the centroids have not seen: it is the geometric mean of what they reach (their 1 % quantile) and of what texts of no language reach (random letters, of
lengths up to thousands of words); the hash is wide enough that foreign n-grams meet few of the language's.
Texts of a few words reach less: below FULL n-grams the floor goes down, geometrically, to what a few random words reach.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected. Ties go to
the first language by name. Without a text to learn from every text is ``und``. Texts of any length are predicted whole. Repeated rows are
predicted each for itself; a null id takes no part in learning and counts as not held out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

BITS = 15
SIZE = 1 << BITS
SAMPLE, CLUSTERS, ROUNDS = 400, 3, 12
#: One text in so many calibrates the floor, if there are enough.
FOLDS = 4
#: Texts of random letters: words, and how many texts of each length.
UNRELATED, DRAWS = (3, 30, 300, 3000), 8
#: N-grams from which a text counts as long.
FULL = 400

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


def counts(text: bytes) -> np.ndarray:
    """Counts of hashed n-grams; those of spaces alone don't count."""
    d = np.frombuffer(b" " + text.translate(LETTERS) + b" ", np.uint8).astype(np.uint32)
    two = (d[:-1] << 8) | d[1:]
    three = (two[:-1] << 8) | d[2:]
    mult = np.uint32(0x9E3779B1)
    out = np.bincount(((two + np.uint32(1 << 24)) * mult) >> np.uint32(32 - BITS), minlength=SIZE)
    out += np.bincount((three * mult) >> np.uint32(32 - BITS), minlength=SIZE)
    for blank in (0x1002020, 0x202020):
        out[((blank * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - BITS)] = 0
    return out


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows of length 1
    of: np.ndarray  # the language of each centroid
    floor: np.ndarray  # by language: the cosine below which a long text is rejected
    short: np.ndarray  # and one of hardly any n-grams

    def vectors(self, raw: np.ndarray) -> np.ndarray:
        x = np.log1p(raw.astype(np.float32)) * self.idf
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)

    def cosines(self, raw: np.ndarray) -> np.ndarray:
        """The cosine with each centroid."""
        some = np.flatnonzero(raw)
        x = np.log1p(raw[some].astype(np.float32)) * self.idf[some]
        return (self.centroids[:, some] @ x) / max(float(np.sqrt((x * x).sum())), 1e-12)

    def predict(self, texts: list[bytes]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        at = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        for i in at:
            raw = counts(texts[i])
            cos = self.cosines(raw)
            best = int(cos.argmax())
            lang, c = int(self.of[best]), float(min(max(cos[best], 0), 1))
            long = min(1.0, int(raw.sum()) / FULL)
            out[i] = (self.langs[lang], c, bool(c < self.short[lang] ** (1 - long) * self.floor[lang] ** long))
        return out


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means, seeded with the text nearest to the mean and then the farthest from the seeds."""
    seeds = [int((x @ x.mean(0)).argmax())]
    while len(seeds) < min(k, len(x)):
        seeds.append(int((x @ x[seeds].T).max(1).argmin()))
    c = x[seeds]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = np.stack([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
    return c


def unrelated() -> list[bytes]:
    """Texts of words of random letters."""
    rng = np.random.default_rng(0)
    out = []
    for n in UNRELATED:
        for _ in range(DRAWS):
            letters = rng.integers(97, 123, 10 * n, dtype=np.uint8)
            letters[np.cumsum(rng.integers(3, 10, n))] = 32
            out.append(letters.tobytes())
    return out


def fit(documents: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learns from text and lang of the given documents (with doc_id, which only picks the sample)."""
    known = base.texts_of(documents, "doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null")
    per_lang = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    rate = {k: 1.5 * sample / n for k, n in per_lang.items()}
    unit = (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000).alias("unit")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(SIZE, np.int64)
        texts = 0
        schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("unit", pa.float64()), ("lang", pa.string()), ("raw", pa.binary())])
        for b in batches:
            picked = []
            for text, lang, u in zip(base.utf8(b["text"]), b["lang"].to_pylist(), b["unit"].to_pylist(), strict=True):
                if has_letter(text):
                    raw = counts(text)
                    df += raw > 0
                    texts += 1
                    if u < rate.get(lang, 0):
                        picked.append((u, lang, zlib.compress(np.minimum(raw, 65_535).astype("<u2").tobytes(), 1)))
            if picked:
                none = [None] * len(picked)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((none, none, *zip(*picked, strict=True)), schema.types, strict=True)], schema=schema)
        none = [None] * (SIZE + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((np.arange(-1, SIZE, dtype=np.int32), np.append([texts], df), none, none, none), schema.types, strict=True)], schema=schema)

    gathered = base.cut(base.map_batches(known.select("text", "lang", unit), gather, "bucket int, n long, unit double, lang string, raw binary"))
    total = {r.bucket: r.n for r in gathered.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # SIZE + 1 rows
    df = np.array([total.get(b, 0) for b in range(SIZE)], np.float64)
    idf = (np.log((1 + total.get(-1, 0)) / (1 + df)) + 0.1).astype(np.float32)
    langs = sorted(per_lang)
    model = Model([], idf, np.zeros((0, SIZE), np.float32), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    for lang in langs:
        rows = gathered.where(F.col("raw").isNotNull() & (F.col("lang") == lang)).orderBy("unit", "raw").limit(sample).select("raw").collect()
        if not rows:
            continue
        x = model.vectors(np.stack([np.frombuffer(zlib.decompress(r.raw), "<u2") for r in rows]))
        aside = np.arange(len(x)) % FOLDS == FOLDS - 1
        c = k_means(x[~aside], clusters)
        reach = np.quantile((x[aside if aside.any() else ~aside] @ c.T).max(1), 0.01)
        model.centroids = np.concatenate([model.centroids, c])
        model.of = np.append(model.of, np.full(len(c), len(model.langs), np.int64))
        model.floor = np.append(model.floor, reach)
        model.langs.append(lang)
    if model.langs:
        cos = np.stack([model.cosines(counts(t)) for t in unrelated()])
        noise, few = (np.array([x[:, model.of == i].max() for i in range(len(model.langs))]) for x in (cos, cos[:DRAWS]))
        model.floor = np.minimum(np.sqrt(model.floor * noise), model.floor)
        model.short = np.minimum(few, model.floor)
    return model


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the cosine) and rejected."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, rejected = zip(*held.value.predict(base.utf8(b["text"])), strict=True)
        return pa.RecordBatch.from_arrays([b["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return base.map_arrow(base.texts_of(documents, "doc_id", "text"), fn, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, whose language is not rejected."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array([not r for _, _, r in held.value.predict(base.utf8(b.column(at)))], pa.bool_()))

    return base.map_arrow(documents, fn, documents.schema)


def held_out(mod: int, remainder: int):
    """Whether crc32 of the id as text leaves the remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == remainder, F.lit(False))


def learnable(documents: DataFrame) -> DataFrame:
    return documents.where(~held_out(5, 0))


def digest(documents: DataFrame) -> DataFrame:
    """The contract columns and rejected. Learns from documents that are not held out."""
    found = predict(documents, fit(learnable(documents)))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score", "rejected")
