from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from kindred.llm import language, toxicity
from tests.llm.conftest import ODD, prose

GERMAN = "der die das und ist nicht ein eine mit auf für von zu im dem den des sich auch werden wurde haben über schön größer straße wird noch nach bei aus um am wie oder aber wenn nur doch".split()


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        de = i % 3 == 0
        text = " ".join(rng.choice(GERMAN) for _ in range(rng.randint(5, 60))) if de else prose(rng, rng.randint(5, 60))
        rows.append((i, text, "de" if de else "en", f"src{i % 4}"))
    return rows


def test_language(make, mixed):
    docs = [*mixed, *ODD]
    got = language.digest(make(docs)).collect()
    assert len(got) == len(docs)
    lang = {i: x for i, _, x, _ in mixed}
    held = [r for r in got if r.doc_id in lang and r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None) and len(held) > 30
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in got}
    for i in (900, 901, 902, 904):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("de", "en", "und") for r in got) and not any(r.rejected for r in got if r.doc_id in lang)
    kept = language.keep_identified(d := make(docs), language.fit(d))
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} >= set(lang)


def test_long_foreign_texts_are_rejected_and_short_clean_ones_stay(make, mixed):
    rng = random.Random(6)
    model = language.fit(make(mixed))
    span = lambda a, b: "".join(map(chr, range(a, b)))
    for letters in (span(0x430, 0x450), span(0x3B1, 0x3CA), span(0x4E00, 0x5E00), span(0x627, 0x64B), span(0xAC00, 0xD000), "bcdfghjklmnpqrstvwxz"):
        for n in (50, 300, 5000):
            texts = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)).encode() for _ in range(4)]
            assert all(r for _, _, r in model.predict(texts)), (letters[:5], n)
    short = [prose(rng, 5).encode() for _ in range(50)] + [" ".join(rng.choices(GERMAN, k=5)).encode() for _ in range(50)]
    assert not any(r for _, _, r in model.predict(short))


def test_floor_is_calibrated_on_texts_the_centroids_have_not_seen(make, mixed):
    """Floors lie above what noise and foreign letters reach and below what unseen texts of the language reach."""
    model = language.fit(make(mixed[:200]))
    unseen = [t.encode() for _, t, _, _ in mixed[200:] if len(t.split()) > 30]
    assert not any(r for _, _, r in model.predict(unseen)) and len(unseen) > 20
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 9))) for _ in range(200)).encode() for _ in range(20)]
    assert all(r for _, _, r in model.predict(noise))
    assert all(0 < f < 1 for f in model.floor) and len(model.centroids) <= language.CLUSTERS * 2


def test_language_without_learning(make):
    d = make([(1, "some text", None, "s"), (2, None, "en", "s")])
    assert [r.lang_pred for r in language.digest(d).collect()] == ["und", "und"] and language.digest(make([])).count() == 0


def test_counts_are_those_of_plain_n_grams():
    text = "Ab c\xe9!".encode()
    padded = b" ab c\xc3\xa9  "[: len(text) + 2]
    grams = [padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1) if padded[i : i + n].strip()]
    assert language.counts(text).sum() == len(grams)


def toxic_rows():
    rng = random.Random(8)
    bad = ["idiot", "scum", "trottel"]
    rows, labels = [], []
    for i in range(400):
        t = prose(rng, rng.randint(10, 80))
        y = int(i % 4 == 0)
        if y:
            w = t.split(" ")
            w.insert(rng.randrange(len(w)), rng.choice(bad))
            t = " ".join(w)
        rows.append((i, t, "en" if i % 2 else "de", "s"))
        if i % 5:
            labels.append((i, 1, y))
    return rows, labels


def test_toxicity(spark, make):
    rows, labels = toxic_rows()
    docs = [*rows, *ODD]
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 1), (8, 1, None), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.digest(make(docs), marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score == by[902].score < 0.3
    again = {r.doc_id: r.score for r in toxicity.digest(make(docs), marks).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)


def test_thresholds_come_from_texts_the_model_has_not_seen(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 500, 30).astype(np.uint32) for _ in range(200)]
    toxic = (np.arange(200) % 3 == 0).astype(np.float32)
    for t, y in zip(texts, toxic, strict=True):
        t[3] = 777 if y else t[3]
    learned, scored = [], []
    train, score = toxicity.train, toxicity.Model.score
    monkeypatch.setattr(toxicity, "train", lambda t, *rest: (learned.extend(map(id, t)), train(t, *rest))[1])
    monkeypatch.setattr(toxicity.Model, "score", lambda m, t: (scored.extend(map(id, t)), score(m, t))[1])
    limits = toxicity.calibrate(texts, toxic, 0.3, ["en" if i % 2 else None for i in range(200)])
    assert set(limits) == {"en", None} and all(0 < x < 1 for x in limits.values())
    assert learned and scored and not set(learned) & set(scored)


def test_one_id_with_several_texts_gives_one_result(spark, make):
    rows, labels = toxic_rows()
    more = [(i, t.upper() + " scum", lang, s) for i, t, lang, s in rows[:40]] + [(7, "word " * 12_000, "en", "s")]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a, b = ({(r.doc_id, round(r.score, 5)) for r in toxicity.digest(make(d), marks).collect()} for d in ([*rows, *more], [*reversed(more), *reversed(rows)]))
    assert a == b and len(a) > 400


def test_toxicity_with_one_class_or_none(spark, make):
    d = make(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.digest(d, none).collect()} == {0}
    one = spark.createDataFrame([(905, 1, 1), (906, 1, 1), (903, 1, 1), (907, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.digest(d, one).collect()} == {1}
    assert toxicity.digest(make([]), none).count() == 0


def test_pooling_equals_plain_convolution():
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 50, n).astype(np.uint32) for n in (0, 1, 2, 7, 40)]
    row = np.arange(toxicity.BUCKETS, dtype=np.int32)
    tables = [[rng.normal(size=(50, toxicity.FILTERS)).astype(np.float32) for _ in range(w)] for w in toxicity.WIDTHS]
    for places in tables:
        for t in places:
            t[0] = 0
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    m = toxicity.Model(row, 0.1, rng.normal(size=n).astype(np.float32), rng.normal(size=n).astype(np.float32), tables, {})
    for t, got in zip(texts, m.score(texts), strict=True):
        padded = [*t.tolist(), *[0] * (toxicity.PAD + 1 + toxicity.PAD)]
        best = [np.max([sum(places[k][padded[i + k]] for k in range(len(places))) for i in range(len(t) + toxicity.PAD + 1)], 0) for places in tables]
        z = np.maximum(np.concatenate(best) + m.shift, 0) @ m.out + m.bias
        assert abs(1 / (1 + np.exp(-z)) - got) < 1e-4


def test_toxicity_learns_from_all_labelled_texts(spark, make, monkeypatch):
    """model, counts and thresholds come from every labelled text that is not held out, however many there are."""
    n = 4200
    rows = [(i, f"text {i} of {'scum' if i % 100 == 0 else 'calm'} words", "en", "s") for i in range(n)]
    marks = spark.createDataFrame([(i, 1, int(i % 100 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    learned = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda t, y, share: (learned.append((len(t), sum(len(t[i]) for i in range(len(t))), int(sum(y)))), train([t[i] for i in range(300)], y[:300], share))[1])
    toxicity.fit(make([*rows, *rows[:50]]), marks)
    open_ids = [i for i in range(n) if crc32(str(i).encode()) % 4 != 2]
    of = lambda ids: (len(ids), 5 * len(ids), sum(i % 100 == 0 for i in ids))
    assert len(open_ids) > 3100 and learned == [of(open_ids), of([i for k, i in enumerate(open_ids) if k % toxicity.FOLDS])]
