from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import bpe, decontaminate, language, secrets
from tests.llm.conftest import prose
from tests.llm.test_similar import brute


def test_stages_take_effect(spark, make, corpus, tmp_path):
    rng = random.Random(21)
    leak = prose(rng, 40).replace("\n", " ")
    secret = 'password = "hunter2secret" and more words'
    foreign = [(960 + i, " ".join("".join(rng.choices("бвгджзклмнпрстфх", k=6)) for _ in range(200)), None, "s") for i in range(5)]
    rows = [*corpus, *foreign, (950, f"Before it. {leak} After it.", "en", "s"), (951, f"{prose(rng, 30)} {secret}", "en", "s")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "tokens":
            assert out.columns == docs.columns
        rows_in = [(r.doc_id, r.text, None, None) for r in docs.collect()]
        if name == "language":
            model = language.fit(docs)
            want = {i: t for (i, t, *_), (_, _, rejected) in zip(rows_in, model.predict([(t or "").encode() for _, t, *_ in rows_in]), strict=True) if not rejected}
            assert None not in want.values() and "" not in want.values() and 0 in want and not any(960 <= i < 965 for i in want if i is not None)
        elif name == "near_duplicates":
            top = brute(rows_in)
            want = {i: t for i, t in want.items() if i is None or top[i][1] == i}
            assert not any(120 < i < 132 for i in want if i is not None)
        elif name == "benchmark":
            index = decontaminate.Index([(1, leak.encode())])
            want = {i: t for i, t in want.items() if not index.search([decontaminate.base.words(t.encode())])[0][0]}
            assert 950 not in want and 951 in want
        elif name == "secrets":
            enc = secrets._encoding(secrets._ranks(None))
            want = {i: secrets._masked(t, secrets.scan(t.encode(), enc)) for i, t in want.items()}
            assert "hunter2" not in want[951] and "[assign]" in want[951]
        elif name == "tokens":
            tok = bpe.load(bpe._spec(None))
            assert {r.doc_id: r.ids for r in out.collect()} == {i: tok.encode_many([t])[0].tolist() for i, t in want.items()}
        assert {r.doc_id: r.text for r in out.collect()} == want, name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id: r.ids for r in whole.collect()} == {r.doc_id: r.ids for r in docs.collect()} and docs.where(F.col("n_tokens") != F.size("ids")).count() == 0


def test_odd_tables(spark, make, tmp_path):
    """Empty tables give none; repeated rows, and columns named as the last stage's own, go through."""
    bench = spark.createDataFrame([], "item_id long, text string")
    text = "a plain text of some words that is long enough to be told from noise by its letters"
    for name, rows in (("empty", []), ("repeated", [(1, text, "en", "s")] * 3 + [(2, None, "en", "s")])):
        make(rows).withColumn("ids", F.lit("clash")).withColumn("__gone", F.lit(1)).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.columns[-3:] == list(bpe.OWN) and "__gone" in out.columns
        assert [(r.doc_id, r.text, r.round_trip) for r in out.collect()] == [(1, text, True)] * (3 if rows else 0)
