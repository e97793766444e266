from __future__ import annotations

import random

import pytest

WORDS = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just those people how too good very make world still see own work men day here between life being under three never know same last another while us might great go come since against right came take used himself few house use place".split()

#: Rows that no operator may stumble over.
ODD = [
    (900, None, None, None),
    (901, "", "en", "src0"),
    (902, " \n\t ", "en", "src0"),
    (903, "A.", "en", None),
    (904, "!!! 123 --- \x00 　", None, "src1"),
    (905, "ÄÖÜ ß 日本語 テキスト 🎉🎉 é", "de", "src1"),
    (906, "word " * 30_000, "en", "src0"),
    (907, "x" * 50_000, "en", "src0"),
    (None, "a row without an id but with words in its text", "en", "src0"),
]


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    return " ".join(w + rng.choice(["", "", "", "", ".", ",", ".\n"]) for w in words)


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text, lang, source) rows, with columns whose names operators use themselves."""

    def f(rows):
        full = [(i, t, lang, source, None if t is None else len(t), 0.5, "x", None) for i, t, lang, source in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, sid long").repartition(3)

    return f


@pytest.fixture(scope="session")
def corpus():
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "de"]), "src0" if i % 3 else f"src{i % 5}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "src0") for i in range(8)]  # copies
    rows += [(120 + i, rows[30][1], "en", "src0") for i in range(12)]  # a hot copy
    return rows + [(700, rows[5][1], "en", "src0")] * 2 + ODD
