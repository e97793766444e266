from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from kindred.llm import graph, similar
from kindred.llm.graph import components
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t, _, _ in rows if i is not None}
    ids = sorted(i for i in sets if sets[i])
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 90 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_structured_words_stay_apart(make):
    """Texts whose words' prefix sums with powers of any odd base agree modulo 2**64 share no shingle."""
    s, t = "a", "b"
    for _ in range(11):
        s, t = s + t, t + s
    rows = [(1, s, "en", "s"), (2, t, "en", "s"), (3, f"{s} {t} {s} {s}", "en", "s"), (4, f"{t} {s} {t} {t}", "en", "s"), (5, s, "en", "s")]
    assert {r.doc_id: r.component_id for r in similar.link_documents(make(rows)).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def near(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice("alpha beta gamma delta epsilon zeta".split())
    return " ".join(w)


def family(rng, start, n, words, edits):
    base = prose(rng, words).replace("\n", "")
    return [(start + i, near(rng, base, rng.randint(0, edits)) if i else base, "en", "s") for i in range(n)]


def test_links_equal_brute_force(make, corpus):
    rng = random.Random(11)
    rows = [*corpus]
    for k, (n, words, edits) in enumerate([(30, 100, 6), (25, 40, 3), (12, 12, 1), (10, 11, 1), (20, 300, 12), (6, 3, 0), (6, 2, 1)]):
        rows += family(rng, 1000 + 100 * k, n, words, edits)
    chain = prose(rng, 80).replace("\n", "")
    for i in range(12):  # links only from one to the next
        rows.append((3000 - i, chain := near(rng, chain, 1), "en", "s"))
    want = brute(rows)
    got = similar.link_documents(make(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    for blocks in ((3, 2, 2), (6, 3, 4)):  # neighbourhoods over many tasks
        small = similar.link_documents(make(rows), blocks=blocks).collect()
        assert sorted(small, key=str) == sorted(got, key=str)
    kept = {r.doc_id for r in similar.keep_one(make(rows)).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c} | {None}


def test_stage_links_five_words_at_four_fifths(spark, make):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randint(1, 120)).replace("\n", ""), "en", "s") for i in range(40)]
    for k, (n, words, edits) in enumerate([(20, 100, 5), (20, 40, 2), (15, 14, 1), (10, 9, 1), (10, 400, 20)]):
        rows += family(rng, 1000 + 100 * k, n, words, edits)
    words = [f"w{i}" for i in range(100)]
    apart = [*words]
    apart[20], apart[70] = "x", "y"
    rows += [(5000, " ".join(words), "en", "s"), (5001, " ".join(apart), "en", "s")]  # 0.81 in five words, 0.885 in three
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, t, _, _ in rows if (w := t.translate(LOWER).split())}
    top = {i: i for i in sets}
    for _ in range(len(sets)):
        old = dict(top)
        for a in sets:
            for b in sets:
                if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    top[a] = min(top[a], top[b])
        if top == old:
            break
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, make(rows), "").collect()}
    assert kept == {i for i in top if top[i] == i} and 5001 not in kept


@pytest.mark.parametrize("rule", [similar.Rule(5, 8, 10), similar.Rule(3, 9, 10)])
def test_linked_sets_share_a_key_of_the_rule(rule):
    rng = np.random.default_rng(1)
    tried = 0
    for n in [*range(4, 60), 100, 300, 900]:
        for _ in range(20):
            pool = rng.integers(0, 2**64, 2 * n + 3, dtype=np.uint64)
            d = int(rng.integers(1, n // 4 + 2))
            r = int(rng.integers(0, d + 1))
            x, y = np.unique(pool[:n]), np.unique(np.concatenate([pool[r:n], pool[n : n + d - r]]))
            shared = len(np.intersect1d(x, y))
            if rule.den * shared >= rule.num * (len(x) + len(y) - shared):
                tried += 1
                assert len(np.intersect1d(similar.segment_keys(x, rule), similar.segment_keys(y, rule))), (n, d, r)
    assert tried > 200


def test_empty_and_single(make):
    assert similar.link_documents(make([])).count() == 0
    assert [tuple(r) for r in similar.link_documents(make([(5, "a b", "en", "s"), (4, "A  b", "en", "s")])).orderBy("doc_id").collect()] == [(4, 1, 4), (5, 1, 4)]


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(0)
    tried = 0
    for n in [*range(8, 60), 100, 300, 900]:
        for _ in range(25):
            pool = rng.integers(0, 2**64, n + n // 5 + 3, dtype=np.uint64)
            d = int(rng.integers(0, n // 9 + 2))
            r = int(rng.integers(0, d + 1))
            x, y = np.unique(pool[:n]), np.unique(np.concatenate([pool[r:n], pool[n : n + d - r]]))
            shared = len(np.intersect1d(x, y))
            if shared and 10 * shared >= 9 * (len(x) + len(y) - shared) and d:
                tried += 1
                assert set(similar.segment_keys(x).tolist()) & set(similar.segment_keys(y).tolist())
    assert tried > 500


def test_groups_find_what_all_pairs_find():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base[:200], 190, replace=False), rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)])) for _ in range(150)]
    sets += [np.unique(np.concatenate([base[200:], rng.integers(0, 2**63, 8, dtype=np.uint64)])) for _ in range(100)]
    top = list(range(len(sets)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    linked = lambda a, b: 19 * len(np.intersect1d(a, b)) >= 9 * (len(a) + len(b))
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                top[root(i)] = root(j)
    t = similar.TokenGroups(sets)
    links = t.links()
    assert all(linked(sets[a], sets[b]) for a, b in links)
    classes = lambda f: sorted(sorted(v) for v in _groups(f, len(sets)))
    assert classes(root) == classes(t.root)


def _groups(root, n):
    out = defaultdict(list)
    for i in range(n):
        out[root(i)].append(i)
    return out.values()


@pytest.mark.parametrize("part", [200_000, 7])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(graph, "PART", part)
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(500 + rng.randrange(50), 500 + rng.randrange(50)) for _ in range(40)] + [(7, 7), (None, 3)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            top[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in top}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tasks_are_multiplied_above_the_join(make, monkeypatch):
    """Nothing that is broadcast has been multiplied by numbers of blocks: its size is that of a table on disk."""
    rng = random.Random(29)
    plans = []
    compare = similar._compare
    monkeypatch.setattr(similar, "_compare", lambda tasks, rule: plans.append(tasks._jdf.queryExecution().optimizedPlan().toString()) or compare(tasks, rule))
    rows = [r for k in range(6) for r in family(rng, 100 * k, 12, 60, 9)]
    similar.link_documents(make(rows), blocks=(3, 2, 2)).collect()
    last = plans[-1].split("\n")
    assert len(plans) == 3 and any("Generate" in x for x in last)
    join = min(i for i, x in enumerate(last) if "Join" in x)
    assert min(i for i, x in enumerate(last) if "Generate" in x) < join and not any("sequence(" in x for x in last[join:])


def test_shuffle_files_go_between_steps(spark, monkeypatch):
    """the shuffle of the keys is gone before the texts are sent; before, it stayed until the driver happened to collect its garbage."""
    import time
    from pathlib import Path

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {p.name for d in folders for p in Path(d).rglob("shuffle_*.data")}
    seen, left, links = set(), [], similar._links
    cut = similar.base.cut

    def first_cut(df, *more):
        out = cut(df, *more)
        if not seen:
            seen.update(files() - before)
        return out

    def look(*more):
        end = time.time() + 20
        while seen & files() and time.time() < end:
            time.sleep(0.2)
        left.append(seen & files())
        return links(*more)

    before = files()
    monkeypatch.setattr(similar.base, "cut", first_cut)
    monkeypatch.setattr(similar, "_links", look)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2 + j) % 97}" for j in range(60))) for i in range(40)], "doc_id long, text string")
    assert similar.link_documents(docs).count() == 40
    assert seen and left == [set()]
