from __future__ import annotations

import os
import random
import time
import tracemalloc
from collections import Counter, defaultdict

import pytest

from kindred.llm import html_text as H

SF = "/root/testdata/sf0.1"


def plain(page: H.Page) -> list[str]:
    """The method written plainly: a path is the tuple of its nodes, everything is computed where it is needed."""
    p = page.paths

    def path(n):
        return () if n == 0 else (*path(p.parent[n]), n)

    found = [(path(n), text, links) for n, text, links in page.blocks if not p.quiet[n]]
    by = defaultdict(list)
    for x in found:
        by[x[0]].append(x)
    box = {k: next((n for n in reversed(k) if p.tag[n] in ("article", "main")), 0) for k in by}

    def raw(k):
        rows = by[k]
        chars = sum(len(t) for _, t, _ in rows)
        marks = sum(t.count(c) for _, t, _ in rows for c in ".,;:!?。，、；：！？…—–-")
        links = sum(x[2] for x in rows)
        return chars / len(rows) * (1 + marks / len(rows)) * max(0.05, 1 - links / chars)

    line = [raw(x[0]) for x in found]
    smooth = [sum(w * line[j] for j, w in ((i - 2, 0.05), (i - 1, 0.15), (i, 0.6), (i + 1, 0.15), (i + 2, 0.05)) if 0 <= j < len(line)) for i in range(len(line))]
    score = {k: sum(s * (10 if box[k] else 1) for s, x in zip(smooth, found, strict=True) if x[0] == k) / len(by[k]) for k in by}
    size = {k: sum(len(x[1]) for x in by[k]) for k in by}
    linked = {k for k in by if sum(x[2] for x in by[k]) > sum(len(x[1]) for x in by[k]) / 2}
    if not found:
        return []
    good = {k for k in by if score[k] >= 0.5 * (sum(score[x] * size[x] for x in by) / sum(size.values())) and (k not in linked or box[k])}
    good = good or {max(by, key=lambda k: (score[k], -k[-1] if k else 0))}
    weight = Counter()
    for k in good:
        if not box[k]:
            weight[k[:-1]] += sum(len(x[1]) for x in by[k])
    parent = max(weight, key=lambda k: (weight[k], -(k[-1] if k else 0))) if weight else None

    def in_text(k):
        if k in good:
            return True
        if box[k] and any(box[k] in g for g in good):
            return k not in linked or p.tag[box[k]] == "article"
        return not box[k] and parent is not None and len(k) > len(parent) and k[: len(parent)] == parent and p.tag[k[len(parent)]] in H.BESIDE and k not in linked

    return [text for k, text, _ in found if in_text(k)]


def random_page(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(1, 60)):
        r = rng.random()
        if r < 0.3:
            out.append(f"<{rng.choice(['div', 'p', 'ul', 'li', 'section', 'article', 'main', 'header', 'h1', 'h2', 'table', 'tr', 'td', 'nav', 'aside', 'div class=ad', 'div class=c1', 'div id=\'c2\'', 'blockquote', 'x-y'])}>")
        elif r < 0.45:
            out.append(f"</{rng.choice(['div', 'p', 'ul', 'li', 'section', 'article', 'main', 'header', 'h1', 'nav', 'a', 'zz'])}>")
        elif r < 0.55:
            out.append(rng.choice(["<a href=x>", "<a name=y>", "</a>", "<b>", "<br>", "<hr>", "<!-- c -->", "<", "&amp;", "<script>x<y</script>"]))
        else:
            out.append(" ".join(rng.choice(["word", "other, ", "more.", "text;", "x"]) for _ in range(rng.randint(1, 25))))
    return "".join(out)


def test_selection_equals_the_plain_version():
    rng = random.Random(5)
    some = 0
    for _ in range(1500):
        html = random_page(rng)
        want = "\n".join(plain(H.Page(html)))
        assert H.main_text(html) == want, html
        some += bool(want)
    assert some > 1000


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_ratios_decide_on_every_page(monkeypatch):
    """Without article elements the same texts are found; without class names and elements that name menus, adverts and footers, the scores alone keep those out."""
    import pyarrow.parquet as pq

    pages = [r["html"] or "" for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]
    texts = list(map(H.main_text, pages))
    for outer in (("<div class=k7>", "</div>"), ("", "")):
        assert [H.main_text(h.replace("<article>", outer[0]).replace("</article>", outer[1])) for h in pages] == texts
    bare = [h.replace('class="ad"', 'class="q7"').replace("<footer>", '<div class="z">').replace("</footer>", "</div>").replace("<nav>", '<div class="n">').replace("</nav>", "</div>") for h in pages]
    same = sum(H.main_text(h) == t for h, t in zip(bare, texts, strict=True))
    assert same > 0.97 * len(pages)
    asked = Counter()
    scores = H.path_scores

    def level(page):
        asked["pages"] += 1
        score, linked, _ = scores(page)
        return dict.fromkeys(score, 1.0), linked, 1.0  # all alike

    monkeypatch.setattr(H, "path_scores", level)
    assert sum(H.main_text(h) == t for h, t in zip(bare, texts, strict=True)) == 0 and asked["pages"] == len(pages)


def test_articles_are_whole():
    assert H.main_text('<article><h1>H</h1><p><a name="top">Text one.<p>Text two.</article>') == "H\nText one.\nText two."
    linked = "<article><h1>Head</h1><p>A paragraph, with text.</p><p class=x><a href=y>All of it a link</a></p><ul><li><a href=z>item</a></ul></article>"
    assert H.main_text(linked) == "Head\nA paragraph, with text.\nAll of it a link\nitem"
    split = "<main><h1>Head line</h1><article><p>First part, with a text of some length.</p></article><p>Between.</p><article><p>Second part, with a text of some length.</p></article></main>"
    assert H.main_text(split) == "Head line\nFirst part, with a text of some length.\nBetween.\nSecond part, with a text of some length."
    assert H.main_text("<article><header><h1>T</h1><p>by me</header><p>Text &amp; more &lt;b&gt; &#233;.</article>") == "T\nText & more <b> é."
    assert H.main_text("<article><p>1 < 2 and a<b and</p><p title='a>b'>3 > 2</p></article>") == "1 < 2 and a\n3 > 2"


@pytest.mark.parametrize("unit", ["<div>x y.", '<a "', '<a ="', "</zz><q9>", "<p>a<x>", "<article>x y.", "<!--", "</", "<p " + "a" * 50, "<table><tr><td>a"])
def test_long_pages_are_linear(unit):
    took = []
    for size in (60_000, 600_000):
        began = time.process_time()
        H.main_text(unit * (size // len(unit)))
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0] + 0.5


def test_a_megabyte_of_nested_blocks_stays_small():
    html = "<div>x y." * (1_000_000 // 9)
    tracemalloc.start()
    text = H.main_text(html)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and text.startswith("x y.")
