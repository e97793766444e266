"""Benchmark decontamination with suffix arrays over the training text.

Documents are dealt with in shards of about SHARD_BYTES of text and SHARD_WORDS words. The words of a shard become
integers, and all its suffixes are sorted: first by as many words as fit a 64-bit key, then by doubling, which sorts
again only suffixes that are still alike, until no two are. Every suffix of every benchmark item is then
binary-searched in every shard for its first WINDOW words; hits that follow each other on one diagonal (place in the
document less place in the item) join into the longest verbatim matches, with their places on both sides.

The benchmark is a query set: it is written in blocks of at most BLOCK_BYTES, and one block at a time is on
the driver and broadcast; with several, the findings are written between them.

Defined results: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z lower-cased text; null texts
have none. An item of fewer than WINDOW words, but not none, is one window. Items without an id or text don't
count; a repeated item counts once, by its item_id. Without benchmark items nothing is hit. A text longer than a
shard is searched in several. Repeated rows are searched each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

WINDOW = 10
#: Bytes of text whose words are held at once (a longer text alone), and words in a suffix array; arrays share the words of a window less one.
SHARD_BYTES, SHARD_WORDS = 1 << 20, 1 << 18
BLOCK_BYTES = 16 << 20

MATCHES = "array<struct<item_id: bigint, start: bigint, n_words: bigint, item_start: bigint>>"
SCHEMA = f"doc_id bigint, text string, n_words bigint, spans array<struct<start: bigint, stop: bigint>>, items array<bigint>, matches {MATCHES}"


class SuffixArray:
    """All suffixes of a sequence of integers >= 0, sorted. A shorter suffix comes before a longer one that starts with it."""

    def __init__(self, ids: np.ndarray):
        n = self.n = len(ids)
        self.bits = max(1, int(ids.max()).bit_length()) if n else 1
        self.packed = max(1, 63 // self.bits)  # words in a key
        self.ids = np.zeros(n + self.packed + 1, np.int64)  # beyond the end: less than any word, which count from 1
        self.ids[:n] = ids + 1
        self.bits = max(1, int(self.ids.max()).bit_length())
        self.packed = max(1, 63 // self.bits)
        keys = self.pack(self.ids, n)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]  # the first words of the sorted suffixes
        self._double()

    def pack(self, ids: np.ndarray, n: int) -> np.ndarray:
        key = np.zeros(n, np.int64)
        for k in range(self.packed):
            key = (key << self.bits) | ids[k : n + k]
        return key

    def _double(self) -> None:
        n, depth = self.n, self.packed
        new = np.ones(n, bool)
        new[1:] = self.keys[1:] != self.keys[:-1]
        rank = np.zeros(n + 1, np.int64)  # by place: where the group of suffixes alike up to depth starts; 0 beyond the end
        at = np.flatnonzero(new)
        group = np.repeat(at, np.diff(np.append(at, n)))  # by position in the order
        rank[self.order] = group + 1
        while True:
            alone = new & np.append(new[1:], True)
            open_ = np.flatnonzero(~alone)
            if not len(open_):
                return
            suffixes = self.order[open_]
            after = rank[np.minimum(suffixes + depth, n)]
            by = np.argsort((group[open_] << 32) | after)
            suffixes, after = suffixes[by], after[by]
            self.order[open_] = suffixes
            own = group[open_]
            fresh = np.ones(len(open_), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
            new[open_] = fresh
            first = np.flatnonzero(fresh)
            group[open_] = np.repeat(open_[first], np.diff(np.append(first, len(open_))))
            rank[suffixes] = group[open_] + 1
            depth *= 2

    def find(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of words (sizes of them count), from where to where the sorted suffixes start with it."""
        m, w = queries.shape
        q = np.zeros((m, w + self.packed), np.int64)
        q[:, :w] = queries + 1
        q[:, :w][np.arange(w) >= sizes[:, None]] = 0
        foreign = (q >> self.bits).any(1)  # a word beyond all of the sequence
        head = np.zeros(m, np.int64)
        rest = np.zeros(m, np.int64)  # what follows a shorter query in the key may be anything
        for k in range(self.packed):
            head = (head << self.bits) | q[:, k]
            rest = (rest << self.bits) | np.where(k < sizes, 0, (1 << self.bits) - 1)
        low, high = np.searchsorted(self.keys, head, "left"), np.searchsorted(self.keys, head | rest, "right")
        high[foreign] = low[foreign]
        live = np.flatnonzero((high > low) & (sizes > self.packed))
        for k in range(self.packed, w):  # word by word within the suffixes that are alike so far
            live = live[(sizes[live] > k) & (high[live] > low[live])]
            if not len(live):
                break
            for bound, after in ((low, False), (high, True)):
                bound[live] = self._bound(low[live], high[live], q[live, k], k, after)
        high = np.maximum(low, high)
        return low, high

    def _bound(self, low: np.ndarray, high: np.ndarray, word: np.ndarray, k: int, after: bool) -> np.ndarray:
        """The first position of each range whose suffix has, k words on, no less than the word (after: more)."""
        a, b = low.copy(), high.copy()
        while True:
            todo = np.flatnonzero(a < b)
            if not len(todo):
                return a
            mid = (a[todo] + b[todo]) >> 1
            there = self.ids[np.minimum(self.order[mid] + k, self.n)]
            less = there <= word[todo] if after else there < word[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b[todo] = np.where(less, b[todo], mid)


class Index:
    """The suffixes of a block of benchmark items, to be searched."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        by_ids: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in base.words(text)]
            for q in range(max(1, len(ids) - window + 1) if ids else 0):
                by_ids.setdefault(tuple(ids[q : q + window]), []).append((item, q))
        self.window = window
        self.places = list(by_ids.values())
        self.size = np.fromiter(map(len, by_ids), np.int64, len(by_ids))
        self.queries = np.zeros((len(by_ids), window), np.int64)
        for row, ids in zip(self.queries, by_ids, strict=True):
            row[: len(ids)] = ids

    def search(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], list[int], list[tuple[int, int, int, int]]]]:
        """For each document (as words) of a shard: hit spans, item ids, longest matches (item, start, n_words, item_start)."""
        none: tuple[list, list, list] = ([], [], [])
        out = [none] * len(docs)
        if not len(self.queries) or not any(docs):
            return out
        number = _Numbers(self.vocab)
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        heads = np.cumsum(sizes + 1) - sizes - 1  # a separator, 0, after each document
        ids = np.zeros(int(sizes.sum()) + len(docs), np.int64)
        for words, at in zip(docs, heads.tolist(), strict=True):
            ids[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        found = [self._places(SuffixArray(ids[a : a + SHARD_WORDS + self.window - 1]), a) for a in range(0, len(ids), SHARD_WORDS)]
        which, place = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        if not len(which):
            return out
        doc = np.searchsorted(heads, place, "right") - 1
        start = place - heads[doc]
        by = np.lexsort((start, doc))
        which, doc, start = which[by], doc[by], start[by]
        cuts = np.flatnonzero(np.diff(doc, prepend=-1)).tolist() + [len(doc)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            out[int(doc[a])] = self._one(which[a:b].tolist(), start[a:b].tolist())
        return out

    def _places(self, array: SuffixArray, offset: int) -> tuple[np.ndarray, np.ndarray]:
        """The queries that occur in the array, and where, counted from offset; what starts in the part it shares with the next is left to that."""
        low, high = array.find(self.queries, self.size)
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        which = np.repeat(hit, count)
        place = array.order[np.repeat(low[hit] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        inside = place < SHARD_WORDS
        return which[inside], place[inside] + offset

    def _one(self, which: list[int], start: list[int]) -> tuple[list, list, list]:
        spans: list[list[int]] = []
        diagonals: dict[tuple[int, int], list[list[int]]] = {}
        for k, s in zip(which, start, strict=True):
            e = s + int(self.size[k])
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(e, spans[-1][1])
            else:
                spans.append([s, e])
            for item, q in self.places[k]:
                runs = diagonals.setdefault((item, s - q), [])
                if runs and s <= runs[-1][2] + 1:
                    runs[-1][1:] = [max(e, runs[-1][1]), s]
                else:
                    runs.append([s, e, s])
        matches = sorted((item, s, e - s, s - shift) for (item, shift), runs in diagonals.items() for s, e, _ in runs)
        return [(a, b) for a, b in spans], sorted({m[0] for m in matches}), matches


class _Numbers(dict):
    """The benchmark's words by their numbers; words of the shard that it doesn't have get the numbers after those as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The items with text, in blocks bounded in bytes (a longer item alone): written once by block, and one block at a time in the driver."""
    items = base.texts_of(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    total, longest = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    n = max(1, -(-2 * (total or 0) // max(BLOCK_BYTES, longest or 1))) if (total or 0) > BLOCK_BYTES else 1
    by_block = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int"))
    if n > 1:
        by_block = base.cut(by_block, by="block")
    for k in range(n):
        if block := [(r.item_id, r.text.encode()) for r in by_block.where(F.col("block") == k).select("item_id", "text").toLocalIterator()]:
            yield block


def _by_block(start: DataFrame, benchmark: DataFrame, window: int, step: Callable[[DataFrame, object], DataFrame]) -> DataFrame:
    """Applies step(documents, index) for one block after the other. Between two blocks the documents are written and the broadcast goes."""
    spark, out, held = start.sparkSession, start, None
    for block in _blocks(benchmark):
        if held is not None:
            out = base.cut(out)
            held.destroy()
        held = spark.sparkContext.broadcast(Index(block, window))
        out = step(out, held)
    return out if held is not None else step(start, spark.sparkContext.broadcast(Index([], window)))


def _shards(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in shards."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > SHARD_BYTES:
            yield run
            run, size = [], 0
        run.append(base.words(t))
        size += len(t)
    if run:
        yield run


def find_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every document: n_words, spans (hit word ranges), items (ids with an occurring window) and matches (longest verbatim matches of at least a window, with locations)."""
    start = base.texts_of(documents, "doc_id", "text").select(
        "doc_id", "text", F.lit(0).cast("bigint").alias("n_words"), F.lit(None).cast("array<struct<start: bigint, stop: bigint>>").alias("spans"), F.lit(None).cast("array<bigint>").alias("items"), F.lit(None).cast(MATCHES).alias("matches")
    )
    return _by_block(start, benchmark, window, lambda d, index: base.map_arrow(d, _searcher(index), SCHEMA)).drop("text")


def _searcher(index) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    match = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "start", "n_words", "item_start")]))

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        found, n_words = [], []
        for shard in _shards(base.utf8(b["text"])):
            found += index.value.search(shard)
            n_words += map(len, shard)
        spans, items, matches = (b[c].to_pylist() for c in ("spans", "items", "matches"))
        new: tuple[list, list, list] = ([], [], [])
        for (s, i, m), s0, i0, m0 in zip(found, spans, items, matches, strict=True):
            s = _merged(s + [(x["start"], x["stop"]) for x in s0]) if s0 else s
            new[0].append([{"start": a, "stop": z} for a, z in s])
            new[1].append(sorted({*i, *(i0 or [])}))
            new[2].append((m0 or []) + [dict(zip(("item_id", "start", "n_words", "item_start"), x, strict=True)) for x in m])
        return pa.RecordBatch.from_arrays(
            [b["doc_id"], b["text"], pa.array(n_words, pa.int64()), pa.array(new[0], span), pa.array(new[1], pa.list_(pa.int64())), pa.array(new[2], match)],
            ["doc_id", "text", "n_words", "spans", "items", "matches"],
        )

    return fn


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs; decided row by row, without a join."""
    at = documents.columns.index("text")

    def step(d: DataFrame, index) -> DataFrame:
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            return b.filter(pa.array([not f[0] for shard in _shards(base.utf8(b.column(at))) for f in index.value.search(shard)], pa.bool_()))

        return base.map_arrow(d, fn, documents.schema)

    return _by_block(documents, benchmark, window, step)


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract columns and the longest match."""
    found = find_matches(documents, benchmark)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        hits = [sum(x["stop"] - x["start"] for x in row) for row in b["spans"].to_pylist()]
        items = b["items"].to_pylist()
        sha = [hashlib.sha256(",".join(sorted(map(str, i))).encode()).hexdigest() for i in items]
        longest = [max([x["n_words"] for x in m], default=0) for m in b["matches"].to_pylist()]
        long = [pa.array(x, pa.int64()) for x in (hits, map(len, items), longest)]
        return pa.RecordBatch.from_arrays([b["doc_id"], b["n_words"], long[0], long[1], pa.array(sha, pa.string()), pa.array([h > 0 for h in hits], pa.bool_()), long[2]], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"])

    return base.map_arrow(found, fn, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long")
