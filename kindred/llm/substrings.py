"""Substring deduplication by hashing lines.

Every line with a word is normalised (A-Z lower-cased, white space runs to one space, trimmed) and hashed
to 128 bits. Digests are grouped over all documents; the earliest occurrence (by doc_id, then line) of each
stays, every other one is removed. A line that has come earlier within the same task is decided there and then;
only the earliest of each task take part in the grouping, so a line that stands in a third of all rows
sends a row a task, not one an occurrence. Only digests, ids and offsets take part in that; the texts are
joined once, with one list a document.

Defined results: lines are split at line feeds; offsets are code points of the original text, end
exclusive, without the line feed. A null text has no lines and stays null. Lines without a word, lines of
fewer words than min_words (an argument, 1 in the query), and all lines of documents with a null id, stay.
Repeated rows of one id and text are one document: the lines that are the first of their digest stay in each.
Texts of any length are handled line by line; empty tables give empty results.

remove_passages() removes passages however lines break them; the query, whose SQL removes lines, does not use it.
A window is N_WORDS consecutive words `[^\\x20\\x09-\\x0D]+` (A-Z lower-cased) of a document. It is gone if an equal one
starts earlier by (doc_id, hash of the text, word), in its own document N_WORDS words earlier at least, so that of a
text that repeats itself the first passage stays. The words of all windows that are gone are removed, white space
around them stays; a null text, documents with a null id or fewer words stay. To compare few windows, each has an anchor: the least
digest of its runs of K words. Equal windows have equal anchors. Neighbours of one anchor are compared as a whole first, by 128 bits;
only of those that are left, where their anchor is left twice, the single windows are compared, by 128 bits too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import base

#: Digests that a task remembers, and rows that leave it at once.
SEEN, ROWS = 200_000, 20_000
#: Words of a window of remove_passages(): a passage of over 50 words holds one; words of an anchor.
N_WORDS, K = 51, 16

#: The query in DuckDB.
SQL = r"""
with d as (select distinct doc_id, text from documents where doc_id is not null and text is not null),
s as (select doc_id, text, string_split(text, chr(10)) ls from d),
l as (select doc_id, text, unnest(ls) line, generate_subscripts(ls, 1) - 1 pos from s),
n as (select *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) norm,
  coalesce(sum(length(line) + 1) over (partition by doc_id, text order by pos rows between unbounded preceding and 1 preceding), 0) start from l),
r as (select *, norm <> '' as unit, norm <> '' and (doc_id, pos) <> min((doc_id, pos)) over (partition by norm) as gone from n),
g as (select doc_id, text, count(*) filter (where unit) n_units, count(*) filter (where gone) n_removed, coalesce(sum(length(line)) filter (where gone), 0) n_removed_chars,
  coalesce(string_agg(start::bigint || ':' || (start + length(line))::bigint, ',' order by pos) filter (where gone), '') spans, coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') kept from r group by doc_id, text)
select x.doc_id, coalesce(g.n_units, 0)::bigint n_units, coalesce(g.n_removed, 0)::bigint n_removed, coalesce(g.n_removed_chars, 0)::bigint n_removed_chars, coalesce(g.spans, '') spans, g.kept as text
from documents x left join g on x.doc_id = g.doc_id and x.text = g.text
"""


def lines(text: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(line, start, stop, normalised words joined) of the lines of min_words words or more."""
    at = 0
    for i, line in enumerate(text.split("\n")):
        words = line.encode().lower().split()
        if len(words) >= min_words:
            yield i, at, at + len(line), b" ".join(words)
        at += len(line) + 1


UNITS = ("doc_id", "of", "line", "start", "stop", "d1", "d2")


def units(documents: DataFrame, min_words: int = 1) -> DataFrame:
    """doc_id, of (hash of the whole text), line, start, stop, and the digest d1, d2: of the lines that are the earliest of their digest so far in their task. Of the others, which can't be the earliest of all, d1 and d2 are null."""
    schema = pa.schema([(c, pa.int64()) for c in UNITS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int, int]] = {}
        found = np.zeros((ROWS, 5), np.int64)
        digests = np.zeros((ROWS, 2), np.int64)
        later = np.zeros(ROWS, bool)

        def rows(n: int) -> pa.RecordBatch:
            columns = [pa.array(found[:n, k].copy()) for k in range(5)] + [pa.array(digests[:n, k].copy(), mask=later[:n].copy()) for k in range(2)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        n = 0
        for b in batches:
            for doc, of, text in zip(b["doc_id"].to_pylist(), b["of"].to_pylist(), b["text"], strict=True):
                for i, start, stop, words in lines(text.as_py(), min_words):
                    h = hashlib.blake2b(words, digest_size=16).digest()
                    first, here = seen.get(h), (doc, i, of)
                    if first == here:
                        continue  # a repeated row
                    later[n] = first is not None and first[:2] < (doc, i)
                    found[n] = doc, of, i, start, stop
                    if not later[n]:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen[h] = here
                        digests[n] = int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)
                    n += 1
                    if n == ROWS:
                        yield rows(n)
                        n = 0
            base.release()
        if n:
            yield rows(n)

    d = base.texts_of(documents, "doc_id", "text").where("doc_id is not null and text is not null")
    return base.map_batches(d.select("doc_id", F.xxhash64("text").alias("of"), "text"), run, ", ".join(f"{c} long" for c in UNITS))


def repeats(found: DataFrame) -> DataFrame:
    """doc_id, of and spans: the lines that are not the earliest of their digest. A digest has at most a few rows a task of units()."""
    nth = F.rank().over(Window.partitionBy("d1", "d2").orderBy("doc_id", "line"))
    later = found.where("d1 is not null").withColumn("nth", nth).where("nth > 1").select("doc_id", "of", "start", "stop")
    gone = later.unionByName(found.where("d1 is null").select("doc_id", "of", "start", "stop"))
    return gone.groupBy("doc_id", "of").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def remove_repeats(documents: DataFrame, min_words: int = 1) -> DataFrame:
    """doc_id, text without the repeated lines, spans removed (original offsets), n_units, n_removed, n_removed_chars."""
    gone = repeats(base.cut(units(documents, min_words)))
    d = base.texts_of(documents, "doc_id", "text").withColumn("of", F.xxhash64("text"))
    joined = d.join(gone, ["doc_id", "of"], "left").select("doc_id", "text", "spans")
    span = "array<struct<start: bigint, stop: bigint>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def one(text: str | None, s: list[dict]) -> tuple[str | None, int, int]:
        if text is None:
            return None, 0, 0
        drop, kept, n, at = {x["start"] for x in s}, [], 0, 0
        for line in text.split("\n"):
            n += len(line.encode().split()) >= min_words
            if at not in drop or not line:
                kept.append(line)
            at += len(line) + 1
        return "\n".join(kept) if drop else text, n, sum(x["stop"] - x["start"] for x in s)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        spans = [s or [] for s in b["spans"].to_pylist()]
        kept, n_units, chars = zip(*(one(t.as_py(), s) for t, s in zip(b["text"], spans, strict=True)), strict=True)
        columns = [b["doc_id"], pa.array(kept, pa.string()), pa.array(spans, kind), *[pa.array(x, pa.int64()) for x in (n_units, map(len, spans), chars)]]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "spans", "n_units", "n_removed", "n_removed_chars"])

    return base.map_arrow(joined, fn, f"doc_id long, text string, spans {span}, n_units long, n_removed long, n_removed_chars long")


def digest(documents: DataFrame) -> DataFrame:
    """One row for each document, the spans as text."""
    return remove_repeats(documents).select("doc_id", "n_units", "n_removed", "n_removed_chars", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.stop)), ",").alias("spans"), "text")


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit digests of all runs of n entries, from digests of runs of 1, 2, 4 and so on; scrambled at each step, so structured texts don't collide."""
    m = max(0, len(h) - n + 1)
    out, done, size = np.zeros(m, np.uint64), 0, 1
    while m and size <= n:
        if n & size:
            out = base.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[done : done + m])
            done += size
        if 2 * size <= n:
            h = base.mix(h[: len(h) - size] * np.uint64(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    return out


def least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours."""
    m, size = max(0, len(h) - n + 1), 1
    while m and 2 * size <= n:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    return np.minimum(h[:m], h[n - size : n - size + m])


def read(b: pa.RecordBatch, digests: base.Digests, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the words of all texts, and of every window that lies in one text its row and first word there. Windows are counted from the first word of the batch."""
    words, ends = [], []
    for text in base.utf8(b["text"]):
        words.append(digests.of(text.lower().split()))
        ends.append(len(words[-1]))
    n = np.array(ends, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return np.concatenate([*words, np.zeros(0, np.uint64)]), row, np.where(pos + n_words <= n[row], pos, -1)


COLUMNS = ("doc_id", "of", "first", "last", "d1", "d2")


def settle(doc: np.ndarray, of: np.ndarray, first: np.ndarray, last: np.ndarray, d1: np.ndarray, d2: np.ndarray, n_words: int) -> pa.RecordBatch:
    """COLUMNS and gone, of rows in the order of their places: equal digests are equal windows. Rows that are gone from these alone are joined with their neighbours, their digests mean nothing and are dealt out evenly."""
    order = np.lexsort((first, of, doc, d2, d1))
    new = np.r_[True, (d1[order[1:]] != d1[order[:-1]]) | (d2[order[1:]] != d2[order[:-1]])]
    head = np.empty(len(order), np.int64)
    head[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the earliest
    gone = (doc != doc[head]) | (of != of[head]) | (first >= first[head] + n_words)
    i = np.flatnonzero(~gone | np.r_[True, ~gone[:-1] | (doc[1:] != doc[:-1]) | (of[1:] != of[:-1]) | (first[1:] != last[:-1] + 1)])
    j = np.r_[i[1:] - 1, len(gone) - 1]
    d1 = np.where(gone, base.mix(d1.view(np.uint64) + np.arange(len(d1), dtype=np.uint64)).view(np.int64), d1)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[i], of[i], first[i], last[j], d1[i], d2[i], gone[i])], [*COLUMNS, "gone"])


def anchors(documents: DataFrame, n_words: int) -> DataFrame:
    """COLUMNS and gone: windows first to last of the document have the anchor d1 and, as a whole, the digest d2."""
    k = min(K, n_words)
    most = n_words - k + 1  # windows that hold one occurrence of an anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = base.Digests()
        for b in batches:
            h, row, pos = read(b, digests, n_words)
            whole, a = runs(h, n_words), least(runs(h, k), most)
            at = np.flatnonzero(pos >= 0)
            if not len(at):
                continue
            new = np.r_[True, (a[at[1:]] != a[at[:-1]]) | (row[at[1:]] != row[at[:-1]])]
            new |= (np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % most == 0
            i = np.flatnonzero(new)
            i, j = at[i], at[np.r_[i[1:] - 1, len(at) - 1]]
            d = base.mix(base.mix(whole[i] * np.uint64(0x9E3779B97F4A7C15) + whole[j]) + (j - i).astype(np.uint64))  # they meet, so they tell all words
            doc, of = (b[c].to_numpy(zero_copy_only=False)[row[i]] for c in ("doc_id", "of"))
            yield settle(doc, of, pos[i], pos[j], a[i].view(np.int64), d.view(np.int64), n_words)
            base.release()

    return base.map_batches(documents, run, ", ".join(f"{c} long" for c in COLUMNS) + ", gone boolean")


def compared(documents: DataFrame, n_words: int) -> DataFrame:
    """COLUMNS and gone: of documents with ranges, every window in them with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = base.Digests()
        for b in batches:
            h, row, pos = read(b, digests, n_words)
            ranges = b["ranges"]
            start = np.searchsorted(row, np.arange(b.num_rows))[np.repeat(np.arange(b.num_rows), ranges.value_lengths().to_numpy(zero_copy_only=False))]
            first, last = (ranges.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("first", "last"))
            wanted = np.zeros(len(row) + 1, np.int64)
            np.add.at(wanted, start + first, 1)
            np.add.at(wanted, start + last + 1, -1)
            at = np.flatnonzero((np.cumsum(wanted[:-1]) > 0) & (pos >= 0))
            if not len(at):
                continue
            d1, d2 = (runs(x, n_words)[at].view(np.int64) for x in (h, base.mix(h ^ np.uint64(0xA0761D6478BD642F))))
            doc, of = (b[c].to_numpy(zero_copy_only=False)[row[at]] for c in ("doc_id", "of"))
            yield settle(doc, of, pos[at], pos[at], d1, d2, n_words)
            base.release()

    return base.map_batches(documents, run, ", ".join(f"{c} long" for c in COLUMNS) + ", gone boolean")


def mark(found: DataFrame, n_words: int) -> DataFrame:
    """doc_id, of, first, last, d1, gone: gone now tells of all rows."""
    so_far = Window.partitionBy("d1", "d2", "gone").orderBy("doc_id", "of", "first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = found.withColumn("head", F.first(F.struct("doc_id", "of", "first")).over(so_far))
    gone = F.col("gone") | (F.col("head.doc_id") != F.col("doc_id")) | (F.col("head.of") != F.col("of")) | (F.col("first") >= F.col("head.first") + n_words)
    return w.select("doc_id", "of", "first", "last", "d1", gone.alias("gone"))


def passages(documents: DataFrame, n_words: int = N_WORDS) -> DataFrame:
    """doc_id, of and ranges (first, last): the windows that are gone."""
    d = base.texts_of(documents, "doc_id", "text").where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("of"), "text")
    by_doc = F.collect_set(F.struct("first", "last")).alias("ranges")
    found = base.cut(mark(anchors(d, n_words), n_words))
    left = found.where("not gone")  # the earliest of equal windows is among these
    again = left.groupBy("d1").count().where("count > 1").select("d1")
    some = left.join(again, "d1", "left_semi").groupBy("doc_id", "of").agg(by_doc)
    windows = compared(d.join(some, ["doc_id", "of"]).select("doc_id", "of", "text", "ranges"), n_words)
    places = ("doc_id", "of", "first", "last")
    later = base.cut(mark(windows, n_words).where("gone").select(*places))
    return found.where("gone").select(*places).unionByName(later).groupBy("doc_id", "of").agg(by_doc)


def remove_passages(documents: DataFrame, n_words: int = N_WORDS) -> DataFrame:
    """doc_id, text without the repeated passages, spans removed (original offsets), n_words, n_removed, n_removed_chars."""
    if n_words < 1:
        raise ValueError("n_words has to be 1 or more")
    d = base.texts_of(documents, "doc_id", "text").withColumn("of", F.xxhash64("text"))
    joined = d.join(passages(documents, n_words), ["doc_id", "of"], "left").select("doc_id", "text", "ranges")
    span = "array<struct<start: bigint, stop: bigint>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def one(text: str | None, ranges: list[dict]) -> tuple[str | None, list[dict], int]:
        if text is None or not ranges:
            return text, [], 0 if text is None else len(text.encode().split())
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        spans: list[list[int]] = []  # in words, end exclusive
        for x in sorted((x["first"], x["last"]) for x in ranges):
            if spans and x[0] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], x[1] + n_words)
            else:
                spans.append([x[0], x[1] + n_words])
        out = [{"start": words[i][0], "stop": words[j - 1][1]} for i, j in spans]
        edges = [0, *(x for s in out for x in (s["start"], s["stop"])), len(text)]
        return "".join(text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)), out, len(words)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        kept, spans, n = zip(*(one(t.as_py(), r.as_py() or []) for t, r in zip(b["text"], b["ranges"], strict=True)), strict=True)
        columns = [b["doc_id"], pa.array(kept, pa.string()), pa.array(spans, kind), *[pa.array(x, pa.int64()) for x in (n, map(len, spans), (sum(x["stop"] - x["start"] for x in s) for s in spans))]]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "spans", "n_words", "n_removed", "n_removed_chars"])

    return base.map_arrow(joined, fn, f"doc_id long, text string, spans {span}, n_words long, n_removed long, n_removed_chars long")
