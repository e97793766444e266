"""N-gram Jaccard join with a token-group matrix.

A document is the set of its distinct word shingles, as sorted 64-bit hashes; documents of equal sets
share a set id and take part once. A Rule gives width and similarity. Linked sets (Jaccard at least 0.9; others alike) of sizes a and b differ in at most
(a + b) / 19 shingles, so when the shingles' hash range is cut into one segment more than that, linked sets
agree on a whole segment. Sets that share no segment with another set are linked with nothing and end here.

The others fall into neighbourhoods: components of the graph that joins sets sharing a segment. In each,
similar sets are partitioned into groups, and each group stores its token union as a row of a bit matrix. A set
is compared with all rows at once: the popcount of the overlap bounds what it can share with any member;
only qualifying groups are opened, their members bounded in the same way, and the survivors compared exactly.
The links found are joined to components over all tasks.

A neighbourhood of up to BLOCKS[0] sets is one task. A larger one is worked on in steps, each over what the one before
left open, since two sets that are connected already need not be compared: (1) parts of BLOCKS[1] sets, every set in
one part; (2) two sets of each class found, in blocks of BLOCKS[0]; (3) if the neighbourhood still has several
classes, everything that may be linked: its sets outside the largest class against all of its sets, by pairs of blocks of
about ROOT * sqrt(its sets), at most BLOCKS[2]. Copies with few changes end with step 2, and a text is sent twice there.
Only a neighbourhood of very many sets that are similar, but not linked, sends its texts once for each block of step 3.

Exactness: segments of fewer than two shingles are weak: unrelated sets may share them. There are SPARE more segments
than needed, so linked sets agree on one more than SPARE; a set with at most SPARE weak segments shares a strong
one and emits no weak ones. Otherwise a weak segment is replaced by its pairs with the segments of a second
cut, of which linked sets share one for the same reason. Set ids, segment
signatures and shingles are 64-bit hashes.

Defined results: null texts and texts without words have an empty set, 0 shingles, and are linked with nothing. A text
of fewer words than a shingle has its whole sequence as one. Rows with a null id get a null component. Repeated
rows of one id and text give equal rows; rows of one id with different texts take part together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from .graph import components

SHINGLE = 3
#: Linked: intersection / union >= NUM / DEN.
NUM, DEN = 9, 10
BLOCKS, ROOT = (250, 64, 4000), 8
#: Members of a group of the token-group matrix.
GROUP = 64
#: Sizes of levels grow by LEVEL from Rule.first.
LEVEL, SPARE = 1.3, 3
#: Bytes of text whose words are held at once.
SLICE = 1 << 20
SEEN = 500_000

#: The query in DuckDB.
SQL = r"""
with recursive d as (select distinct doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents where doc_id is not null and text is not null),
s as (select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end g from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by doc_id),
c as (select doc_id, string_agg(g, chr(10) order by g) k from s group by doc_id),
r as (select doc_id, min(doc_id) over (partition by k) rep from c),
t as (select s.doc_id, s.g from s join r on s.doc_id = r.doc_id and r.doc_id = r.rep),
p as (select a.doc_id x, b.doc_id y, count(*) o from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * o >= 90 * (a.n + b.n - o)),
u as (select x, y from e union all select y, x from e),
reach as (select rep node, rep top from r where doc_id = rep union select u.y, reach.top from reach join u on u.x = reach.node),
m as (select node, min(top) component_id from reach group by node)
select distinct documents.doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(m.component_id, documents.doc_id) component_id
from documents left join n on n.doc_id = documents.doc_id left join r on r.doc_id = documents.doc_id left join m on m.node = r.rep
"""

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
HIGH = np.uint64(32)
_digests = base.Digests()


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    words = [t.lower().split() for t in texts]
    h = _digests.of(list(chain.from_iterable(words)))
    cuts = np.cumsum([0, *map(len, words)]).tolist()
    n = max(0, len(h) - k + 1)
    s = h[:n].copy()
    for j in range(1, k):
        s = base.mix(s * A + h[j : n + j] + np.uint64(j))
    out = []
    for w, a, b in zip(words, cuts, cuts[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(s[a : b - k + 1]))
        else:
            out.append(np.array([int.from_bytes(hashlib.blake2b(b" ".join(w), digest_size=8, person=b"short").digest(), "little")] if w else [], np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a non-empty set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


@dataclass(frozen=True)
class Rule:
    """Linked: intersection / union of the sets of shingles of `width` words >= num / den. Linked sets of sizes a and b differ in at most (a + b) * (den - num) / (den + num) shingles."""

    width: int = SHINGLE
    num: int = NUM
    den: int = DEN

    def differ(self, total: int) -> int:
        """The most shingles in which linked sets of this sum of sizes differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    @property
    def first(self) -> int:
        """A set of at most so many shingles is linked with no other set of that size or less."""
        return (self.den + self.num - 1) // (2 * (self.den - self.num))

    def spare(self, differ: int) -> int:
        """Spare segments: the more shingles may differ, the smaller the segments and the more of them are weak."""
        return SPARE + (differ // 24 if 19 * (self.den - self.num) <= self.den + self.num else differ // 2)


RULE = Rule()
_levels: dict[Rule, list[tuple[int, int]]] = {}


def levels(n: int, rule: Rule = RULE) -> list[tuple[int, int, int]]:
    """(level, segments, spare segments) in which a set of n shingles takes part: that of its size, and those in which a larger linked set may be.

    Spare: segments on which the set agrees, beyond one, with every set linked with it in that level.
    """
    known = _levels.setdefault(rule, [])
    while not known or known[-1][0] < 3 * n * rule.den // rule.num:
        size = max(known[-1][0] + 1, int(known[-1][0] * LEVEL)) if known else rule.first
        differ = rule.differ(2 * size)
        known.append((size, differ + 1 + (rule.spare(differ) if differ else 0)))
    out = []
    for i, (size, m) in enumerate(known):
        if n <= size:
            if m > 1:
                out.append((i, m, m - 1 - rule.differ(n + min(size, n * rule.den // rule.num))))
            if rule.den * n <= rule.num * size:
                break
    return out


def segment_keys(shingles: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """The keys that a linked set of another id shares at least one of."""
    out = []
    scrambled = base.mix(shingles + B)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(scrambled, dtype=np.uint64)])
    for level, m, spare in levels(len(shingles), rule):
        segment = (((shingles >> HIGH) * np.uint64(m)) >> HIGH).astype(np.int64)
        cuts = np.append(np.searchsorted(segment, np.arange(m)), len(shingles))
        place = base.mix(np.arange(m, dtype=np.uint64) + np.uint64(level * 1_000_003 + 1))
        keys = base.mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ place)
        weak = np.diff(cuts) < 2
        out.append(keys[~weak])
        if weak.sum() > spare:
            at = ((scrambled >> HIGH) * np.uint64(m)) >> HIGH
            second = np.zeros(m, np.uint64)
            np.add.at(second, at.astype(np.int64), base.mix(shingles ^ A))
            second = base.mix(second ^ base.mix(place))
            out.append(base.mix(second + keys[weak][:, None] * A).ravel())
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


ROWS = "kind int, key long, a long, b long, n int"
SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32())])
KEY, EDGE, DOC = 0, 1, 2


def _rows(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
    n = np.zeros(len(key), np.int32) if n is None else n
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(key), kind, np.int32), key, a, b, n)], schema=SCHEMA)


def _spread(x: np.ndarray) -> np.ndarray:
    return base.mix(x.view(np.uint64)).view(np.int64)


def _slices(b: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    ids, texts, size = [], [], 0
    for i, t in zip(b["doc_id"].to_pylist(), base.utf8(b["text"]), strict=True):
        ids.append(i)
        texts.append(t)
        size += len(t)
        if size > SLICE:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _emit(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """DOC rows (id, set id, shingles), and of each new set its KEY rows; keys that repeat in a slice meet here and leave once, with EDGE rows."""
    seen: set[int] = set()
    for b in batches:
        for ids, texts in _slices(b):
            docs, of, sizes, keys, owners = [], [], [], [], []
            for doc, s in zip(ids, shingle_sets(texts, rule.width), strict=True):
                if not len(s):
                    continue
                docs.append(doc)
                of.append(sid := set_id(s))
                sizes.append(len(s))
                if sid not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sid)
                    keys.append(k := segment_keys(s, rule))
                    owners.append(np.full(len(k), sid, np.int64))
            if not docs:
                continue
            d, s = np.array(docs, np.int64), np.array(of, np.int64)
            yield _rows(DOC, _spread(d), d, s, np.array(sizes, np.int32))
            if keys:
                k, o = np.concatenate(keys), np.concatenate(owners)
                order = np.lexsort((o, k))
                k, o = k[order], o[order]
                new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
                yield _rows(KEY, k[new], o[new], o[new])
                if not new.all():
                    first = o[np.flatnonzero(new)][np.cumsum(new) - 1]
                    more = o != first
                    if more.any():
                        e = np.unique(np.stack([o[more], first[more]], 1), axis=0)
                        yield _rows(EDGE, _spread(e[:, 0]), np.ascontiguousarray(e[:, 0]), np.ascontiguousarray(e[:, 1]))
    _digests.forget()  # the worker goes on to other tasks


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind, key and a: sets that share a key are joined to the key's first."""
    last, pivot = None, 0
    for b in batches:
        kind, key, a, other = (b[c].to_numpy(zero_copy_only=False) for c in ("kind", "key", "a", "b"))
        n = int(np.searchsorted(kind, KEY, "right"))
        if n < len(kind):
            yield b.slice(n)
        if n:
            key, a = key[:n], a[:n]
            new = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
            at = np.cumsum(new) - 1
            firsts = a[new]
            first = np.where(at >= 0, firsts[np.maximum(at, 0)] if len(firsts) else 0, pivot)
            last, pivot = key[-1], int(first[-1])
            if (more := a != first).any():
                e = np.unique(np.stack([a[more], first[more]], 1), axis=0)
                yield _rows(EDGE, np.zeros(len(e), np.int64), np.ascontiguousarray(e[:, 0]), np.ascontiguousarray(e[:, 1]))


class TokenGroups:
    """The token-group matrix of a neighbourhood, filled set by set in order of size."""

    def __init__(self, sets: list[np.ndarray], rule: Rule = RULE, labels: list[int] | None = None):
        """labels: sets of one label are connected already."""
        self.sets, self.rule = sets, rule
        typical = int(np.median([len(s) for s in sets]))
        self.bits = min(1 << 16, max(512, 1 << (8 * typical).bit_length()))
        self.words = self.bits // 64
        self.matrix = np.zeros((16, self.words), np.uint64)  # a group's token union
        self.rows = np.zeros((len(sets), self.words), np.uint64)
        self.members: list[list[int]] = []
        first: dict[int, int] = {}
        self.parent = [first.setdefault(x, i) for i, x in enumerate(labels)] if labels else list(range(len(sets)))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def links(self) -> list[tuple[int, int]]:
        """Links that connect the same sets as all links do."""
        out = []
        size = np.array([len(s) for s in self.sets])
        for q in np.argsort(size, kind="stable").tolist():
            s, n = self.sets[q], int(size[q])
            bit = np.unique(s & np.uint64(self.bits - 1)).astype(np.int64)
            np.bitwise_or.at(self.rows[q], bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64))
            row, lost = self.rows[q], n - len(bit)
            home = -1
            if self.members:
                need = -(-self.rule.num * n // self.rule.den)
                bound = np.bitwise_count(self.matrix[: len(self.members)] & row).sum(1, dtype=np.int64) + lost
                for g in np.flatnonzero(bound >= need).tolist():
                    if self.root(self.members[g][0]) == self.root(q):
                        if len(self.members[g]) < GROUP and home < 0:
                            home = g
                        continue
                    if (x := self._open(q, row, lost, np.array(self.members[g]), size)) >= 0:
                        out.append((q, x))
                        self.parent[self.root(q)] = self.root(x)
                        if len(self.members[g]) < GROUP and home < 0:
                            home = g
            if home < 0:
                home = len(self.members)
                self.members.append([])
                if home == len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.members[home].append(q)
            self.matrix[home] |= row
        return out

    def _open(self, q: int, row: np.ndarray, lost: int, at: np.ndarray, size: np.ndarray) -> int:
        """A member linked with q, or -1. Linked: (num + den) * shared >= num * (sum of sizes)."""
        both = self.rule.num + self.rule.den
        total = self.rule.num * (size[at] + size[q])
        bound = np.bitwise_count(self.rows[at] & row).sum(1, dtype=np.int64) + lost
        s = self.sets[q]
        for i in np.flatnonzero(both * np.minimum(bound, size[at]) >= total).tolist():
            other = self.sets[at[i]]
            spot = np.searchsorted(other, s)
            shared = int((other[np.minimum(spot, len(other) - 1)] == s).sum())
            if both * shared >= total[i]:
                return int(at[i])
        return -1


def _verify(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task (neighbourhood, i, j): links of each task's sets."""
    task, ids, labels, texts = None, [], [], []

    def done() -> pa.RecordBatch:
        edges = np.zeros((0, 2), np.int64)
        if len(set(labels)) > 1:
            sets: dict[int, np.ndarray] = {}
            of = dict(zip(ids, labels, strict=True))
            for at in range(0, len(texts), 256):
                for i, s in zip(ids[at : at + 256], shingle_sets(texts[at : at + 256], rule.width), strict=True):
                    if len(s) and set_id(s) == i:
                        sets[i] = s
            names = list(sets)
            if len(names) > 1:
                links = TokenGroups(list(sets.values()), rule, [of[i] for i in names]).links()
                edges = np.array([(names[x], names[y]) for x, y in links], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, 0])), pa.array(np.ascontiguousarray(edges[:, 1]))], ["a", "b"])

    for b in batches:
        columns = [b[c].to_pylist() for c in ("near", "i", "j", "sid", "label")]
        for near, x, y, i, label, text in zip(*columns, base.utf8(b["text"]), strict=True):
            if (near, x, y) != task:
                if (r := done()).num_rows:
                    yield r
                task, ids, labels, texts = (near, x, y), [], [], []
            ids.append(i)
            labels.append(label)
            texts.append(text)
    if (r := done()).num_rows:
        yield r
    _digests.forget()


def _written(df: DataFrame) -> DataFrame:
    """base.cut(); the shuffle files of the step, which nothing reads any more, go: otherwise keys and each sending of the texts would lie on disk together."""
    out = base.cut(df)
    del df
    base.release_shuffles(out.sparkSession)
    return out


def _compare(tasks: DataFrame, rule: Rule) -> DataFrame:
    """The links (a, b) among the sets of each task. tasks: near, i, j, sid, label, text."""
    dealt = tasks.select("near", "i", "j", "sid", "label", "text").repartition("near", "i", "j").sortWithinPartitions("near", "i", "j")
    return base.map_batches(dealt, partial(_verify, rule=rule), "a long, b long")


def _dealt(count, size):
    """The block of a set, by its id, of as many blocks as the count needs."""
    return F.pmod(F.xxhash64("sid"), F.ceil(count / size)).cast("int")


def _open(sets: DataFrame, links: DataFrame) -> DataFrame:
    """near, sid, label (the class found so far), n (sets of the class), classes and top (the largest class) of the neighbourhood: where there is more than one class."""
    classes = components(links).select(F.col("node").alias("sid"), F.col("component").alias("label"))
    named = sets.select("near", "sid").join(classes, "sid", "left").select("near", "sid", F.coalesce("label", "sid").alias("label"))
    sizes = named.groupBy("near", "label").agg(F.count("*").alias("n"))
    several = sizes.groupBy("near").agg(F.count("*").alias("classes"), F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top")).where("classes > 1")
    return named.join(base.cut(several.select("near", "classes", "all", F.col("top.n").alias("n"), F.col("top.label").alias("top"))), "near")


def _links(texts: DataFrame, blocks: tuple[int, int, int], rule: Rule) -> DataFrame:
    """Links that connect the same sets as all links do. texts: near, n (sets of the neighbourhood), sid, text."""
    whole, part, most = blocks
    own = F.when(F.col("n") > whole, _dealt(F.col("n"), part)).otherwise(0)
    found = _written(_compare(texts.select("near", own.alias("i"), F.lit(0).alias("j"), "sid", F.col("sid").alias("label"), "text"), rule))
    large = base.cut(texts.where(F.col("n") > whole).select("near", "sid"))
    if large.isEmpty():
        return found
    left = base.cut(_open(large, found))
    if left.isEmpty():
        return found
    # two sets of each class
    ends = left.groupBy("near", "label").agg(F.max("classes").alias("classes"), F.array_distinct(F.array(F.min("sid"), F.max("sid"))).alias("sids"))
    ends = ends.select("near", "label", F.explode("sids").alias("sid"), "classes").withColumn("i", _dealt(2 * F.col("classes"), whole))
    found = _written(found.unionByName(_compare(texts.join(ends.drop("near"), "sid").withColumn("j", F.lit(0)), rule)))
    left = base.cut(_open(left, found))
    if left.isEmpty():
        return found
    # sets outside the largest class (in blocks from `first` on) against all of the neighbourhood's sets
    size = F.greatest(F.least(ROOT * F.sqrt("all"), F.lit(most)), F.lit(part))
    left = left.withColumn("first", F.ceil(F.col("n") / size).cast("int")).withColumn("others", F.ceil((F.col("all") - F.col("n")) / size).cast("int"))
    hashed = F.xxhash64("sid")
    upto = lambda a, n: F.sequence(a, a + n - 1)
    pair = lambda x, y: F.struct(F.least(x, y).alias("i"), F.greatest(x, y).alias("j"))
    mine = F.pmod(hashed, F.col("first")).cast("int")
    other = F.col("first") + F.pmod(hashed, F.col("others")).cast("int")
    of_top = F.transform(upto(F.col("first"), F.col("others")), lambda o: pair(mine, o))
    of_rest = F.transform(F.filter(upto(F.lit(0), F.col("first") + F.col("others")), lambda o: o != other), lambda o: pair(other, o))
    # joined first, multiplied after: what is multiplied below the join counts as small as before, and would be broadcast
    both = texts.join(left.select("sid", "label", "top", "first", "others"), "sid")
    tasks = both.select("near", "sid", "label", "text", F.explode(F.when(F.col("label") == F.col("top"), of_top).otherwise(of_rest)).alias("p")).select("near", "p.i", "p.j", "sid", "label", "text")
    return _written(found.unionByName(_compare(tasks, rule)))


def link_documents(documents: DataFrame, blocks: tuple[int, int, int] = BLOCKS, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id reachable by links. blocks: sets of a task (see above); rule: shingle width and similarity."""
    d = base.texts_of(documents, "doc_id", "text")
    whole = d.where("doc_id is not null and text is not null")
    met = base.map_batches(base.map_batches(whole, partial(_emit, rule=rule), ROWS).repartition("key").sortWithinPartitions("kind", "key", "a"), _meet, ROWS)
    met = base.cut(met)
    base.release_shuffles(met.sparkSession)
    docs = met.where(f"kind = {DOC}").select(F.col("a").alias("doc_id"), F.col("b").alias("sid"), F.col("n").alias("n_shingles"))
    reps = base.cut(docs.groupBy("sid").agg(F.min("doc_id").alias("rep")))
    near = base.cut(components(met.where(f"kind = {EDGE}").select("a", "b")))
    many = base.cut(near.groupBy("component").agg(F.count("*").alias("n")))  # written, so that its size is known: where it is small, no component meets in one task
    members = near.join(many, "component").select(F.col("node").alias("sid"), F.col("component").alias("near"), "n").join(reps, "sid").withColumnRenamed("rep", "doc_id")
    texts = base.cut(whole.join(members, "doc_id").select("near", "n", "sid", "text"))
    base.release_shuffles(texts.sparkSession)
    links = _links(texts, blocks, rule)
    classes = components(links).select(F.col("node").alias("sid"), "component")
    named = reps.join(classes, "sid", "left").select("sid", "rep", F.coalesce("component", "sid").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_set = named.join(least, "component").select("sid", "component_id")
    found = docs.join(of_set, "sid").groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.max("n_shingles").alias("n_shingles"))
    ids = d.select("doc_id").join(found, "doc_id", "left")
    return ids.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The documents, with all their columns, that have the smallest id of their component; those with a null id stay, and so does every row of a kept id."""
    name = "gone"
    while name in documents.columns:
        name += "_"
    gone = link_documents(documents, rule=rule).where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return documents.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
