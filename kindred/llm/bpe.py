"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

For one pre-token the leaves of the tree hold ``rank * width + position`` of each adjacent pair, so
the root is the leftmost pair of lowest rank. A merge touches three leaves (the merged pair, its left
and its right neighbour), each updated along its path to the root, until the root holds no pair.
Short pre-tokens are encoded many at a time: one numpy array holds the trees of a block of them.

Texts are cut into chunks before each space; a chunk pre-tokenises independently of its neighbours
except where a run of white space crosses chunks, and such texts are matched as a whole. Each distinct
chunk of a slice of texts is looked up by its characters in a cache of each worker, up to CACHE entries.

Defined results: null and empty texts encode to no ids and decode to the empty text. Strings of
special tokens become those tokens. Decoding joins token bytes; invalid UTF-8 becomes U+FFFD.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import base

#: White space as Unicode defines it.
WS = r"[\t-\r\x20\x85\xa0  -     　]"
NS = WS[:1] + "^" + WS[1:]
PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{WS[1:-1]}]+|{WS}+(?!{NS})|{WS}+")
#: A space between white space, or at the end after white space: its run crosses pieces.
CROSSING = regex.compile(rf"\x20(?<={WS}\x20)(?={WS}|\Z)")
CACHE = 500_000
#: Punctuation that is a pre-token of its own after letters.
MARKS = frozenset(",.;:!?")
#: Pre-tokens up to so many bytes are encoded in blocks.
WIDE = 128
SLICE = 1_000_000
NONE = np.int32(2**31 - 1)


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairTable:
    """(left id, right id) -> rank, by levels of multiplicative hashing: what collides on one level moves to the next."""

    def __init__(self, pairs: np.ndarray):
        keys, ranks = (pairs[:, 0].astype(np.uint64) << np.uint64(32)) | pairs[:, 1].astype(np.uint64), np.arange(len(pairs), dtype=np.int32)
        self.levels = []
        bits = max(4, int(len(keys)).bit_length() + 2)
        while len(keys):
            mult = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x61C88647 * len(self.levels))
            at = (keys * mult) >> np.uint64(64 - bits)
            _, first = np.unique(at, return_index=True)
            k, r = np.full(1 << bits, ~np.uint64(0)), np.full(1 << bits, NONE)
            k[at[first]], r[at[first]] = keys[first], ranks[first]
            self.levels.append((mult, np.uint64(64 - bits), k, r))
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, ranks, bits = keys[left], ranks[left], max(4, bits - 3)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        out = np.full(len(key), NONE)
        for mult, shift, k, r in self.levels:
            at = (key * mult) >> shift
            hit = k[at] == key
            out[hit] = r[at[hit]]
        return out


class Tokenizer:
    """Encodes and decodes as a byte-level BPE tokenizer file says. spec: the file's JSON."""

    def __init__(self, spec: dict):
        vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        chars = byte_chars()
        byte_of = {c: b for b, c in chars.items()}
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pairs = PairTable(pairs)
        self.ranks = {(int(a), int(b)): i for i, (a, b) in enumerate(pairs)}
        self.first = np.array([vocab[chars[b]] for b in range(256)], np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in chain(vocab.items(), self.special.items()):
            self.bytes[i] = t.encode() if i in self.special.values() else bytes(byte_of[c] for c in t)
        self.names = [str(i) for i in range(len(self.bytes))]
        self._forget()

    def _forget(self) -> None:
        """Empties the cache: slot of each chunk, and by slot the chunk's ids in one array. Chunks are written without the space they start with; a first chunk, which has none, is a tuple."""
        self.slots: dict[str | tuple[str], int] = {}
        self.store, self.starts, self.sizes = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.stored = 0

    # one pre-token

    def merge_one(self, token: bytes) -> list[int]:
        """A pre-token of any length: one scalar segment tree."""
        n = len(token)
        ids = [int(self.first[b]) for b in token]
        if n < 2:
            return ids
        width = 1 << (n - 1).bit_length()
        none = len(self.ranks) * width
        tree = [none] * (2 * width)
        rank = self.ranks.get
        for i in range(n - 1):
            r = rank((ids[i], ids[i + 1]))
            if r is not None:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, right: int) -> None:
            r = rank((ids[i], ids[right])) if right < n else None
            at, v = width + i, none if r is None else r * width + i
            while at and tree[at] != v:
                tree[at] = v
                at >>= 1
                v = min(tree[2 * at], tree[2 * at + 1]) if at else v

        while (root := tree[1]) < none:
            i = root % width
            j = after[i]
            ids[i], ids[j] = int(self.merged[root // width]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            put(j, n)
            put(i, after[i])
            if before[i] >= 0:
                put(before[i], i)
        return [x for x in ids if x >= 0]

    # many pre-tokens

    def merge_many(self, tokens: list[bytes]) -> list[list[int]]:
        """Pre-tokens of any lengths; those of up to WIDE bytes in blocks of equal tree width."""
        out: list[list[int]] = [[]] * len(tokens)
        by_width: dict[int, list[int]] = {}
        for i, t in enumerate(tokens):
            if len(t) > WIDE:
                out[i] = self.merge_one(t)
            elif t:
                by_width.setdefault(1 << max(1, (len(t) - 1).bit_length()), []).append(i)
        for width, at in by_width.items():
            for s in range(0, len(at), block := max(64, (1 << 19) // width)):
                part = at[s : s + block]
                for i, ids in zip(part, self._block([tokens[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _block(self, tokens: list[bytes], width: int) -> list[list[int]]:
        n = len(tokens)
        raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8)
        size = np.fromiter(map(len, tokens), np.int64, n)
        inside = (np.arange(width) < size[:, None]).ravel()
        ids = np.where(inside, self.first[raw], np.int32(-1))
        tree = np.full((n, 2 * width), NONE)
        flat = tree.ravel()
        left = np.flatnonzero(inside[:-1] & inside[1:] & (np.arange(1, n * width) % width > 0))
        rank = self.pairs.rank(ids[left], ids[left + 1])
        has = rank < NONE
        left, rank = left[has], rank[has]
        flat[left // width * 2 * width + width + left % width] = rank * np.int32(width) + (left % width).astype(np.int32)
        s = width // 2
        while s:
            np.minimum(tree[:, 2 * s : 4 * s : 2], tree[:, 2 * s + 1 : 4 * s : 2], out=tree[:, s : 2 * s])
            s //= 2
        after = np.tile(np.arange(1, width + 1), n)
        before = np.tile(np.arange(-1, width - 1), n)
        ends = np.zeros(n, np.int64) + size

        def leaf(rows: np.ndarray, at: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self.pairs.rank(ids[rows * width + at], ids[rows * width + right])
            return np.where(rank < NONE, rank * np.int32(width) + at.astype(np.int32), NONE)

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            i = (root % width).astype(np.int64)
            here = rows * width
            j = after[here + i]
            k = after[here + j]
            ids[here + i] = self.merged[root // width]
            ids[here + j] = -1
            after[here + i] = k
            more, p = k < ends[rows], before[here + i]
            before[(here + k)[more]] = i[more]
            has = p >= 0
            # the leaves of the merged pair's right half, of the new pair and of the one before it, then their paths
            new = np.full(len(rows), NONE)
            new[more] = leaf(rows[more], i[more], k[more])
            top = np.concatenate([rows, rows, rows[has]]) * (2 * width)
            node = np.concatenate([j, i, p[has]]) + width
            flat[top + node] = np.concatenate([np.full(len(rows), NONE), new, leaf(rows[has], p[has], i[has])])
            for _ in range(width.bit_length() - 1):
                node >>= 1
                child = top + 2 * node
                flat[top + node] = np.minimum(flat[child], flat[child + 1])
            rows = rows[tree[rows, 1] < NONE]
        keep = ids >= 0
        flat_ids, cuts = ids[keep].tolist(), np.concatenate([[0], np.cumsum(keep.reshape(n, width).sum(1))]).tolist()
        return [flat_ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    # texts

    def _pieces(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks that pre-tokenise each for itself."""
        parts = []
        for c in chunks:
            body = c[1:] if c[:1] == " " else c
            if body.isalpha():  # one pre-token
                parts.append((c,))
            elif body[-1:] in MARKS and body[:-1].isalpha():
                parts.append((c[:-1], c[-1]))
            else:
                parts.append(PRETOKEN.findall(c))
        distinct = list(set(chain.from_iterable(parts)))
        ids = dict(zip(distinct, self.merge_many([t.encode() for t in distinct]), strict=True))
        return [ids[p[0]] if len(p) == 1 else list(chain.from_iterable(map(ids.__getitem__, p))) for p in parts]

    def _remember(self, chunks: list[str | tuple[str]]) -> None:
        n, ids = len(self.slots), self._pieces([c[0] if isinstance(c, tuple) else " " + c for c in chunks])
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        while len(self.store) < self.stored + len(flat):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while len(self.starts) < n + len(ids):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.store[self.stored : self.stored + len(flat)] = flat
        self.sizes[n : n + len(ids)] = sizes
        self.starts[n : n + len(ids)] = self.stored + np.cumsum(sizes) - sizes
        self.stored += len(flat)
        self.slots.update(zip(chunks, range(n, n + len(ids)), strict=True))

    def _whole(self, text: str) -> np.ndarray:
        """A text with special tokens, or with white space that crosses chunks."""
        out: list[int] = []
        for k, segment in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append(self.special[segment])
            elif segment:
                tokens = PRETOKEN.findall(segment)
                distinct = list(set(tokens))
                ids = dict(zip(distinct, self.merge_many([t.encode() for t in distinct]), strict=True))
                out.extend(chain.from_iterable(map(ids.__getitem__, tokens)))
        return np.array(out, np.int32)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Chunks start at spaces; each distinct chunk is encoded once, and ids are gathered by chunk."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        plain, chunks, ends = [], [], []
        for i, text in enumerate(texts):
            if CROSSING.search(text) or self.split and any(s in text for s in self.special):
                out[i] = self._whole(text)
            elif text:
                plain.append(i)
                head, *rest = text.split(" ")
                chunks.append((head,))
                chunks += rest
                ends.append(len(chunks))
        if not chunks:
            return out
        distinct = set(chunks)
        fresh = [c for c in distinct if c not in self.slots]
        if len(self.slots) + len(fresh) > CACHE:
            self._forget()
            fresh = list(distinct)
        if fresh:
            self._remember(fresh)
        slot = np.fromiter(map(self.slots.__getitem__, chunks), np.int64, len(chunks))
        size = self.sizes[slot]
        till = np.cumsum(size)
        ids = self.store[np.repeat(self.starts[slot] - till + size, size) + np.arange(till[-1])]
        last = till[np.array(ends) - 1].tolist()
        for i, x, y in zip(plain, [0, *last[:-1]], last, strict=True):
            out[i] = ids[x:y]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, Tokenizer] = {}


def load(spec: str) -> Tokenizer:
    """The tokenizer of a file's text, kept in the worker with its cache."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizer(json.loads(spec))
    return _loaded[key]


@contextmanager
def no_gc():
    """The caches hold many small tuples and no cycles; walking them again and again costs more than the encoding."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _spec(path: str | None) -> str:
    with open(path or default_path(), encoding="utf-8") as f:  # on the driver; executors get the text (under 2 MB)
        return f.read()


def _slices(texts: list[str]) -> Iterable[list[str]]:
    """Runs of texts of about SLICE characters, so that their pieces stay small in memory."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= SLICE:
            yield run
            run, n = [], 0
    if run:
        yield run


def encode(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id and ids, array<int>, of every whole text."""
    spec = documents.sparkSession.sparkContext.broadcast(_spec(tokenizer_path))

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        tok = load(spec.value)
        texts = [t or "" for t in b["text"].to_pylist()]
        with no_gc():
            encoded = [ids for run in _slices(texts) for ids in tok.encode_many(run)]
        flat = [np.zeros(0, np.int32), *encoded]
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in encoded])])
        ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(flat)))
        return pa.RecordBatch.from_arrays([b["doc_id"], ids], ["doc_id", "ids"])

    return base.map_arrow(base.texts_of(documents, "doc_id", "text"), fn, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id and text of (doc_id, ids)."""
    spec = encoded.sparkSession.sparkContext.broadcast(_spec(tokenizer_path))

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        tok = load(spec.value)
        return pa.RecordBatch.from_arrays([b["doc_id"], pa.array([tok.decode(x or []) for x in b["ids"].to_pylist()], pa.string())], ["doc_id", "text"])

    return base.map_arrow(encoded.select("doc_id", "ids"), fn, "doc_id long, text string")


OWN = ("n_tokens", "ids", "round_trip")


def tokenize(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The documents with n_tokens, ids, and round_trip: whether the decoded ids are the text (null counts as empty). Columns of these names that came in are replaced."""
    spec = documents.sparkSession.sparkContext.broadcast(_spec(tokenizer_path))
    d = documents.drop(*OWN)
    at = d.columns.index("text")

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        tok = load(spec.value)
        texts = [t or "" for t in b.column(at).to_pylist()]
        with no_gc():
            encoded = [ids for run in _slices(texts) for ids in tok.encode_many(run)]
            same = [tok.decode(ids.tolist()) == t for ids, t in zip(encoded, texts, strict=True)]
        n = np.array([len(x) for x in encoded], np.int64)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *encoded])))
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(n), ids, pa.array(same, pa.bool_())], [*b.schema.names, *OWN])

    schema = T.StructType([*d.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    return base.map_arrow(d, fn, schema)


def digest(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The contract columns. Each text is encoded, and its ids decoded, in one pass; neither ids nor decoded texts leave the worker."""
    spec = documents.sparkSession.sparkContext.broadcast(_spec(tokenizer_path))

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        tok = load(spec.value)
        name, n, ids_sha, text_sha = tok.names.__getitem__, [], [], []
        with no_gc():
            for run in _slices([t or "" for t in b["text"].to_pylist()]):
                for ids in map(np.ndarray.tolist, tok.encode_many(run)):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return base.map_arrow(base.texts_of(documents, "doc_id", "text"), fn, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
