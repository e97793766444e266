"""Secret scan: fixed credential patterns, and random strings found by their token efficiency.

A string drawn at random splits into many short tokens under a byte-pair vocabulary, prose and
identifiers into few long ones. Candidates are maximal runs of credential characters of at least
MIN_RUN characters; those with fewer than MAX_RATIO characters a token are reported as kind
``entropy``, except known digests and identifiers (see ``KNOWN``).

Defined results: a null or empty text has no spans. Offsets are code points, end exclusive. A run that meets a
base span is not tested. Very long texts and runs take time in proportion to their length.
Repeated rows are scanned each for itself; null ids pass through.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import base

KINDS = ("assign", "access", "hex")
#: The base patterns and the least length of the match or, for assign, of group 2.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_CLASS = bytes(120 if 48 <= i <= 57 or 97 <= i <= 102 else 32 for i in range(256))
RUN_CLASS = bytes(120 if chr(i) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" else 32 for i in range(256))

#: Random strings: least length, and the characters a token below which a run counts as random.
MIN_RUN, MAX_RATIO = 20, 2.0
#: Very long runs are split into pieces of so many characters, a cut of which makes a token or two of thousands.
PIECE = 4096
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
#: Known digests and identifiers: UUIDs; pure decimal or hexadecimal strings (digests: hex is a base kind of its own); dates and times; digests named as such.
KNOWN = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]+|[0-9_+/=-]+(T[0-9_+/=-]+Z?)?|(sha\d{1,3}|md5)[-_:=/]?[A-Za-z0-9+/=]+")
#: Numbers and dates between separators of an identifier; the rest decides.
NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,8}(?![A-Za-z0-9])")


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=table, special_tokens={})


def is_random(s: str, encoding) -> bool:
    """Whether a run of credential characters reads as random: no known form, few characters a token."""
    if KNOWN.fullmatch(s):
        return False
    rest = NUMBER.sub("", s)
    n = sum(len(encoding.encode_ordinary(rest[i : i + PIECE])) for i in range(0, len(rest), PIECE))
    return len(rest) < MAX_RATIO * n


def _apart(runs: Iterable[re.Match], taken: list[tuple[int, int]]) -> Iterator[re.Match]:
    """The runs that overlap no taken span; both come sorted."""
    reach, i = 0, 0
    for m in runs:
        while i < len(taken) and taken[i][0] < m.end():
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= m.start():
            yield m


def scan(data: bytes, encoding) -> list[tuple[int, int, str]]:
    """Sorted (start, end, kind) of one UTF-8 text. Byte-level gates keep the patterns off texts that can't match."""
    found: list[tuple[int, int, str]] = []
    lower = data.lower()
    keyed = any(k in lower for k in KEYS)
    access = b"AKIA" in data
    hexed = b"x" * MIN_HEX in data.translate(HEX_CLASS)
    run = b"x" * MIN_RUN in data.translate(RUN_CLASS)
    if not (keyed or access or hexed or run):
        return found
    text = data.decode()
    if keyed:
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if access:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if hexed:
        found += [(*m.span(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    if run:
        taken = sorted((a, b) for a, b, _ in found)
        found += [(*m.span(), "entropy") for m in _apart(RUN.finditer(text), taken) if is_random(m[0], encoding)]
    order = {k: i for i, k in enumerate((*KINDS, "entropy"))}
    return sorted(found, key=lambda x: (x[0], order[x[2]], x[1]))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _ranks(path: str | None) -> bytes:
    with open(path or default_ranks(), "rb") as f:  # on the driver; executors get the bytes (under 1 MB)
        return f.read()


def scan_secrets(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """doc_id and found: array of (kind, start, stop) by start, then kind. ranks_path: a tiktoken vocabulary."""
    ranks = documents.sparkSession.sparkContext.broadcast(_ranks(ranks_path))

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoding(ranks.value)
        rows = [[{"kind": k, "start": s, "stop": e} for s, e, k in scan(t, enc)] for t in base.utf8(b["text"])]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([b["doc_id"], pa.array(rows, kind)], ["doc_id", "found"])

    return base.map_arrow(base.texts_of(documents, "doc_id", "text"), fn, "doc_id long, found array<struct<kind string, start long, stop long>>")


def mask_secrets(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """documents as they are, with every span found replaced by ``[kind]``; documents without one stay unchanged.

    All columns are kept; a column n_chars of an integer type follows the new text. Null texts stay null.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(_ranks(ranks_path))
    at = documents.columns.index("text")
    counted = "n_chars" in documents.columns

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoding(ranks.value)
        new, changed = [], False
        for t in b.column(at).cast(pa.binary()).to_pylist():
            spans = scan(t, enc) if t else []
            if spans:
                t, changed = _masked(t.decode(), spans).encode(), True
            new.append(t)
        if not changed:
            return b
        columns = list(b.columns)
        columns[at] = pa.array(new, pa.binary()).cast(columns[at].type)
        if counted and pa.types.is_integer(kind := b.schema.field(i := b.schema.names.index("n_chars")).type):
            columns[i] = pa.array([old if old is None or a == c else len(c.decode()) for old, a, c in zip(b.column(i).to_pylist(), b.column(at).cast(pa.binary()).to_pylist(), new, strict=True)], kind)
        return pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return base.map_arrow(documents, fn, documents.schema)


def _masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def digest(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """The contract columns: counts by base kind, digest of the base spans, all spans as text."""
    found = scan_secrets(documents, ranks_path)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        sha, spans = [], []
        for row in b["found"].to_pylist():
            said = [(x["kind"], f"{x['kind']}:{x['start']}:{x['stop']}") for x in row]
            for k in KINDS:
                counts[k].append(sum(x[0] == k for x in said))
            sha.append(hashlib.sha256(",".join(s for k, s in said if k in KINDS).encode()).hexdigest())
            spans.append(",".join(s for _, s in said))
        return pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(sha, pa.string()), pa.array(spans, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return base.map_arrow(found, fn, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
