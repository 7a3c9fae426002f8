"""Secret scan: fixed patterns, and strings that a primed compressor cannot
shorten.

Base kinds (``assign``, ``access``, ``hex``) are the patterns of the contract;
their spans are always reported. The method adds ``novel`` spans: a candidate
is a run of ``MIN_RUN`` or more characters of the secret alphabet, with letters
and digits, that touches no base span and has a sensitive word within
``CONTEXT`` bytes before it. Its novelty is what it adds to the zstandard size
of the text around it, the compressor being primed with a dictionary of
identifiers; a candidate that adds ``MIN_RATIO`` of its own length or more is
reported.

The dictionary holds common identifiers of code and the ``TOP_IDENTIFIERS``
most frequent names before ``=``, ``:`` or ``(``, counted over all texts and
combined in every task before the shuffle. The most frequent stand last,
where they are nearest to the text.

Everything is matched on UTF-8 bytes, where the patterns' ASCII characters can
be nothing else; spans are reported in code points.

Defined cases: a null text is empty and has no spans; repeated rows are
scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import slices, text_bytes

#: Fixed patterns and least lengths of the contract.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "novel")

MIN_RUN = 20
CONTEXT = 64
MIN_RATIO = 0.7
TOP_IDENTIFIERS = 2048
FLUSH = 100_000

SENSITIVE = re.compile(
    rb"key|secret|token|passw|pwd|auth|bearer|credential|private|signature|session|cookie|jwt|login", re.IGNORECASE
)

#: Identifiers that are common in code of any kind.
COMMON_IDENTIFIERS = """
abstract args array async await begin boolean break bytes callback catch char class client close config connect
const constructor content context continue count create data debug decode default define delete description
double else encode enum error event except exception export extends false field file filter final float format
function global handle header host http https implements import index init input instance interface integer
length lambda license list local login logger method module name namespace next null number object open option
output override package param parse path pattern port print private process property protected public query
raise range read record reference register remove request response result return save schema select self send
server service session settings size socket source start state static status stop string struct super switch
system table template test text this throw time timeout true type undefined update upload user username value
version virtual void while width window with write yield authorization bearer access_key secret_key api_key
password token client_id client_secret private_key public_key
""".split()

_HEX = bytes(104 if chr(c) in "0123456789abcdef" else 46 for c in range(256))
_HEX_RUN = re.compile(rb"h{%d,}" % MIN_HEX)
_RUN = bytes(114 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_=-") else 46 for c in range(256))
_RUNS = re.compile(rb"r{%d,}" % MIN_RUN)
_NAME = re.compile(rb"([A-Za-z_][A-Za-z0-9_]{2,31})[\x20\x09]*$")
_AFTER_NAME = re.compile(rb"[=:(]")


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the base patterns, in bytes."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in text:
        out += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    runs = text.translate(_HEX)
    if b"h" * MIN_HEX in runs:
        out += [(*m.span(), 2) for m in _HEX_RUN.finditer(runs)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def candidates(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    runs = text.translate(_RUN)
    if b"r" * MIN_RUN not in runs:
        return []
    out = []
    for m in _RUNS.finditer(runs):
        a, b = m.span()
        run = text[a:b]
        if not any(48 <= c <= 57 for c in run) or run.isdigit() or not re.search(rb"[A-Za-z]", run):
            continue
        if any(s < b and a < e for s, e, _ in base):
            continue
        if SENSITIVE.search(text, max(0, a - CONTEXT), a):
            out.append((a, b))
    return out


def compressor(names: list[bytes]) -> zstandard.ZstdCompressor:
    """Primed with the identifiers; ``names`` most frequent first."""
    content = b" ".join([*(n.encode() for n in COMMON_IDENTIFIERS), *reversed(names)])
    primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=9)
    return zstandard.ZstdCompressor(dict_data=primed, write_checksum=False, write_content_size=False)


def marginal(zstd: zstandard.ZstdCompressor, text: bytes, a: int, b: int) -> int:
    """Bytes that the candidate adds to its compressed surroundings."""
    before, after = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    return len(zstd.compress(before + text[a:b] + after)) - len(zstd.compress(before + after))


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    first = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(first)])
    return [(int(at[a]), int(at[b]), k) for a, b, k in spans]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def names_in(text: bytes):
    """Names before ``=``, ``:`` or ``(``."""
    for m in _AFTER_NAME.finditer(text):
        if found := _NAME.search(text[max(0, m.start() - 40) : m.start()]):
            yield found[1]


def identifiers(docs: DataFrame, top: int = TOP_IDENTIFIERS) -> list[bytes]:
    """The most frequent names over all texts: ``top`` of them at most."""

    def run(batches):
        count: Counter[bytes] = Counter()

        def out():
            pairs = list(count.items())
            count.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.int64())], ["name", "n"]
            )

        for b in slices(batches):
            for text in text_bytes(b):
                count.update(names_in(text))
            if len(count) >= FLUSH:
                yield out()
        if count:
            yield out()

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "name binary, n bigint")
    ranked = found.groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(top)
    return [bytes(r["name"]) for r in ranked.collect()]


def scan(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel``."""
    names = docs.sparkSession.sparkContext.broadcast(identifiers(docs))

    def run(batches):
        zstd = compressor(names.value)
        for batch in slices(batches):
            rows = []
            for text in text_bytes(batch):
                base = base_spans(text)
                novel = [
                    (a, b, 3) for a, b in candidates(text, base) if marginal(zstd, text, a, b) >= min_ratio * (b - a)
                ]
                every = code_points(text, sorted(base + novel, key=lambda s: (s[0], s[2])))
                of = Counter(k for _, _, k in every)
                digest = hashlib.sha256(joined([s for s in every if s[2] < 3]).encode()).hexdigest()
                rows.append((of[0], of[1], of[2], digest, joined(every), of[3]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint"
    )
