"""Secret scan: fixed patterns plus character Markov models.

The fixed patterns are scanned in every whole text.  Their values are the
labelled sample of random strings; all other runs of identifier characters
are the sample of ordinary identifiers.  Second-order transition counts of
both classes are summed over the whole corpus, and a further run of at least
``MIN_RUN`` characters with letters and digits is reported as ``markov`` if the
log-likelihood ratio of "random" against "ordinary" exceeds ``MIN_TOTAL`` in
all and ``MIN_EACH`` a character.  Such spans never overlap a fixed one: of a run
that touches fixed spans the parts left over are scored, each as a run.

Defined results: null and empty texts have no spans; texts of any length are
scanned whole; spans that start together stand in the order of their kinds; without any labelled
sample the random model is uniform; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, small_batches

# The patterns of the base kinds, in their order.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Characters of identifiers and random strings; number 0 is everything else.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1
MIN_RUN = 20
MIN_WORD = 8
MIN_TOTAL = 25.0
MIN_EACH = 1.0
_CODE = np.zeros(256, dtype=np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, SIZE)
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
_DIGIT, _LETTER = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z]")


def base_spans(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind number, end) in bytes, (start, end) of the secret values)."""
    spans, values = [], []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(raw):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                spans.append((m.start(), 0, m.end()))
                values.append(m.span(2))
    if b"AKIA" in raw:
        for m in ACCESS.finditer(raw):
            if m.end() - m.start() >= ACCESS_LEAST:
                spans.append((m.start(), 1, m.end()))
                values.append(m.span())
    for m in HEX.finditer(raw):
        spans.append((m.start(), 2, m.end()))
        values.append(m.span())
    return spans, values


def _cells(codes: np.ndarray) -> np.ndarray:
    """Transition cells (two characters back, one back, character) of all places."""
    one = np.concatenate([[0], codes[:-1]])
    two = np.concatenate([[0, 0], codes[:-2]]) if len(codes) > 1 else np.zeros_like(codes)
    two = np.where(one == 0, 0, two)
    return (two * SIZE + one) * SIZE + codes


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SIZE ** 3), dtype=np.int64)
    any_rows = False
    for b in rows_of(batches):
        any_rows = True
        for text in b["text"].to_pylist():
            if not text:
                continue
            raw = text.encode()
            codes = _CODE[np.frombuffer(raw, dtype=np.uint8)]
            spans, values = base_spans(raw)
            for lo, hi in values:
                part = codes[lo:hi]
                np.add.at(counts[1], _cells(part)[part > 0], 1)
            for lo, _, hi in spans:
                codes[lo:hi] = 0
            inside = codes > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
            length = edge[1::2] - edge[::2]
            long = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(long, edge[::2][length >= MIN_WORD], 1)
            np.add.at(long, edge[1::2][length >= MIN_WORD], -1)
            cells = _cells(codes)[np.cumsum(long)[:-1] > 0]
            np.add.at(counts[0], cells, 1)
    if any_rows:
        kind, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(counts[kind, cell])],
            ["kind", "cell", "n"])


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio random : ordinary of every transition cell."""
    model = []
    for kind, prior in ((1, 0.5), (0, 0.02)):  # the random sample is narrower than what random strings may hold
        c = counts[kind].reshape(SIZE, SIZE, SIZE)[:, :, 1:].astype(float)
        lower = c.sum(axis=0, keepdims=True)
        lower = (lower + 1) / (lower.sum(axis=2, keepdims=True) + SIZE - 1)
        p = (c + 2 * lower) / (c.sum(axis=2, keepdims=True) + 2)
        p = (1 - prior) * p + prior / (SIZE - 1)
        full = np.zeros((SIZE, SIZE, SIZE))
        full[:, :, 1:] = np.log(p)
        model.append(full.ravel())
    return (model[0] - model[1]).astype(np.float32)


def train(docs: DataFrame) -> np.ndarray:
    """Ratio table from the transition counts of the whole corpus."""
    small_batches(docs.sparkSession)
    got = (docs.select("text").mapInArrow(_train, "kind int, cell int, n long")
           .groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow())  # at most 2 * SIZE**3 rows
    counts = np.zeros((2, SIZE ** 3), dtype=np.int64)
    counts[got["kind"].to_numpy(), got["cell"].to_numpy()] = got["n"].to_numpy()
    return ratios(counts)


def _outside(lo: int, hi: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of [lo, hi) that no fixed span covers; ``base`` is sorted by start."""
    for s, _, e in base:
        if s >= hi:
            break
        if e > lo:
            if s > lo:
                yield lo, s
            lo = e
    if lo < hi:
        yield lo, hi


def model_spans(raw: bytes, base: list[tuple[int, int, int]], table: np.ndarray) -> list[tuple[int, int, int]]:
    """Further random-looking runs, or the parts of them that are outside the fixed spans."""
    out = []
    base = sorted(base)
    for m in _RUN.finditer(raw):
        for lo, hi in _outside(*m.span(), base):
            run = raw[lo:hi]
            if len(run) < MIN_RUN or not _DIGIT.search(run) or not _LETTER.search(run):
                continue
            total = float(table[_cells(_CODE[np.frombuffer(run, dtype=np.uint8)])].sum())
            if total >= MIN_TOTAL and total >= MIN_EACH * len(run):
                out.append((lo, len(KINDS), hi))
    return out


def scan(text: str | None, table: np.ndarray) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(fixed spans, all spans) as (kind, start, end) in code points."""
    raw = (text or "").encode()
    base, _ = base_spans(raw)
    extra = model_spans(raw, base, table)
    every = sorted(base + extra)
    if every and not raw.isascii():
        point = np.cumsum(np.concatenate([[0], (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80]))
        every = [(int(point[s]), k, int(point[e])) for s, k, e in every]
    names = [*KINDS, "markov"]
    spans = [(names[k], s, e) for s, k, e in every]
    return [x for x in spans if x[0] != "markov"], spans


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_RESULT = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in rows_of(batches):
            rows = []
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                base, every = scan(text, table)
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((doc, *n, hashlib.sha256(_join(base).encode()).hexdigest(), _join(every),
                             len(every) - len(base)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"])
    return run


def secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of the secrets of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    return docs.select("doc_id", "text").mapInArrow(_scan(shared), _RESULT)
