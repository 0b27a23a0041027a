"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased, every run of anything but letters becomes one space,
and each text is read behind three spaces as character 4-grams.  Counts of all
training texts are summed in Spark per language; the models (discounted
4-grams, continuation counts below) are stored as sorted arrays of packed
n-grams with one column of log-probabilities per language, so that scoring a
text is one binary search per character, and a second or third one for unseen
n-grams.  The language of the lowest cross-entropy per character wins.

Confidence is calibrated by a logistic model of the margin to the runner-up,
the cross-entropy itself and the length.  Its sample is bounded: about
``SAMPLE`` different training texts a language, as themselves (right or wrong) and with
their characters shuffled (no language).  Below ``REJECT`` a text is rejected: text
in two known languages scores lower than in one, but far above noise.  The threshold
is between the held-out scores of both sides: clean texts of two languages in one
score 0.49 and more, random letters and languages never learned 0.001 at most.

Characters are folded to 64 symbols: the space, a to z, and 37 more that take
the other letters by code point (the lower-case letters of one alphabet stand
together, so they stay apart).  No 4-gram is dropped, yet there are at most
2^24 of them whatever the corpus holds, which bounds the model that is sent to
the tasks: 4 bytes an n-gram and 4 more a language.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if there is nothing to learn from; ties go to the
language first in code point order; rows repeat as they occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, rows_of, small_batches, store

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
#: First symbol of the letters beyond a to z, which are 1 to 26 (the space is 0).
OTHER = 27
#: Different training texts a language that calibrate the score (about).
SAMPLE = 400
REJECT = 0.1
UNDEFINED = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")
_COUNTS = "lang string, gram int, n long"


def normalise(text: str | None) -> str:
    """Lower-case letters with single spaces, without outer spaces."""
    return _NO_LETTERS.sub(" ", (text or "").lower()).strip()


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(packed 4-grams of all normalised texts, number of them per text)."""
    pad = " " * (ORDER - 1)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    flat = "".join([pad + t + " " for t in texts])
    code = np.frombuffer(flat.encode("utf-32-le"), dtype="<u4").astype(np.int32)
    sym = np.where(code == 32, 0, np.where((code >= 97) & (code <= 122), code - 96,
                                           OTHER + code % (SYMBOLS - OTHER))).astype(np.int32)
    key = sym[ORDER - 1:].copy()
    for back in range(1, ORDER):
        key |= sym[ORDER - 1 - back:len(sym) - back] << (BITS * back)
    keep = np.ones(len(key), dtype=bool)
    ends = np.cumsum(lengths + ORDER - 1)[:-1]
    for k in range(ORDER - 1):  # 4-grams that reach into the next text
        keep[ends - (ORDER - 1) + k] = False
    return key[keep], lengths


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in held[lang]])
        n = np.concatenate([c for _, c in held[lang]])
        u, at = np.unique(keys, return_inverse=True)
        return u, np.bincount(at, weights=n).astype(np.int64)

    for b in rows_of(batches):
        langs = np.array(b["lang"].to_pylist(), dtype=object)
        texts = [normalise(t) for t in b["text"].to_pylist()]
        for lang in sorted(set(langs)):
            some = [t for t, x in zip(texts, langs, strict=True) if x == lang and t]
            if some:
                held.setdefault(lang, []).append(np.unique(grams(some)[0], return_counts=True))
                if len(held[lang]) == 32:
                    held[lang] = [merged(lang)]
    for lang in held:
        keys, n = merged(lang)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])


@dataclass
class Model:
    """Sorted n-gram arrays, longest first, with log-probabilities by language."""

    langs: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None

    def score(self, key: np.ndarray) -> np.ndarray:
        """Log-probability of every packed 4-gram in every language."""
        out = np.zeros((len(key), len(self.langs)), dtype=np.float32)
        todo = np.arange(len(key))
        for level in range(ORDER):
            table = self.keys[level]
            here = key[todo] & ((1 << (BITS * (ORDER - level))) - 1)
            at = np.minimum(np.searchsorted(table, here), len(table) - 1)
            found = table[at] == here
            out[todo[found]] += self.logp[level][at[found]]
            todo, here = todo[~found], here[~found]
            if not len(todo):
                break
            if level == ORDER - 1:  # a symbol never seen
                out[todo] += self.backoff[level][0] - np.float32(np.log(SYMBOLS))
                break
            context = here >> BITS
            at = np.minimum(np.searchsorted(self.contexts[level], context), len(self.contexts[level]) - 1)
            seen = self.contexts[level][at] == context
            out[todo[seen]] += self.backoff[level][at[seen]]
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Mean negative log-probability per character, texts by languages."""
        key, lengths = grams(texts)
        starts = np.cumsum(lengths) - lengths
        sums = np.empty((len(texts), len(self.langs)))
        # score() in slices of whole texts, so that memory follows the slice
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + (1 << 20))))
            part = self.score(key[starts[first]:starts[last] if last < len(texts) else len(key)])
            sums[first:last] = np.add.reduceat(part.astype(np.float64), starts[first:last] - starts[first], axis=0)
            first = last
        return -sums / lengths[:, None]

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the best language, calibration features) per text."""
        h = self.entropies(texts)
        order = np.sort(h, axis=1)
        n = np.array([len(t) for t in texts], dtype=float)
        margin = order[:, 1] - order[:, 0] if len(self.langs) > 1 else np.ones(len(texts))
        return h.argmin(axis=1), np.stack([np.ones(len(n)), margin, order[:, 0], 1 / np.sqrt(n)], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, confidence) per raw text."""
        clean = [normalise(t) for t in texts]
        lang, score = [UNDEFINED] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(clean) if t]
        if some and self.langs:
            best, x = self.features([clean[i] for i in some])
            for i, b in zip(some, best.tolist(), strict=True):
                lang[i] = self.langs[b]
            score[some] = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        return lang, score


def build(counts: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Kneser-Ney models from (language, packed 4-grams, counts)."""
    model = Model([lang for lang, _, _ in counts])
    width = len(counts)
    if not width:
        return model
    per_level: list[list[tuple]] = [[] for _ in range(ORDER)]
    for _, gram, n in counts:
        order = np.argsort(gram)
        key, c = gram[order], n[order].astype(float)
        for level in range(ORDER):
            context, first = np.unique(key >> BITS, return_index=True)
            row = np.searchsorted(context, key >> BITS)
            total = np.add.reduceat(c, first)
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            kinds = np.add.reduceat(np.ones(len(c)), first)
            per_level[level].append((key, np.maximum(c - discount, 0) / total[row], context, discount * kinds / total))
            if level < ORDER - 1:  # continuation counts: different characters in front
                key, c = np.unique(key & ((1 << (BITS * (ORDER - 1 - level))) - 1), return_counts=True)
                c = c.astype(float)
    lower = None
    for level in reversed(range(ORDER)):
        key = np.unique(np.concatenate([p[0] for p in per_level[level]]))
        prob = np.zeros((len(key), width))
        if lower is None:
            base = np.full((len(key), width), 1.0 / SYMBOLS)
        else:
            short = key & ((1 << (BITS * (ORDER - 1 - level))) - 1)
            base = np.exp(lower(short))
        for j, (own, p, context, gamma) in enumerate(per_level[level]):
            at = np.minimum(np.searchsorted(context, key >> BITS), len(context) - 1)
            g = np.where(context[at] == key >> BITS, gamma[at], 1.0)
            prob[:, j] = g * base[:, j]
            prob[np.searchsorted(key, own), j] += p
        contexts = np.unique(np.concatenate([p[2] for p in per_level[level]]))
        back = np.zeros((len(contexts), width), dtype=np.float32)
        for j, (_, _, context, gamma) in enumerate(per_level[level]):
            back[np.searchsorted(contexts, context), j] = np.log(gamma)
        model.keys.insert(0, key)
        model.logp.insert(0, np.log(prob).astype(np.float32))
        model.contexts.insert(0, contexts)
        model.backoff.insert(0, back)
        depth = level

        def lower(k: np.ndarray, depth: int = depth) -> np.ndarray:
            """Log-probabilities of shorter n-grams from the levels built so far."""
            part = Model(model.langs, model.keys, model.logp, model.contexts, model.backoff)
            out = np.zeros((len(k), width))
            todo = np.arange(len(k))
            for lv in range(ORDER - depth):
                here = k[todo] & ((1 << (BITS * (ORDER - depth - lv))) - 1)
                at = np.minimum(np.searchsorted(part.keys[lv], here), len(part.keys[lv]) - 1)
                ok = part.keys[lv][at] == here
                out[todo[ok]] += part.logp[lv][at[ok]]
                todo, here = todo[~ok], here[~ok]
                if not len(todo):
                    break
                if lv == ORDER - depth - 1:
                    out[todo] += part.backoff[lv][0] - np.log(SYMBOLS)
                    break
                ctx = here >> BITS
                at = np.minimum(np.searchsorted(part.contexts[lv], ctx), len(part.contexts[lv]) - 1)
                ok = part.contexts[lv][at] == ctx
                out[todo[ok]] += part.backoff[lv][at[ok]]
            return out
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method for a ridge-regularised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w - np.linalg.solve(hess, grad)
    return w


def _shuffled(text: str, seed: int) -> str:
    chars = np.array(list(text))
    np.random.default_rng(seed).shuffle(chars)
    return re.sub(" +", " ", "".join(chars)).strip()


def _calibrate(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in rows_of(batches):
            pairs = [(normalise(t), x) for t, x in zip(b["text"].to_pylist(), b["lang"].to_pylist(), strict=True)]
            pairs = [(t, x) for t, x in pairs if t]
            texts = [t for t, _ in pairs] + [_shuffled(t, len(t)) for t, _ in pairs]
            if not pairs:
                continue
            best, x = model.features(texts)
            right = [model.langs[i] == lang for i, (_, lang) in zip(best, pairs, strict=False)] + [False] * len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), pa.array(right)], ["x", "right"])
    return run


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of the rows (text, lang) of ``docs``; null languages are ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = store(docs.mapInArrow(_count, _COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lm")
    rows = []
    for lang in sorted(r["lang"] for r in counts.select("lang").distinct().collect()):
        got = counts.where(F.col("lang") == lang).select("gram", "n").toArrow()
        rows.append((lang, got["gram"].to_numpy(), got["n"].to_numpy()))
    drop(counts)
    model = build(rows)
    if model.langs:
        # sampled by text, copies once: a text with very many copies fills no sample
        texts = docs.select("lang", "text", F.xxhash64("text").alias("hash"))
        sizes = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(
            F.approx_count_distinct("hash").alias("n")).collect()}
        share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in sizes.items()))
        some = (texts.where(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30))
                .groupBy("lang", "hash").agg(F.first("text").alias("text")))
        shared = spark.sparkContext.broadcast(model)
        got = some.mapInArrow(_calibrate(shared), "x array<double>, right boolean").collect()
        x, y = np.array([r["x"] for r in got]).reshape(-1, 4), np.array([r["right"] for r in got], dtype=float)
        model.weights = logistic(x, y)
    return model


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in rows_of(batches):
            lang, score = model.predict(b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.int64()), b["held_out"], pa.array(lang), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])
    return run


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that are never learned from; a null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row; learns from the rows that
    are not held out."""
    model = train(docs.where(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double"))


def _accept(shared, reject: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in rows_of(batches):
            lang, score = model.predict(b["text"].to_pylist())
            keep = (score >= reject) & (np.array(lang, dtype=object) != UNDEFINED)
            if keep.any():
                yield b.filter(pa.array(keep))
    return run


def accepted(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """Rows of ``docs`` whose language is recognised."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs.where(~held_out())))
    return docs.mapInArrow(_accept(shared, reject), docs.schema)
