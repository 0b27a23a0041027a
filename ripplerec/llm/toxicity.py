"""Toxicity: Levenshtein automata intersected with a lexicon trie.

The lexicon is learned from the labelled rows that are not held out: words and
word stems that are far more frequent in toxic documents.  It is held as a
trie; the Levenshtein automaton of every entry runs over the trie at once
(``LexiconAutomaton`` for one word, ``lexicon.LexiconWalk`` for a sorted
vocabulary).  Every distinct word of the corpus is matched once, and the words that hit
are a map for the pass over the documents.  Stems and terms of
four letters match with one edit as weak hits, shorter terms only as they are
spelled; weak hits are features of their own.  A hit inside
quotation marks or behind a reporting word within ``WINDOW`` words is counted
as quotation, any other as abuse.  A logistic model over the hit counts gives
the score.

Counts cover every labelled row; the logistic model is fitted to at most about
``SAMPLE`` distinct texts of them, each with the number of its rows as weight.  A lexicon
or a map of hits beyond its bound in bytes is taken in blocks: hits are found, and
counts summed, block by block.

Defined results: null and empty texts have no hits; labels of null or unknown
documents are ignored, and a document labelled more than once counts as often;
without any label the score is 0.  A quotation may be of any length within its
paragraph (up to a blank line).  Repeated rows are scored each; ties cannot
arise, and further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, parts, rows_of, small_batches, store
from .langid import held_out
from .lexicon import LexiconWalk

THRESHOLD = 0.3
SAMPLE = 20_000
#: A term is in at least so many toxic documents at every size of the corpus, ...
MIN_SUPPORT = 3
#: ... so many times as frequent there as in the others ...
MIN_LIFT = 10.0
#: ... and not by chance: log-likelihood ratio of its counts (1 in 1,000).
MIN_RATIO = 10.83
#: Bytes of terms in one block of the lexicon; a trie has at most so many nodes.
MAX_LEXICON_BYTES = 2 << 20
#: Bytes of matched words that are sent to the tasks at once.
MAX_HIT_BYTES = 16 << 20
#: Distinct words that a task gathers before it passes them on.
FLUSH_WORDS = 400_000
STEM_LENGTHS = range(5, 13)
WINDOW = 4
#: Words that a worker remembers the automaton's answer for.
CACHE_WORDS = 400_000
#: States that an automaton keeps before it starts anew.
CACHE_STATES = 200_000

_WORD = re.compile(r"[^\W_]+(?:[*@$][^\W_]+)*")
_QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“"}
# Words that introduce a quotation or mention.
REPORTING = frozenset(("said says called calls wrote word words term quote quoted quotes "
                       "sagte nannte wort begriff dit appelle mot terme dijo llama palabra").split())
FEATURES = ["constant", "abuse", "abuse fuzzy", "quoted", "density", "weak", "weak quoted"]


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _terms_of(word: str) -> tuple[str, ...]:
    return (word + " ", *(word[:n] for n in STEM_LENGTHS if n < len(word)))


def terms(tokens: list[str], known: dict[str, tuple[str, ...]] | None = None) -> set[str]:
    """Words (ending in a space) and their stems; ``known`` remembers those of a word."""
    out: set[str] = set()
    for w in set(tokens):
        if known is None:
            out.update(_terms_of(w))
            continue
        of = known.get(w)
        if of is None:
            of = known[w] = _terms_of(w)
        out.update(of)
    return out


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of toxic and of other documents that hold each term."""
    bad: Counter = Counter()
    good: Counter = Counter()
    known: dict[str, tuple[str, ...]] = {}

    def rows() -> pa.RecordBatch:
        names = list(bad.keys() | good.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([bad[t] for t in names], pa.int64()),
             pa.array([good[t] for t in names], pa.int64())], ["term", "bad", "good"])

    for b in rows_of(batches):
        for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
            (bad if toxic else good).update(terms(words(text), known))
            if len(known) > CACHE_WORDS // 4:
                known.clear()
            if len(bad) + len(good) > 1_000_000:
                yield rows()
                bad.clear()
                good.clear()
    yield rows()


def _ratio(n_bad: int, n_good: int) -> Column:
    """Log-likelihood ratio of a term's counts against equal shares in both classes."""
    total, n = F.col("bad") + F.col("good"), n_bad + n_good
    cells = [(F.col("bad"), n_bad * total / n), (F.col("good"), n_good * total / n),
             (n_bad - F.col("bad"), n_bad * (n - total) / n), (n_good - F.col("good"), n_good * (n - total) / n)]
    return 2 * sum((F.when(x > 0, x * F.log(x / e)).otherwise(0.0) for x, e in cells), F.lit(0.0))


def lexicon_counts(known: DataFrame, n_bad: int, n_good: int) -> DataFrame:
    """(term, bad, good) of the terms that tell toxic documents from others."""
    lift = (F.col("bad") / n_bad) / ((F.col("good") + 0.5) / (n_good + 1))
    return (known.mapInArrow(_document_terms, "term string, bad long, good long")
            .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .where((F.col("bad") >= MIN_SUPPORT) & (lift >= MIN_LIFT) & (_ratio(n_bad, n_good) >= MIN_RATIO)))


def choose(counts: list[tuple[str, int, int]], n_bad: int, n_good: int) -> list[tuple[str, bool]]:
    """(term, is a stem) entries of the lexicon from document counts."""
    lift = {t: (b / n_bad) / ((g + 0.5) / (n_good + 1)) for t, b, g in counts}
    support = {t: b for t, b, _ in counts}
    good = {t for t in lift if lift[t] >= MIN_LIFT}
    children: dict[str, list[str]] = {}
    for t in good:
        for n in STEM_LENGTHS:
            if n < len(t) and t[:n] in good:
                children.setdefault(t[:n], []).append(t)
    for stem, longer in sorted(children.items(), key=lambda x: len(x[0])):
        if stem not in good:
            continue
        longer = [t for t in longer if t in good]
        if any(support[t] >= 0.9 * support[stem] for t in longer):
            good.discard(stem)  # a longer entry says the same
        else:  # whole words stay, for their misspellings
            good.difference_update([t for t in longer if not t.endswith(" ")])
    return sorted((t.rstrip(" "), not t.endswith(" ")) for t in good)


def choose_table(found: DataFrame) -> DataFrame:
    """(term, stem): ``choose`` for a lexicon table (term, bad, good) of any size; one
    round per stem length, each on a written table."""
    good = store(found.select("term", "bad"), "terms")
    for n in STEM_LENGTHS:
        stems = good.where((F.length("term") == n) & ~F.col("term").endswith(" ")).select(
            F.col("term").alias("stem"), F.col("bad").alias("own"))
        longer = good.where(F.length("term") > n).select("term", "bad", F.substring("term", 1, n).alias("stem"))
        # every stem with something longer, and whether a longer entry says the same
        same = (longer.join(stems, "stem").groupBy("stem").agg(F.max(F.col("bad") >= 0.9 * F.col("own")).alias("said")))
        same = store(same, "stems")
        out = same.where("said").select(F.col("stem").alias("term")).union(
            longer.join(same.where("not said"), "stem").where(~F.col("term").endswith(" ")).select("term"))
        after = store(good.join(out, "term", "left_anti"), "terms")
        drop(good)
        good = after
    return good.select(F.rtrim("term").alias("term"), (~F.col("term").endswith(" ")).alias("stem"))


def edits(term: str, stem: bool) -> int:
    """Edits within which a word is taken for the entry."""
    return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2


def weak_edits(term: str, stem: bool) -> int:
    """Edits within which a word may be the entry: stems and terms of four
    letters with one edit are often other words, so the fit weighs them."""
    return max(edits(term, stem), 1 if stem or len(term) == 4 else 0)


class LexiconAutomaton:
    """Deterministic automaton of all words within the edit budget of a term."""

    def __init__(self, entries: list[tuple[str, bool]], allowed=edits):
        self.child: list[dict[str, int]] = [{}]
        self.end: list[int] = [0]  # 1: a word ends here, 2: any suffix may follow
        self.budget: list[int] = [0]  # the most edits any term below may use
        self.own: list[int] = [0]
        self.tail: list[int] = [-1]  # a stem's edits, after which any suffix may follow
        for term, stem in entries:
            budget = allowed(term, stem)
            node = 0
            self.budget[0] = max(self.budget[0], budget)
            for ch in term:
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.end.append(0)
                    self.budget.append(0)
                    self.own.append(0)
                    self.tail.append(-1)
                node = self.child[node][ch]
                self.budget[node] = max(self.budget[node], budget)
            self.end[node] = max(self.end[node], 2 if stem else 1)
            self.own[node] = max(self.own[node], budget)
            if stem:
                self.tail[node] = max(self.tail[node], budget)
        self._reset()

    def _reset(self) -> None:
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.step: list[dict[str, int]] = []
        self.accept: list[int] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        """With the term characters that the word leaves out, least edits only."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, used = todo.pop()
            if used > self.budget[node] or best.get(node, 99) <= used:
                continue
            best[node] = used
            todo += [(c, used + 1) for c in self.child[node].values()]
        return frozenset(best.items())

    def _state(self, items: frozenset) -> int:
        if items not in self.number:
            self.number[items] = len(self.states)
            self.states.append(items)
            self.step.append({})
            # 2: an entry as it is spelled, 1: within its budget
            hit = [used for node, used in items if self.end[node] and used <= self.own[node]]
            self.accept.append(0 if not hit else 2 if min(hit) == 0 else 1)
        return self.number[items]

    def _next(self, state: int, ch: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, used in self.states[state]:
            if used <= self.tail[node]:
                out.add((node, used))  # a stem stays matched
            out.add((node, used + 1))  # the word has one more character
            for c, nxt in self.child[node].items():
                out.add((nxt, used + (c != ch)))
        to = self._state(self._closed(out))
        self.step[state][ch] = to
        return to

    def match(self, word: str) -> int:
        """2: a term, 1: a misspelled one, 0: neither."""
        if len(self.states) > CACHE_STATES:
            self._reset()
        state = self.start
        for ch in word:
            to = self.step[state].get(ch)
            state = self._next(state, ch) if to is None else to
            if state == self.dead:
                return 0
        return self.accept[state]


class Scorer:
    """Features of a text under one lexicon."""

    def __init__(self, entries: list[tuple[str, bool]], weights: np.ndarray | None = None):
        self.automaton = LexiconAutomaton(entries)
        # only the entries that may have more edits than the first automaton gives them
        self.weak = LexiconAutomaton([e for e in entries if weak_edits(*e) > edits(*e)], weak_edits)
        self.weights = weights
        self.seen: dict[str, int] = {}

    def match(self, word: str) -> int:
        """2: a term, 1: a misspelled one, 3: perhaps one, 0: none."""
        return self.automaton.match(word) or (3 if self.weak.match(word) else 0)

    def features(self, text: str | None) -> list[float]:
        seen = self.seen
        if len(seen) > CACHE_WORDS:
            seen.clear()
        tokens = set(words(text))
        for w in tokens.difference(seen):
            seen[w] = self.match(w)
        return vector(counts(text, {w: seen[w] for w in tokens if seen[w]}))

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.features(text), self.weights), -30, 30))))


def counts(text: str | None, kinds: dict[str, int]) -> list[int]:
    """Exact, misspelled, quoted, weak and weak quoted hits, and words, of one text;
    ``kinds`` has the words that hit."""
    tokens = words(text)
    if kinds.keys().isdisjoint(tokens):
        return [0, 0, 0, 0, 0, len(tokens)]
    low = text.lower()
    quoted = quotation(low)
    exact = fuzzy = mention = weak = weak_mention = 0
    for i, m in enumerate(_WORD.finditer(low)):
        kind = kinds.get(m.group())
        if kind:
            if quoted[m.start()] or not REPORTING.isdisjoint(tokens[max(0, i - WINDOW):i]):
                mention += kind != 3
                weak_mention += kind == 3
            elif kind == 3:
                weak += 1
            elif kind == 2:
                exact += 1
            else:
                fuzzy += 1
    return [exact, fuzzy, mention, weak, weak_mention, len(tokens)]


def vector(n: list[int]) -> list[float]:
    """Features of one text's counts."""
    exact, fuzzy, mention, weak, weak_mention, tokens = n
    density = 1000.0 * exact / tokens if exact else 0.0
    return [1.0, *(float(np.log1p(x)) for x in (exact, fuzzy, mention, density, weak, weak_mention))]


def quotation(text: str) -> np.ndarray:
    """Per character: inside quotation marks that close in the same paragraph."""
    inside = np.zeros(len(text) + 1, dtype=bool)
    for left, right in _QUOTES.items():
        at = text.find(left)
        end = -1  # of the paragraph
        while at >= 0:
            if end < at:
                end = text.find("\n\n", at)
                end = len(text) if end < 0 else end
            close = text.find(right, at + 1, end)
            if close < 0:
                at = text.find(left, end)
                continue
            inside[at:close] = True
            at = text.find(left, close + 1)
    return inside


# ------------------------------------------------------------------ over the corpus

def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[str] = set()
    for b in rows_of(batches):
        for text in b["text"].to_pylist():
            seen.update(words(text))
        if len(seen) > FLUSH_WORDS:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])
            seen.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])


def _match(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strong, weak = (LexiconWalk(a) for a in shared.value)
        for b in rows_of(batches):
            some = sorted(b["word"].to_pylist())
            kind = strong.match(some)
            kind = np.where(kind > 0, kind, np.where(weak.match(some) > 0, 3, 0))
            hit = np.flatnonzero(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([some[i] for i in hit], pa.string()), pa.array(kind[hit], pa.int32())], ["word", "kind"])
    return run


def hits(docs: DataFrame, blocks: list[list[tuple[str, bool]]]) -> DataFrame:
    """(word, kind) of the distinct words of ``docs`` that an entry of any block takes: 2 exact,
    1 misspelled, 3 weak, the first of these that holds in some block."""
    spark = docs.sparkSession
    vocabulary = store(docs.select("text").mapInArrow(_words, "word string").distinct(), "vocabulary")
    # neighbours in order share their prefixes' work
    size = vocabulary.count()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    ordered = vocabulary.repartitionByRange(max(parts(size, 100_000), 1), "word").sortWithinPartitions("word")
    found = None
    for entries in blocks:
        automata = (LexiconAutomaton(entries), LexiconAutomaton([e for e in entries if weak_edits(*e) > edits(*e)], weak_edits))
        some = ordered.mapInArrow(_match(spark.sparkContext.broadcast(automata)), "word string, kind int")
        found = some if found is None else found.union(some)
    if len(blocks) > 1:
        order = F.when(F.col("kind") == 2, 0).otherwise(F.col("kind"))
        found = found.groupBy("word").agg(F.min_by("kind", order).alias("kind"))
    found = store(found, "hits")
    drop(vocabulary)
    small_batches(spark)
    return found


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = shared.value
        for b in rows_of(batches):
            found = pa.array([counts(t, kinds) for t in b["text"].to_pylist()], pa.list_(pa.int64()))
            kept = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), found], [*kept, "hits"])
    return run


def counted(rows: DataFrame, found: DataFrame, max_bytes: int = MAX_HIT_BYTES) -> DataFrame:
    """``rows`` (text and further columns) with ``hits``, the counts of each text, instead of the text."""
    spark = rows.sparkSession
    small_batches(spark)
    kept = [f for f in rows.schema if f.name != "text"]
    size = found.agg(F.sum(F.octet_length("word") + 8)).first()[0] or 0
    blocks = parts(size, max_bytes)
    if blocks > 1:  # the counts of several passes are summed by row
        rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    out = None
    for block in range(blocks):
        part = found.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast({r["word"]: r["kind"] for r in part.collect()})
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
        some = rows.mapInArrow(_count(shared), f"{fields}, hits array<long>")
        out = some if out is None else out.union(some)
    if blocks > 1:
        sums = [F.sum(F.col("hits")[i]) for i in range(5)] + [F.max(F.col("hits")[5])]
        out = out.groupBy("_row").agg(*(F.first(f.name).alias(f.name) for f in kept), F.array(*sums).alias("hits"))
    return out.select(*(f.name for f in kept), "hits")


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Newton's method for a ridge-regularised logistic regression of rows that count ``n`` times."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w - np.linalg.solve(hess, grad)
    return w


def _marks(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, max_bytes: int = MAX_LEXICON_BYTES) -> tuple[list[list[tuple[str, bool]]], int]:
    """(blocks of lexicon entries, labelled rows) from the labelled documents that are not held out;
    no blocks without both classes."""
    small_batches(docs.sparkSession)
    # one plan at every size: labels grow with the documents, so they are never broadcast
    known = docs.select("doc_id", "text").where(~held_out()).join(_marks(labels).hint("merge"), F.col("doc_id") == F.col("_id"))
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_good:
        return [], 0
    found = store(lexicon_counts(known.select("text", "toxic"), n_bad, n_good), "lexicon")
    size = found.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    if size <= max_bytes:
        blocks = [choose([(r["term"], r["bad"], r["good"]) for r in found.collect()], n_bad, n_good)]
    else:
        table = store(choose_table(found), "entries")
        n = parts(table.agg(F.sum(F.octet_length("term"))).first()[0] or 0, max_bytes / 2)
        blocks = [sorted((r["term"], r["stem"]) for r in table.where(F.pmod(F.xxhash64("term"), F.lit(n)) == i).collect())
                  for i in range(n)]
    drop(found)
    return blocks, n_bad + n_good


def weigh(docs: DataFrame, labels: DataFrame, found: DataFrame, rows: int, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the features, fitted to a sample by text: copies of a text are one row with a weight."""
    share = min(1.0, sample / rows)
    some = docs.select("doc_id", "text").where(~held_out() & (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30)))
    some = (some.join(_marks(labels).hint("merge"), F.col("doc_id") == F.col("_id"))
            .groupBy(F.xxhash64("text").alias("_text"), "toxic").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")))
    got = counted(some.select("text", "toxic", "n"), found).collect()
    x = np.array([vector(r["hits"]) for r in got]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["toxic"] for r in got], dtype=float), np.array([r["n"] for r in got], dtype=float))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[str, bool]], np.ndarray | None]:
    """(lexicon, weights) from the labelled documents that are not held out."""
    blocks, rows = learn(docs, labels)
    if not rows:
        return [], None
    return sorted(e for b in blocks for e in b), weigh(docs, labels, hits(docs, blocks), rows, sample)


def _score(weights: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            if weights is None:
                score = np.zeros(b.num_rows)
            else:
                x = np.array([vector(n) for n in b["hits"].to_pylist()])
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.int64()), b["held_out"], pa.array(score),
                 pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, lexicon_bytes: int = MAX_LEXICON_BYTES,
             hit_bytes: int = MAX_HIT_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    blocks, rows = learn(docs, labels, lexicon_bytes)
    found, weights = hits(docs, blocks or [[]]), None
    if rows:
        weights = weigh(docs, labels, found, rows)
    out = counted(docs.select("doc_id", held_out().alias("held_out"), "text"), found, hit_bytes)
    return out.mapInArrow(_score(weights), "doc_id long, held_out boolean, score double, predicted int")
