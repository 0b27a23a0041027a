"""The lexicon walk against the automaton; blocks, hot texts and long quotations."""

import collections
import random
import zlib

import pytest

from ripplerec.llm import toxicity
from ripplerec.llm.lexicon import LexiconWalk


@pytest.mark.parametrize("seed", range(12))
def test_walk_equals_the_automaton(seed):
    rng, letters = random.Random(seed), "abcé"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    entries = sorted({(word(rng.randrange(1, 12)), rng.random() < 0.3) for _ in range(rng.randrange(40))})
    words = sorted({word(rng.randrange(16)) for _ in range(500)} | {t for t, _ in entries} | {t + "ab" * 30 for t, _ in entries})
    for allowed in (toxicity.edits, toxicity.weak_edits):
        automaton = toxicity.LexiconAutomaton(entries, allowed)
        assert LexiconWalk(automaton).match(words).tolist() == [automaton.match(w) for w in words]


def _tables(spark, n=400):
    """A third of all labelled rows are one text; toxic words have inflected and misspelled forms."""
    rng = random.Random(5)
    ids = [i for i in range(4 * n) if zlib.crc32(str(i).encode()) % 4 != 2][:n]
    plain = ["common", "things", "about", "weather", "scummy", "people"]
    bad = ["grumblefish", "grumblefishes", "grumblefishing", "scoundrel", "scum"]
    rows = []
    for k, i in enumerate(ids):
        toxic = k % 3 == 0
        text = " ".join(rng.choices(plain, k=6) + ([rng.choice(bad)] if toxic else []) + [f"w{rng.randrange(200)}"])
        rows.append((i, "you scoundrel of the many copies" if k % 3 == 1 and k % 2 else text, int(toxic or (k % 3 == 1 and k % 2))))
    rows += [(10**6 + j, t, None) for j, t in enumerate(["grumblefsh", "scoundrels", None, "", "a scumm"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    extra = df.selectExpr("doc_id", "text", "1 as toxic", "'x' as hits", "'y' as word", "2 as kind", "3 as _row", "'z' as n")
    return extra, df.where("toxic is not null").selectExpr("doc_id", "toxic", "'t' as text", "0 as quality")


def test_blocks_of_lexicon_and_hits_give_the_same_scores(spark):
    docs, labels = _tables(spark)
    want = collections.Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in toxicity.toxicity(docs, labels).collect())
    assert sum(r[3] for r in want) > 50
    got = toxicity.toxicity(docs, labels, lexicon_bytes=40, hit_bytes=60).collect()
    assert collections.Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in got) == want


def test_lexicon_table_is_chosen_like_a_small_one(spark):
    docs, labels = _tables(spark)
    known = docs.select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    bad, good = collections.Counter(), collections.Counter()
    for r in known:
        (bad if r.toxic else good).update(toxicity.terms(toxicity.words(r.text)))
    n_bad = sum(r.toxic for r in known)
    n_good = len(known) - n_bad
    rows = [(t, bad[t], good[t]) for t in bad if bad[t] >= 3 and bad[t] / n_bad >= 10 * (good[t] + 0.5) / (n_good + 1)]
    table = toxicity.choose_table(spark.createDataFrame(rows, "term string, bad long, good long"))
    assert sorted((r.term, r.stem) for r in table.collect()) == toxicity.choose(rows, n_bad, n_good)
    assert len(rows) > 10


def test_copies_of_a_text_are_one_weighted_row_of_the_fit(spark, monkeypatch):
    docs, labels = _tables(spark)
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, y, n: seen.append((len(y), n.sum(), n.max())) or fit(x, y, n))
    toxicity.train(docs, labels)
    (rows, total, most), = seen
    assert total == 400 and most >= 60 and rows < 340


def test_quotations_of_any_length():
    scorer = toxicity.Scorer([("idiot", False)])
    name = dict(zip(toxicity.FEATURES, range(99), strict=False))
    long = "thing " * 400
    for text, quoted in ((f'they wrote: "{long} idiot {long}" there', True), (f"«{long}\nidiot {long}» x", True),
                         (f'a 5" pipe, {long}\n\nyou idiot and a 6" one', False), (f'"{long}\n\n idiot', False),
                         (f'no marks {long} idiot', False), ('"a" idiot "b"', False)):
        got = scorer.features(text)
        assert bool(got[name["quoted"]]) == quoted and bool(got[name["abuse"]]) != quoted, text[:40]
