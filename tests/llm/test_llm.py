"""Training-data operators against brute force, round trips and held-out labels."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ripplerec.llm import (
    decontaminate,
    dom,
    exact_dedup,
    fuse,
    html_extract,
    langid,
    packing,
    secrets,
    simhash_dedup,
    substring_dedup,
    token_counts,
    toxicity,
)
from ripplerec.llm.queries import ORACLE_SQL, QUERIES
from ripplerec.llm.rindex import NOBODY, RunLengthIndex

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key string"


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    long = "the quick brown fox jumps over the lazy dog " * 3000
    rows = [(1, None), (2, ""), (3, "Hello world, this is a small text"), (3, "Hello world, this is a small text"),
            (None, "Hello world, this is a small text"), (None, None), (5, long), (6, long.upper()), (7, long + "x"),
            (8, "!!! 123 ..."), (9, "x"), (10, "é" * 70), (11, "é" * 70)]
    return spark.createDataFrame([(i, t, "en" if i else None, None, None, "s", "k") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES] == list(range(1, 14))


def test_odd_and_empty_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "item_id long, text string")
    labels = spark.createDataFrame([(3, 0, 1), (5, 1, 0), (None, 0, 0), (6, 0, None)],
                                   "doc_id long, quality int, toxic int")
    pages = "page_id long, url string, html string"
    odd_pages = spark.createDataFrame([(1, None, None), (2, "http://a.b/", ""), (3, "x", "<p>one<p>two"), (None, "", "a < b &amp; c")], pages)
    for run in (secrets.secrets, langid.identify, langid.accepted, simhash_dedup.near_duplicates, simhash_dedup.keep_one,
                exact_dedup.dedup, token_counts.token_counts, substring_dedup.remove_repeats,
                lambda d: toxicity.toxicity(d, labels)):
        assert run(empty).count() == 0
    for run in (secrets.secrets, langid.identify, simhash_dedup.near_duplicates, exact_dedup.dedup,
                token_counts.token_counts, substring_dedup.remove_repeats, lambda d: toxicity.toxicity(d, labels)):
        assert run(odd).count() == odd.count()
    assert packing.pack(empty).count() == 0 and packing.pack(odd).count() >= odd.count()
    assert decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.contaminated(empty, bench.limit(0)).count() == 0
    got = {r.page_id: r.text for r in html_extract.main_text(odd_pages).collect()}
    assert got == {1: "", 2: "", 3: "one\ntwo", None: "a < b & c"}
    assert html_extract.main_text(spark.createDataFrame([], pages)).count() == 0


# ------------------------------------------------------------------ op1

def test_secrets(spark, docs):
    pats = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
            ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32)]
    want = {}
    for d, t in docs.select("doc_id", "text").collect():
        spans = []
        for k, (name, p, g, least) in enumerate(pats):
            for m in re.finditer(p, t or "", re.I | re.A if k == 0 else 0):
                if len(m.group(g)) >= least:
                    spans.append((m.start(), k, m.end(), name))
        text = ",".join(f"{n}:{s}:{e}" for s, k, e, n in sorted(spans))
        want[d] = hashlib.sha256(text.encode()).hexdigest()
    assert {r.doc_id: r.base_sha256 for r in secrets.secrets(docs).collect()} == want


def plain_markov(text, table):
    """Runs outside the fixed spans, character by character."""
    raw = (text or "").encode()
    base, _ = secrets.base_spans(raw)
    free = [not any(s <= i < e for s, _, e in base) and chr(b) in secrets.ALPHABET for i, b in enumerate(raw)] + [False]
    # the run itself must be long enough, then each part of it
    out, i = [], 0
    while i < len(raw):
        j = i
        while free[j]:
            j += 1
        part = raw[i:j]
        if len(part) >= secrets.MIN_RUN and re.search(rb"[0-9]", part) and re.search(rb"[A-Za-z]", part):
            codes, total = [0, 0, *(secrets.ALPHABET.index(chr(b)) + 1 for b in part)], 0.0
            for k in range(2, len(codes)):
                total += float(table[(codes[k - 2] * secrets.SIZE + codes[k - 1]) * secrets.SIZE + codes[k]])
            if total >= secrets.MIN_TOTAL and total >= secrets.MIN_EACH * len(part):
                out.append((len(raw[:i].decode()), len(raw[:j].decode())))
        i = j + 1
    return out


def test_markov_spans_equal_plain_scoring(docs):
    table = secrets.train(docs)
    rng = random.Random(6)
    letters = secrets.ALPHABET
    pieces = [lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=16)), lambda: "".join(rng.choices("0123456789abcdef", k=33)),
              lambda: "".join(rng.choices(letters, k=rng.randrange(15, 50))), lambda: " ", lambda: "é ", lambda: "token=",
              lambda: "identifier_name_of_2_words", lambda: "z", lambda: "\n"]
    found = touching = 0
    for _ in range(1500):
        text = "".join(rng.choice(pieces)() for _ in range(rng.randrange(1, 7)))
        base, every = secrets.scan(text, table)
        got = [(s, e) for k, s, e in every if k == "markov"]
        assert got == plain_markov(text, table)
        assert [x for x in every if x[0] != "markov"] == base
        found += len(got)
        touching += sum(s == e2 or e == s2 for s, e in got for _, s2, e2 in base)
    assert found > 100 and touching > 20


def test_markov_finds_random_runs_only(docs):
    table = secrets.train(docs)
    key = "q7ZxP0vK3mWb8RtYc2LdHs5NfJ1gAe9u"
    base, every = secrets.scan(f"é {key} and ordinary_identifier_names_2", table)
    assert base == [] and every == [("markov", 2, 2 + len(key))]


# ------------------------------------------------------------------ op2

def test_wrapper_induction():
    page = "<html><body><div>My Site</div><div id=c><p>%s</p><p>%s</p></div><div>Copyright us</div><script>if(a<b)</script></body></html>"
    first = html_extract.Wrapper(page % ("alpha one", "beta two"))
    counts = {}
    for i in range(6):
        first.observe(page % (f"words of page {i}", f"more words {i} &amp; x"), counts)
    stats = [{"node": k, "pages": int(v[0]), "same": int(v[1]), "mass": int(v[2])} for k, v in counts.items()]
    w = html_extract.Wrapper(page % ("alpha one", "beta two"), stats)
    assert w.extract(page % ("new  text\n here<br>now", "a &lt; b")) == "new text here now\na < b"


def _host(spark, page, n=8, extra=()):
    rows = [(i, "http://a.b/x", page.format(*[f"{w} {i}" for w in ("one", "two", "three")])) for i in range(n)]
    rows += [(100 + i, "http://a.b/x", h) for i, h in enumerate(extra)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in got}


def test_template_inside_article_is_removed(spark):
    got = _host(spark, "<body><article><p>{0}</p><div class=boxed>About the author</div><p>{1}</p></article></body>")
    assert got == {i: f"one {i}\ntwo {i}" for i in range(8)}
    copies = _host(spark, "<body><article><p>same text</p></article></body>")
    assert set(copies.values()) == {"same text"}


def test_all_varying_slots_are_content(spark):
    page = "<body><div>My Site</div><section><p>{0}</p></section><div>Read on</div><section><p>{1}</p></section><div>{2}</div></body>"
    want = {i: f"one {i}\ntwo {i}\nthree {i}" for i in range(8)}
    assert _host(spark, page) == want
    # null, empty and error pages are never the pivot
    extra = [None, "", " "] + ["<h1>Error</h1>"] * 4
    got = _host(spark, page, extra=extra)
    assert {i: t for i, t in got.items() if i < 100} == want


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.main_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", dom.html.unescape(re.sub(r"<[^>]*>", " ", p))).strip()
                 for p in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


# ------------------------------------------------------------------ op3

def test_language_held_out(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.identify(docs).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert langid.accepted(docs).count() == docs.count()


def test_noise_and_unknown_languages_are_rejected(spark, docs):
    rng = random.Random(3)
    cyrillic = "".join(map(chr, range(0x430, 0x450)))

    def noise(letters, n, longest):
        return " ".join("".join(rng.choices(letters, k=rng.randrange(2, longest))) for _ in range(n))

    planted = [noise(letters, n, longest) for letters in ("abcdefghijklmnopqrstuvwxyz", "asdfghjkl", cyrillic, "ABCdefXYZ0189+/")
               for n in (10, 40, 200) for longest in (9, 60)]
    planted += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
                "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
                "Все люди рождаются свободными и равными в своем достоинстве и правах.",
                "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
                "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi.", "12 !! 34", "", None]
    rows = [(-i - 1, t, None, None, None) for i, t in enumerate(planted)]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").union(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in langid.accepted(both).collect()}
    assert kept == {r.doc_id for r in docs.collect()}
    score = {r.doc_id: r.score for r in langid.identify(both).collect()}
    assert max(score[r[0]] for r in rows) < langid.REJECT / 10


def test_kneser_ney_sums_to_one():
    texts = ["abab", "abc"]
    key, _ = langid.grams(texts)
    u, n = np.unique(key, return_counts=True)
    model = langid.build([("x", u, n)])
    context = key[2] >> langid.BITS << langid.BITS
    all_next = context | np.arange(langid.SYMBOLS, dtype=np.int32)
    assert np.exp(model.score(all_next)).sum() == pytest.approx(1, abs=1e-3)


def test_alphabets_keep_their_letters_apart():
    blocks = [range(0x61, 0x7B), range(0xDF, 0x100), range(0x3B1, 0x3CA), range(0x430, 0x450)]
    for block in blocks:
        letters = [chr(c) for c in block if chr(c).isalpha()]
        key, lengths = langid.grams(letters)
        first = key[np.cumsum(lengths) - lengths]  # three spaces and the letter
        assert len(set(first.tolist())) == len(letters) and 0 < first.min() and first.max() < langid.SYMBOLS


# ------------------------------------------------------------------ op4, op5

def test_simhash_brute_force(spark, docs):
    extra = spark.createDataFrame([(9000 + i, "a b c d e f g " * 9 + f"w{i % 7}") for i in range(30)], "doc_id long, text string")
    table = docs.select("doc_id", "text").union(extra)
    for hot in (simhash_dedup.HOT_BUCKET, 3):
        got = simhash_dedup.near_duplicates(table, hot=hot).collect()
        fp = np.array([int(r.fingerprint, 16) for r in got], dtype=np.uint64)
        root = list(range(len(fp)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for i in range(len(fp)):
            for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3).tolist():
                root[find(j)] = find(i)
        least = {}
        for i, r in enumerate(got):
            least[find(i)] = min(r.doc_id, least.get(find(i), r.doc_id))
        assert all(r.component_id == least[find(i)] for i, r in enumerate(got))


def test_simhash_links_across_the_bit_of_a_hot_wildcard_bucket(spark):
    rng = random.Random(8)
    want = set()
    fps = set()
    for part in (0, 1):
        own, far = 32 * part, 32 * (1 - part)
        for wild in (0, 5, 31):
            base = rng.getrandbits(32) << own
            for _ in range(6):  # far apart but for the wildcard bucket
                fp = base | rng.getrandbits(32) << far
                other = fp ^ 1 << (own + wild) ^ sum(1 << far + i for i in rng.sample(range(32), 2))
                fps |= {fp, other}
                want.add(frozenset((fp, other)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(fps)]
    nodes = spark.createDataFrame(signed, "fp long")
    for hot in (simhash_dedup.HOT_BUCKET, 3):
        got = simhash_dedup.links(nodes, hot).collect()
        assert {frozenset((a % (1 << 64), b % (1 << 64))) for a, b in got} == want


def test_simhash_index_is_never_broadcast(spark):
    # the fingerprints are far below the broadcast threshold, their exploded index is not sized
    nodes = spark.range(50).select((F.col("id") * 7919).alias("fp"))
    for hot in (simhash_dedup.HOT_BUCKET, 3):
        plan = simhash_dedup.links(nodes, hot)._jdf.queryExecution().executedPlan().toString()
        inner = re.findall(r"(\w+Join)[^\n]*, Inner", plan)
        assert inner and set(inner) == {"SortMergeJoin"}


def test_exact_dedup_sql(spark, docs):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = collections.Counter(con.execute(ORACLE_SQL["op5_exact_dedup"]).fetchall())
    for batches in (1, 2, 4):
        assert rows_of(exact_dedup.dedup(docs, batches)) == want


def test_binary_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 60_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        f = fuse.build(keys)
        assert fuse.contains(f, keys).all()
        assert fuse.contains(f, rng.integers(0, 1 << 63, 100_000, dtype=np.uint64)).mean() < 1e-3


# ------------------------------------------------------------------ op6

def test_levenshtein_automaton():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    words = ["idiot", "idiom", "worthless", "scum"]
    auto = toxicity.LexiconAutomaton([(w, False) for w in words] + [("achlich", True)])
    budget = {"idiot": 1, "idiom": 1, "worthless": 2, "scum": 0}
    rng = random.Random(3)
    for _ in range(4000):
        w = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = rng.choice(["", "x", "i", "o"])
        w = "".join(w)
        want = 2 if w in words else 1 if any(distance(w, t) <= budget[t] for t in words) else 0
        assert auto.match(w) == want, w
    assert auto.match("achlichkeit") == 2 and auto.match("achlic") == 0


def test_misspelled_families_and_short_terms():
    rows = ["you idiot", "these idiots", "so idiotic", "scum of all", "a git here"] * 5
    counts = collections.Counter(t for r in rows for t in toxicity.terms(toxicity.words(r)))
    common = {"you", "these", "so", "of", "all", "a", "here"}
    entries = toxicity.choose([(t, n, 900 * (t.strip() in common)) for t, n in counts.items()], len(rows), 1000)
    assert {("idiot", True), ("idiot", False), ("idiots", False), ("scum", False), ("git", False)} <= set(entries)
    scorer = toxicity.Scorer(entries)
    name = dict(zip(toxicity.FEATURES, range(99), strict=False))
    assert scorer.features("you ideot")[name["abuse fuzzy"]] > 0
    assert scorer.features("idiocracy no, idiotcracy")[name["abuse"]] > 0
    for text in ("ideotcracy", "scumm", "scm"):
        got = scorer.features(text)
        assert got[name["weak"]] > 0 and not got[name["abuse"]] and not got[name["abuse fuzzy"]]
    assert scorer.features('he said "scumm"')[name["weak quoted"]] > 0
    assert scorer.features("a git")[name["abuse"]] > 0 and not any(scorer.features("a gitt")[1:])


def test_rare_terms_are_learned_at_every_size(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    for n_bad in (200, 600):  # the rare term is in 2 % and in less of the toxic documents
        rows = [(i, "common things grumblefish" if k < 4 else "common things scoundrel" if k < n_bad else "common things",
                 int(k < n_bad)) for k, i in enumerate(ids[:4 * n_bad])]
        table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        entries, weights = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
        assert {("grumblefish", False), ("scoundrel", False)} <= set(entries)
        scorer = toxicity.Scorer(entries, weights)
        assert scorer.score("a grumblefish") > scorer.score("a fish")


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.96 * len(held)
    scorer = toxicity.Scorer([("idiot", False)])
    assert scorer.features('he said "idiot" to me')[3] > 0 and scorer.features("you idiot")[1] > 0


# ------------------------------------------------------------------ op7

def test_edits_keep_counts(docs):
    path = token_counts.vocabulary_path()
    count = token_counts.counter(path)
    rng = random.Random(4)
    scripts = [" ".join("".join(chr(0x430 + rng.randrange(32)) for _ in range(rng.randrange(1, 9))) for _ in range(4000)),
               "".join(rng.choice("，。") if rng.random() < 0.05 else chr(0x4E00 + rng.randrange(20000)) for _ in range(9000)),
               "".join(chr(0x3041 + rng.randrange(80)) for _ in range(9000)),
               "\n".join("".join(rng.choices("abcxyz'!19 ", k=rng.randrange(30))) for _ in range(900)),
               "".join(rng.choices(["'s", "'re", "é", "’", " ", "  ", "\u3000", "1", "٣", "字", "😀", "\x1c", "e\u0301", "\U0001fae8"], k=6000))]
    for text in [r.text for r in docs.limit(40).collect()] + scripts:
        tree = token_counts.SegmentTree.of(text, path)
        assert tree.total == count(text) and tree.text == text
        if text in scripts:
            assert max(map(len, tree.parts)) < 2 * token_counts.SEGMENT
        for _ in range(8):
            n = len(tree.text)
            a = rng.randrange(n + 1)
            b = min(n, a + rng.choice((0, 1, 3, 40, 700)))
            held = tree.encoded
            new = rng.choice(("", " ", "  ", "\n", "foo bar", " 's", "é", "don't ", "字", "long text " * 300))
            tree.edit(a, b, new)
            assert tree.total == count(tree.text)
            assert tree.encoded - held <= 8 * token_counts.SEGMENT + len(new) or text not in scripts


def test_vocabulary_tokens_merge_whole():
    """A token of the vocabulary is reached by its merges, so a piece cut off at a place no merge crosses is counted alike."""
    ranks = token_counts._ranks(token_counts.vocabulary_path())
    for token in random.Random(1).sample(sorted(ranks), 5000):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            i = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
            assert parts[i] + parts[i + 1] in ranks
            parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_kept_trees_take_edits(spark, docs, odd):
    count = token_counts.counter(token_counts.vocabulary_path())
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    kept = token_counts.store(token_counts.trees(odd), "trees")
    text = {r.version: "".join(r.parts) for r in kept.collect()}
    assert set(text.values()) == {t or "" for _, t in rows}
    for round_ in range(2):  # edits of the trees, then of the trees that came out
        made = [(r.doc_id, r.version, a, a + 3, "new ") for r in kept.collect() for n in [r.chars[1]]
                for a in range(0, max(0, n - 3), max(7, n // 5))]
        edits = spark.createDataFrame(made * 2, "doc_id long, version long, start long, stop long, text string")
        out = token_counts.store(token_counts.recount(token_counts.with_edits(kept, edits), keep=True), "trees")
        assert out.count() == len(rows)
        for r in out.collect():
            now = "".join(r.parts)
            assert r.n_tokens_edited == r.tokens[1] == count(now) and r.n_chars_edited == len(now)
        assert out.where("n_edits > 3").count() >= 5
        kept = token_counts.store(token_counts.edited(out), "trees")


def test_token_query(spark, docs):
    count = token_counts.counter(token_counts.vocabulary_path())
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.token_counts(docs).collect():
        assert r.n_tokens == count(text[r.doc_id])
        assert r.n_tokens_edited == count(token_counts.MASKED.sub(token_counts.MASK, text[r.doc_id]))


# ------------------------------------------------------------------ op8

def brute_repeats(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            if d is not None:
                first[raw[i:i + 50]] = min(d, first.get(raw[i:i + 50], d))
    out = collections.Counter()
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if d is not None and first[raw[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, x in zip(raw, gone, strict=True) if not x)
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[(d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_substring_dedup(spark, docs, odd):
    rng = random.Random(2)
    base = [" ".join(rng.choices(["ab", "the", "cd ef", "x", "é"], k=200)) for _ in range(5)]
    rows = []
    for i in range(100):
        b = rng.choice(base)
        at = rng.randrange(len(b))
        t = b[at:at + rng.randrange(300)]
        p = rng.randrange(len(t) + 1)
        rows.append((rng.choice([None, i, i, 7]), t[:p] + rng.choice(["", "Q"]) + t[p:]))
    rows += [(500 + i, "For " * rng.randrange(100)) for i in range(10)] + [(600, "a" * 49), (601, "a" * 50), (602, "a" * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(substring_dedup.remove_repeats(table, 2000, 3000)) == brute_repeats(rows)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(substring_dedup.remove_repeats(docs, 200_000, 400_000)) == brute_repeats(rows)


def test_substring_dedup_of_hot_keys(spark):
    """A phrase in many contexts is split by its windows; the result is the same."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    phrase = "a phrase of thirty-two bytes here"
    rows = []
    for i in range(400):
        around = [" ".join(rng.choices(words, k=8)) for _ in range(2)]
        rows.append((i % 390, f"{around[0]} {phrase} {around[1]}"))
        if i % 9 == 0:
            rows.append((1000 + i, f"x{i} {around[0][-20:]} {phrase} {around[1]}"))
    table = spark.createDataFrame([(*r, "s", 1, b"k", True) for r in rows],
                                  "doc_id long, text string, bucket string, shard int, keys binary, hot boolean")
    want = brute_repeats(rows)
    for hot in (0, 20, substring_dedup.HOT_PIECES):
        assert rows_of(substring_dedup.remove_repeats(table, 4000, 6000, hot)) == want
    # the text of the largest shard, with and without the split
    buckets = [pa.table({"doc_id": [d for d, _ in rows[i::8]], "text": [t for _, t in rows[i::8]],
                         "bucket": pa.array([i] * len(rows[i::8]), pa.int32())}) for i in range(8)]
    shards, largest = 16, {}
    for hot in (20, 10**6):
        keys = pa.concat_tables([substring_dedup._send_keys(shards)(b) for b in buckets])
        shared = pa.concat_tables([substring_dedup._find_shared(hot)(keys.filter(pc.equal(keys["shard"], s))) for s in range(shards)
                                   if s in keys["shard"].to_pylist()])
        text = collections.Counter()
        for i, b in enumerate(buckets):
            for r in substring_dedup._send_pieces(shards)(b, shared.filter(pc.equal(shared["bucket"], i))).to_pylist():
                text[r["shard"]] += sum(r["lengths"])
        largest[hot] = max(text.values()) / (sum(text.values()) / shards)
    assert largest[20] < 1.5 < 3 < largest[10**6]


def test_covered_windows_come_from_the_index():
    rng = random.Random(11)
    for number in (1, 3, 60):
        base = bytes(rng.choice(b"abc") for _ in range(400))
        cut = set()
        for a in (rng.randrange(310) for _ in range(number)):  # pieces: windows of one key
            text = base[a:a + rng.randrange(50, 85)]
            keys = substring_dedup.window_keys(np.frombuffer(text, dtype=np.uint8))
            at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            cut |= {(int(keys[i]), text[i:j + 49]) for i, j in zip(at[:-1], at[1:], strict=True)}
        texts = [t for _, t in sorted(cut)]
        key = np.array([k for k, _ in sorted(cut)], dtype=np.uint64)
        first = np.array([rng.randrange(20) for _ in texts])
        many = np.array([rng.random() < 0.3 for _ in texts])
        for keys, size in ((np.zeros(len(texts), dtype=np.uint64), 1), (key, 100), (key, 1 << 20)):
            whole, covered = substring_dedup.covered_windows(texts, keys, first, many, size)
            for i, t in enumerate(texts):
                same = [(u, f) for u, f, k in zip(texts, first.tolist(), keys.tolist(), strict=True) if k == keys[i]]
                least = [min(g for u, g in same if t[j:j + 50] in u) for j in range(len(t) - 49)]
                assert [int(covered[i]) >> j & 1 for j in range(len(least))] == [int(x < first[i]) for x in least]
                if many[i]:
                    assert whole[i] == max(least)
                else:
                    assert whole[i] >= first[i] or whole[i] == max(least)


def test_matching_statistics():
    rng = random.Random(5)
    for _ in range(60):
        texts = [bytes(rng.choice(b"abc\x00") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 6))]
        asked = [bytes(rng.choice(b"abc\xfe") for _ in range(rng.randrange(25))) for _ in range(5)] + texts
        owners = [rng.randrange(4) for _ in texts]
        limit = rng.choice((1, 2, 4, 8, 50))
        index = RunLengthIndex(texts, limit, np.array(owners))
        for p, got, least in zip(asked, index.matching_statistics(asked), index.earliest(asked), strict=True):
            for i, n in enumerate(got.tolist()):
                want = max(k for k in range(min(limit, len(p) - i) + 1) if any(p[i:i + k] in t for t in texts))
                assert n == want
                holds = [o for o, t in zip(owners, texts, strict=True) if n == limit and p[i:i + limit] in t]
                assert least[i] == min(holds, default=NOBODY)


# ------------------------------------------------------------------ op9

def test_index_compares_eight_bytes_at_a_time():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"\0ab\xff") for _ in range(rng.randrange(0, 70))) for _ in range(60)]
    strings += [strings[3][:20] + b"ab" * 20 + bytes([i]) for i in range(9)]
    index = RunLengthIndex(strings, 50, np.arange(len(strings)))
    starts = np.cumsum([0] + [len(s) + 1 for s in strings])
    pos, at = (np.array([rng.randrange(starts[-1]) for _ in range(4000)]) for _ in range(2))
    at[:500] = pos[:500]
    text = [s[i:] for s in strings for i in range(len(s) + 1)]
    want = [next((i for i, (a, b) in enumerate(zip(text[p], text[q])) if a != b), min(len(text[p]), len(text[q])))
            for p, q in zip(pos, at)]
    got = index._compare(pos, index.words, index.left, at)
    assert got.tolist() == [min(w, 50) for w in want] and max(want) > 50
    first, lengths, flat = index.earliest_flat(strings)
    for s, f, n in zip(strings, first.tolist(), lengths.tolist()):
        assert flat[f:f + n].tolist() == [
            next((o for o, t in enumerate(strings) if s[i:i + 50] in t), None) if len(s) - i >= 50 else NOBODY for i in range(n)]


def test_tiling_of_reordered_passages(spark):
    item = " ".join(f"w{i}" for i in range(40))
    parts = item.split()
    moved = " ".join(["lorem ipsum", *parts[20:], "dolor", *parts[:20], "sit"])
    texts = [(1, item), (2, moved.upper()), (3, " ".join(parts[:25])), (4, "nothing here at all " * 20), (5, " ".join(parts[::-1]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    for block in (decontaminate.BLOCK_CHARS, 10):
        got = {(r.doc_id, r.item_id): (r.n_covered, r.n_tiles) for r in decontaminate.contaminated(docs, bench, block_chars=block).collect()}
        assert got == {(1, 7): (40, 1), (2, 7): (40, 2)}


def plain_tiling(doc, item, least):
    """Greedy string tiling by comparing every pair of places."""
    used_doc, used_item, found = set(), set(), []
    while True:
        best = []
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while (q + n < len(item) and p + n < len(doc) and doc[p + n] == item[q + n]
                       and p + n not in used_doc and q + n not in used_item):
                    n += 1
                best.append((n, q, p))
        longest = max((b[0] for b in best), default=0)
        if longest < least:
            return found
        for n, q, p in best:
            if n == longest and used_doc.isdisjoint(range(p, p + n)) and used_item.isdisjoint(range(q, q + n)):
                used_doc.update(range(p, p + n))
                used_item.update(range(q, q + n))
                found.append(n)


def plain_contaminations(texts, bench, coverage=0.8):
    out = collections.Counter()
    for d, t in texts:
        for i, b in bench:
            doc, item = decontaminate.words(t), decontaminate.words(b)
            found = plain_tiling(doc, item, min(5, len(item))) if item else []
            if item and sum(found) >= coverage * len(item):
                out[(d, i, len(item), sum(found), len(found))] += 1
    return out


def test_tiling_equals_plain_tiling(spark):
    rng = random.Random(8)
    bench = [(i, " ".join(rng.choices("abcd", k=rng.randrange(1, 30)))) for i in range(25)]
    bench += [(3, bench[3][1]), (90, None), (91, ""), (92, "..."), (93, "Zeta"), (94, "one, two; three"), (None, "ab cd ef gh ij kl")]
    texts = [(500, None), (501, ""), (502, "it is zeta"), (503, "One two  THREE four"), (504, "one two four three"),
             (None, "ab cd ef gh ij kl"), (505, "ab cd ef gh ij")]
    for d in range(60):
        words = [w for _ in range(3) for w in (rng.choice(bench)[1] or "").split()] if d % 2 else rng.choices("abcd", k=25)
        if d % 3 == 0 and words:
            cut = rng.randrange(len(words))
            words = words[cut:] + ["gap"] + words[:cut]
        texts.append((d // 2, " ".join(words)))
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in texts], "doc_id long, text string, item_id string, n_tiles string")
    items = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc_id string")
    want = plain_contaminations(texts, bench)
    assert len(want) > 40 and any(k[4] > 1 for k in want) and any(k[2] < 5 for k in want) and any(k[3] < k[2] for k in want)
    for block in (decontaminate.BLOCK_CHARS, 60):
        got = decontaminate.contaminated(docs, items, block_chars=block)
        assert collections.Counter((r.doc_id, r.item_id, r.n_words, r.n_covered, r.n_tiles) for r in got.collect()) == want
        left = rows_of(decontaminate.clean(docs, items).select("doc_id", "text"))
        gone = {k[0] for k in want}
        assert left == collections.Counter((d, t) for d, t in texts if d not in gone)


def test_seed_of_very_many_items():
    """A seed that all items share is not in the index, and texts that repeat it propose no pair."""
    shared = "please answer the following question"
    rows = [(i, f"{shared} a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(100_000)]
    index = decontaminate.block_index(rows)
    (keys, owner), = index["lookup"].values()
    assert len(np.unique(owner)) == len(rows) and np.unique(keys, return_counts=True)[1].max() == 1
    texts = [f"{shared} " * 20] * 500 + [rows[70_000][1]]
    assert list(decontaminate.contaminations(texts, index, 0.8)) == [(500, 70_000, 11, 1)]


def test_decontamination_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()}
    items = [decontaminate.words(r.text) for r in bench.collect()]
    want = {r.doc_id for r in docs.collect() for t in [" " + " ".join(decontaminate.words(r.text)) + " "]
            if any(" " + " ".join(i) + " " in t for i in items)}
    assert want and want <= got


# ------------------------------------------------------------------ op10, pipeline

def test_packing(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs).toPandas()
    by = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()}
    n = 0
    for r in docs.collect():
        ids = [*tok.encode(r.text, add_special_tokens=False).ids, 0]
        for piece, lo in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[lo:lo + 2048], dtype="<u4").tobytes()
            assert by[(r.doc_id, piece)] == (lo, len(part) // 4, zlib.crc32(part))
            n += 1
    assert n == len(got)
    place = got.sort_values(["sequence_id", "offset"])
    total = place.groupby("sequence_id").length
    assert total.sum().max() <= 2048 and (place.offset == total.cumsum() - place.length).all()
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 2048)


def test_words_encode_alone():
    encode = packing.encoder(packing.tokenizer_path())
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    for t in ["", " \x1c a\xa0b é ́x", "Don't <|endoftext|> STOP<|STARTOFTEXT|>\r\n12 3.5", "İı ΑΣ Σ 漢字　かな"]:
        assert np.frombuffer(encode([t])[0], dtype="<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_pipeline(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in cp.run(spark, SF).collect()} == kept and len(kept) > 100
