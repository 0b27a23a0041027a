"""Spelling variants, nearest neighbours and the Merkle manifest against brute force."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from ripplerec.llm import merkle, nearest, spelling, vptree
from ripplerec.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, tree string, pos long"


def odd_docs(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", "t", 3) for r in rows], DOCS)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def oracle(name, con, columns):
    rel = con.sql(ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in columns]
    return collections.Counter(tuple(r[i] for i in at) for r in rel.fetchall())


# ------------------------------------------------------------------ op11

def brute_variants(docs):
    count = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            count[low] += 1
    vocab = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    holes = collections.defaultdict(set)
    for w in vocab:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)  # replaced at i
    near = {w: set() for w in vocab}
    for w in vocab:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]] - {w}
            short = w[:i] + w[i + 1:]
            if short in vocab:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocab[form[w]] if form[w] else None))
    return collections.Counter(out)


def test_spelling_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = QUERIES["op11_spelling"](spark, SF)
    assert rows_of(got.select("word", "form", "root", "n", "n_near", "form_n")) == want and len(want) > 1000


def test_spelling_odd_rows_small_rounds_and_long_words(spark):
    rng = random.Random(3)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "Größe grösse größe GRÖSSE größen", "de", "s", 1)]
    base = ["abcde", "abcdé", "aabbcc", "aabcc", "abbcc", "letter", "leter", "lettter", "letters", "ÀÉÎÕÜ", "àéîõü", "x×y÷z"]
    long = "".join(rng.choice("abcdeé") for _ in range(3000))
    base += [long, long[:1500] + long[1501:], long[:2000] + "z" + long[2001:], "q" * 70, "q" * 69, "q" * 71]
    for i in range(400):
        rows.append((i % 60, " ".join(rng.choices(base, k=12)) + ", 12 " + rng.choice(base).upper(), "en", "s", 5))
    docs = odd_docs(spark, rows)
    want = brute_variants([r[:2] for r in rows])
    assert max(r[4] for r in want) >= 3 and any(r[1] != r[2] for r in want)
    assert rows_of(spelling.variants(docs)) == want
    # filters in several pieces and broadcast rounds give the same pairs
    assert rows_of(spelling.variants(docs, round_bytes=128, piece_words=2)) == want
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.where("text = ''")).count() == 0


def test_spelling_keys_of_edits_equal_the_words_keys():
    word, alphabet = "straße", np.array(sorted(b"abcdefz"), dtype=np.uint8)

    class All:
        seen: list = []

        def hit(self, length, key):
            self.seen.append((length, set(key.tolist())))
            return np.arange(len(key))

    every = All()
    list(spelling.probe(np.array([1]), spelling.letters([word]), alphabet, every))
    key = lambda w: int(spelling.mix(spelling.sums(spelling.letters([w])))[0])
    short = {key(word[:i] + word[i + 1:]) for i in range(len(word))}
    put = {key(word[:i] + chr(c) + word[i + 1:]) for i in range(len(word)) for c in alphabet.tolist() if c > ord(word[i])}
    assert {s for n, k in every.seen if n == 5 for s in k} == short
    assert {s for n, k in every.seen if n == 6 for s in k} == put


def test_bloom_filter_has_every_word_and_few_others():
    rng = np.random.default_rng(1)
    keys = spelling.mix(rng.integers(0, 1 << 62, 200_000).astype(np.uint64))
    blocks = spelling.blocks_of(100_000, 1)
    f = spelling.Filters({(6, 0): spelling.bloom(keys[:100_000], blocks)}, {6: 1}, {6: blocks})
    assert len(f.hit(6, keys[:100_000])) == 100_000
    assert len(f.hit(6, keys[100_000:])) < 600  # 0.6 %
    assert not len(f.hit(7, keys))


# ------------------------------------------------------------------ op12

def brute_nearest(rows, k=20, every=20):
    """rows: (row, vec_id, vector); copies of a row are told apart by ``row``."""
    out = collections.Counter()
    for row, q, v in rows:
        if q is None or q % every:
            continue
        scored = []
        for other, i, w in rows:
            if other != row and len(w) == len(v):
                total = 0.0
                for a, b in zip(v, w, strict=True):
                    total += a * b
                scored.append((-total, i is None, i or 0, total))
        for rank, (_, null, i, score) in enumerate(sorted(scored)[:k], 1):
            out[q, rank, None if null else i, score] += 1
    return out


def test_nearest_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = QUERIES["op12_nearest"](spark, SF)
    assert rows_of(got) == oracle("op12_nearest", con, got.columns)


def test_nearest_odd_vectors(spark):
    rng = np.random.default_rng(5)
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(0, 240, 2)] + [(i, rng.integers(-3, 4, 3).tolist()) for i in range(1, 200, 2)]
    rows += [(20, same), (20, same), (None, same), (None, [3.0, 3.0, 3.0]), (40, [9.0, 1.0]), (60, [2.0, 7.0])]
    bad = [(80, None), (100, []), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [float("nan"), 1.0, 1.0]),
           (180, [float("inf"), 1.0, 1.0])]
    schema = "vec_id long, embedding array<float>, label int, row string, dim string, score string"
    df = spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], 1, "r", "d", "s") for i, v in rows + bad], schema)
    kept = [(n, i, [float(x) for x in v]) for n, (i, v) in enumerate(rows) if any(v)]
    want = brute_nearest(kept)
    assert rows_of(nearest.neighbours(df)) == want
    # several shards and query blocks
    stored = nearest.store(nearest.valid(df), "vectors")
    got = nearest.nearest(stored, stored.where("vec_id % 20 = 0"), shard_bytes=1000, block_bytes=60)
    assert rows_of(got.select("query_id", "rank", "vec_id", "score")) == want
    assert nearest.neighbours(df.limit(0)).count() == 0
    assert nearest.neighbours(df.where("vec_id = 80")).count() == 0


def test_factor_one_is_exact_and_a_larger_one_saves_work():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 8)) * 3
    v = rng.standard_normal((4000, 8)) * 0.3 + centres[rng.integers(0, 40, 4000)]
    tree = vptree.build(v, np.arange(4000), np.arange(4000))
    q = np.arange(0, 4000, 20)
    work, recall = {}, {}
    for factor in (1.0, 1.5):
        s = vptree.Search(tree, v[q], q, 20, factor)
        row, _ = s.run()
        hit = 0
        for j, i in enumerate(q):
            score = vptree.exact(np.repeat(v[i:i + 1], 4000, 0), v)
            score[i] = -np.inf
            hit += len(set(tree.ids[row[j]]) & set(np.lexsort((np.arange(4000), -score))[:20]))
        work[factor], recall[factor] = s.compared / (len(q) * 4000), hit / (20 * len(q))
    assert recall[1.0] == 1.0 and recall[1.5] >= 0.9
    assert work[1.5] < work[1.0] < 1.0


# ------------------------------------------------------------------ op13

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def brute_manifest(docs):
    """docs: (doc_id, text, lang, source, n_chars)."""
    def leaf(d, more=0):
        return H(*(field(x) for x in (d[0], d[3], d[2], None if d[4] is None else d[4] + more, d[1])))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, pos):
        return [((pos >> i) & 1, level[(pos >> i) ^ 1] if (pos >> i) ^ 1 < len(level) else None)
                for i, level in enumerate(tree[:-1])]

    groups = collections.defaultdict(list)
    for d in docs:
        groups[d[2]].append(d)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[g] = levels([leaf(d) for d in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = collections.Counter()
    for at, g in enumerate(names):
        for pos, d in enumerate(groups[g]):
            steps = path(trees[g], pos) + path(top, at)
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[4] is not None
            node = leaf(d, 1) if hit else leaf(d)
            for right, s in steps:
                node = H(node) if s is None else H(s, node) if right else H(node, s)
            out[d[0], leaf(d), trees[g][-1][0], top[-1][0], H(*(s for _, s in steps if s)), node, node == top[-1][0]] += 1
    return out


def test_manifest_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = QUERIES["op13_manifest"](spark, SF)
    want = oracle("op13_manifest", con, got.columns)
    assert rows_of(got) == want
    assert {r.verified for r in got.select("verified").distinct().collect()} == {True, False}


@pytest.mark.parametrize("block", [2, 12])
def test_manifest_odd_rows(spark, block):
    rng = random.Random(4)
    rows = [(None, None, None, None, None), (1, "", "en", "", 0), (1, "", "en", "", 0), (2, "é" * 5000, "zz", "s", 5000),
            (3, "lone", "", "s", 4), (None, "x", "en", "s", 1), (7, "no length", "en", None, None)]
    rows += [(i, f"text {i}", rng.choice(["en", "en", "de", None]), "s", i) for i in range(10, 60)]
    docs = odd_docs(spark, rows)
    assert rows_of(merkle.manifest_check(docs, block)) == brute_manifest(rows)
    assert rows_of(merkle.manifest_check(docs.where("doc_id = 2"), block)) == brute_manifest(rows[3:4])
    assert merkle.manifest_check(docs.limit(0), block).count() == 0


def test_multiproof_of_some_leaves_is_minimal(spark):
    docs = odd_docs(spark, [(i, f"t{i}", "en" if i % 5 else "de", "s", i) for i in range(100)])
    rows = merkle.store(merkle.leaves_of(docs), "rows")
    m = merkle.manifest(rows, ["doc_id", "digest", "row"], 3)
    wanted = m.leaves.where("doc_id in (1, 2, 3, 50, 99)")
    proofs = merkle.multiproofs(m, wanted, 3).withColumn("leaf", merkle.F.col("digest"))
    assert [r.folded for r in merkle.folded(proofs).collect()] == [m.root] * 5
    # leaves 0 and 1 of "en" are each other's siblings: not fetched
    asked = {(r.at, r.level, r.idx) for r in merkle.missing(wanted.withColumn("block", merkle.F.shiftright("pos", 3)), m)
             .where("block = 0 and tree = '=en'").collect()}
    assert asked == {("=en", 0, 3), ("=en", 2, 1), ("=en", 3, 1), ("=en", 4, 1), ("=en", 5, 1), ("=en", 6, 1), ("", 0, 0)}
