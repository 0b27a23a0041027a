"""Pipeline stages on nulls, empty texts, repeated rows and empty tables."""

import collections

import corpus_pipeline as cp
from ripplerec.llm import exact_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
GOOD = "the quick brown fox jumps over the lazy dog and runs away from all of the other animals"


def texts(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_on_odd_rows(spark, tmpdir_path):
    rows = [(i, f"{GOOD} number {'abcdefghij'[i % 10] * (i // 10 + 1)}", "en", "s", 1) for i in range(40)]
    rows += [(100, "Same Words here and there", "en", None, None), (101, "same words HERE and there", "en", None, None),
             (102, None, None, None, None), (103, "", "en", None, None), (104, "12 34", "en", None, None),
             (105, "a question that stands in the benchmark", "en", None, None), (None, GOOD + " null", "en", None, None),
             (7, rows[7][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmpdir_path}/odd/documents.parquet")
    spark.createDataFrame([(1, "A question that stands in the benchmark!"), (2, None), (3, "")],
                          "item_id long, text string").write.parquet(f"{tmpdir_path}/odd/benchmark.parquet")
    stage = dict(cp.STAGES)
    left = texts(exact_dedup.keep_largest(docs))
    assert left[(101, rows[41][1])] == 1 and (100, rows[40][1]) not in left
    assert (102, None) not in left and left[(103, "")] == 1  # a null text counts as empty
    clean = texts(stage["benchmark decontamination"](spark, docs, f"{tmpdir_path}/odd"))
    assert texts(docs) - clean == collections.Counter({(105, rows[45][1]): 1})
    known = texts(stage["language ID"](spark, docs, f"{tmpdir_path}/odd"))
    assert not any(d in (102, 103, 104) for d, _ in known) and all(known[(r[0], r[1])] for r in rows[:40])
    for name, function in cp.STAGES[:-1]:
        assert function(spark, docs, f"{tmpdir_path}/odd").columns == docs.columns, name
    assert cp.run(spark, f"{tmpdir_path}/odd").count() > 0


def test_pipeline_on_empty_tables(spark, tmpdir_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmpdir_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmpdir_path}/none/benchmark.parquet")
    assert cp.run(spark, f"{tmpdir_path}/none").count() == 0
