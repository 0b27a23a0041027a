"""Blocked scoring: blocks below a row's k-th score are skipped, results stay exact; heads are data."""

import numpy as np
import pytest
from pyspark import cloudpickle

from ripplerec.operators import scoring as S
from ripplerec.operators.lookup import state_vector

RNG = np.random.default_rng(4)
DIM, ITEMS = 6, 4000


def _actor():
    eye = lambda n: S.Layer(np.eye(n), np.zeros(n))
    return S.ActorModel(eye(DIM), eye(DIM), eye(DIM))


def _catalog():
    """Few items of great norm; every vector twice, so the k-th place is tied."""
    v = RNG.integers(-4, 5, (ITEMS // 2, DIM)).astype(float) * np.where(RNG.random(ITEMS // 2) < 0.05, 8.0, 0.25)[:, None]
    return np.concatenate([v, v])


def _frame(spark, matrix, bias=None):
    rows = [(i, [float(x) for x in v], *([float(bias[i])] if bias is not None else [])) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id int, vec array<double>" + (", bias double" if bias is not None else ""))


def _states(spark, n=60):
    m = np.abs(RNG.integers(-3, 4, (n, DIM)).astype(float))  # relu keeps them as they are
    m[0] = 0.0  # every score is zero: ties by id only
    return m, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "row int, state array<double>")


def _brute(scores, k):
    scores = np.round(scores, S.SCORE_DECIMALS)
    return {i: np.lexsort((np.arange(scores.shape[1]), -s))[:k].tolist() for i, s in enumerate(scores)}


def test_blocks_below_the_kth_score_are_skipped_and_ties_are_exact(spark):
    items = _catalog()
    m, rows = _states(spark)
    rows = rows.where("row > 0")
    stats = S.WalkStats(spark)
    out = S.recommend(rows, _actor(), k=7, state_col="state", item_vecs=_frame(spark, items), blocked=True,
                      block_size=100, stats=stats)
    got = {r.row: list(r.item_rec) for r in out.collect()}
    want = _brute(m @ items.T, 7)
    assert got == {i: w for i, w in want.items() if i}
    assert stats.met.value >= 40 and stats.skipped.value > 0.8 * stats.met.value
    # a zero action skips nothing wrongly: every score is zero and the smallest ids win
    zero = S.recommend(_states(spark)[1].where("row = 0"), _actor(), k=7, state_col="state",
                       item_vecs=_frame(spark, items), blocked=True, block_size=100).collect()
    assert [list(r.item_rec) for r in zero] == [list(range(7))]


def test_more_places_than_items_and_no_items(spark):
    m, rows = _states(spark, 5)
    few = RNG.standard_normal((3, DIM))
    out = S.recommend(rows, _actor(), k=10, state_col="state", item_vecs=_frame(spark, few), blocked=True, block_size=2)
    assert {r.row: list(r.item_rec) for r in out.collect()} == _brute(m @ few.T, 10)
    none = S.recommend(rows, _actor(), k=10, state_col="state", item_vecs=_frame(spark, few).limit(0), blocked=True)
    assert all(list(r.item_rec) == [] for r in none.collect())


@pytest.mark.parametrize("as_table", [True, False])
def test_policy_head_is_read_as_blocks(spark, as_table):
    w, b = RNG.standard_normal((ITEMS, DIM)), RNG.standard_normal(ITEMS)
    eye = S.Layer(np.eye(DIM), np.zeros(DIM))
    shipped = S.PolicyModel(eye, eye, S.Layer(w, b))
    model = S.PolicyModel(eye, eye, _frame(spark, w, b)) if as_table else shipped
    m, rows = _states(spark)
    out = S.recommend(rows, model, k=9, state_col="state", blocked=True, block_size=256)
    assert {r.row: list(r.item_rec) for r in out.collect()} == _brute(m @ w.T + b, 9)
    # above the bound the head does not travel with the function
    with pytest.raises(ValueError, match="blocked"):
        S.recommend(rows, model, S.ItemCatalog(np.arange(0), np.zeros((0, DIM)), DIM), state_col="state", max_bytes=1000)


def test_blocked_function_does_not_carry_the_head(spark, monkeypatch):
    w = RNG.standard_normal((20_000, DIM))
    eye = S.Layer(np.eye(DIM), np.zeros(DIM))
    sent = []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, schema: sent.append(len(cloudpickle.dumps(f))) or self)
    S.recommend(_states(spark)[1], S.PolicyModel(eye, eye, S.Layer(w, np.zeros(len(w)))), k=3, state_col="state",
                blocked=True, block_size=5000)
    assert sent and sent[-1] < 200_000 < w.nbytes


def test_rows_that_cannot_be_scored_are_counted(spark):
    bad = spark.createDataFrame([(i, [1.0] * (DIM + 1)) for i in range(5)], "row int, state array<double>")
    cat, stats = S.ItemCatalog(np.arange(3), np.eye(3, DIM), DIM), S.WalkStats(spark)
    out = S.recommend(bad, _actor(), cat, state_col="state", null_on_error=True, stats=stats).collect()
    assert [r.item_rec for r in out] == [None] * 5 and stats.failed.value == 5


def test_state_vectors_of_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, 0, [1, 2]), (5, None, 0, [2]), (6, 7, 1, [])],
                                 "raw_user long, window_end long, user_id int, items array<int>")
    vecs = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "id int, vec array<float>")
    args = (["raw_user", "window_end"], "user_id", "items", vecs, vecs, 1)
    got = {(r.raw_user, r.window_end): r.state for r in state_vector(rows, *args).collect()}
    assert got == {(None, 1): [0.0, 1.0, 2.0], (5, None): [0.0, 2.0], (6, 7): [1.0]}
