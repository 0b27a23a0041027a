"""Actor-model scoring: G1 ``actor_action``, G2 ``recommend_actor``
(ddpg), G3 ``recommend_policy`` (reinforce), G4 ``recommend_constrained``
(bcq), G5 scoring from a ready state column, G10 ``recommend`` dispatch.

The reference posts one user at a time to a web service.  Here scoring is a
batch operator: rows are scored many at a time inside ``mapInPandas`` (Arrow
batches, numpy matmuls), weights are data passed with the function.

Item catalog.  Exact top-k needs every item's score.  A catalog whose size in
bytes is under ``MAX_SHIPPED_BYTES`` is shipped to the tasks with the function;
for any other ``blocked=True`` writes it once as block files in the shared
folder, ordered by norm, and every scoring task walks the blocks over its own rows
with a running top k: no row is shuffled or replicated.  A block whose bound
(Cauchy-Schwarz: the action's norm times the block's greatest item norm, plus its greatest
bias) is below a row's k-th score is not scored for that row, and not read if it is for none.
The policy head's weights are such blocks too: in blocked form they are data in the
shared folder, not part of the function.

Ties: scores are rounded to 9 decimals, then item id ascending.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import scratch_path

# Largest catalog shipped to every task: its vector matrix plus the gather
# table by dense id, both float64.  Above it, ``blocked=True`` scoring.
MAX_SHIPPED_BYTES = 256 * 1024 * 1024
SCORE_DECIMALS = 9


# --------------------------------------------------------------------------- models

def _relu(x):
    return np.maximum(x, 0.0)


@dataclass
class Layer:
    w: np.ndarray  # (out, in)
    b: np.ndarray  # (out,)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w.T + self.b


@dataclass
class ActorModel:
    """ddpg actor: relu(fc1) -> relu(fc2) -> fc3 = action; score = action . item."""
    fc1: Layer
    fc2: Layer
    fc3: Layer
    algo: str = "ddpg"

    def action(self, state: np.ndarray, rng=None) -> np.ndarray:
        return self.fc3(_relu(self.fc2(_relu(self.fc1(state)))))

    def scores(self, state, items, rng=None):
        return self.action(state) @ items.T


@dataclass
class PolicyModel:
    """reinforce policy: relu(pfc1) -> relu(pfc2) -> softmax head over items.
    log-softmax is monotone per row, so the top k is taken on the logits."""
    pfc1: Layer
    pfc2: Layer
    # (n_items, hidden), row i scores dense item i; or a table (id, vec, bias) of any size
    head: Layer | DataFrame | None
    algo: str = "reinforce"

    def action(self, state: np.ndarray, rng=None) -> np.ndarray:
        return _relu(self.pfc2(_relu(self.pfc1(state))))

    def scores(self, state, items, rng=None):
        return self.head(self.action(state))

    def log_probs(self, state):
        z = self.scores(state, None)
        m = z.max(axis=1, keepdims=True)
        return z - m - np.log(np.exp(z - m).sum(axis=1, keepdims=True))


@dataclass
class ConstrainedModel:
    """bcq: generator decode(state, z) then perturbation 0.05 tanh(mlp)."""
    dec1: Layer
    dec2: Layer
    dec3: Layer
    per1: Layer
    per2: Layer
    per3: Layer
    latent: int
    phi: float = K.BCQ_PHI
    z_clamp: float = K.BCQ_Z_CLAMP
    noise: bool = True
    algo: str = "bcq"

    def action(self, state: np.ndarray, rng=None) -> np.ndarray:
        n = state.shape[0]
        if self.noise:
            z = np.clip(rng.standard_normal((n, self.latent)), -self.z_clamp, self.z_clamp)
        else:
            z = np.zeros((n, self.latent))
        gen = self.dec3(_relu(self.dec2(_relu(self.dec1(np.concatenate([state, z], axis=1))))))
        a = self.per3(_relu(self.per2(_relu(self.per1(np.concatenate([state, gen], axis=1))))))
        return gen + self.phi * np.tanh(a)

    def scores(self, state, items, rng=None):
        return self.action(state, rng) @ items.T


def load_model_npz(path: str, algo: str):
    """Weights as data: an ``.npz`` with arrays named ``<layer>.weight`` /
    ``<layer>.bias`` (the layer names of the models above)."""
    z = np.load(path)

    def L(name):
        return Layer(z[f"{name}.weight"].astype(np.float64), z[f"{name}.bias"].astype(np.float64))
    if algo == "ddpg":
        return ActorModel(L("fc1"), L("fc2"), L("fc3"))
    if algo == "reinforce":
        return PolicyModel(L("pfc1"), L("pfc2"), L("softmax_fc"))
    if algo == "bcq":
        d1 = L("decoder1")
        return ConstrainedModel(d1, L("decoder2"), L("decoder3"), L("perturbator.fc1"),
                                L("perturbator.fc2"), L("perturbator.fc3"),
                                latent=int(z["latent_dim"]) if "latent_dim" in z else 2 * L("decoder3").w.shape[0])
    raise ValueError(f"wrong algorithm: {algo}")


# --------------------------------------------------------------------------- catalog

@dataclass
class ItemCatalog:
    """Dense item ids and their vectors (rows of ``matrix``)."""
    ids: np.ndarray
    matrix: np.ndarray
    dim: int
    gather: np.ndarray = field(default=None)  # index = dense id, OOV/missing rows zero

    @staticmethod
    def size_in_bytes(item_vecs: DataFrame, dim: int, oov_id: int | None = None) -> int:
        """Bytes of the shipped form: row count and largest dense id, times ``dim`` doubles."""
        n, top = item_vecs.agg(F.count(F.lit(1)), F.max("id")).first()
        return (n + max(int(top if top is not None else -1) + 1, (oov_id or 0) + 1)) * dim * 8

    @staticmethod
    def from_frame(item_vecs: DataFrame, dim: int, oov_id: int | None = None,
                   max_bytes: int = MAX_SHIPPED_BYTES) -> "ItemCatalog":
        """Ship a bounded catalog to the tasks.  Its size (row count and the
        largest dense id, times ``dim`` doubles) is checked first; above
        ``max_bytes`` use ``blocked=True`` scoring instead."""
        size = ItemCatalog.size_in_bytes(item_vecs, dim, oov_id)
        if size > max_bytes:
            raise ValueError(f"the catalog needs {size} bytes > {max_bytes}: use blocked scoring")
        pdf = item_vecs.select("id", "vec").toPandas().sort_values("id")
        ids = pdf["id"].to_numpy(dtype=np.int64)
        mat = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vec"]]) if len(ids) else \
            np.zeros((0, dim))
        size = int(max(ids.max() + 1 if len(ids) else 0, (oov_id or 0) + 1))
        gather = np.zeros((size, dim))
        gather[ids] = mat
        return ItemCatalog(ids, mat, dim, gather)


# --------------------------------------------------------------------------- scoring core

def _topk_index(r: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the top k per row of rounded scores ``r``: score
    desc, id asc.  Vectorised; exact even when ties cross the cut."""
    n, m = r.shape
    kk = min(k, m)
    idm = np.broadcast_to(ids, r.shape)
    if m <= 256 and kk <= 16 and np.isfinite(r).all() and (ids[1:] > ids[:-1]).all():
        # ids ascend, so the first of the greatest scores is the one to take
        left, sel, rows = r.copy(), np.empty((n, kk), dtype=np.int64), np.arange(n)
        for j in range(kk):
            sel[:, j] = left.argmax(axis=1)
            left[rows, sel[:, j]] = -np.inf
        return sel
    if m <= 256:
        return np.lexsort((idm, -r), axis=-1)[:, :kk]
    c = min(m, kk + 32)
    cand = np.argpartition(-r, c - 1, axis=1)[:, :c]
    sub = np.take_along_axis(r, cand, 1)
    o = np.lexsort((ids[cand], -sub), axis=-1)
    sel = np.take_along_axis(cand, o, 1)[:, :kk]
    if c < m:
        # a tie at the k-th score that extends past the candidates: redo the
        # row exactly (full sort) -- rare, and never drops a tied lower id
        kth = np.take_along_axis(sub, o, 1)[:, kk - 1]
        nxt = -np.partition(-r, c, axis=1)[:, c]
        for row in np.nonzero(nxt >= kth)[0]:
            sel[row] = np.lexsort((ids, -r[row]))[:kk]
    return sel


def _matrix(arr, width: int, dtype=np.float64) -> np.ndarray:
    """Fixed-width Arrow list column -> (rows, width) numpy matrix without a
    Python loop; NULL lists become zero rows (the OOV rule)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    out = np.zeros((n, width), dtype=dtype)
    if n == 0:
        return out
    vals = arr.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    if arr.null_count:
        valid = ~arr.is_null().to_numpy(zero_copy_only=False)
        out[valid] = vals.reshape(-1, width)
    else:
        out[:] = vals.reshape(n, width)
    return out


def _width(arr) -> int:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    lens = pc.list_value_length(arr).to_numpy(zero_copy_only=False)
    lens = lens[~np.isnan(lens)] if lens.dtype.kind == "f" else lens
    if len(lens) and (lens != lens[0]).any():
        raise ValueError("rows must have equal-length arrays to be scored together")
    return int(lens[0]) if len(lens) else 0


def _states(batch: pa.RecordBatch, state_col, user_vec_col, items_col, catalog, dim):
    if state_col is not None:
        col = batch.column(state_col)
        return _matrix(col, _width(col))
    u = _matrix(batch.column(user_vec_col), dim)
    items_arr = batch.column(items_col)
    items = _matrix(items_arr, _width(items_arr), np.int64)
    size = catalog.gather.shape[0]
    g = catalog.gather[np.clip(items, 0, size - 1)]
    g[items >= size] = 0.0
    return np.concatenate([u, g.reshape(len(items), -1)], axis=1)


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _keyed_normals(keys: np.ndarray | None, n: int, width: int, base_seed: int) -> np.ndarray:
    """(n, width) standard normals.  With ``keys`` a row's values depend only
    on (base_seed, its key, column): counters are hashed (splitmix64) to two
    uniforms and turned into a normal (Box-Muller) -- vectorised, and the same
    however rows are batched or partitioned."""
    if keys is None:
        return np.random.default_rng(base_seed).standard_normal((n, width))
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(base_seed) * _GOLDEN, dtype=np.uint64)
        for c in range(keys.shape[1]):
            h = _mix64(h ^ (keys[:, c].astype(np.uint64) + _GOLDEN))
        j = np.arange(width, dtype=np.uint64)
        a = _mix64(h[:, None] + (np.uint64(2) * j + np.uint64(1)) * _GOLDEN)
        b = _mix64(h[:, None] + (np.uint64(2) * j + np.uint64(2)) * _GOLDEN)
    u1 = ((a >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53   # (0, 1]
    u2 = (b >> np.uint64(11)).astype(np.float64) * 2.0 ** -53           # [0, 1)
    return np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2)


def _seed_keys(batch: pa.RecordBatch, seed_cols) -> np.ndarray | None:
    if not seed_cols:
        return None
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                     for c in seed_cols], axis=1)


def _actions(model, state, seed_keys, base_seed):
    if isinstance(model, ConstrainedModel) and model.noise:
        # a row's noise depends only on its own key; one batched forward pass
        z = _keyed_normals(seed_keys, len(state), model.latent, base_seed)
        return model.action(state, _FixedNoise(z))
    return model.action(state)


class _FixedNoise:
    def __init__(self, z):
        self.z = z

    def standard_normal(self, shape):
        return self.z


def _fixed_lists(mat: np.ndarray, pa_type) -> pa.Array:
    n, w = mat.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(w))
    return pa.ListArray.from_arrays(offsets, pa.array(mat.reshape(-1), type=pa_type))


def _passthrough(df: DataFrame, drop: list[str]) -> list[str]:
    return [c for c in df.columns if c not in drop]


def _check_noise(model, seed_cols) -> None:
    if getattr(model, "noise", False) and not seed_cols:
        raise ValueError("a model with noise needs seed_cols, the key of a row")


class WalkStats:
    """How many blocks the scoring tasks met, how many of them they did not read, and how
    many rows could not be scored (``null_on_error``)."""

    def __init__(self, spark):
        self.met = spark.sparkContext.accumulator(0)
        self.skipped = spark.sparkContext.accumulator(0)
        self.failed = spark.sparkContext.accumulator(0)


def head_bytes(model) -> int:
    """Bytes of a policy head that travels with the function; 0 for the other models."""
    head = getattr(model, "head", None)
    return 0 if head is None or isinstance(head, DataFrame) else head.w.nbytes + head.b.nbytes


def recommend(df: DataFrame, model, catalog: ItemCatalog | None = None, k: int = K.N_REC,
              items_col: str = "items", user_vec_col: str = "user_vec",
              state_col: str | None = None, out_col: str = "item_rec",
              seed_cols: tuple[str, ...] = (), base_seed: int = 0,
              item_vecs: DataFrame | None = None, blocked: bool = False,
              block_size: int = 65_536, rows_per_walk: int = 50_000,
              null_on_error: bool = False, stats: WalkStats | None = None,
              max_bytes: int = MAX_SHIPPED_BYTES) -> DataFrame:
    """Append ``out_col`` = top ``k`` dense item ids per row.

    Input: either ``state_col`` (G5, a ready state vector) or a user vector
    column plus a history of dense item ids (the state is built in the task
    from the catalog matrix).  Vector inputs are consumed, not echoed back.
    ``blocked=True`` scores against ``item_vecs`` without shipping the catalog
    (needs ``state_col``), see ``_recommend_blocked``.  ``null_on_error`` gives
    the rows of a batch that can't be scored a NULL list for ``fallback_hot``.

    Runs as ``mapInArrow``: list columns become numpy matrices without a
    per-row Python step, and the result list column is built in Arrow.
    """
    _check_noise(model, seed_cols)
    if blocked:
        return _recommend_blocked(df, model, item_vecs, k, state_col, out_col, block_size,
                                  rows_per_walk, seed_cols, base_seed, stats)
    if isinstance(getattr(model, "head", None), DataFrame) or head_bytes(model) > max_bytes:
        raise ValueError(f"the policy head needs more than {max_bytes} bytes: use blocked scoring")
    drop = [state_col] if state_col else [user_vec_col]
    keep = _passthrough(df, drop)
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    dim = catalog.dim

    def lists(batch):
        st = _states(batch, state_col, user_vec_col, items_col, catalog, dim)
        if isinstance(model, PolicyModel):
            act, block = model.action(st), (np.arange(len(model.head.w)), model.head.w, model.head.b)
        else:
            act = _actions(model, st, _seed_keys(batch, seed_cols), base_seed)
            block = (catalog.ids, catalog.matrix, None)
        return _fixed_lists(_walk(act, [Block(np.inf, 0.0, lambda: block)], k), pa.int32())

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            try:
                top = lists(batch)
            except Exception:
                if not null_on_error:
                    raise
                if stats is not None:
                    stats.failed.add(batch.num_rows)
                top = pa.nulls(batch.num_rows, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [top], names=keep + [out_col])

    return df.mapInArrow(run, schema)


def actor_action(df: DataFrame, model, catalog: ItemCatalog | None = None,
                 items_col: str = "items", user_vec_col: str = "user_vec",
                 state_col: str | None = None, out_col: str = "action",
                 seed_cols: tuple[str, ...] = (), base_seed: int = 0) -> DataFrame:
    """G1: the model's action vector per row (ARRAY<DOUBLE>)."""
    _check_noise(model, seed_cols)
    drop = [state_col] if state_col else [user_vec_col]
    keep = _passthrough(df, drop)
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField(out_col, T.ArrayType(T.DoubleType()))])
    dim = catalog.dim if catalog is not None else None

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            st = _states(batch, state_col, user_vec_col, items_col, catalog, dim)
            act = _actions(model, st, _seed_keys(batch, seed_cols), base_seed)
            cols = [batch.column(c) for c in keep] + [_fixed_lists(act, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=keep + [out_col])

    return df.mapInArrow(run, schema)


# Score-matrix cells (rows x items) held at once.
SCORE_CHUNK_CELLS = 4_000_000


@dataclass
class Block:
    """Items scored together: their greatest norm and bias, and how to get them."""
    norm: float
    bias: float
    load: Callable[[], tuple[np.ndarray, np.ndarray, np.ndarray | None]]  # ids, matrix, bias


def _walk(act: np.ndarray, blocks: Iterable[Block], k: int, stats: WalkStats | None = None) -> np.ndarray:
    """(rows, <= k) best item ids per action row, exact: a row leaves out a block only
    when no score in it can reach the row's k-th best (equal scores are still compared)."""
    n, most = len(act), np.iinfo(np.int64).max
    best, score = np.full((n, k), most, dtype=np.int64), np.full((n, k), -np.inf)
    norms = np.linalg.norm(act, axis=1)
    for block in blocks:
        with np.errstate(invalid="ignore"):
            bound = norms * block.norm * (1 + 1e-9) + block.bias + 2 * 10.0 ** -SCORE_DECIMALS
            rows = np.flatnonzero(~(bound < score[:, -1])) if k else np.arange(0)
        if stats is not None:
            stats.met.add(1)
            stats.skipped.add(int(not len(rows)))
        if not len(rows):
            continue
        ids, matrix, bias = block.load()
        if not len(ids):
            continue
        step = max(1, SCORE_CHUNK_CELLS // len(ids))
        for lo in range(0, len(rows), step):
            at = rows[lo:lo + step]
            s = act[at] @ matrix.T
            s = np.round(s if bias is None else s + bias, SCORE_DECIMALS)
            sel = _topk_index(s, ids, k)
            if np.isneginf(score[at, 0]).all() and len(ids) >= k and np.isfinite(top := np.take_along_axis(s, sel, 1)).all():
                best[at], score[at] = ids[sel], top  # nothing was found before
                continue
            found = np.concatenate([best[at], ids[sel]], axis=1)
            values = np.concatenate([score[at], np.take_along_axis(s, sel, 1)], axis=1)
            order = np.lexsort((found, -values), axis=-1)[:, :k]
            best[at], score[at] = np.take_along_axis(found, order, 1), np.take_along_axis(values, order, 1)
    filled = int((best[:1] != most).sum()) if n else 0  # every row has as many
    return best[:, :filled].astype(np.int32)


_BLOCK = "id long, vec array<double>, bias double"


def write_item_blocks(item_vecs: DataFrame, block_size: int) -> list[tuple[str, float, float]]:
    """Write items (id, vec and maybe bias) as files of at most ``block_size`` in the shared
    folder, those of great norm first -> (address, greatest norm, greatest bias) by falling norm."""
    spark = item_vecs.sparkSession
    path = scratch_path(spark, f"tables/item_blocks-{uuid.uuid4().hex[:12]}")
    bias = F.col("bias").cast("double") if "bias" in item_vecs.columns else F.lit(0.0)
    rows = item_vecs.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"),
                            bias.alias("bias"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    files = max(1, -(-rows.count() // block_size))
    (rows.repartitionByRange(files, norm.desc()).sortWithinPartitions(norm.desc())
     .write.option("maxRecordsPerFile", block_size).parquet(path))
    # a row a file: the catalog's size by the block's
    found = (spark.read.schema(_BLOCK).parquet(path).groupBy(F.input_file_name().alias("file"))
             .agg(F.max(norm).alias("norm"), F.max("bias").alias("bias")).collect())
    return sorted(((r["file"], r["norm"], r["bias"]) for r in found), key=lambda x: (-x[1], x[0]))


def _read_block(address: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if address.startswith("s3a:"):
        address = "s3:" + address[4:]
    store, path = fs.FileSystem.from_uri(address)
    with store.open_input_file(path) as f:
        t = pq.ParquetFile(f).read()
    return t["id"].to_numpy(), _matrix(t["vec"], _width(t["vec"])), t["bias"].to_numpy()


def head_table(spark, head: Layer, rows: int = 65_536) -> DataFrame:
    """A head's weights as a table (id, vec, bias) in the shared folder, sent some rows at a time."""
    path = scratch_path(spark, f"tables/head-{uuid.uuid4().hex[:12]}")
    for lo in range(0, max(1, len(head.w)), rows):
        w, b = head.w[lo:lo + rows], head.b[lo:lo + rows]
        part = pa.table({"id": pa.array(np.arange(lo, lo + len(w), dtype=np.int64)),
                         "vec": _fixed_lists(np.ascontiguousarray(w, dtype=np.float64), pa.float64()),
                         "bias": pa.array(np.asarray(b, dtype=np.float64))})
        spark.createDataFrame(part).write.mode("append").parquet(path)
    return spark.read.schema(_BLOCK).parquet(path)


def _recommend_blocked(df, model, item_vecs, k, state_col, out_col, block_size, rows_per_walk,
                       seed_cols, base_seed, stats):
    """Exact top-k for a catalog of any size, as one map over the rows.

    A task holds the actions of up to ``rows_per_walk`` rows, reads one block of
    ``block_size`` items after the other and keeps the best ``k`` so far.  Its
    memory is bounded by these rows, one block and ``SCORE_CHUNK_CELLS``
    scores, whatever the number of items.  The policy head's weights are blocks as well, one
    weight row an item, and leave the function.  The block files are read with
    Arrow's file systems (local or mounted paths, hdfs, s3, gs).
    """
    if state_col is None:
        raise ValueError("blocked scoring needs state_col")
    keep = _passthrough(df, [state_col])
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    policy = isinstance(model, PolicyModel)
    if policy:
        item_vecs = model.head if isinstance(model.head, DataFrame) else head_table(df.sparkSession, model.head)
        model = replace(model, head=None)
    files = write_item_blocks(item_vecs, block_size)

    def blocks() -> Iterator[Block]:
        for address, norm, bias in files:
            yield Block(norm, bias, lambda address=address: _read_block(address))

    def scored(held, acts):
        top = _walk(np.concatenate(acts), blocks(), k, stats)
        lo = 0
        for batch in held:
            hi = lo + batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [_fixed_lists(top[lo:hi], pa.int32())],
                                             names=keep + [out_col])
            lo = hi

    def run(batches):
        held, acts, rows = [], [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            state = _states(batch, state_col, None, None, None, None)
            acts.append(model.action(state) if policy else
                        _actions(model, state, _seed_keys(batch, seed_cols), base_seed))
            held.append(batch.select(keep))
            rows += batch.num_rows
            if rows >= rows_per_walk:
                yield from scored(held, acts)
                held, acts, rows = [], [], 0
        if held:
            yield from scored(held, acts)

    return df.mapInArrow(run, schema)


def model_for(algo: str, models: dict):
    """Pick the model by name; an unknown name is an error."""
    if algo not in K.ALGOS or algo not in models:
        raise ValueError(f"wrong algorithm: {algo}")
    return models[algo]
