"""DuckDB oracle SQL for the registered queries (driver correctness gate).

Each string runs on the driver's pre-registered views.  The common CTEs
restate the fixture rules in plain SQL: records from ``events``, the
vocabulary rule, dense ids, OOV = dictionary size, embeddings, weights.
"""

from __future__ import annotations

from .. import constants as K
from ..operators.sinks import CONSUMED_CHUNK
from .fixtures import EMBED_DIM, HIDDEN, VOCAB_MIN_SHARE

_SHARE = repr(float(VOCAB_MIN_SHARE))

RECORDS = """
rec AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
         ts, epoch_us(ts) AS ts_us, CAST(event_id AS BIGINT) AS event_id
  FROM events)"""

MAPS = f"""
ucnt AS (SELECT user_id AS raw_id, count(*) AS c FROM rec GROUP BY 1),
umap AS (SELECT raw_id, CAST(row_number() OVER (ORDER BY raw_id) - 1 AS INTEGER) AS dense_id
         FROM ucnt WHERE c >= {_SHARE} * (SELECT avg(c) FROM ucnt)),
icnt AS (SELECT item_id AS raw_id, count(*) AS c FROM rec GROUP BY 1),
imap AS (SELECT raw_id, CAST(row_number() OVER (ORDER BY raw_id) - 1 AS INTEGER) AS dense_id
         FROM icnt WHERE c >= {_SHARE} * (SELECT avg(c) FROM icnt)),
uoov AS (SELECT CAST(count(*) AS INTEGER) AS oov FROM umap),
ioov AS (SELECT CAST(count(*) AS INTEGER) AS oov FROM imap),
mrec AS (
  SELECT rec.user_id AS raw_user, rec.item_id AS raw_item,
         CAST(coalesce(um.dense_id, (SELECT oov FROM uoov)) AS INTEGER) AS user_id,
         CAST(coalesce(im.dense_id, (SELECT oov FROM ioov)) AS INTEGER) AS item_id,
         rec.ts, rec.ts_us, rec.event_id
  FROM rec LEFT JOIN umap um ON um.raw_id = rec.user_id
           LEFT JOIN imap im ON im.raw_id = rec.item_id)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _pop_counts(src: str = "mrec") -> str:
    slide_us = K.POP_SLIDE_SEC * 1_000_000
    k = K.POP_WINDOW_SEC // K.POP_SLIDE_SEC
    return f"""
pwin AS (
  SELECT item_id, CAST((ts_us // {slide_us} + 1 + unnest(range({k}))) * {K.POP_SLIDE_SEC * 1000} AS BIGINT) AS window_end
  FROM {src}),
pcounts AS (SELECT window_end, item_id, count(*) AS cnt FROM pwin GROUP BY 1, 2)"""


def _pop_top(n: int | None) -> str:
    lim = f"WHERE rank <= {n}" if n else ""
    return f"""
ranked AS (
  SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id ASC) AS INTEGER) AS rank,
         item_id, cnt FROM pcounts),
ptop AS (SELECT * FROM ranked {lim})"""


def sliding_counts() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), body="SELECT window_end, item_id, cnt FROM pcounts")


def top_n_items(n: int | None = K.TOP_N) -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(n),
                     body="SELECT window_end, rank, item_id, cnt FROM ptop")


def hot_list() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(K.TOP_N),
                     body="SELECT rank, arg_max(item_id, window_end) AS item_id FROM ptop GROUP BY rank")


def _hist_ctes(src: str = "rec", hist: int = K.HIST_LEN) -> str:
    """E1 by its definition: the exploded (window, event) sequence per user,
    last ``hist`` items at the last row of each window."""
    slide_us = K.HIST_SLIDE_SEC * 1_000_000
    k = K.HIST_WINDOW_SEC // K.HIST_SLIDE_SEC
    return f"""
hex AS (
  SELECT user_id, item_id, ts_us, event_id,
         CAST((ts_us // {slide_us} + 1 + unnest(range({k}))) * {K.HIST_SLIDE_SEC * 1000} AS BIGINT) AS window_end
  FROM {src}),
hseq AS (
  SELECT user_id, window_end,
         list(item_id) OVER (PARTITION BY user_id ORDER BY window_end, ts_us, event_id
                             ROWS BETWEEN {hist - 1} PRECEDING AND CURRENT ROW) AS items,
         row_number() OVER (PARTITION BY user_id, window_end ORDER BY ts_us DESC, event_id DESC) AS rn
  FROM hex),
hist AS (SELECT user_id, window_end, items FROM hseq WHERE rn = 1)"""


def user_history() -> str:
    return with_ctes(RECORDS, _hist_ctes(), body="SELECT user_id, window_end, items FROM hist")


def full_history() -> str:
    return with_ctes(RECORDS, _hist_ctes(),
                     body=f"SELECT user_id, window_end, items FROM hist WHERE len(items) = {K.HIST_LEN}")


def user_history_dedup() -> str:
    slide_us = K.HIST_SLIDE_SEC * 1_000_000
    k = K.HIST_WINDOW_SEC // K.HIST_SLIDE_SEC
    return with_ctes(RECORDS, f"""
pev AS (
  SELECT user_id, ts_us, event_id,
         list(item_id) OVER (PARTITION BY user_id ORDER BY ts_us, event_id
                             ROWS BETWEEN {K.HIST_LEN - 1} PRECEDING AND CURRENT ROW) AS items
  FROM rec),
pex AS (
  SELECT user_id, ts_us, event_id, items,
         CAST((ts_us // {slide_us} + 1 + unnest(range({k}))) * {K.HIST_SLIDE_SEC * 1000} AS BIGINT) AS window_end
  FROM pev)""", body="SELECT user_id, window_end, arg_max(items, ts_us) AS items FROM pex GROUP BY 1, 2")


def user_windows() -> str:
    slide_us = K.HIST_SLIDE_SEC * 1_000_000
    k = K.HIST_WINDOW_SEC // K.HIST_SLIDE_SEC
    return with_ctes(RECORDS, f"""
wex AS (
  SELECT user_id, item_id, ts_us, event_id,
         CAST((ts_us // {slide_us} + 1 + unnest(range({k}))) * {K.HIST_SLIDE_SEC * 1000} AS BIGINT) AS window_end
  FROM rec),
wrn AS (SELECT *, row_number() OVER (PARTITION BY user_id, window_end ORDER BY ts_us DESC, event_id DESC) AS rn FROM wex)""",
        body=f"""SELECT user_id, window_end, count(*) AS n_events,
       list(item_id ORDER BY ts_us, event_id) FILTER (WHERE rn <= {K.HIST_LEN}) AS items
FROM wrn GROUP BY 1, 2""")


def build_id_map() -> str:
    return with_ctes(RECORDS, MAPS, body="SELECT raw_id, dense_id FROM umap")


def filter_min_interactions() -> str:
    return with_ctes(RECORDS, MAPS, body=f"""
SELECT event_id, user_id, item_id FROM rec
WHERE user_id IN (SELECT raw_id FROM ucnt WHERE c >= {_SHARE} * (SELECT avg(c) FROM ucnt))""")


def merge_features() -> str:
    return """
SELECT l.l_orderkey, l.l_linenumber, c.c_custkey, c.c_mktsegment, p.p_partkey, p.p_brand, l.l_quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
     JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN part p ON l.l_partkey = p.p_partkey"""


def map_ids() -> str:
    return with_ctes(RECORDS, MAPS, body="SELECT event_id, user_id, item_id FROM mrec")


def map_id_arrays() -> str:
    return with_ctes(RECORDS, MAPS, _hist_ctes(), """
hel AS (SELECT user_id, window_end, unnest(items) AS el, unnest(range(len(items))) AS pos FROM hist),
hmap AS (
  SELECT h.user_id, h.window_end,
         list(CAST(coalesce(im.dense_id, (SELECT oov FROM ioov)) AS INTEGER) ORDER BY h.pos) AS items
  FROM hel h LEFT JOIN imap im ON im.raw_id = h.el GROUP BY 1, 2)""",
        body="""SELECT hist.user_id, hist.window_end, coalesce(hmap.items, []::INTEGER[]) AS items
FROM hist LEFT JOIN hmap USING (user_id, window_end)""")


def format_time() -> str:
    return with_ctes(RECORDS, body="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM rec")


def encode_wire() -> str:
    return with_ctes(RECORDS, body="""
SELECT event_id, concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR),
                           CAST(ts_us // 1000 AS VARCHAR)) AS line FROM rec""")


def decode_records() -> str:
    return with_ctes(RECORDS, MAPS, body="SELECT user_id, item_id, CAST(ts_us // 1000 AS BIGINT) AS time_ms FROM mrec")


def explode_ranks() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(K.TOP_N),
                     body="SELECT window_end, rank, item_id FROM ptop")


def _user_times() -> str:
    slide_us = K.HIST_SLIDE_SEC * 1_000_000
    k = K.HIST_WINDOW_SEC // K.HIST_SLIDE_SEC
    return f"""
qtimes AS (
  SELECT DISTINCT CAST((ts_us // {slide_us} + 1 + unnest(range({k}))) * {K.HIST_SLIDE_SEC * 1000} AS BIGINT) AS t
  FROM rec)"""


def hot_list_asof() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(K.TOP_N), _user_times(), f"""
probe AS (SELECT t, CAST(unnest(range(1, {K.TOP_N + 1})) AS INTEGER) AS rank FROM qtimes)""",
        body="""SELECT p.t, p.rank, w.item_id FROM probe p
ASOF JOIN ptop w ON p.rank = w.rank AND p.t >= w.window_end""")


# ------------------------------------------------------------------ scoring

_D, _H, _P = EMBED_DIM, HIDDEN, K.HIST_LEN + 1


def _w(j: str, i: str) -> str:
    return f"CAST((((31*{j} + 17*({i})) % 19) - 9) AS DOUBLE) / 64.0"


def _b(j: str) -> str:
    return f"CAST((((7*{j}) % 11) - 5) AS DOUBLE) / 64.0"


def _score_ctes() -> str:
    """Full-history rows, vectors, and the fixture nets up to the actions.

    Layer 1 is factorised: W1 . (u ++ v_1 .. v_10) = W1[:, u] . u + sum_p
    W1[:, p] . v_p, with per-id projections computed once.  The weight rule
    does not depend on the layer, so every 64x64 layer shares one matrix.
    """
    return "," .join([
        """
srec AS (SELECT raw_user AS user_id, item_id, ts_us, event_id FROM mrec)""",
        _hist_ctes("srec"),
        f"""
fh AS (
  SELECT h.user_id AS raw_user, CAST(coalesce(um.dense_id, (SELECT oov FROM uoov)) AS INTEGER) AS user_id,
         h.window_end, h.items
  FROM hist h LEFT JOIN umap um ON um.raw_id = h.user_id WHERE len(h.items) = {K.HIST_LEN}),
uvec AS (SELECT um.dense_id AS id, CAST(e.embedding AS DOUBLE[]) AS vec FROM umap um JOIN embeddings e ON e.vec_id = um.raw_id),
ivec AS (SELECT im.dense_id AS id, CAST(e.embedding AS DOUBLE[]) AS vec FROM imap im JOIN embeddings e ON e.vec_id = im.raw_id),
zero AS (SELECT list_transform(range({_D}), lambda i: 0.0::DOUBLE) AS vec),
uvec_all AS (SELECT id, vec FROM uvec UNION ALL SELECT (SELECT oov FROM uoov), vec FROM zero),
ivec_all AS (SELECT id, vec FROM ivec UNION ALL SELECT (SELECT oov FROM ioov), vec FROM zero),
wm AS (SELECT list(list_transform(range({_H}), lambda i: {_w('j', 'i')}) ORDER BY j) AS m,
              list({_b('j')} ORDER BY j) AS b
       FROM (SELECT unnest(range({_H})) AS j)),
w1 AS (SELECT p, list(list_transform(range({_D}), lambda i: {_w('j', f'{_D}*p + i')}) ORDER BY j) AS m
       FROM (SELECT j, unnest(range({_P})) AS p FROM (SELECT unnest(range({_H})) AS j)) GROUP BY p),
uproj AS (SELECT u.id, list_transform(range({_H}), lambda j: list_dot_product(u.vec, w1.m[j+1])) AS s
          FROM uvec_all u, w1 WHERE w1.p = 0),
iproj AS (SELECT v.id, w1.p - 1 AS pos, list_transform(range({_H}), lambda j: list_dot_product(v.vec, w1.m[j+1])) AS s
          FROM ivec_all v, w1 WHERE w1.p > 0),
fel AS (SELECT raw_user, window_end, user_id, unnest(items) AS item, unnest(range({K.HIST_LEN})) AS pos FROM fh),
parts AS (
  SELECT f.raw_user, f.window_end, ip.s FROM fel f JOIN iproj ip ON ip.id = f.item AND ip.pos = f.pos
  UNION ALL
  SELECT f.raw_user, f.window_end, up.s FROM fh f JOIN uproj up ON up.id = f.user_id),
pj AS (SELECT raw_user, window_end, unnest(s) AS v, unnest(range({_H})) AS j FROM parts),
pre AS (SELECT raw_user, window_end, list(sv ORDER BY j) AS pre
        FROM (SELECT raw_user, window_end, j, sum(v) AS sv FROM pj GROUP BY ALL) GROUP BY ALL),
l1 AS (SELECT p.raw_user, p.window_end, p.pre,
              list_transform(range({_H}), lambda j: greatest(0.0, p.pre[j+1] + wm.b[j+1])) AS h1 FROM pre p, wm),
l2 AS (SELECT l1.raw_user, l1.window_end, l1.pre,
              list_transform(range({_H}), lambda j: greatest(0.0, list_dot_product(l1.h1, wm.m[j+1]) + wm.b[j+1])) AS h2
       FROM l1, wm),
ddpg AS (SELECT l2.raw_user, l2.window_end, l2.pre,
                list_transform(range({_D}), lambda j: list_dot_product(l2.h2, wm.m[j+1]) + wm.b[j+1]) AS action
         FROM l2, wm)"""])


def _rank_recs(src: str, k: int) -> str:
    """(raw_user, window_end, item_id, score) -> top k list per row."""
    return f"""
rk AS (SELECT *, row_number() OVER (PARTITION BY raw_user, window_end ORDER BY score DESC, item_id ASC) AS rn FROM {src}),
recs AS (SELECT fh.raw_user, fh.user_id, fh.window_end, fh.items,
                CAST(list(rk.item_id ORDER BY rk.rn) AS INTEGER[]) AS item_rec
         FROM fh JOIN rk ON rk.raw_user = fh.raw_user AND rk.window_end = fh.window_end AND rk.rn <= {k}
         GROUP BY ALL)"""


def _dot_scores(action_src: str) -> str:
    return f"""
sc AS (SELECT a.raw_user, a.window_end, v.id AS item_id, round(list_dot_product(a.action, v.vec), 9) AS score
       FROM {action_src} a, ivec v)"""


def _policy_scores() -> str:
    return f"""
whead AS (SELECT list(list_transform(range({_H}), lambda j: {_w('i', 'j')}) ORDER BY i) AS m, list({_b('i')} ORDER BY i) AS b
          FROM (SELECT unnest(range((SELECT oov FROM ioov))) AS i)),
logit AS (SELECT l2.raw_user, l2.window_end,
                 list_transform(range(len(whead.b)), lambda i: list_dot_product(l2.h2, whead.m[i+1]) + whead.b[i+1]) AS z
          FROM l2, whead),
sc AS (SELECT raw_user, window_end, CAST(unnest(range(len(z))) AS INTEGER) AS item_id, round(unnest(z), 9) AS score FROM logit)"""


def _bcq_actions() -> str:
    return f"""
wg AS (SELECT list(list_transform(range({_D}), lambda i: {_w('j', f'{_D * _P} + i')}) ORDER BY j) AS m
       FROM (SELECT unnest(range({_H})) AS j)),
p1 AS (SELECT d.raw_user, d.window_end, d.action AS gen,
              list_transform(range({_H}), lambda j: greatest(0.0, d.pre[j+1] + list_dot_product(d.action, wg.m[j+1]) + wm.b[j+1])) AS h
       FROM ddpg d, wg, wm),
p2 AS (SELECT p1.raw_user, p1.window_end, p1.gen,
              list_transform(range({_H}), lambda j: greatest(0.0, list_dot_product(p1.h, wm.m[j+1]) + wm.b[j+1])) AS h
       FROM p1, wm),
bcq AS (SELECT p2.raw_user, p2.window_end,
               list_transform(range({_D}), lambda j: p2.gen[j+1] + {K.BCQ_PHI} * tanh(list_dot_product(p2.h, wm.m[j+1]) + wm.b[j+1])) AS action
        FROM p2, wm)"""


def _scoring_base() -> list[str]:
    return [RECORDS, MAPS, _score_ctes()]


def recommend_actor(k: int = K.N_REC) -> str:
    return with_ctes(*_scoring_base(), _dot_scores("ddpg"), _rank_recs("sc", k),
                     body="SELECT raw_user, user_id, window_end, item_rec FROM recs")


def recommend_policy(k: int = K.N_REC) -> str:
    return with_ctes(*_scoring_base(), _policy_scores(), _rank_recs("sc", k),
                     body="SELECT raw_user, user_id, window_end, item_rec FROM recs")


def recommend_constrained(k: int = K.N_REC) -> str:
    return with_ctes(*_scoring_base(), _bcq_actions(), _dot_scores("bcq"), _rank_recs("sc", k),
                     body="SELECT raw_user, user_id, window_end, item_rec FROM recs")


def actor_action() -> str:
    return with_ctes(*_scoring_base(), body="""
SELECT raw_user, window_end, CAST(i - 1 AS INTEGER) AS pos, CAST(action[i] AS DOUBLE) AS value
FROM (SELECT *, unnest(range(1, len(action) + 1)) AS i FROM ddpg)""")


def topk_blocked(k: int = K.N_REC) -> str:
    return with_ctes(*_scoring_base(), _dot_scores("ddpg"), body=f"""
SELECT raw_user, window_end, CAST(rn AS INTEGER) AS rank, item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_user, window_end ORDER BY score DESC, item_id ASC) AS rn FROM sc)
WHERE rn <= {k}""")


def state_vector() -> str:
    return with_ctes(*_scoring_base(), body=f"""
SELECT f.raw_user, f.window_end,
       list_concat(coalesce(u.vec, (SELECT vec FROM zero)),
                   flatten(list(coalesce(v.vec, (SELECT vec FROM zero)) ORDER BY fe.pos))) AS state
FROM fh f LEFT JOIN uvec u ON u.id = f.user_id
     JOIN fel fe ON fe.raw_user = f.raw_user AND fe.window_end = f.window_end
     LEFT JOIN ivec v ON v.id = fe.item
GROUP BY f.raw_user, f.window_end, u.vec""")


def scoring_requests() -> str:
    return with_ctes(*_scoring_base(), body=f"""
SELECT raw_user, window_end,
       '{{"user": [' || CAST(user_id AS VARCHAR) || '], "n_rec": {K.N_REC}, "item": [[' ||
       array_to_string(list_transform(items, lambda x: CAST(x AS VARCHAR)), ',') || ']]}}' AS request
FROM fh""")


def scoring_requests_state() -> str:
    return with_ctes(*_scoring_base(), f"""
st AS (
  SELECT f.raw_user, f.window_end, f.user_id,
         list_concat(coalesce(u.vec, (SELECT vec FROM zero)),
                     flatten(list(coalesce(v.vec, (SELECT vec FROM zero)) ORDER BY fe.pos))) AS state
  FROM fh f LEFT JOIN uvec u ON u.id = f.user_id
       JOIN fel fe ON fe.raw_user = f.raw_user AND fe.window_end = f.window_end
       LEFT JOIN ivec v ON v.id = fe.item
  GROUP BY f.raw_user, f.window_end, f.user_id, u.vec)""", body=f"""
SELECT raw_user, window_end,
       '{{"user": ' || CAST(user_id AS VARCHAR) || ', "n_rec": {K.N_REC}, "embedding": [[' ||
       array_to_string(list_transform(state, lambda x: printf('%f', x)), ',') || ']]}}' AS request
FROM st""")


def _hot_for(src_times: str) -> str:
    return f"""
qt AS (SELECT DISTINCT window_end AS t FROM {src_times}),
probe AS (SELECT t, CAST(unnest(range(1, {K.TOP_N + 1})) AS INTEGER) AS rank FROM qt),
hot AS (SELECT p.t, p.rank, w.item_id FROM probe p ASOF JOIN ptop w ON p.rank = w.rank AND p.t >= w.window_end)"""


_REWARD = ("CASE WHEN prev IS NULL THEN -1 ELSE CAST(coalesce(list_sum(list_transform(prev, "
           "lambda r: len(list_filter(items, lambda c: c = r)))), 0) AS INTEGER) END")


def _pipeline(scored: list[str], rec_src: str, failed: bool, literal: bool = False,
              n_rec: int = K.N_REC) -> list[str]:
    if failed:
        recs = "recs AS (SELECT raw_user, user_id, window_end, items, CAST(NULL AS INTEGER[]) AS item_rec FROM fh)"
        extra = f"h.rank <= {n_rec}"
    else:
        recs = None
        extra = f"h.rank <= {n_rec} - len(r.item_rec)"
    part = "window_end, user_id" if literal else "user_id"
    order = "raw_user" if literal else "window_end, raw_user"
    ctes = [*scored, _pop_counts(), _pop_top(K.TOP_N), _hot_for("fh")]
    if recs:
        ctes.append(recs)
    ctes.append(f"""
filled AS (
  SELECT r.raw_user, r.user_id, r.window_end, r.items,
         list_concat(coalesce(r.item_rec, []::INTEGER[]),
                     coalesce(list(h.item_id ORDER BY h.rank) FILTER (WHERE {extra}), []::INTEGER[])) AS item_rec
  FROM recs r LEFT JOIN hot h ON h.t = r.window_end
  GROUP BY r.raw_user, r.user_id, r.window_end, r.items, r.item_rec),
rw AS (SELECT *, lag(item_rec) OVER (PARTITION BY {part} ORDER BY {order}) AS prev FROM filled)""")
    return ctes


_OUT = ("SELECT user_id, raw_user, window_end, strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') AS time, "
        "item_rec, " + _REWARD + " AS last_reward FROM rw")


def recommend_pipeline(k: int = K.N_REC) -> str:
    scored = [*_scoring_base(), _dot_scores("ddpg"), _rank_recs("sc", k)]
    return with_ctes(*_pipeline(scored, "recs", False), body=_OUT)


def fallback_pipeline() -> str:
    return with_ctes(*_pipeline([*_scoring_base()], "recs", True), body=_OUT)


def last_reward_hot() -> str:
    return with_ctes(*_pipeline([*_scoring_base()], "recs", True),
                     body="SELECT user_id, raw_user, window_end, " + _REWARD + " AS last_reward FROM rw")


def last_reward_literal() -> str:
    scored = [*_scoring_base(), _dot_scores("ddpg"), _rank_recs("sc", K.N_REC)]
    return with_ctes(*_pipeline(scored, "recs", False, literal=True),
                     body="SELECT user_id, raw_user, window_end, " + _REWARD + " AS last_reward FROM rw")


# ------------------------------------------------------------------ sinks, sources

_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def record_log() -> str:
    return with_ctes(RECORDS, MAPS, body=f"SELECT user_id AS user, item_id AS item, {_TIME} AS time FROM mrec")


def _consumed_ctes(literal: bool) -> str:
    src = "mrec"
    extra = ""
    if literal:
        extra = """,
firstev AS (SELECT user_id, arg_min(event_id, (ts_us, event_id)) AS eid FROM mrec GROUP BY 1),
kept AS (SELECT m.* FROM mrec m JOIN firstev f ON f.user_id = m.user_id WHERE m.event_id <> f.eid)"""
        src = "kept"
    return MAPS + extra + f""",
users AS (SELECT DISTINCT user_id FROM mrec),
fi AS (SELECT user_id, item_id, min((ts_us, event_id)) AS f FROM {src} GROUP BY 1, 2),
ft AS (SELECT user_id, {_TIME} AS t, min((ts_us, event_id)) AS f FROM {src} GROUP BY 1, 2)"""


def user_consumed(literal: bool = False) -> str:
    return with_ctes(RECORDS, _consumed_ctes(literal) + """,
li AS (SELECT user_id, list(item_id ORDER BY f) AS consumed FROM fi GROUP BY 1),
lt AS (SELECT user_id, list(t ORDER BY f) AS time FROM ft GROUP BY 1)""",
        body="""SELECT u.user_id AS "user", coalesce(li.consumed, []::INTEGER[]) AS consumed,
       coalesce(lt.time, []::VARCHAR[]) AS time
FROM users u LEFT JOIN li USING (user_id) LEFT JOIN lt USING (user_id)""")


def user_consumed_chunks(literal: bool = False) -> str:
    return with_ctes(RECORDS, _consumed_ctes(literal) + """,
placed AS (
  SELECT user_id, 'item' AS kind, CAST(item_id AS VARCHAR) AS v, row_number() OVER (PARTITION BY user_id ORDER BY f) - 1 AS pos FROM fi
  UNION ALL
  SELECT user_id, 'time' AS kind, t AS v, row_number() OVER (PARTITION BY user_id ORDER BY f) - 1 AS pos FROM ft)""",
                     body=f"""SELECT user_id AS "user", kind, pos // {CONSUMED_CHUNK} AS chunk, list(v ORDER BY pos) AS vals
FROM placed GROUP BY ALL""")


def unique_records() -> str:
    return with_ctes(RECORDS, MAPS, body=f"""
SELECT user_id AS "user", item_id AS item, strftime(arg_min(ts, (ts_us, event_id)), '%Y-%m-%d %H:%M:%S') AS time
FROM mrec GROUP BY 1, 2""")


def wire_messages() -> str:
    return with_ctes(RECORDS, body="""
SELECT CAST(user_id AS VARCHAR) AS key,
       concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(ts_us // 1000 AS VARCHAR)) AS value
FROM rec""")


def top_table() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(K.TOP_N), body="""
SELECT CAST(arg_max(item_id, window_end) AS INTEGER) AS item, CAST(rank AS VARCHAR) AS rank FROM ptop GROUP BY rank""")


def history_store() -> str:
    return with_ctes(RECORDS, _hist_ctes(), body=f"""
SELECT user_id, arg_max(items, window_end) AS items FROM hist{_closed(10_000)} GROUP BY user_id""")


def hot_store() -> str:
    return with_ctes(RECORDS, MAPS, _pop_counts(), _pop_top(K.TOP_N), body=f"""
SELECT CAST(arg_max(item_id, window_end) AS INTEGER) AS item, CAST(rank AS VARCHAR) AS rank
FROM ptop{_closed(0)} GROUP BY rank""")


def recommend_by_name() -> str:
    made = {"ddpg": recommend_actor, "reinforce": recommend_policy, "bcq": recommend_constrained}
    return " UNION ALL ".join(f"SELECT '{algo}' AS algo, * FROM ({made[algo]()})" for algo in K.ALGOS)


def read_events_csv() -> str:
    return with_ctes(RECORDS, body="SELECT user_id, item_id, CAST(ts_us // 1000 AS BIGINT) AS time_ms FROM rec")


def read_text_tolerant() -> str:
    return "SELECT CAST(user_id AS INTEGER) AS c0, event_type AS c4 FROM events"


def read_embeddings() -> str:
    return with_ctes(RECORDS, MAPS, """
uv AS (SELECT um.dense_id AS id, e.embedding AS vec FROM umap um JOIN embeddings e ON e.vec_id = um.raw_id),
iv AS (SELECT im.dense_id AS id, e.embedding AS vec FROM imap im JOIN embeddings e ON e.vec_id = im.raw_id)""",
        body="SELECT 'user' AS kind, id, vec FROM uv UNION ALL SELECT 'item' AS kind, id, vec FROM iv")


def late_rows() -> str:
    """Four arrivals by event id; the watermark of each is the latest time before it less 10 s."""
    return with_ctes(RECORDS, """
cuts AS (SELECT event_id % 4 AS cut, max(ts_us) // 1000 - 10000 AS mark FROM rec GROUP BY 1)""",
                     body="""SELECT event_id, user_id, item_id,
       ts_us < 1000 * coalesce((SELECT max(mark) FROM cuts WHERE cut < event_id % 4), 0) AS late FROM rec""")


def _closed(lateness_ms: int) -> str:
    """Windows whose end the watermark has reached at the end of the stream."""
    return f" WHERE window_end <= (SELECT max(ts_us) // 1000 FROM rec) - {lateness_ms}"


ORACLES = {
    "sliding_counts": sliding_counts,
    "sliding_counts_paned": sliding_counts,
    "top_n_items": top_n_items,
    "rank_all_items": lambda: top_n_items(None),
    "hot_list": hot_list,
    "build_id_map": build_id_map,
    "filter_min_interactions": filter_min_interactions,
    "merge_features": merge_features,
    "map_ids": map_ids,
    "map_id_arrays": map_id_arrays,
    "format_time": format_time,
    "encode_wire": encode_wire,
    "decode_records": decode_records,
    "explode_ranks": explode_ranks,
    "user_windows": user_windows,
    "user_history": user_history,
    "user_history_dedup": user_history_dedup,
    "full_history": full_history,
    "hot_list_asof": hot_list_asof,
    "actor_action": actor_action,
    "recommend_actor": recommend_actor,
    "recommend_policy": recommend_policy,
    "recommend_constrained": recommend_constrained,
    "recommend_state": recommend_actor,
    "recommend_state_policy": recommend_policy,
    "recommend_state_constrained": recommend_constrained,
    "recommend_policy_blocked": recommend_policy,
    "topk_per_key": topk_blocked,
    "state_vector": state_vector,
    "scoring_requests": scoring_requests,
    "scoring_requests_state": scoring_requests_state,
    "decode_scores": recommend_actor,
    "fill_with_hot": lambda: recommend_pipeline(5),
    "fallback_hot": fallback_pipeline,
    "recommend_pipeline": recommend_pipeline,
    "last_reward": last_reward_hot,
    "last_reward_literal": last_reward_literal,
    "record_log": record_log,
    "user_consumed": user_consumed,
    "user_consumed_literal": lambda: user_consumed(True),
    "unique_records": unique_records,
    "wire_messages": wire_messages,
    "top_table": top_table,
    "read_events_csv": read_events_csv,
    "read_text_tolerant": read_text_tolerant,
    "read_id_map": build_id_map,
    "read_embeddings": read_embeddings,
    "record_log_stream": record_log,
    "unique_records_stream": unique_records,
    "user_consumed_stream": user_consumed,
    "top_n_items_stream": lambda: top_n_items() + _closed(0),
    "user_history_stream": lambda: user_history() + _closed(10_000),
    "last_reward_stream": last_reward_hot,
    "top_n_panes_stream": lambda: top_n_items() + _closed(0),
    "rank_all_panes_stream": lambda: top_n_items(None) + _closed(0),
    "late_rows_stream": late_rows,
    "history_store_stream": history_store,
    "user_consumed_chunks": user_consumed_chunks,
    "user_consumed_literal_chunks": lambda: user_consumed_chunks(True),
    "user_consumed_chunks_stream": user_consumed_chunks,
    "hot_store_stream": hot_store,
    "wire_topic_stream": decode_records,
    "recommend_by_name": recommend_by_name,
    "recommend_stream": lambda: recommend_pipeline() + _closed(10_000),
}


def oracle_sql() -> dict[str, str]:
    return {name: fn() for name, fn in ORACLES.items()}
