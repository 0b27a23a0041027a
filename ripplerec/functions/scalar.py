"""Column functions: B1 ``encode_wire``, B5 ``format_time``, B8
``scoring_request`` / ``scoring_request_state``, B9 ``decode_scores``,
A4 ``split_wire``.  All are built-in expressions (whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_time(ms) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd HH:mm:ss' in the session zone (UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms)), K.TIME_FORMAT)


def encode_wire(user, item, time_ms) -> Column:
    """B1: the wire line 'user,item,time'."""
    return F.concat_ws(K.WIRE_SEP, _c(user).cast("string"), _c(item).cast("string"),
                       _c(time_ms).cast("string"))


def _strict(field: Column, kind: str, what: str) -> Column:
    parsed = F.try_cast(field, kind) if hasattr(F, "try_cast") else field.try_cast(kind)
    return F.when(parsed.isNull(), F.raise_error(F.lit(f"bad {what} in wire line"))).otherwise(parsed)


def split_wire(line) -> Column:
    """A4 helper: 'user,item,time' -> struct(user, item, time_ms); a bad or
    missing number fails the job, like the reference's parse (independent of
    the session's ANSI setting)."""
    parts = F.split(_c(line), K.WIRE_SEP)
    return F.struct(_strict(parts.getItem(0), "bigint", "user").alias("user_id"),
                    _strict(parts.getItem(1), "int", "item").alias("item_id"),
                    _strict(parts.getItem(2), "bigint", "time").alias("time_ms"))


def scoring_request(user, items, n_rec) -> Column:
    """B8 (sequence form): '{"user": [u], "n_rec": n, "item": [[i1,i2,..]]}'."""
    return F.concat(F.lit('{"user": ['), _c(user).cast("string"), F.lit('], "n_rec": '),
                    _c(n_rec).cast("string"), F.lit(', "item": [['),
                    F.array_join(F.transform(_c(items), lambda x: x.cast("string")), ","),
                    F.lit("]]}"))


def vector_text(vec) -> Column:
    """A vector's six-decimal floats as one text, in an array of one: a piece of
    the state that ``scoring_request_state`` takes as it is.  None for an empty vector."""
    text = F.array_join(F.transform(_c(vec), lambda x: F.format_string("%f", x)), ",")
    return F.when(F.size(_c(vec)) == 0, F.array().cast("array<string>")).when(_c(vec).isNotNull(), F.array(text))


def scoring_request_state(user, state, n_rec, texts: bool = False) -> Column:
    """B8 (embedding form): '{"user": u, "n_rec": n, "embedding": [[%f,..]]}'
    with a bare user id and six-decimal floats, as the reference writes it.  With ``texts``
    the state's elements are ``vector_text`` pieces; else its floats are written here."""
    parts = _c(state) if texts else F.transform(_c(state), lambda x: F.format_string("%f", x))
    return F.concat(F.lit('{"user": '), _c(user).cast("string"), F.lit(', "n_rec": '),
                    _c(n_rec).cast("string"), F.lit(', "embedding": [['),
                    F.array_join(parts, ","),
                    F.lit("]]}"))


def encode_scores(items) -> Column:
    """The scorer's response body: '[[i1,i2,..]]'."""
    return F.to_json(F.array(_c(items)))


def decode_scores(body) -> Column:
    """Response '[[i..]]' -> first row as ARRAY<INT>."""
    return F.from_json(_c(body), "array<array<int>>").getItem(0)
