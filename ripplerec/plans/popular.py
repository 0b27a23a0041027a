"""Popular-items job (batch): records -> mapped ids -> sliding counts ->
per-window top N -> rank store.  The reference maps ids before counting."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as K
from ..operators.lookup import map_ids
from ..operators.ranking import hot_list, top_n_items
from ..operators.windows import sliding_counts, sliding_counts_paned


def mapped_records(records: DataFrame, user_map: DataFrame, item_map: DataFrame) -> DataFrame:
    """A4-style mapping of both ids (unknown -> OOV code)."""
    return map_ids(map_ids(records, "user_id", user_map), "item_id", item_map)


def popular_counts(records: DataFrame, paned: bool = True) -> DataFrame:
    if paned:
        return sliding_counts_paned(records, "item_id", K.POP_WINDOW_SEC, K.POP_SLIDE_SEC)
    return sliding_counts(records, "item_id", K.POP_WINDOW, K.POP_SLIDE)


def popular_items(records: DataFrame, item_map: DataFrame, n: int | None = K.TOP_N,
                  paned: bool = True) -> DataFrame:
    """Flagship: (window_end ms, rank, item_id dense, cnt) for the top ``n``."""
    mapped = map_ids(records.select("item_id", "ts"), "item_id", item_map)
    return top_n_items(popular_counts(mapped, paned), n)


def current_hot_list(records: DataFrame, item_map: DataFrame, n: int = K.TOP_N) -> DataFrame:
    return hot_list(popular_items(records, item_map, n))
