"""The encoder batch over the feature table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from clickweave.operators.folds import fold_table
from clickweave.operators.outoffold import oof_encode_long

# The 31 encoded key sets, in the reference's order.  The
# item / category / product / server_timeDay keys are the per-user log modes.
ENCODE_KEYS: list[list[str]] = [
    ["app_code"], ["user_id", "app_code"], ["impression_timeHour"], ["impression_timeDayofweek"], ["os_version"],
    ["app_code", "impression_timeHour"], ["os_version", "app_code"], ["user_date_item_uniq"], ["user_hr_item_uniq"],
    ["app_impression_count"], ["user_hr_sess_uniq"], ["item_price"], ["item_id"], ["user_id", "item_price"],
    ["user_id", "item_id"], ["category_3", "server_timeDay"], ["product_type"], ["user_id", "item_id", "product_type"],
    ["item_uniq"], ["category_3"], ["user_daywk_item_uniq"], ["category_2"], ["user_week_impcnt"],
    ["user_app_hr_impcnt"], ["user_app_min_impcnt"], ["user_day_unicount"], ["user_daywk_unicount"],
    ["user_moe_unicount"], ["user_mos_unicount"], ["user_hr_unicount"], ["user_min_unicount"],
]


def encode_features(
    spark: SparkSession,
    features: DataFrame,
    folds: Sequence[Any],
    fold_col: str = "impression_date",
    fold_type: str = "date",
    key_sets: Sequence[Sequence[str]] = ENCODE_KEYS,
    label: str = "is_click",
    train_flag: str = "train_set",
    id_col: str = "impression_id",
) -> DataFrame:
    """Add the mean / count / sum encodings of every key set (3 per key set).

    ``features`` should be a lineage-cut table (``cut_lineage``): every key
    set groups it again and joins the result back.
    """
    ft = fold_table(spark, folds, fold_type, fold_col)
    return oof_encode_long(features, key_sets, label, fold_col, train_flag, ft, len(folds), id_col)
