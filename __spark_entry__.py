"""

Each query reads the binding views over the given tables (``bindings.py``),
runs the engine's operators and returns a DataFrame whose column names match
the DuckDB oracle in ``oracle.py``.  Shared stages (prepared log, log
tables, impression features) are built once per session and table folder and
lineage-cut into ``spark.checkpoint.dir``; every query still covers whole
tables.  Float columns that come from sums are rounded the same way as in
the oracle (``_fr``).
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import bindings  # noqa: E402
import oracle  # noqa: E402
from clickweave.functions.dates import micros_to_seconds, parse_timestamp  # noqa: E402
from clickweave.operators.folds import fold_sizes, fold_table, kfold_assign, timeseries_split_sizes  # noqa: E402
from clickweave.operators.metrics import auc_by_group, mean_metric  # noqa: E402
from clickweave.operators.outoffold import SLOT, fold_values, oof_encode, oof_encode_long  # noqa: E402
from clickweave.plans import features as fp  # noqa: E402
from clickweave.plans.encoders import encode_features  # noqa: E402
from clickweave.plans.chain import Chain, Inputs, before_date_end, unite  # noqa: E402
from clickweave.plans.matrix import model_matrix  # noqa: E402
from clickweave.plans.model import TreeParams, average_fold_predictions, top_features  # noqa: E402
from clickweave.session import configure, cut_lineage, scratch_path, write_table  # noqa: E402
from clickweave.sources.files import (  # noqa: E402
    IMPRESSIONS,
    ITEMS,
    PREDICTIONS,
    TEST_IMPRESSIONS,
    VIEW_LOG,
    read_csv,
    scan_csv,
    write_csv,
    write_predictions,
)

STATS = ("min", "max", "mean", "std")


def _fr(c: str | Column, digits: int = 6) -> Column:
    """Rounding used for float sums in both engines (see ``oracle.fr``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(1 + 1e-12), digits)


BINDINGS = {
    "a": {"imps": "a_impressions", "log": "a_view_log", "items": "a_item_data", "log_order": bindings.A_LOG_ORDER,
          "folds": bindings.A_FOLDS, "fold": "impression_date", "fold_type": "date"},
    "b": {"imps": "b_impressions", "log": "b_view_log", "items": "b_item_data", "log_order": bindings.B_LOG_ORDER,
          "folds": bindings.B_FOLDS, "fold": "fold", "fold_type": "int"},
}


class Workbench:
    """Stages of one binding's build, memoized per session and folder."""

    _cache: dict[tuple, "Workbench"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, binding: str = "a"):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.b = BINDINGS[binding]
        self.views = bindings.register(spark, sf_dir, binding)
        self.cfg = fp.FeatureConfig(log_order=self.b["log_order"])
        self._memo: dict[str, DataFrame] = {}

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, binding: str = "a") -> "Workbench":
        key = (spark.sparkContext.applicationId, sf_dir, binding)
        if key not in cls._cache:
            cls._cache[key] = Workbench(spark, sf_dir, binding)
        return cls._cache[key]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def log(self) -> DataFrame:
        return self._once("log", lambda: fp.prepare_log(
            fp.join_items(self.views[self.b["log"]], self.views[self.b["items"]]), self.cfg))

    def log_tables(self) -> fp.LogTables:
        if "log_tables" not in self._memo:
            self._memo["log_tables"] = fp.log_features(self.log(), self.cfg, fp.compact)
        return self._memo["log_tables"]

    def imps(self) -> DataFrame:
        return self._once("imps", lambda: cut_lineage(fp.prepare_impressions(self.views[self.b["imps"]])))

    def features(self) -> DataFrame:
        return self._once("features", lambda: fp.impression_features(self.imps(), self.log_tables(), self.cfg))

    def folds(self) -> DataFrame:
        return fold_table(self.spark, self.b["folds"], self.b["fold_type"], self.b["fold"])

    def enc_user_app(self) -> DataFrame:
        return self._once("enc_user_app", lambda: cut_lineage(oof_encode(
            self.imps(), ["user_id", "app_code"], "is_click", self.b["fold"], "train_set", self.folds(),
            len(self.b["folds"])).drop("__cw_slot")))

    def encoded(self) -> DataFrame:
        return self._once("encoded", lambda: write_table(encode_features(
            self.spark, self.features(), self.b["folds"], self.b["fold"], self.b["fold_type"]), "encoded"))


def _wb(spark: SparkSession, sf_dir: str, binding: str = "a") -> Workbench:
    return Workbench.get(spark, sf_dir, binding)


def _feat(names: list[str], round_cols: tuple[str, ...] = (), binding: str = "a") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = _wb(spark, sf_dir, binding).features()
        return f.select("impression_id", *[_fr(n).alias(n) if n in round_cols else F.col(n) for n in names])
    return run


def _sec_stat_names(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in STATS]


# ---- impressions -------------------------------------------------------------

TIME_LAG_COLS = [c for k in range(1, 6) for c in (
    f"user_time_diffprev{'' if k == 1 else k}", f"user_time_diffnext{'' if k == 1 else k}", f"user_time_diff{k}")]
GAP_USER = [n for k in range(1, 6) for n in _sec_stat_names(f"user_time_diff{k}")]
COUNTS = [n for n, _ in oracle.IMP_COUNTS]
COUNT_LAG_COLS = [f"{b}_{s}" for _, b in oracle.COUNT_LAGS
                  for s in ("prev", "nxt", "diffprev", "diffnext", "prev2", "nxt2", "diffprev2", "diffnext2")]
CUMCOUNT_COLS = ["user_app_cumcount", "user_app_code_inv_cumcount", "user_app_code_cumcount_ratio",
                 "user_app_code_inv_cumcount_ratio", "user_min_cumcount", "user_min_inv_cumcount",
                 "user_min_cumcount_ratio", "user_min_inv_cumcount_ratio", "user_app_4g_cumcount",
                 "user_app_4g_inv_cumcount", "user_app_4g_cumcount_ratio", "user_app_4g_inv_cumcount_ratio"]
NUNIQUE_USER = ["user_app_unicount", "user_wk_unicount", "user_day_unicount", "user_daywk_unicount",
                "user_moe_unicount", "user_mos_unicount", "user_hr_unicount", "user_min_unicount"]
TIME_RANGE = ["user_time_min", "user_time_max", "app_code_time_min", "app_code_time_max", "user_app_code_time_min",
              "user_app_code_time_max", "user_app_over_min_timediff", "user_app_over_max_timediff"]
IMP_RATIOS = ["user_app_app_impr_cnt_r", "user_app_app_over_cnt_r", "user_app_4g_over_cnt_r", "user_app_weekbytot_r",
              "user_app_hrbytot_r", "user_app_minbytot_r", "user_app_timebytot_r"]
LOG_RATIOS = ["user_log_cnt_r", "user_device_uniq_log_r", "user_sess_uniq_log_r", "user_item_uniq_log_r",
              "user_ser_tim_uniq_log_r", "user_user_day_sess_uniq_log_r"]
DATE_PARTS = ["impression_date", "impression_timeDay", "impression_timeWeek", "impression_timeDayofweek",
              "impression_timeIs_month_end", "impression_timeIs_month_start", "impression_timeHour",
              "impression_timeMinute"]


def _std(names: list[str]) -> tuple[str, ...]:
    return tuple(n for n in names if n.endswith("_std"))


# ---- view log ----------------------------------------------------------------


def q_log_count_user(spark, sf_dir):
    return _wb(spark, sf_dir).log_tables().user.select("user_id", "user_id_cnt")


def q_log_time_lags(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    g = fp.log_gap_columns(wb.log(), wb.cfg, None)
    return g.select("row_id", *[micros_to_seconds(F.col(f"__log_d{k}")).alias(f"log_time_diff{k}") for k in range(1, 6)])


def q_log_price_lags(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    g = fp.log_gap_columns(wb.log(), wb.cfg, None)
    return g.select("row_id", *[f"user_price_diff{k}" for k in range(1, 5)])


def q_log_gap_stats_user(spark, sf_dir, binding="a"):
    names = [n for k in range(1, 6) for n in _sec_stat_names(f"user_time_diff{k}_log")]
    u = _wb(spark, sf_dir, binding).log_tables().user
    return u.select("user_id", *[_fr(n).alias(n) if n.endswith("_std") else F.col(n) for n in names])


def q_log_price_gap_stats_user(spark, sf_dir, binding="a"):
    names = [n for k in range(1, 5) for n in _sec_stat_names(f"user_price_diff{k}_log")]
    u = _wb(spark, sf_dir, binding).log_tables().user
    rounded = lambda n: n.endswith("_std") or n.endswith("_mean")
    return u.select("user_id", *[_fr(n).alias(n) if rounded(n) else F.col(n) for n in names])


def q_log_nunique_user(spark, sf_dir):
    names = ["device_uniq", "sess_uniq", "item_uniq", "ser_dat_user_uniq", "ser_wk_user_uniq",
             "ser_daywk_user_uniq", "ser_hr_user_uniq"]
    return _wb(spark, sf_dir).log_tables().user.select("user_id", *names)


def q_log_mode_user(spark, sf_dir, binding="a"):
    names = [n for _, n in oracle.MODE_COLS]
    return _wb(spark, sf_dir, binding).log_tables().user.select("user_id", *names)


def q_b_enc_user_app(spark, sf_dir):
    e = _wb(spark, sf_dir, "b").enc_user_app()
    return e.select("impression_id", *[_fr(n).alias(n) for n in ENC_NAMES.values()])


def q_log_item_join(spark, sf_dir):
    return _wb(spark, sf_dir).log().select(
        "row_id", "item_id", "item_price", "category_1", "category_2", "category_3", "product_type")


def q_factorize_device(spark, sf_dir):
    return _wb(spark, sf_dir).log().select("row_id", "device_type")


# ---- sources, filters, sets ---------------------------------------------------


def _a_imps(spark, sf_dir) -> DataFrame:
    return _wb(spark, sf_dir).views["a_impressions"]


def q_train_cutoff(spark, sf_dir):
    """Date cutoff written as a time range on the raw column, so the
    predicate reaches the parquet scan."""
    return _a_imps(spark, sf_dir).filter(before_date_end("impression_time", bindings.A_CUTOFF)).select(
        "impression_id", "impression_time", "user_id", "app_code", "is_click", "impression_date")


def q_train_test_split(spark, sf_dir):
    return _a_imps(spark, sf_dir).filter(F.col("train_set") == 1).select("impression_id", "is_click", "impression_date")


def q_union_train_test(spark, sf_dir):
    imps = _a_imps(spark, sf_dir).select("impression_id", "user_id", "impression_time", "is_click")
    after = imps.filter(~before_date_end("impression_time", bindings.A_CUTOFF)).drop("is_click")
    return unite(imps, after, bindings.A_CUTOFF).drop("impression_date")


def q_head_n(spark, sf_dir):
    imps = _a_imps(spark, sf_dir)
    return imps.orderBy(*fp.impression_order()).limit(1000).select(
        "impression_id", "user_id", "impression_time", "train_set")


def q_scan_impressions(spark, sf_dir):
    """CSV round trip: write the binding's impressions to the shared folder,
    scan them back with the declared schema (no inference)."""
    imps = _a_imps(spark, sf_dir).select(
        F.col("impression_id").cast("string").alias("impression_id"), "impression_time", "user_id", "app_code",
        "os_version", "is_4G", "is_click")
    path = scratch_path(spark, "impressions-csv")
    write_csv(imps, path)
    return read_csv(spark, path, IMPRESSIONS)


#: Faults planted in the lines of an input, by id modulo 50: a word for a time or number, a missing field, one too many.
PLANTED = 50


def _lines(df: DataFrame, id_col: str, columns: list[Column], wrong: int) -> DataFrame:
    """CSV lines with planted faults; ``wrong`` is the place of the column that holds a word."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    kind = F.pmod(F.col(id_col), F.lit(PLANTED))
    bad = [F.lit("wrong") if i == wrong else t for i, t in enumerate(texts)]
    return df.select(F.when(kind == 0, F.concat_ws(",", *bad)).when(kind == 1, F.concat_ws(",", *texts[:-1]))
                     .when(kind == 2, F.concat_ws(",", *texts, F.lit("more"))).otherwise(F.concat_ws(",", *texts)).alias("line"))


def _planted_scans(spark, sf_dir) -> dict:
    """View log and items written as lines with planted faults, scanned with their declared schemas."""
    wb = _wb(spark, sf_dir)

    def build():
        log, parts = wb.views["a_view_log"], spark.read.parquet(f"{sf_dir}/part.parquet")
        log = _lines(log, "row_id", [F.date_format("server_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                                     *[F.col(f.name) for f in VIEW_LOG.fields[1:]]], 0)
        items = _lines(parts, "p_partkey", [F.col("p_partkey"), F.col("p_retailprice"), *[F.col("p_size") % k for k in (5, 7, 11)],
                                            F.col("p_partkey") % 13], 3)
        out = {}
        for name, lines, schema in (("view_log", log, VIEW_LOG), ("items", items, ITEMS)):
            path = scratch_path(spark, f"{name}-lines")
            lines.write.text(path)
            out[name] = scan_csv(spark, path, schema, header=False)
        return out
    return wb._once("planted_scans", build)


def q_scan_view_log(spark, sf_dir):
    return _planted_scans(spark, sf_dir)["view_log"].rows


def q_scan_items(spark, sf_dir):
    return _planted_scans(spark, sf_dir)["items"].rows


def q_scan_rejects(spark, sf_dir):
    """Malformed lines per input and failed columns."""
    parts = [s.rejects.select(F.lit(n).alias("input"), "columns") for n, s in _planted_scans(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).groupBy("input", "columns").agg(F.count(F.lit(1)).alias("n"))


def q_text_timestamps(spark, sf_dir):
    """Times written as text (every third without a time of day, every tenth with slashes) parsed again."""
    imps = _a_imps(spark, sf_dir)
    text = (F.when(F.col("impression_id") % 10 == 0, F.date_format("impression_time", "yyyy/MM/dd"))
            .when(F.col("impression_id") % 3 == 0, F.date_format("impression_time", "yyyy-MM-dd"))
            .otherwise(F.date_format("impression_time", "yyyy-MM-dd HH:mm:ss")))
    return imps.select("impression_id", parse_timestamp(text).alias("parsed_time"))


def q_date_parts(spark, sf_dir):
    return _wb(spark, sf_dir).imps().select("impression_id", *DATE_PARTS)


def q_epoch_columns(spark, sf_dir):
    return _wb(spark, sf_dir).imps().select(
        "impression_id", "impression_time_ord", micros_to_seconds(F.col(fp.US)).alias("total_time_secs"))


def q_factorize_os(spark, sf_dir):
    return _wb(spark, sf_dir).imps().select("impression_id", "os_version")


# ---- encoders, folds, metrics -------------------------------------------------

ENC_NAMES = {"mean": "user_id_app_code_enc", "count": "user_id_app_code_countenc", "sum": "user_id_app_code_sumenc"}


def _enc_query(kind: str, train: bool):
    def run(spark, sf_dir):
        e = _wb(spark, sf_dir).enc_user_app()
        e = e.filter(F.col("train_set") == (1 if train else 0))
        return e.select("impression_id", _fr(ENC_NAMES[kind]).alias(ENC_NAMES[kind]))
    return run


def _enc_batch(name: str):
    keys = oracle.ENC_BATCHES[name]

    def run(spark, sf_dir):
        wb = _wb(spark, sf_dir)
        base = wb._once("imps_with_modes", lambda: cut_lineage(wb.imps().join(
            wb.log_tables().user.select("user_id", *[n for _, n in oracle.MODE_COLS]), "user_id", "left")))
        out = oof_encode_long(base, keys, "is_click", "impression_date", "train_set", wb.folds(), len(bindings.A_FOLDS),
                              "impression_id")
        cols = ["_".join(k) + s for k in keys for s in ("_enc", "_countenc", "_sumenc")]
        return out.select("impression_id", *[_fr(c).alias(c) for c in cols])
    return run


def _enc_count_batch(name: str):
    """Encodings by counted features, from the table that the model matrix is cut from."""
    cols = ["_".join(k) + s for k in oracle.ENC_COUNT_BATCHES[name] for s in ("_enc", "_countenc", "_sumenc")]

    def run(spark, sf_dir):
        return _wb(spark, sf_dir).encoded().select("impression_id", *[_fr(c).alias(c) for c in cols])
    return run


def q_fold_sizes(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    train = wb.imps().filter(F.col("train_set") == 1)
    return fold_sizes(train, "impression_date", "is_click", wb.folds())


def q_timeseries_split(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    train = wb.imps().filter(F.col("train_set") == 1)
    return timeseries_split_sizes(train, "impression_date", "is_click", wb.folds())


def q_timeseries_split_gaps(spark, sf_dir):
    """Listed folds without rows: before all rows, after them, and between."""
    wb = _wb(spark, sf_dir)
    train = wb.imps().filter((F.col("train_set") == 1) & (F.col("impression_date") != F.lit("2024-01-05").cast("date")))
    folds = fold_table(spark, [*bindings.A_FOLDS, dt.date(2023, 12, 30), dt.date(2030, 1, 1)], "date", "impression_date")
    return timeseries_split_sizes(train, "impression_date", "is_click", folds)


def _fold_auc(spark, sf_dir) -> DataFrame:
    e = _wb(spark, sf_dir).enc_user_app().filter(F.col("train_set") == 1)
    return auc_by_group(e, "is_click", "user_id_app_code_enc", ["impression_date"])


def q_auc_exact(spark, sf_dir):
    return _fold_auc(spark, sf_dir).select("impression_date", "n_pos", "n_neg", _fr("auc").alias("auc"))


def q_fold_metrics(spark, sf_dir):
    m = mean_metric(_fold_auc(spark, sf_dir))
    return m.select("n_folds", _fr("mean_auc").alias("mean_auc"))


def q_avg_fold_predictions(spark, sf_dir):
    """Per-fold test scores averaged per impression (M5).  The score of fold d
    is that fold's mean encoding of (user, app); each test row is expanded to
    its D fold slots (D = 23 listed folds, a fixed parameter)."""
    wb = _wb(spark, sf_dir)
    imps = wb.imps()
    n = len(bindings.A_FOLDS)
    keys = ["user_id", "app_code"]
    train = imps.filter(F.col("train_set") == 1)
    test = imps.filter(F.col("train_set") == 0).select("impression_id", *keys)
    per_fold = test.withColumn(SLOT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    scores = fold_values(per_fold, train, keys, "is_click", "impression_date", wb.folds(), n)
    avg = average_fold_predictions(scores, n_folds=n)
    return avg.select("impression_id", _fr("is_click").alias("is_click"))


def q_predictions_sink(spark, sf_dir):
    """Prediction sink (S3): fold-averaged test scores written as CSV to the
    shared folder and scanned back with the declared schema."""
    preds = q_avg_fold_predictions(spark, sf_dir).select(
        F.col("impression_id").cast("string").alias("impression_id"), "is_click")
    path = scratch_path(spark, "predictions-csv")
    write_predictions(preds, path)
    return read_csv(spark, path, PREDICTIONS)


def q_kfold_assign(spark, sf_dir):
    e = _wb(spark, sf_dir).imps().filter(F.col("train_set") == 1)
    return kfold_assign(e, "impression_id", 5, label="is_click").select("impression_id", "is_click", "fold")


def q_model_matrix(spark, sf_dir):
    m = model_matrix(_wb(spark, sf_dir).encoded())
    rounded = {c for c in m.columns if c.endswith(("_std", "enc")) or (c.startswith("user_price") and c.endswith("_mean"))}
    return m.select(*[_fr(c).alias(c) if c in rounded else F.col(c) for c in m.columns])


#: The registered run has the reference's settings: rate 0.02, 200 rounds without a new minimum of the loss, at most 50,000 trees.
QUERY_TREES = TreeParams()


def _chain(spark, sf_dir) -> Chain:
    """Binding A written as the four CSV inputs, and the whole run from them to the prediction file."""
    wb = _wb(spark, sf_dir)

    def build():
        imps = wb.views["a_impressions"].withColumn("impression_id", F.col("impression_id").cast("string"))
        folder = scratch_path(spark, "run")
        items = wb.views["a_item_data"]
        inputs = Inputs(*(f"{folder}/{n}-csv" for n in ("train", "test", "view-log", "items")), items_schema=items.schema)
        write_csv(imps.filter("train_set = 1").select(*IMPRESSIONS.fieldNames()), inputs.train)
        write_csv(imps.filter("train_set = 0").select(*TEST_IMPRESSIONS.fieldNames()), inputs.test)
        write_csv(wb.views["a_view_log"].select(*VIEW_LOG.fieldNames()), inputs.view_log)
        write_csv(items, inputs.items)
        chain = Chain(spark, inputs, folder, bindings.A_FOLDS, bindings.A_CUTOFF, fp.FeatureConfig(log_order=bindings.A_LOG_ORDER),
                      QUERY_TREES).run()
        chain.clear()
        return chain
    return wb._once("chain", build)


def q_gbt_fold_scores(spark, sf_dir):
    return _chain(spark, sf_dir).metrics()


def q_gbt_fold_sizes(spark, sf_dir):
    """Folds of the fitted models with their held-out rows."""
    return _chain(spark, sf_dir).metrics().select("fold_idx", "impression_date", "n_valid")


def q_model_predictions(spark, sf_dir):
    """Test scores of the fold models averaged per impression (M5), from the prediction file (S3)."""
    return _chain(spark, sf_dir).predictions()


def q_run_predictions(spark, sf_dir):
    """The run's prediction file, from four CSV inputs: every test impression once, with a probability."""
    p = _chain(spark, sf_dir).predictions()
    return p.select("impression_id", F.col("is_click").between(0, 1).alias("is_probability"))


def q_feature_importance(spark, sf_dir):
    """The importance file of the run, scanned back."""
    return _chain(spark, sf_dir).importance()


def q_top_features(spark, sf_dir):
    """The 25 features of largest gain (O3; the limit is the feature)."""
    return top_features(_chain(spark, sf_dir).importance())


# ---- registry -------------------------------------------------------------------

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "imp_time_lags": _feat(TIME_LAG_COLS),
    "imp_gap_stats_user": _feat(GAP_USER, _std(GAP_USER)),
    "imp_gap_stats_user_app": _feat(_sec_stat_names("user_app_time_diff1"), ("user_app_time_diff1_std",)),
    "imp_gap_stats_user_app_dow": _feat(_sec_stat_names("user_app_daywk_time_diff1"),
                                        ("user_app_daywk_time_diff1_std",)),
    "imp_counts": _feat(COUNTS),
    "imp_count_lags": _feat(COUNT_LAG_COLS),
    "imp_cumcounts": _feat(CUMCOUNT_COLS),
    "imp_nunique_user": _feat(NUNIQUE_USER),
    "imp_nunique_user_app": _feat(["user_app_time_unicount"]),
    "imp_time_range": _feat(TIME_RANGE),
    "imp_ratios": _feat(IMP_RATIOS),
    "log_ratios": _feat(LOG_RATIOS),
    "log_count_user": q_log_count_user,
    "log_time_lags": q_log_time_lags,
    "log_price_lags": q_log_price_lags,
    "log_gap_stats_user": q_log_gap_stats_user,
    "log_gap_stats_user_date": _feat(
        [n for k in range(1, 6) for n in _sec_stat_names(f"user_date_time_diff{k}_log")],
        tuple(f"user_date_time_diff{k}_log_std" for k in range(1, 6))),
    "log_gap_stats_user_dow": _feat(
        [n for k in range(1, 6) for n in _sec_stat_names(f"user_daywk_diff{k}_log")],
        tuple(f"user_daywk_diff{k}_log_std" for k in range(1, 6))),
    "log_price_gap_stats_user": q_log_price_gap_stats_user,
    "log_nunique_user": q_log_nunique_user,
    "log_nunique_user_date": _feat(["user_date_sess_uniq", "user_date_item_uniq"]),
    "log_nunique_user_dow": _feat(["user_daywk_sess_uniq", "user_daywk_item_uniq"]),
    "log_nunique_user_hour": _feat(["user_hr_sess_uniq", "user_hr_item_uniq"]),
    "log_mode_user": q_log_mode_user,
    "log_item_join": q_log_item_join,
    "date_parts": q_date_parts,
    "epoch_columns": q_epoch_columns,
    "factorize_os": q_factorize_os,
    "factorize_device": q_factorize_device,
    "train_cutoff": q_train_cutoff,
    "train_test_split": q_train_test_split,
    "union_train_test": q_union_train_test,
    "head_n": q_head_n,
    "scan_impressions": q_scan_impressions,
    "scan_view_log": q_scan_view_log,
    "scan_items": q_scan_items,
    "scan_rejects": q_scan_rejects,
    "text_timestamps": q_text_timestamps,
    "run_predictions": q_run_predictions,
    "gbt_fold_sizes": q_gbt_fold_sizes,
    "enc_mean_train": _enc_query("mean", True),
    "enc_mean_test": _enc_query("mean", False),
    "enc_count_train": _enc_query("count", True),
    "enc_count_test": _enc_query("count", False),
    "enc_sum_train": _enc_query("sum", True),
    "enc_sum_test": _enc_query("sum", False),
    **{name: _enc_batch(name) for name in oracle.ENC_BATCHES},
    **{name: _enc_count_batch(name) for name in oracle.ENC_COUNT_BATCHES},
    "model_matrix": q_model_matrix,
    "fold_sizes": q_fold_sizes,
    "timeseries_split": q_timeseries_split,
    "timeseries_split_gaps": q_timeseries_split_gaps,
    "auc_exact": q_auc_exact,
    "fold_metrics": q_fold_metrics,
    "avg_fold_predictions": q_avg_fold_predictions,
    "predictions_sink": q_predictions_sink,
    # binding B: day-granular times (ties broken by id), string app codes, year folds
    "b_imp_time_lags": _feat(TIME_LAG_COLS, binding="b"),
    "b_imp_gap_stats_user": _feat(GAP_USER, _std(GAP_USER), binding="b"),
    "b_imp_count_lags": _feat(COUNT_LAG_COLS, binding="b"),
    "b_imp_cumcounts": _feat(CUMCOUNT_COLS, binding="b"),
    "b_log_gap_stats_user": lambda spark, sf_dir: q_log_gap_stats_user(spark, sf_dir, "b"),
    "b_log_price_gap_stats_user": lambda spark, sf_dir: q_log_price_gap_stats_user(spark, sf_dir, "b"),
    "b_log_mode_user": lambda spark, sf_dir: q_log_mode_user(spark, sf_dir, "b"),
    "b_enc_user_app": q_b_enc_user_app,
    "kfold_assign": q_kfold_assign,
    # no SQL oracle: model fits
    "gbt_fold_scores": q_gbt_fold_scores,
    "model_predictions": q_model_predictions,
    "feature_importance": q_feature_importance,
    "top_features": q_top_features,
}


def entry(spark: SparkSession) -> DataFrame:
    return _QUERIES["imp_gap_stats_user"](spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; empty where that
    subpackage or the pipeline file is not installed.  Any other import error
    is raised."""
    try:
        import corpus_pipeline
        from clickweave.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("clickweave.llm", "corpus_pipeline"):
            raise
        return {}, {}
    sql = {**llm.ORACLE_SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**oracle.all_sql(), **_training_data()[1]}
