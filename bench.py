"""Bench: headline stages on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Stages (each forced to completion with a count, so every row is built):

* features_a  - full base-feature table, binding A (E1)
* encode_a    - 93 out-of-fold encodings over it (E2, 31 key sets)
* auc_a       - exact per-fold AUC of one encoding
* features_b  - full base-feature table, binding B (day-granular ties,
                10x log rows)
* gbt_a       - boosted trees on 2 held-out folds (E3), tree counts by the rule of the registered run
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

import bindings  # noqa: E402
from clickweave.operators.metrics import auc_by_group  # noqa: E402
from clickweave.plans import features as fp  # noqa: E402
from clickweave.plans.encoders import encode_features  # noqa: E402
from clickweave.plans.matrix import feature_names, model_matrix  # noqa: E402
from clickweave.plans.model import TreeParams, run_folds  # noqa: E402
from clickweave.session import local_session, write_table  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    stages = os.environ.get("BENCH_STAGES", "features_a,encode_a,auc_a,features_b,gbt_a").split(",")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="clickweave-bench")
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        # stages are independent: release caches, and let the JVM collect
        # finished plans so the context cleaner frees their shuffle and
        # broadcast state before the next stage
        spark.catalog.clearCache()
        spark.sparkContext._jvm.System.gc()
        return out

    views = bindings.register(spark, sf_dir, "b")
    cfg_a = fp.FeatureConfig(log_order=bindings.A_LOG_ORDER)
    cfg_b = fp.FeatureConfig(log_order=bindings.B_LOG_ORDER)

    feats_a = None
    if {"features_a", "encode_a", "auc_a", "gbt_a"} & set(stages):
        def build_a():
            f = fp.build_features(views["a_impressions"], views["a_view_log"], views["a_item_data"], cfg_a)
            rows["features_a"] = f.count()
            return f
        feats_a = timed("features_a", build_a)
    enc_a = None
    if {"encode_a", "auc_a", "gbt_a"} & set(stages):
        def enc():
            e = write_table(encode_features(spark, feats_a, bindings.A_FOLDS), "bench-encoded")
            rows["encode_a"] = e.count()
            return e
        enc_a = timed("encode_a", enc)
    if "auc_a" in stages:
        def auc():
            train = enc_a.filter(F.col("train_set") == 1)
            r = auc_by_group(train, "is_click", "user_id_app_code_enc", ["impression_date"]).collect()
            rows["auc_a"] = len(r)
        timed("auc_a", auc)
    if "features_b" in stages:
        def build_b():
            f = fp.build_features(views["b_impressions"], views["b_view_log"], views["b_item_data"], cfg_b)
            rows["features_b"] = f.count()
        timed("features_b", build_b)
    if "gbt_a" in stages:
        def gbt():
            run = run_folds(spark, model_matrix(enc_a), feature_names(), bindings.A_FOLDS[-2:],
                            params=TreeParams(step=0.3, patience=2, first_round=4), parallelism=2)
            rows["gbt_a"] = len(run.metrics.collect())
        timed("gbt_a", gbt)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_sec", "value": total, "unit": "sec", "queries": times,
                      "rows": rows, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
