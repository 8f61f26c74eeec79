"""Global ranks and first-seen codes without a single task."""
import random

from pyspark.sql import functions as F

from clickweave.operators.dictionary import encode_first_seen, first_seen_codes, global_rank
from clickweave.session import checkpoint_root


def _windows(df):
    """Partition keys of every window node of the optimized plan."""
    out, stack = [], [df._jdf.queryExecution().optimizedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "Window":
            out.append(node.partitionSpec().size())
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_codes_follow_the_first_rows(spark):
    r = random.Random(3)
    rows = [(i, r.choice([f"v{r.randint(0, 400)}", None])) for i in range(3000)]
    want = {}
    for _, v in rows:
        if v is not None:
            want.setdefault(v, len(want))
    df = spark.createDataFrame(rows, "i int, v string").repartition(7)
    codes = first_seen_codes(df, "v", [F.col("i")])
    assert {x.v: x.code for x in codes.collect()} == want
    assert dict(codes.dtypes)["code"] == "int"
    coded = {x.i: x.v for x in encode_first_seen(df, "v", [F.col("i")]).collect()}
    assert coded == {i: -1 if v is None else want[v] for i, v in rows}


def test_rank_has_no_unpartitioned_window_and_takes_ties_by_the_order(spark):
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("k"), "id")
    ranked = global_rank(df, [F.col("k"), F.col("id")], "rank")
    assert _windows(ranked) and all(_windows(ranked))
    got = [(x.k, x.id) for x in ranked.orderBy("rank").collect()]
    assert got == sorted((x.k, x.id) for x in df.collect())
    assert sorted(x.rank for x in ranked.collect()) == list(range(1000))
    assert global_rank(df.limit(0), [F.col("id")], "rank").collect() == []


def test_a_session_without_a_checkpoint_folder_gets_one(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId, folder = "local[2]", "app-without-folder", None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    session = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    root = checkpoint_root(session)
    assert root and checkpoint_root(session) == root == session.sparkContext.folder
