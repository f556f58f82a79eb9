"""Metrics over streams of dialogues against the batch engine, with shuffled, repeated and restarted batches."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeworks.errors import PlanError
from gaugeworks.operators.metric import metric_table
from gaugeworks.plans.contracts import MetricPlan, Source
from gaugeworks.streaming import total_table
from gaugeworks.streaming.dialogues import start_dialogue_metric

SCHEMA = "g string, turn int, score string, vote string, w string, part string, at timestamp"


def rows(seed=4, n=60):
    rnd = random.Random(seed)
    out = []
    for g in range(n):
        score, w = rnd.choice(["0", "1", "0,5", None]), rnd.choice(["1", "2", None])
        for t in range(rnd.randint(1, 5)):
            shown = score if rnd.random() < 0.7 else None  # a later row may bring the value
            out.append((f"g{g}", t, "0.25" if rnd.random() < 0.05 else shown, rnd.choice(["yes", "no", ""]) if g % 7 == 0 else "yes", w, "even" if g % 2 == 0 else "odd", None))
    return out


def stream_of(spark, folder, table, files=5):
    for k in range(files):
        spark.createDataFrame(table[k::files], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def plans():
    one = Source("score")
    yes = Source("vote", normalization="value_map", value_map=(("yes", Decimal(1)), ("no", Decimal(0))))
    yield MetricPlan("m", "identity", (one,), missing_policy="exclude_unit", unit="dialogue", group="g", order="turn"), None
    yield MetricPlan("m", "mean_criteria", (one, yes), missing_policy="exclude_value", unit="dialogue", group="g", order="turn", weight="w"), ["part"]
    yield MetricPlan("m", "accuracy", (Source("score", "prediction", "label"), Source("vote", "target", "label")), missing_policy="zero", unit="dialogue", group="g", order="turn"), ["part"]


@pytest.mark.parametrize("n", range(3))
def test_stream_of_dialogues_equals_the_batch(spark, tmp_path, n):
    plan, by = list(plans())[n]
    table = rows()
    random.Random(n).shuffle(table)
    folder = f"file://{tmp_path}"
    stream = stream_of(spark, folder, table)
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        start_dialogue_metric(stream, plan, f"{folder}/sums", f"{folder}/state", by, availableNow=True).awaitTermination()
    told = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert told(total_table(spark, plan, f"{folder}/sums", by)) == told(metric_table(spark.createDataFrame(table, SCHEMA), plan, by))
    assert spark.read.parquet(f"{folder}/sums").filter("total_units < 0").count() > 0  # shares were taken back


def test_rows_that_come_after_a_restart_change_their_dialogue(spark, tmp_path):
    plan = next(plans())[0]
    folder = f"file://{tmp_path}"
    first = [("a", 0, "1", "yes", "1", "p", None), ("b", 0, None, "yes", "1", "p", None)]
    later = [("b", 1, "0", "yes", "1", "p", None), ("a", 1, "0", "yes", "1", "p", None), (None, 0, "1", "yes", "1", "p", None)]
    seen = []
    for part in (first, later):
        stream = stream_of(spark, folder, part, 1)
        start_dialogue_metric(stream, plan, f"{folder}/sums", f"{folder}/state", availableNow=True).awaitTermination()
        r = total_table(spark, plan, f"{folder}/sums").first()
        seen.append((r["total_units"], r["scored_units"], r["unsteady"], r["value"]))
    assert seen == [(2, 1, 0, 1.0), (3, 3, 1, None)]


def test_summaries_go_with_the_watermark_and_their_share_stays(spark, tmp_path):
    plan = next(plans())[0]
    folder = f"file://{tmp_path}"
    when = lambda m: __import__("datetime").datetime(2024, 1, 1, 0, m)
    parts = [[("a", 0, "1", "y", "1", "p", when(0))], [("b", 0, "0", "y", "1", "p", when(30))], [("c", 0, "0", "y", "1", "p", when(40)), ("a", 1, "0", "y", "1", "p", when(1))]]
    for part in parts:
        stream = stream_of(spark, folder, part, 1).withWatermark("at", "1 minute")
        q = start_dialogue_metric(stream, plan, f"{folder}/sums", f"{folder}/state", event_time="at", hold=60, availableNow=True)
        q.awaitTermination()
    # the late row of a is behind the watermark and left out
    r = total_table(spark, plan, f"{folder}/sums").first()
    assert (r["total_units"], r["scored_units"], r["unsteady"], round(r["value"], 6)) == (3, 3, 0, 0.333333)
    state = spark.read.format("statestore").option("path", f"{folder}/state").option("stateVarName", "summary").load()
    assert {r[0] for r in state.select(F.col("key.unit")).collect()} <= {"b", "c"}


def test_plans_that_need_no_state_are_refused(spark, tmp_path):
    plan = MetricPlan("m", "identity", (Source("score"),))
    with pytest.raises(PlanError):
        start_dialogue_metric(spark.createDataFrame([], SCHEMA), plan, f"{tmp_path}/s", f"{tmp_path}/c")
    with pytest.raises(PlanError):
        start_dialogue_metric(spark.createDataFrame([], SCHEMA), next(plans())[0], f"{tmp_path}/s", f"{tmp_path}/c", event_time="at")
