"""Scalars, grouping, canonical rows, checks, publishing and profiles."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeworks.errors import LayoutError
from gaugeworks.functions import scalars as S
from gaugeworks.operators import grouping, ordering, profile, publish, reconcile, validate
from gaugeworks.operators.canon import build_canon, drop_blank_questions, id_flags
from gaugeworks.operators.metric import with_scores
from gaugeworks.plans.contracts import MetricPlan, Source
from gaugeworks.plans.layout import Cell, LayoutPlan, raw_names


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_scalar_rules(spark):
    assert column(spark, [None, "", "  \t", "x"], S.blank) == [True, True, True, False]
    assert column(spark, [" A  b ", "Ёж"], S.normalize_key) == ["a b", "еж"]
    assert column(spark, ["Оценка: Ёж!", "--", "A b"], S.slug) == ["оценка_еж", "metric", "a_b"]
    assert column(spark, ["abcdef", "abc"], lambda c: S.cap(c, 4)) == ["abc…", "abc"]
    assert column(spark, ["1 234,5", "97%", "x", "", "1e2"], S.parse_number) == [Decimal("1234.5"), Decimal("0.97"), None, None, Decimal(100)]
    assert column(spark, ["1", "x", "", "0.1234567890123"], S.bad_number) == [False, True, False, True]
    assert column(spark, ["1,5%", "nan", "-inf", "a", "1 000"], S.is_numeric) == [True, True, True, False, True]
    assert column(spark, ["3%", "inf", "x", "2,5"], S.coerce_numeric) == [0.03, None, None, 2.5]
    found = column(spark, ["from 1 234,5 % to -7 and 3.25", "none"], S.numbers)
    assert [(r["value"], r["percent"]) for r in found[0]] == [(Decimal("1234.5"), True), (Decimal(-7), False), (Decimal("3.25"), False)] and found[1] == []
    for text, target, scale in [("0.9736", "97.36", "percent"), ("97%", "0.97", "ratio"), ("97 %", "97", "percent"), ("97", "0.97", "ratio"), ("5", "5", "raw")]:
        t = Decimal(target)
        assert column(spark, [text], lambda c: S.span_has_value(c, t, scale)) == [S.has_value(text, t, scale)]
    assert S.percent_value("0,98", Decimal("0.98")) == 98 and S.percent_value("98%", Decimal(98)) == 98 and S.percent_value("7", Decimal(3)) is None
    assert [S.column_letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"] and S.column_index("AAA") == 702


def test_ordered_work_in_buckets(spark):
    rnd = random.Random(1)
    rows = [(i * 3, rnd.choice([None, None, "a", "b"])) for i in range(60)]
    df = spark.createDataFrame(rows, "o long, v string").repartition(3)
    got = {r["o"]: (r["f"], r["n"]) for r in ordering.number_rows(ordering.forward_fill(df, "v", "o", "f", bucket=7), "o", "n", bucket=7).collect()}
    last = None
    for n, (o, v) in enumerate(rows):
        last = v or last
        assert got[o] == (last, n)


def union_find(ranges):
    points = sorted({p for a, b in ranges for p in range(a, b + 1)})
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in ranges:
        for p in range(a, b + 1):
            x, y = find(a), find(p)
            root[max(x, y)] = min(x, y)
    out = {}
    for p in points:
        out.setdefault(find(p), []).append(p)
    return sorted((min(v), max(v)) for v in out.values())


def test_islands_are_components_of_ranges(spark):
    rnd = random.Random(4)
    for _ in range(3):
        ranges = [(a, a + rnd.randint(0, 6)) for a in (rnd.randint(0, 60) for _ in range(14))]
        got = grouping.merge_islands(spark.createDataFrame(ranges, "r1 long, r2 long")).collect()
        assert sorted(map(tuple, got)) == union_find(ranges)


def test_islands_carry_over_buckets_and_partitions(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(s, a, a + rnd.choice([0, 1, 5, 90, -3])) for s in ("x", "y", None) for a in (rnd.randint(-200, 200) for _ in range(40))]
    monkeypatch.setattr(ordering.carried, "__defaults__", (*ordering.carried.__defaults__[:2], 4, 3))
    df = spark.createDataFrame(rows, "sheet string, r1 long, r2 long")
    got = grouping.merge_islands(df.filter("sheet is not null"), partition=("sheet",)).collect()
    for s in ("x", "y"):
        assert sorted((r["r1"], r["r2"]) for r in got if r["sheet"] == s) == union_find([(a, b) for n, a, b in rows if n == s and a <= b])
    assert grouping.merge_islands(df.filter("r1 > 1000")).collect() == []
    plan = grouping.merge_islands(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("bucket", [1, 4, 30, 1000])
def test_islands_of_partitions_cut_anywhere(spark, bucket):
    rnd = random.Random(bucket)
    rows = [(s, n, a, a + rnd.choice([0, 1, 2, 15, most, -3])) for s, n, most in (("x", 1, 90), ("x", None, 3), (None, 1, 6), (None, None, 90)) for a in (rnd.randint(-300, 300) for _ in range(40))]
    rows += [("few", 1, 5, 9), ("few", 1, 9, 10), ("few", 1, -700, -650), ("one", 1, -9, 900), ("one", 1, 3, 4), (None, 2, 5, 1), ("null", 1, None, 4), ("null", 1, 4, None)]
    df = spark.createDataFrame(rows, "sheet string, part int, r1 long, r2 long")
    got = [tuple(r) for r in grouping.merge_islands(df, partition=("sheet", "part"), bucket=bucket).collect()]
    valid = [r for r in rows if None not in r[2:] and r[2] <= r[3]]
    assert {r[:2] for r in got} == {r[:2] for r in valid}
    for key in {r[:2] for r in valid}:
        assert sorted(r[2:] for r in got if r[:2] == key) == union_find([r[2:] for r in valid if r[:2] == key])
    whole = grouping.merge_islands(df, bucket=bucket)
    assert sorted(map(tuple, whole.collect())) == union_find([r[2:] for r in valid])


def rows_shuffled(plan):
    """Rows that a query's final plan has written to shuffles."""
    name = plan.nodeName()
    if name == "ReusedExchange":
        return 0
    if name == "AdaptiveSparkPlan":
        return rows_shuffled(plan.executedPlan())
    if name.endswith("QueryStage"):
        return rows_shuffled(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    children = plan.children()
    return own + sum(rows_shuffled(children.apply(i)) for i in range(children.size()))


def test_islands_shuffle_ranges_twice_however_far_apart(spark):
    for apart in (7, 50_000, 10_000_000):
        df = spark.range(3000).select((F.col("id") % 3).alias("sheet"), (F.col("id") * apart).alias("r1"), (F.col("id") * apart + 5).alias("r2"))
        got = grouping.merge_islands(df, partition=("sheet",))
        assert len(got.collect()) == 3000
        assert rows_shuffled(got._jdf.queryExecution().executedPlan()) <= 2 * 3000 + 300


def test_carried_sums_and_maxima(spark):
    rnd = random.Random(2)
    keys = rnd.sample(range(-300, 300), 80)
    rows = [(k, rnd.choice([None, rnd.randint(0, 9)])) for k in keys]
    df = spark.createDataFrame(rows, "k long, v long")
    for combine, plain in ((F.sum, sum), (F.max, max)):
        got = {r["k"]: r["o"] for r in ordering.carried(df, "k", "v", "o", combine, bucket=5).collect()}
        for k in keys:
            before = [v for j, v in rows if j < k and v is not None]
            assert got[k] == (plain(before) if before else None)


def sheet(spark, rows):
    return spark.createDataFrame([(i + 2, *r) for i, r in enumerate(rows)], "source_row_id long, k string, q string")


def test_column_groups_inherit_and_meet_again(spark):
    got = grouping.group_by_column(sheet(spark, [("a", "1"), (" ", "2"), ("b", "3"), (" a ", "4")]), "k")
    got = grouping.with_turn_index(got).orderBy("source_row_id").collect()
    assert [(r["group_index"], r["turn_index"]) for r in got] == [(0, 1), (0, 2), (1, 1), (0, 3)]
    with pytest.raises(LayoutError):
        grouping.group_by_column(sheet(spark, [(None, "1"), ("b", "2")]), "k")


def test_merged_groups_fill_nulls(spark):
    df = sheet(spark, [("a", "1"), (None, "2"), (None, None), ("b", ""), ("c", "5")])
    merges = spark.createDataFrame([(2, 0, 4, 0), (4, 1, 5, 1), (1, 0, 1, 1)], "r1 int, c1 int, r2 int, c2 int")
    got = grouping.group_by_merges(df, merges, {0: "k", 1: "q"}).orderBy("source_row_id").collect()
    assert [r["group_index"] for r in got] == [0, 0, 0, 0, 1]
    assert [r["k"] for r in got] == ["a", "a", "a", "b", "c"] and [r["q"] for r in got] == ["1", "2", None, "", "5"]


@pytest.mark.parametrize("cell,container,expected", [
    ("Q: x A: y", "plain_text", [(None, "x", "y")]), ("__Q : x__ A: ", "plain_text", [(None, "x", None)]), ("Q: x A: y Q: z", "plain_text", []),
    ("pre Q: x A: y", "plain_text", []), ("A: x Q: y", "plain_text", []), ("Q:  A: y", "plain_text", []), ("['Q: a b', 'A:  c ']", "python_list", [(None, "a b", " c ")]),
    ("['Q: it's', 'A: ok']", "python_list", [(None, "it's", "ok")]), ("[('1', 'q', None), (2, 'w', 'e')]", "plain_text", [("1", "q", None), ("2", "w", "e")]), ("[('1', '', 'x')]", "plain_text", []),
])
def test_cells_of_dialogue(cell, container, expected):
    literal = grouping.literal_turns(cell)
    got = literal if literal is not None else [(None, q, a) for q, a in grouping.MarkerSplit("Q", "A", container).turns(cell)]
    assert got == expected


def test_unrolled_rows(spark):
    got = grouping.unroll_cell(sheet(spark, [("", "Q: a A: b Q: c A: d"), ("", "[('x', 'y', 'z')]")]), "q", "Q", "A").orderBy("source_row_id", "blob_turn").collect()
    assert [(r["query_id_override"], r["blob_question"], r["blob_answer"], r["group_index"]) for r in got] == [("row-2-t1", "a", "b", 0), ("row-2-t2", "c", "d", 0), ("x", "y", "z", 1)]
    with pytest.raises(LayoutError) as e:
        grouping.unroll_cell(sheet(spark, [("", None), ("", "Q: a A: b")]), "q", "Q", "A")
    assert e.value.details["invalid_count"] == 1


def table(spark):
    rows = [(2, "1", "s1", "q1", "a1", None, 2.0, "1"), (3, "2", "s1", "q2", " ", "b2", 1.0, "0"), (4, "1", "s2", "q3", "a3", "b3", 1.0, "1")]
    return spark.createDataFrame(rows, "source_row_id long, id string, sess string, ask string, ans string, ans2 string, w double, mark string")


def test_canonical_identity_weights_and_names(spark):
    canon, account = build_canon(table(spark), LayoutPlan("ask", ("ans", "ans2"), query_id="id", session_id="sess", weight="w"))
    got = canon.orderBy("source_row_id").collect()
    assert [(r["query_id"], r["session_id"], r["input_query_count"], r["output_answer"]) for r in got] == [("1", "s1", 2, "a1"), ("2", "s1", 1, "b2"), ("1", "s2", 1, "a3")]
    assert account["query_id"] == "column"
    canon, account = build_canon(table(spark), LayoutPlan("ask", ("ans",), query_id="id"))
    assert [r["query_id"] for r in canon.orderBy("source_row_id").collect()] == ["row-0", "row-1", "row-2"] and account["query_id"] == "made"
    with pytest.raises(LayoutError):
        build_canon(table(spark).withColumn("w", F.lit(0.5)), LayoutPlan("ask", ("ans",), weight="w"))
    with pytest.raises(LayoutError):
        build_canon(table(spark).withColumn("sess", F.lit(" ")), LayoutPlan("ask", ("ans",), session_id="sess"))
    assert raw_names(["query_id", "x", "query_id__raw"]) == {"query_id": "query_id__raw", "x": "x", "query_id__raw": "query_id__raw__raw"}
    assert not id_flags(table(spark).withColumn("big", F.lit(2.0**60)), "big")["renders"]


def test_violations(spark):
    canon, _ = build_canon(table(spark), LayoutPlan("ask", ("ans",), grouping="column", group_column="sess"))
    assert validate.violations(canon) == []
    broken = canon.withColumn("input_query", F.when(F.col("source_row_id") == 3, " ").otherwise(F.col("input_query"))).withColumn("query_id", F.lit("x")).withColumn("turn_index", F.col("turn_index") + 1)
    assert {(v["check"], v["column"], v["count"]) for v in validate.violations(broken.withColumn("a_metric", F.lit(float("nan"))))} == {
        ("blank", "input_query", 1), ("duplicate_id", "query_id", 1), ("turn_index", "turn_index", 2), ("metric_not_finite", "a_metric", 3)}
    assert validate.violations(canon.drop("turn_index"))[-1]["check"] == "group_without_turn"
    assert validate.violations(canon.drop("query_id"))[0]["check"] == "missing_column"
    assert validate.blank_answers(canon, ["ans2", "ask", "ans"]) == {"count": 1, "fallbacks": ["ans2", "ask"]}
    kept, gone = drop_blank_questions(broken)
    assert kept.count() == 2 and [r[0] for r in gone.collect()] == [3]
    cells = sheet(spark, [("k", "USER: a BOT: b"), ("k", "USER: c BOT: d")])
    assert validate.dialogue_columns(cells, ["k", "q"]) == [{"column": "q", "question_marker": "USER", "answer_marker": "BOT"}]
    assert not validate.repeated_in_groups(cells, "k", "q") and validate.repeated_in_groups(cells.withColumn("q", F.lit("x")), "k", "q")


def test_published_tables(spark):
    ids = dict(zip("ABCDEFG", ("id", "sess", "ask", "ans", "ans2", "w", "mark")))
    layout = LayoutPlan("ask", ("ans", "ans2"), query_id="id", grouping="column", group_column="sess", weight="w", scenario=None, column_ids=ids)
    canon, _ = build_canon(table(spark), layout)
    plan = MetricPlan("m", "identity", (Source("mark", column_id="G"),), assessment_mode="turn_with_history")
    flat = publish.publish(with_scores(canon, plan), layout, plan)
    assert flat.variant == "flat" and flat.frame.columns == ["session_id", "query_id", "input_query_count", "input_query", "output_answer", "mark_metric", "main_metric"]
    assert [r["session_id"] for r in flat.frame.orderBy("input_query").collect()] == ["s1", "s1", "s2"]
    plan = MetricPlan("m", "identity", (Source("mark", column_id="G"),), assessment_mode="dialogue", reported_value=Decimal("0.5"))
    d = publish.publish(with_scores(canon, plan), layout, plan)
    assert d.variant == "dialogue" and d.dropped == ("main_metric", "mark_metric") and d.frame.columns == ["session_id", "dialogue"]
    rows = d.frame.collect()
    assert [tuple(t) for t in rows[0]["dialogue"]] == [("1", "q1", "a1"), ("2", "q2", "b2")]
    assert d.frame.select(publish.dialogue_literal(F.col("dialogue"))).first()[0] == "[('1', 'q1', 'a1'), ('2', 'q2', 'b2')]"
    report = {"status": "computed", "recomputed_value": 1.0, "reconciliation": {}, "threshold_verdict": None}
    assert publish.monitoring_contract(d, plan, report)["sources"][0]["column"] == "mark_metric"
    assert publish.monitoring_contract(d, None, None)["status"] == "not_computable"


def test_profiles_and_candidates(spark):
    df = table(spark)
    got = {r["column_name"]: r for r in profile.profile_columns(df, ["id", "ask", "w", "ans2"], "source_row_id").collect()}
    assert (got["id"]["non_null"], got["id"]["numeric"], got["id"]["distinct_values"]) == (3, 3, 2) and got["ans2"]["non_null"] == 2
    assert [tuple(v) for v in got["id"]["values"]] == [("1", 2), ("2", 1)] and got["ask"]["first_value"] == "q1"
    assert profile.samples(df, ["ans"], "source_row_id") == {"ans": ["a1", "a3"]}
    c = reconcile.identity_candidates(df, ["mark", "ask"], weight="w", group="sess")
    got = {(r["column_name"], r["assessment_mode"], r["reducer"]): round(r["value"], 6) for r in c.collect()}
    assert got == {("mark", "qa", "mean"): 0.666667, ("mark", "qa", "frequency_weighted_mean"): 0.75, ("mark", "dialogue", "mean"): 1.0, ("mark", "dialogue", "frequency_weighted_mean"): 1.0}
    assert [r["reducer"] for r in reconcile.matching_plans(c, Decimal("0.75"), Decimal("0.01")).collect()] == ["frequency_weighted_mean"]


def test_column_evidence_is_bounded_and_whole(spark):
    # 30 values are listed, 31 aren't, whether a task sees them all or few; long texts and numbers are whole
    rows = [(i, str(i % 30), str(i % 31), f"v{i}", "x" * 500 if i % 2 else None, " \t" if i else "1,5 %") for i in range(2000)]
    df = spark.createDataFrame(rows, "n long, a string, b string, c string, d string, e string")
    for parts in (df.coalesce(1), df.repartition(7), df.repartition(150)):
        got = {r["column_name"]: r for r in profile.profile_columns(parts, ["a", "b", "c", "d", "e"], "n", distinct=False).collect()}
        assert [(v["value"], v["n"]) for v in got["a"]["values"]] == [(str(i), 67 if i < 20 else 66) for i in range(30)]
        assert got["b"]["values"] is None and got["c"]["values"] is None and got["c"]["samples"] == ["v0", "v1", "v2"]
        assert (got["d"]["non_null"], got["d"]["numeric"]) == (1000, 0) and got["d"]["samples"] == ["x" * 199 + "…"] * 3
        assert got["d"]["values"][0]["value"] == "x" * 500 and (got["e"]["non_null"], got["e"]["numeric"]) == (1, 1)
    assert profile.profile_columns(df.filter("n < 0"), ["a", "e"], "n").collect() == []
    # what a task sends doesn't grow with the values
    cells = df.repartition(4).select(F.lit("c").alias("key"), F.col("n").alias("row"), F.col("c").alias("value"))
    sent = sum(len(f) for part in range(4) for f in profile._tally(iter([cells.filter(F.col("row") % 4 == part).withColumn("is_number", F.lit(False)).toPandas()])))
    assert sent <= 4 * (1 + profile.SAMPLES)


def test_candidates_take_one_row_a_task(spark):
    df = spark.createDataFrame([(i, "g" if i % 2 else None, "nan" if i % 3 == 0 else str(i), i % 4 == 0, "nan" if i == 1 else "2") for i in range(12)], "source_row_id long, g string, x string, y boolean, w string")
    found = reconcile.identity_candidates(df, ["x", "y"], weight="w", group="g")
    got = {(r["column_name"], r["assessment_mode"], r["reducer"]): round(r["value"], 6) for r in found.collect()}
    xs = [i for i in range(12) if i % 3]
    assert got[("x", "qa", "mean")] == round(sum(xs) / len(xs), 6) and got[("x", "qa", "frequency_weighted_mean")] == round((sum(xs) - 1) / 7, 6)
    assert got[("y", "qa", "mean")] == 0.25 and got[("x", "dialogue", "mean")] == 1.5 and got[("y", "dialogue", "mean")] == 0.5
    assert got[("x", "dialogue", "frequency_weighted_mean")] == 1.5  # a group's first weight that is a number
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Aggregate"), plan.count("Generate"), plan.count("Expand")) == (3, 2, 0)  # sums of all columns in a row, then a row a mean


@pytest.mark.parametrize("container", ["plain_text", "python_list"])
def test_marked_text_needs_no_python(spark, container):
    rng, pieces = random.Random(7), ["Q:", "A:", "Q :", "__A\x1c:", "_", " ", "\n", "\t", "\xa0", "\x85", "\x1f", "q", "й", "x.y", "Q", ":", "'", ""]
    cells = [None, "", "Q:", "Q: A:", "Q: a A:", "Q: a A: b", "A: a Q: b", " _\nQ: a A: b__\n"] + ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(1500)]
    cells += ["".join(f"{rng.choice(['', '_', ' ', chr(0xa0)])}Q: {rng.choice('abc _')}{rng.choice(pieces[3:])} A:{rng.choice('ab _')}" for _ in range(rng.randint(1, 4))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(cells)), "source_row_id long, cell string")
    got = {r["source_row_id"]: [(t["question"], t["answer"]) for t in r["turns"]] for r in grouping.marked_turns(df, "cell", "Q", "A", container, "turns").collect()}
    split = grouping.MarkerSplit("Q", "A", container)
    want = {i: [] if c is None else split.turns(c) for i, c in enumerate(cells)}
    assert got == want and sum(map(bool, want.values())) > 300
    whole = df.filter(F.col("source_row_id").isin([i for i, t in want.items() if t]))
    out = grouping.unroll_cell(whole, "cell", "Q", "A", container)
    assert out.count() == sum(map(len, want.values()))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_literals_beside_marked_text(spark):
    rows = [(1, "Q: a A: b"), (2, "\n[('x', 'y', None)]"), (3, "(['7', 'u', 'v'],)"), (4, "[Q: c A: d"), (5, "# c\n[('x', 'y', 'z')]")]
    df = spark.createDataFrame(rows, "source_row_id long, cell string")
    good = grouping.unroll_cell(df.filter("source_row_id <> 4"), "cell", "Q", "A").orderBy("source_row_id").collect()
    assert [(r["query_id_override"], r["blob_question"], r["blob_answer"]) for r in good] == [("row-1-t1", "a", "b"), ("x", "y", None), ("7", "u", "v"), ("x", "y", "z")]
    with pytest.raises(LayoutError) as caught:
        grouping.unroll_cell(df, "cell", "Q", "A")
    assert "4" in str(caught.value.__dict__) + str(caught.value)
    assert grouping.unroll_cell(df.filter("source_row_id > 9"), "cell", "Q", "A").count() == 0
