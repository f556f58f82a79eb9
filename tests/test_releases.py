"""Releases that are whole or absent, whatever dies when; digest trees that find what changed."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.sources import releases, sinks


def table(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("t"), "id").alias("t"))


def publish(spark, folder, n, **options):
    draft = releases.Releases(spark, folder, **options).begin()
    draft.put_table("rows", table(spark, n))
    draft.put_json("report.json", {"n": n})
    draft.put_workbook("rows.xlsx", draft.table("rows"), "rows")
    return draft.commit()


class Died(Exception):
    pass


def test_death_at_any_write_leaves_the_earlier_release(spark, tmp_path, monkeypatch):
    (tmp_path / "out").mkdir()
    (tmp_path / "out/theirs.txt").write_text("keep")
    folder = str(tmp_path / "out")
    first = publish(spark, folder, 3)
    steps = []
    for owner, name in ((releases._Files, "create"), (releases._Files, "writer"), (releases, "write_table"), (releases._Files, "delete")):
        real = getattr(owner, name)

        def step(*a, real=real, **k):
            steps.append(1)
            if len(steps) == fatal:
                raise Died
            out = real(*a, **k)
            if len(steps) == -fatal:  # after the write
                raise Died
            return out

        monkeypatch.setattr(owner, name, step)
    fatal, deaths, done = 1, 0, False
    while not done:
        for sign in (1, -1):
            steps.clear()
            fatal = sign * abs(fatal)
            before = releases.Releases(spark, folder).current()
            try:
                now = publish(spark, folder, 5, grace=0)
                done = True
            except (Died, releases.ReleaseError):
                deaths += 1
                now = None
            fatal_, fatal = fatal, 0
            left = releases.Releases(spark, folder, grace=0)
            current = left.current()
            assert left.verify(current) == [] and current.number in (before.number, before.number + 1)
            assert current.table(spark, "rows").count() == (3 if current.number == first.number else 5)
            assert now is None or current == now
            fatal = fatal_
        fatal = abs(fatal) + 1
    assert deaths >= 8
    fatal = 0
    left.recover()
    assert len(left.files.names("runs")) == len(left.files.names("pointers")) == 1 and (tmp_path / "out/theirs.txt").read_text() == "keep"


def test_pointers_that_are_cut_short_and_writers_that_meet(spark, tmp_path):
    folder = str(tmp_path)
    one = publish(spark, folder, 2)
    store = releases.Releases(spark, folder)
    store.files.create("pointers/0000000002.json", b'{"run": "gone", "manif')  # whole on no such file system
    assert store.current() == one
    assert publish(spark, folder, 4).number == 3 and store.current().number == 3
    a, b = store.begin(), store.begin()
    for d in (a, b):
        d.put_json("x.json", d.run)
    store._numbers = lambda numbers=store._numbers(): numbers  # both look before either writes
    a.commit()
    with pytest.raises(releases.ReleaseError):
        b.commit()
    del store._numbers
    assert store.current().manifest["run"] == a.run


def test_verify_names_what_changed(spark, tmp_path):
    r = publish(spark, str(tmp_path), 4)
    store = releases.Releases(spark, str(tmp_path))
    path = r.path.removeprefix("file:")
    with open(f"{path}/report.json", "r+b") as f:
        f.write(b"[")
    assert store.verify(r) == ["report.json"]
    with open(f"{path}/extra", "wb") as f:
        f.write(b"x")
    assert store.verify(r) == ["extra", "report.json"]
    assert store.files.digest("runs/" + r.manifest["run"] + "/rows.xlsx") == r.manifest["files"]["rows.xlsx"]


def leaf(v):
    return "n" if v is None else f"v{len(str(v).encode())}:{v}"


def tree(values, fan):
    level = [leaf(v) for v in values]
    while True:
        level = [hashlib.sha256("\x1f".join(level[i:i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
        if len(level) == 1:
            return level[0]


def test_digest_is_the_root_of_a_tree(spark):
    for n in (1, 4, 5, 70):
        values = [None if i % 7 == 3 else "" if i % 5 == 0 else f"é{i}" for i in range(n)]
        df = spark.createDataFrame([(i, v, i * 2) for i, v in enumerate(values)], "n long, t string, x long").repartition(3)
        got = dict(sinks.frame_digest(df, "n", fan_out=4).collect())
        assert got == {"t": tree(values, 4), "x": tree([i * 2 for i in range(n)], 4)}


def test_difference_finds_the_changed_cells(spark):
    df = table(spark, 300).withColumn("n", F.col("id"))
    changed = df.withColumn("t", F.when(F.col("n") == 137, None).otherwise(F.col("t"))).withColumn("id", F.when(F.col("n").isin(5, 299), F.lit(-1)).otherwise(F.col("id")))
    found = lambda a, b: sorted(map(tuple, sinks.frame_difference(a, b, "n", fan_out=8).collect()))
    assert found(df, changed) == [("id", 0, 7), ("id", 296, 303), ("t", 136, 143)]
    assert found(df, df.repartition(4)) == []
    assert found(df, df.filter("n < 290")) == [(c, *r) for c in ("id", "t") for r in ((288, 295), (296, 303))]
    assert found(df.filter("n < 7"), df.filter("n < 9")) == [(c, *r) for c in ("id", "t") for r in ((0, 7), (8, 15))]
