import os

import pytest
from pyspark.sql import functions as F

from spanloom.operators import products
from spanloom.stages import Stages
from spanloom.streaming import events


def test_a_stopped_run_goes_on(spark, tmp_path):
    root, data, calls = f"file://{tmp_path}/root", f"file://{tmp_path}/data", []
    spark.range(10).write.parquet(data)
    (tmp_path / "root" / "other").mkdir(parents=True)
    (tmp_path / "root" / "other" / "table-kept").write_text("not ours")

    def job(bound=5, fail=False, **how):
        stages = Stages(spark, root)

        def first():
            calls.append("first")
            return spark.read.parquet(data).where(f"id < {bound}")

        def second(of):
            calls.append("second")
            if fail:
                return of.select(F.raise_error(F.lit("killed")).cast("string").alias("x"))
            return of.select((F.col("id") * 2).alias("x"))

        a = stages.run("first", first, [data], {"bound": bound}, **how)
        b = stages.run("second", lambda: second(a), [a])
        return stages, sorted(r["x"] for r in b.collect())

    with pytest.raises(Exception, match="killed"):
        job(fail=True)
    assert calls == ["first", "second"]
    stages, got = job()
    assert got == [0, 2, 4, 6, 8] and stages.skipped == ["first"] and stages.ran == ["second"]
    assert len([p for p in (tmp_path / "root" / "second").iterdir() if p.name.startswith("table-")]) == 1  # what the stopped run left is gone
    stages, got = job()
    assert stages.skipped == ["first", "second"] and calls == ["first", "second", "second"]
    stages, got = job(bound=3)
    assert got == [0, 2, 4] and stages.ran == ["first", "second"]
    stages, got = job(bound=3, force=True)
    assert stages.ran == ["first", "second"] and job(bound=3)[0].skipped == ["first", "second"]
    spark.range(-2, 0).write.mode("append").parquet(data)
    stages, got = job(bound=3)
    assert got == [-4, -2, 0, 2, 4] and stages.ran == ["first", "second"]
    assert job(bound=3, version="2")[0].ran == ["first", "second"]
    assert (tmp_path / "root" / "other" / "table-kept").exists()
    with pytest.raises(FileNotFoundError):
        Stages(spark, root).run("third", lambda: None, [f"{data}/nothing-here"])
    with pytest.raises(ValueError):
        Stages(spark, root).run("a/b", lambda: None)


ROWS = [("a", 1, "x", 5), ("a", 2, "x", 10), ("b", 3, "y", 20), ("a", 4, "z", 30), ("b", 5, "y", 4000), ("b", 6, "x", 4100), ("a", 7, "z", 9000), ("c", 8, "x", 9100), ("a", 9, "x", 9200), ("a", 9, "x", 9200)]


@pytest.fixture
def stream(spark, tmp_path):
    """Rows of key, order, value and seconds; a few to a batch, and one far in the future that ends what is open."""
    rows = [*ROWS, ("end", 99, "end", 10**6)]
    for i in range(0, len(rows), 3):
        spark.createDataFrame(rows[i : i + 3], "k string, o long, v string, s long").select("k", "o", "v", F.timestamp_seconds("s").alias("t")).coalesce(1).write.parquet(f"file://{tmp_path}/in/batch={i}")
        for file in (tmp_path / "in" / f"batch={i}").iterdir():  # files come in the order of their times
            os.utime(file, (1_600_000_000 + i, 1_600_000_000 + i))

    def run(change):
        source = spark.readStream.schema("k string, o long, v string, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in/*")
        change(source).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").collect() if "end" not in tuple(r))

    batch = spark.createDataFrame(ROWS, "k string, o long, v string, s long").select("k", "o", "v", F.timestamp_seconds("s").alias("t"))
    return run, batch


def test_streamed_runs_equal_the_batch(stream):
    run, batch = stream
    want = products.runs(batch, ["k"], "o", "v").select("k", "v", "first", "last", "n")
    assert run(lambda s: events.tag_runs(s, "k", "o", "v", "t", idle=20_000)) == sorted(map(tuple, want.collect()))


def test_streamed_runs_end_when_idle(stream):
    """A key that was silent for long begins a new run, even of the same value, whether a timer or its next row ends the old one."""
    run, _ = stream
    got = run(lambda s: events.tag_runs(s, "k", "o", "v", "t", late="0 seconds", idle=2000))
    assert got == [("a", "x", 1, 2, 2), ("a", "x", 9, 9, 2), ("a", "z", 4, 4, 1), ("a", "z", 7, 7, 1), ("b", "x", 6, 6, 1), ("b", "y", 3, 3, 1), ("b", "y", 5, 5, 1), ("c", "x", 8, 8, 1)]


def test_streamed_sessions_equal_the_batch(stream):
    run, batch = stream
    want = events.sessions(batch, "t", "100 seconds", ["k"])
    assert run(lambda s: events.sessions(s, "t", "100 seconds", ["k"], late="1 day")) == sorted(map(tuple, want.collect()))


def test_streamed_first_of_equals(stream):
    run, batch = stream
    got = run(lambda s: events.first_of_equals(s, "t", ["k", "v"], late="10 days").select("k", "v", "o"))
    assert sorted(x[:2] for x in got) == sorted(map(tuple, batch.select("k", "v").distinct().collect()))
    assert {x for x in got if x[:2] in (("b", "y"), ("c", "x"))} == {("b", "y", 3), ("c", "x", 8)}
