"""A log of answers: calls are counted by the client, in a folder that outlives it."""

import os
import uuid

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from millrace.operators import batch as B
from millrace.sources.staging import fresh_path


def counting(folder, fails_at=None):
    """A client that writes down every prompt it is asked, and fails at one of them while a file stands there."""
    def make():
        def client(prompts):
            if fails_at in prompts and os.path.exists(f"{folder}/fail"):
                raise ValueError("model is down")
            for p in prompts:
                with open(f"{folder}/{uuid.uuid4().hex}.asked", "w") as file:
                    file.write(p)
            return [f" {p.upper()} " for p in prompts]
        return client
    return make


def asked(folder):
    return sorted(open(f"{folder}/{n}").read() for n in os.listdir(folder) if n.endswith(".asked"))


def test_every_prompt_is_asked_once(spark, tmp_path):
    log = fresh_path(spark, "log")
    df = spark.createDataFrame([(i, f"p{i % 5}") for i in range(20)] + [(99, None)], "i int, p string").repartition(4)
    for _ in range(2):
        got = {r.i: r.a for r in B.complete_logged(df, "p", "a", log, counting(tmp_path)).collect()}
        assert got == {**{i: f"P{i % 5}" for i in range(20)}, 99: ""}
    assert asked(tmp_path) == ["", "p0", "p1", "p2", "p3", "p4"]
    more = spark.createDataFrame([(1, "p1"), (2, "new")], "i int, p string")
    assert {r.a for r in B.complete_logged(more, "p", "a", log, counting(tmp_path)).collect()} == {"P1", "NEW"}
    assert asked(tmp_path) == ["", "new", "p0", "p1", "p2", "p3", "p4"]


def test_a_job_that_failed_asks_only_what_is_open(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "PROMPTS_PER_CALL", 1)
    log = fresh_path(spark, "log")
    df = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "i int, p string").coalesce(1)
    (tmp_path / "fail").touch()
    with pytest.raises(PySparkException, match="model is down"):
        B.complete_logged(df, "p", "a", log, counting(tmp_path, "p33")).collect()
    before = asked(tmp_path)
    assert "p33" not in before
    os.remove(tmp_path / "fail")
    got = B.complete_logged(df, "p", "a", log, counting(tmp_path, "p33")).collect()
    assert len(got) == 40 and asked(tmp_path) == sorted(f"p{i}" for i in range(40))


def test_a_task_that_runs_again_does_not_repeat_calls(tmp_path, monkeypatch):
    monkeypatch.setattr(B, "PROMPTS_PER_CALL", 2)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    batch = pa.RecordBatch.from_arrays([pa.array([f"k{i}" for i in range(9)]), pa.array([f"p{i}" for i in range(9)])], ["_key", "_prompt"])
    run = B._asking(counting(tmp_path, "p6"), str(tmp_path / "log"), "job", 0, 0.0)
    (tmp_path / "fail").touch()
    with pytest.raises(ValueError):
        list(run(iter([batch])))
    assert asked(tmp_path) == [f"p{i}" for i in range(6)]
    os.remove(tmp_path / "fail")
    (out,) = run(iter([batch]))
    assert out.column("_answer").to_pylist() == [f"P{i}" for i in range(9)] and asked(tmp_path) == [f"p{i}" for i in range(9)]
    # an unfinished file of a call is no answer
    (tmp_path / "log/job/3/x.open").write_text("half")
    assert len(B.TaskLog(str(tmp_path / "log"), "job/3").answers()) == 9
