from __future__ import annotations

import os
import threading

import pytest

from hirelens.plans import publish as P


def _write(spark, root, n):
    run_id, path = P.new_run(root)
    spark.range(n).write.parquet(path + "/t")
    return run_id


def _read(spark, root):
    return spark.read.parquet(P.current_run(spark, root) + "/t").count()


def test_readers_follow_the_last_published_run(spark, scratch_dir):
    assert P.current_run(spark, scratch_dir) is None
    first = _write(spark, scratch_dir, 3)
    assert P.current_run(spark, scratch_dir) is None  # written, not published
    assert P.publish(spark, scratch_dir, first) == 1 and _read(spark, scratch_dir) == 3
    second = _write(spark, scratch_dir, 5)
    assert _read(spark, scratch_dir) == 3
    assert P.publish(spark, scratch_dir, second) == 2 and _read(spark, scratch_dir) == 5
    assert [r["run_id"] for r in P.published(spark, scratch_dir).collect()] == [second, first]


def test_two_writers_at_once_leave_one_order(spark, scratch_dir):
    runs = [_write(spark, scratch_dir, n) for n in (1, 2, 3, 4)]
    gate = threading.Barrier(len(runs))

    def work(run):
        gate.wait()
        P.publish(spark, scratch_dir, run)

    threads = [threading.Thread(target=work, args=(r,)) for r in runs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = [(r["version"], r["run_id"]) for r in P.published(spark, scratch_dir).collect()]
    assert sorted(r for _, r in found) == sorted(runs)  # no line was lost
    assert found == sorted(found, reverse=True)
    assert P.current_run(spark, scratch_dir) == P.run_dir(scratch_dir, found[0][1])
    assert all(P.current_run(s, scratch_dir) == P.run_dir(scratch_dir, found[0][1]) for s in (spark, spark.newSession()))


def test_a_crash_between_the_steps_shows_nothing(spark, scratch_dir, monkeypatch):
    first = _write(spark, scratch_dir, 3)
    P.publish(spark, scratch_dir, first)
    _write(spark, scratch_dir, 9)  # dies before its line
    assert _read(spark, scratch_dir) == 3
    log = os.path.join(scratch_dir, P.LOG)
    for name, half in (("half", '{"version":9,"run_id":"abc'), ("cut", '{"version":8,"run_id":"abc"}\n'), ("empty", "")):
        with open(os.path.join(log, f"part-{name}.json"), "w") as f:
            f.write(half)
    assert _read(spark, scratch_dir) == 3 and P.published(spark, scratch_dir).count() == 1
    os.makedirs(os.path.join(log, "_temporary", "0"))  # a writer that died inside Spark's commit
    with open(os.path.join(log, "_temporary", "0", "part.json"), "w") as f:
        f.write('{"version":7,"run_id":"x","whole":"x","written_ms":1}\n')
    assert _read(spark, scratch_dir) == 3


def test_sweep_keeps_what_readers_need(spark, scratch_dir):
    runs = [_write(spark, scratch_dir, n) for n in (1, 2, 3)]
    for r in runs:
        P.publish(spark, scratch_dir, r)
    dead = _write(spark, scratch_dir, 7)
    assert P.sweep(spark, scratch_dir, keep=2) == [runs[0]]
    assert sorted(os.listdir(os.path.join(scratch_dir, P.RUNS))) == sorted([runs[1], runs[2], dead])  # a job may still be writing
    assert _read(spark, scratch_dir) == 3
    later = int(os.path.getmtime(P.run_dir(scratch_dir, dead)) * 1000) + 10_000
    assert P.sweep(spark, scratch_dir, keep=2, unpublished_ms=5_000, now_ms=later) == [dead]
    with pytest.raises(ValueError):
        P.sweep(spark, scratch_dir, keep=0)
    assert P.sweep(spark, scratch_dir + "/other") == []


def test_a_failed_publication_leaves_no_files(spark, scratch_dir, monkeypatch):
    from hirelens.plans import run_marts as R
    from test_sources import test_read_hiring_tables_from_directory

    test_read_hiring_tables_from_directory(spark, scratch_dir)
    out = scratch_dir + "/out"
    first = R.run(spark, scratch_dir, out)

    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr(R, "publish", broken)
    with pytest.raises(OSError):
        R.run(spark, scratch_dir, out)
    assert R.published_marts(spark, out) == first and len(os.listdir(out + "/" + P.RUNS)) == 1
    monkeypatch.undo()
    for _ in range(3):
        last = R.run(spark, scratch_dir, out, keep=2)
    assert R.published_marts(spark, out) == last and len(os.listdir(out + "/" + P.RUNS)) == 2
