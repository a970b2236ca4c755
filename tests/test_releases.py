"""Releases and baseline generations: failures between any two steps, writers at once."""

import threading

import pytest

from loanframe.sources import (
    all_releases,
    files,
    latest_release,
    load_baseline,
    publish_run,
    save_baseline,
    stage_run,
)

SNAP = "column string, value string, row_count bigint, pct double"


def _snapshot(spark, value):
    return spark.createDataFrame([("hue", value, 4, 100.0)], SNAP)


def _value(spark, path):
    found = load_baseline(spark, path)
    return None if found is None else [r.value for r in found.collect()]


@pytest.fixture(params=["true", "false"])
def markers(spark, request):
    key = "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(key.removeprefix("spark.hadoop."), request.param)
    yield request.param
    conf.unset(key.removeprefix("spark.hadoop."))


def test_baseline_does_not_need_marker_files(spark, tmp_out, markers):
    path = tmp_out("baseline")
    assert _value(spark, path) is None
    save_baseline(_snapshot(spark, "one"), path)
    assert _value(spark, path) == ["one"]
    with pytest.raises(ValueError, match="already"):
        save_baseline(_snapshot(spark, "two"), path)
    save_baseline(_snapshot(spark, "three"), path, refresh=True)
    assert _value(spark, path) == ["three"]
    # Append-only: the first generation can still be read.
    first = all_releases(spark, path)[0]
    assert [r.value for r in spark.read.parquet(first.path("snapshot")).collect()] == ["one"]


class Died(Exception):
    pass


@pytest.mark.parametrize("step", ["stage_run", "publish_run", "manifest", "appears"])
def test_a_save_that_dies_leaves_the_baseline_as_it_was(spark, tmp_out, monkeypatch, step):
    from loanframe.sources import releases as module

    path = tmp_out("baseline")

    def dies(*_a, **_k):
        raise Died

    def attempt(value, refresh):
        with monkeypatch.context() as m:
            if step == "manifest":
                m.setattr(module, "_numbers", dies)  # the manifest is written, but aside
                m.setattr(files, "load_baseline", lambda *_: None)
            elif step == "appears":
                m.setattr(module, "_appears", dies)
            else:
                m.setattr(files, step, dies)
            with pytest.raises(Died):
                save_baseline(_snapshot(spark, value), path, refresh)

    attempt("lost", False)
    assert _value(spark, path) is None
    save_baseline(_snapshot(spark, "kept"), path)
    attempt("lost", True)
    assert _value(spark, path) == ["kept"]
    save_baseline(_snapshot(spark, "newer"), path, refresh=True)
    assert _value(spark, path) == ["newer"]


@pytest.mark.parametrize("refresh", [False, True])
def test_writers_at_once(spark, tmp_out, refresh):
    path, start, got = tmp_out("baseline"), threading.Barrier(4), []

    def write(i):
        start.wait()
        try:
            save_baseline(_snapshot(spark, f"w{i}"), path, refresh)
            got.append(i)
        except ValueError as e:
            assert "already" in str(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    kept = all_releases(spark, path)
    # A first save is won by one writer; refreshes all get a number of their own.
    assert len(kept) == len(got) == (4 if refresh else 1)
    assert [r.number for r in kept] == list(range(1, len(kept) + 1))
    values = [spark.read.parquet(r.path("snapshot")).first().value for r in kept]
    assert sorted(values) == sorted(f"w{i}" for i in got)
    assert _value(spark, path) == values[-1:]


def test_a_baseline_without_generations_is_read_and_refreshed(spark, tmp_out):
    path = tmp_out("baseline")
    _snapshot(spark, "old").write.parquet(path)
    assert _value(spark, path) == ["old"]
    with pytest.raises(ValueError, match="already"):
        save_baseline(_snapshot(spark, "new"), path)
    save_baseline(_snapshot(spark, "new"), path, refresh=True)
    assert _value(spark, path) == ["new"]


def test_a_number_that_is_taken_is_not_taken_again(spark, tmp_out, monkeypatch):
    from loanframe.sources import releases as module

    root = tmp_out("root")
    assert latest_release(spark, root) is None
    one = publish_run(spark, stage_run(root), {"t": "t"}, {"n": 1})
    # This writer looked before the other one published.
    seen = iter([[], [1]])
    with monkeypatch.context() as m:
        m.setattr(module, "_numbers", lambda *_: next(seen))
        two = publish_run(spark, stage_run(root), {"t": "t"}, {"n": 2})
        seen = iter([[], [1]])
        with pytest.raises(ValueError, match="already"):
            publish_run(spark, stage_run(root), {"t": "t"}, first_only=True)
    assert (one.number, two.number) == (1, 2)
    assert [r.facts["n"] for r in all_releases(spark, root)] == [1, 2]
    assert latest_release(spark, root) == two
