"""Atomic runs, streams with state, numbered lines: what a stop or a restart leaves behind."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from noticemill.operators import diff, merge
from noticemill.plans import refresh
from noticemill.sinks import runs, store
from noticemill.sources import lines
from noticemill.streaming import changes, windows

from .test_operators import notices


class Stop(Exception):
    """The machine goes away here."""


def run_all(spark, folder, rows, run_id, stop_at=None):
    """One run whose writes are counted; stops before write number ``stop_at``."""
    done = 0

    def step():
        nonlocal done
        if done == stop_at:
            raise Stop
        done += 1

    base = runs.head(spark, folder)
    before = next((r for r in runs.ids(spark, folder) if r < run_id), None)
    baseline = store.read_snapshot(spark, folder, before) if before else None
    entry = diff.change_entry(rows, baseline, f"at {run_id}", store.FIELDS)
    tables = {"records": rows.select(*store.FIELDS, "ord"), "totals": store.payload(rows, "t"), "changes": entry}
    attempt = f"{run_id}-{stop_at}"
    for name, df in tables.items():
        step()
        runs.write(folder, {name: df}, attempt)
    step()
    return runs.commit(spark, folder, attempt, run_id, base)


def seen(spark, folder):
    log = sorted((r.run_id, r.new_count, r.removed_count) for r in store.read_log(spark, folder).collect())
    totals = sorted((r.run_id, r.total_records) for r in store.read_totals(spark, folder).collect())
    records = {r: sorted(x.company for x in store.read_snapshot(spark, folder, r).collect()) for r in runs.ids(spark, folder)}
    return log, totals, records


def test_a_run_that_stops_anywhere_leaves_no_trace(spark, tmp_path):
    folder = str(tmp_path)
    first = notices(spark, [("A", None, "2025-01-01", 5), ("B", None, "2025-01-01", 6)])
    second = notices(spark, [("A", None, "2025-01-01", 5), ("C", None, "2025-01-01", 7), ("C", None, "2025-01-01", 7)])
    assert seen(spark, folder) == ([], [], {})
    for stop in range(4):
        with pytest.raises(Stop):
            run_all(spark, folder, first, "1", stop)
        assert seen(spark, folder) == ([], [], {})
    run_all(spark, folder, first, "1")
    after_one = seen(spark, folder)
    assert after_one == ([("1", 2, 0)], [("1", 2)], {"1": ["A", "B"]})
    for stop in range(4):
        with pytest.raises(Stop):
            run_all(spark, folder, second, "2", stop)
        assert seen(spark, folder) == after_one
    run_all(spark, folder, second, "2")
    whole = seen(spark, folder)
    assert whole == ([("1", 2, 0), ("2", 2, 1)], [("1", 2), ("2", 3)], {"2": ["A", "C", "C"], "1": ["A", "B"]})
    assert len(runs.vacuum(spark, folder, list(store.TABLES))) == 6  # two of the stops came before any write
    assert seen(spark, folder) == whole and runs.vacuum(spark, folder, list(store.TABLES)) == []


def test_of_two_writers_one_wins(spark, tmp_path):
    folder, base = str(tmp_path), 0
    rows = notices(spark, [("A", None, "2025-01-01", 5)])
    entry = diff.change_entry(rows, None, "t", store.FIELDS)
    attempts = [runs.write(folder, {"records": rows.select(*store.FIELDS, "ord"), "totals": store.payload(rows, "t"), "changes": entry}) for _ in range(2)]
    assert runs.commit(spark, folder, attempts[0], "1", base) == 1
    with pytest.raises(runs.Conflict):
        runs.commit(spark, folder, attempts[1], "2", base)
    assert runs.ids(spark, folder) == ["1"]


def test_a_void_commit_hides_nothing(spark, tmp_path):
    rows = notices(spark, [("A", None, "2025-01-01", 5)])
    (tmp_path / "commits").mkdir()
    (tmp_path / "commits" / f"{1:020}.json").write_text("")
    assert runs.ids(spark, str(tmp_path)) == [] and runs.head(spark, str(tmp_path)) == 1
    refresh.run(spark, rows, str(tmp_path), "1", "t")
    assert runs.ids(spark, str(tmp_path)) == ["1"] and runs.head(spark, str(tmp_path)) == 2


def test_dry_run_and_history_of_files(spark, tmp_path):
    rows = notices(spark, [("A", "2025-01-01", "2025-03-01", 5, "X County", "c", "t")])
    out = refresh.run(spark, rows, str(tmp_path / "out"), "1", "t", dry_run=True)
    assert (out.entry.new_count, out.totals.total_employees) == (1, 5) and not (tmp_path / "out").exists()
    (tmp_path / "years").mkdir()
    record = {"company": "P", "employees": 9, "effective_date": "2020-01-01", "fiscal_year": 2019, "source": "pdf"}
    (tmp_path / "years" / "y.json").write_text(json.dumps({"fiscal_year": 2019, "records": [record]}))
    out = refresh.run(spark, rows, str(tmp_path / "out"), "1", "t", past=str(tmp_path / "years"))
    years = {r.fiscal_year: r.employees for r in spark.read.parquet(str(tmp_path / "out" / "charts" / "years")).collect()}
    assert years["2019"] == 9 and years["current"] == 5 and out.failed == {}


def test_charts_without_rows_are_empty(spark, tmp_path):
    out = refresh.run(spark, notices(spark, [("A", None, "TBD", 5)]), str(tmp_path), "1", "t")
    status = {r.chart: r.status for r in out.manifest.collect()}
    assert status["timeline"] == status["monthly"] == "empty" and status["companies"] == "ok"


# changes as a stream


def snapshots(spark):
    one = [("A", None, "2025-01-01", 5), ("A", None, "2025-01-01", 5), ("B", None, None, 6), ("C", None, "2025-01-02", 7), ("D", None, "x", 1)]
    two = [("A", None, "2025-01-01", 5), ("B", None, None, 6), ("E", None, "2025-01-02", 7), ("D", None, "x", 1)]
    three = [("A", None, "2025-01-01", 5), ("A", None, "2025-01-01", 5), ("C", None, "2025-01-02", 7), ("E", None, "2025-01-02", 8)]
    return [notices(spark, s) for s in (one, two, three, [])]


WANT = {
    1: {("A", 0, 2), ("B", 0, 1), ("C", 0, 1), ("D", 0, 1)},
    2: {("A", 2, 1), ("C", 1, 0), ("E", 0, 1)},
    3: {("A", 1, 2), ("B", 1, 0), ("C", 0, 1), ("D", 1, 0), ("E", 1, 0), ("E", 0, 1)},
    4: {("A", 2, 0), ("C", 1, 0), ("E", 1, 0)},
}


def told(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.taken, []).append((r.company, r.before, r.after))
    assert all(len(x) == len(set(x)) for x in out.values())
    return {k: set(v) for k, v in out.items()}


@pytest.mark.parametrize("calls", [[1, 1, 1, 1], [4], [2, 2], [1, 3]])
def test_stream_tells_each_change_once(spark, tmp_path, calls):
    """Whatever comes together in a batch, also over restarts; the last snapshot is empty."""
    feeds, folder, at, found = str(tmp_path / "feeds"), str(tmp_path / "state"), 0, None
    for n in calls:
        for rows in snapshots(spark)[at : at + n]:
            at += 1
            changes.feed(rows, at, 3).write.parquet(f"{feeds}/{at}")
        found = changes.follow(spark, feeds, folder)
        assert told(found) == {k: WANT[k] for k in range(1, at + 1)}
    again = changes.follow(spark, feeds, folder)  # nothing new
    assert told(again) == told(found)


def test_stream_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    """A batch whose lines were written but not marked as done is told once all the same."""
    feeds, folder = str(tmp_path / "feeds"), str(tmp_path / "state")
    one, two, *_ = snapshots(spark)
    changes.feed(one, 1, 2).write.parquet(f"{feeds}/1")
    changes.follow(spark, feeds, folder)
    changes.feed(two, 2, 2).write.parquet(f"{feeds}/2")
    changes.follow(spark, feeds, folder)
    commits = sorted((tmp_path / "state" / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)  # as if the process had stopped before it could say so
    assert told(changes.follow(spark, feeds, folder)) == {1: WANT[1], 2: WANT[2]}


def test_a_snapshot_in_parts_waits_for_the_rest(spark, tmp_path):
    feeds, folder = str(tmp_path / "feeds"), str(tmp_path / "state")
    one, two, *_ = snapshots(spark)
    changes.feed(one, 1, 1).write.parquet(f"{feeds}/1")
    whole = changes.feed(two, 2, 1).persist()
    part = F.col("company") == "A"
    whole.where(part).write.parquet(f"{feeds}/2a")
    assert told(changes.follow(spark, feeds, folder)) == {1: WANT[1]}
    whole.where(~part).write.parquet(f"{feeds}/2b")
    assert told(changes.follow(spark, feeds, folder)) == {1: WANT[1], 2: WANT[2]}


def test_stream_equals_the_batch_diff(spark, tmp_path):
    rnd = random.Random(3)
    sides = [[(f"co {rnd.randrange(60)}", None, rnd.choice(["2025-01-01", "2025-02-01", None]), rnd.randrange(3)) for _ in range(400)] for _ in range(2)]
    old, new = (notices(spark, s) for s in sides)
    for k, rows in enumerate((old, new), 1):
        changes.feed(rows, k, 4).write.parquet(str(tmp_path / "f" / str(k)))
    found = changes.follow(spark, str(tmp_path / "f"), str(tmp_path / "s")).where("taken = 2")
    added, removed = diff.strict(new, old)
    assert sum(r.after for r in found.where("before = 0").collect()) == added.count()
    assert sum(r.before for r in found.where("after = 0").collect()) == removed.count()


# windows


def event(i, when, value=1.0, kind="a"):
    return (i, datetime.datetime(2025, 1, 1) + datetime.timedelta(hours=when), value, kind)


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp, value double, event_type string")


def test_windows_close_once_and_drop_what_is_late(spark, tmp_path):
    """Out of order within a day, repeated, and too late."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: windows.closed(windows.once(spark.readStream.schema(events(spark, []).schema).parquet(source)))
    (tmp_path / "in").mkdir()
    nothing = windows.append(stream(), folder)
    assert nothing.rows.count() == 0 and nothing.late == 0

    def come(*rows):
        events(spark, list(rows)).coalesce(1).write.mode("append").parquet(source)
        got = windows.append(stream(), folder)
        return sorted((r.window_start.day, r.events, float(r.value)) for r in got.rows.collect()), got.late

    assert come(event(1, 1), event(2, 30), event(3, 20)) == ([], 0)
    assert come(event(2, 30), event(4, 10), event(5, 49)) == ([(1, 3, 3.0)], 0)  # a repeat; one from the day before; the first day closes
    assert come(event(6, 2), event(7, 50)) == ([(1, 3, 3.0)], 1)  # too late for the first day
    assert come(event(8, 100)) == ([(1, 3, 3.0), (2, 1, 1.0), (3, 2, 2.0)], 0)


def test_no_events_give_no_windows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema(events(spark, []).schema).parquet(str(tmp_path / "none"))
    assert windows.drain(windows.daily(stream)).count() == 0


# lines


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    rnd, whole = random.Random(5), []
    for k, n in enumerate((300, 0, 1, 57)):
        own = [("é" * rnd.randrange(30)) + f"line {k} {i}" for i in range(n)]
        (tmp_path / f"part-{k}.txt").write_text("\n".join(own) + ("\n" if n and k != 3 else ""), encoding="utf-8")
        whole += own
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], split)
        spark.conf.set(names[1], "1")
        got = [(r.ord, r.value) for r in lines.numbered(spark, str(tmp_path)).orderBy("ord").collect()]
    finally:
        for n, v in zip(names, old, strict=True):
            spark.conf.set(n, v)
    assert got == list(enumerate(whole))


@pytest.mark.parametrize("n", [1, 5, 58, 70, 1000])
def test_last_lines(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(lines, "TAIL_BYTES", 50)
    whole = []
    for k, size in enumerate((30, 0, 1, 57)):
        own = [f"ü line {k} {i}" for i in range(size)]
        (tmp_path / f"part-{k}.txt").write_bytes("".join(x + ("\r\n" if k == 0 else "\n") for x in own).encode())
        whole += own
    got = [(r.ord, r.value) for r in lines.last(spark, str(tmp_path), n).orderBy("ord").collect()]
    own = whole[-n:]
    assert got == [(i - len(own), x) for i, x in enumerate(own)]


def test_merged_notices_survive_a_round_trip(spark, tmp_path):
    rows = merge.merge_duplicates(notices(spark, [("A", "2025-01-01", "2025-03-01", 5, "X County", "c", "t")]))
    runs.commit(spark, str(tmp_path), runs.write(str(tmp_path), {"records": rows.select(*store.FIELDS, "ord")}), "1", 0)
    assert store.read_snapshot(spark, str(tmp_path), "1").first().company == "A"
