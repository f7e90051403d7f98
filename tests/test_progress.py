"""The progress log: folding, replays, write errors, streams that go on, the run log by day."""

import json
import os
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from test_streams import feed, stamp

from tidemark import jobs
from tidemark.operators import maintenance, progress, runlog
from tidemark.operators.sinks import append_log, read_text, remove_folder


def event(batch, run="r", day="2024-01-05", rows=1):
    return {"name": "silver_sensors", "run_id": run, "batch_id": batch, "started_at": f"{day}T10:00:00.000Z", "milliseconds": 10,
            "rows_read": rows, "rows_written": 0, "sources": [{"source": "s", "start_offset": None, "end_offset": "1", "rows": rows}]}


def write(path, *events):
    for e in events:
        file = progress.event_file(path, e)
        os.makedirs(os.path.dirname(file), exist_ok=True)
        with open(file, "w") as out:
            out.write(json.dumps(e) + "\n")


def files(path):
    return sorted(f"{d}/{n}" for d, _, names in os.walk(path) for n in names if not n.startswith("."))


def keys(spark, path):
    return sorted((r.run_id, r.batch_id) for r in progress.read_progress(spark, path).collect())


def test_ten_thousand_batches_become_few_files(spark, folder):
    write(folder, *[event(b, day=f"2024-01-0{1 + b % 4}") for b in range(10_000)])
    assert len(files(folder)) == 10_000
    assert progress.fold_progress(spark, folder) == [20240101, 20240102, 20240103, 20240104]
    assert progress.read_progress(spark, folder).count() == 10_000  # the tail stands beside the versions: once each
    assert progress.fold_progress(spark, folder) == []
    assert not [f for f in files(folder) if f.endswith(".json")]
    assert len(files(folder)) <= 4 * 3  # a file, a mark of success and a list a day
    assert progress.read_progress(spark, folder).count() == 10_000
    assert progress.tail_days(spark, folder) == [20240104]
    assert runlog.topic_progress(spark, folder).agg({"num_input_rows": "sum"}).first()[0] == 10_000


def test_events_between_folds_and_reports_that_come_again(spark, folder):
    for b in range(5):
        write(folder, event(b))
        progress.fold_progress(spark, folder)
    write(folder, event(1))  # reported again after it was folded
    assert keys(spark, folder) == [("r", b) for b in range(5)]
    progress.fold_progress(spark, folder)
    progress.fold_progress(spark, folder)
    assert keys(spark, folder) == [("r", b) for b in range(5)]
    assert len([d for d in os.listdir(f"{folder}/folded/day=20240105") if d.startswith("v=")]) <= 2


def test_a_reader_keeps_its_files_while_a_fold_runs(spark, folder):
    write(folder, event(0), event(1))
    progress.fold_progress(spark, folder)
    write(folder, event(2))
    reader = progress.read_progress(spark, folder)
    assert progress.fold_progress(spark, folder) == [20240105]  # removes what the first fold took
    assert [f.rsplit("/", 1)[1] for f in files(f"{folder}/tail")] == ["r-2.json"]
    assert sorted(r.batch_id for r in reader.collect()) == [0, 1, 2]


def test_a_fold_that_died_is_repeated(spark, folder):
    write(folder, event(0))
    progress.fold_progress(spark, folder)
    write(folder, event(1))
    progress.fold_progress(spark, folder)
    version = f"{folder}/folded/day=20240105/v=2"
    assert json.loads(read_text(spark, f"{version}/_taken")) == ["r-1.json"]
    remove_folder(spark, f"{version}/_taken")  # as if it had died before its last step
    assert keys(spark, folder) == [("r", 0), ("r", 1)]
    assert progress.fold_progress(spark, folder) == [20240105]
    assert keys(spark, folder) == [("r", 0), ("r", 1)]


def test_nothing_logged_yet(spark, folder):
    assert progress.fold_progress(spark, f"{folder}/none") == [] and keys(spark, f"{folder}/none") == []
    runlog.settle_streams(spark, f"{folder}/runs", f"{folder}/none", "silver")
    assert not os.path.exists(f"{folder}/runs")


def test_runs_are_logged_once_whatever_is_folded(spark, folder):
    for b in range(4):
        write(f"{folder}/p", event(b, day="2024-01-05"), event(b, run="other", day="2024-01-06"))
        runlog.settle_streams(spark, f"{folder}/runs", f"{folder}/p", "silver")
    runlog.settle_streams(spark, f"{folder}/runs", f"{folder}/p", "silver")
    runs = [r.run_id for r in spark.read.parquet(f"{folder}/runs").collect()]
    assert sorted(runs) == sorted(f"{r}-{b}" for r in ("r", "other") for b in range(4))


def progress_event(batch):
    text = json.dumps({"name": "n", "runId": "run", "batchId": batch, "timestamp": "2024-01-05T10:00:00.000Z",
                       "durationMs": {}, "sources": [], "sink": {}})
    return SimpleNamespace(progress=SimpleNamespace(json=text))


def test_events_that_cannot_be_written_are_tried_again(spark, folder, monkeypatch):
    log, broken, real = runlog.ProgressLog(spark, folder, tries=2, pause=0), [True], runlog.write_text

    def flaky(*args):
        if broken[0]:
            raise OSError("no space")
        real(*args)

    monkeypatch.setattr(runlog, "write_text", flaky)
    query, ended = SimpleNamespace(runId="run", name="n"), SimpleNamespace(runId="run")
    log.onQueryStarted(ended)
    log.onQueryProgress(progress_event(0))
    log.onQueryProgress(progress_event(1))
    log.onQueryTerminated(ended)
    with pytest.raises(OSError, match="2 progress events"):
        log.wait(query, 1)
    broken[0] = False
    log.onQueryProgress(progress_event(2))
    log.wait(query, 1)
    assert keys(spark, folder) == [("run", 0), ("run", 1), ("run", 2)]


def test_a_running_stream_shows_in_the_run_log(spark, folder, monkeypatch):
    lake, src, seen = f"{folder}/lake", f"{folder}/src", []
    options = feed(f"{src}/sensors", "0", {"reading_id": "r0", "event_ts": stamp()})
    settle = runlog.settle_streams

    def settled(*args):
        settle(*args)
        rows = spark.read.parquet(f"{lake}/pipeline_runs").count() if os.path.exists(f"{lake}/pipeline_runs") else 0
        seen.append((len(spark.streams.active), rows))
        if rows or len(seen) > 30:
            for query in spark.streams.active:
                query.stop()

    monkeypatch.setattr(runlog, "settle_streams", settled)
    monkeypatch.setattr(jobs, "SETTLE_SECONDS", 2)
    jobs.main(["hours", "--lake", lake, "--option", "format=text", "--option", f"path={src}/sensors"], spark)
    assert any(active and rows for active, rows in seen), (seen, options)


def test_closed_days_of_the_run_log_become_one_file(spark, folder):
    row = {"run_id": "a", "dag_id": "d", "stage": "s", "status": "success", "rows_read": 1, "rows_written": 1, "error_msg": None}
    days = [datetime(2024, 1, d, 8, tzinfo=timezone.utc) for d in (5, 5, 5, 6, 6)]
    for n, at in enumerate(days):
        run = row | {"run_id": str(n), "started_at": at, "finished_at": at, "_loaded_at": at}
        append_log(spark.createDataFrame([run], runlog.RUNS.schema), f"{folder}/pipeline_runs", runlog.RUNS)
    rewritten = maintenance.optimize_table(spark, folder, runlog.RUNS, before=20240106)
    assert [f.rsplit("/", 1)[1] for f in rewritten] == ["_s=20240105"]
    counts = [len([f for f in files(f"{folder}/pipeline_runs/_p=202401/_s=2024010{d}") if f.endswith(".parquet")]) for d in (5, 6)]
    assert counts == [1, 2]
    assert sorted(r.run_id for r in spark.read.parquet(f"{folder}/pipeline_runs").collect()) == ["0", "1", "2", "3", "4"]
