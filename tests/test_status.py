"""The status store: additions, compaction, filters, and what a question for some ids reads."""

import hashlib
import os
from datetime import datetime, timezone

import pytest

from slipway.operators import status
from slipway.operators.status import STATUS_DDL, StatusStore, append_status, append_status_rows, status_table


def name_of(number):
    return hashlib.sha256(str(number).encode()).hexdigest()


def record(number):
    at = datetime(2026, 1, 1 + number % 5, tzinfo=timezone.utc)
    return (name_of(number), None, "SQL", "OK", None, None, "SQL code submitted", None, None, 1, at, at)


def asked(spark, *numbers):
    return spark.createDataFrame([(name_of(number),) for number in numbers], "submission_id string")


def found(df):
    return sorted(row.submission_id for row in df.collect())


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """30 additions of 10 rows, with a compaction after every 4."""
    path = str(tmp_path_factory.mktemp("status"))
    for n in range(30):
        append_status_rows(spark, [record(10 * n + k) for k in range(10)], path)
        StatusStore(spark, path).compact(after=4, fan=3)
    return path


def test_many_additions_few_files(spark, filled):
    store = StatusStore(spark, filled)
    assert found(store.rows()) == sorted(map(name_of, range(300)))
    assert len(store.tail) < 4 and len(store.segments) <= 6
    # At most one file for each segment, day and digit, however many additions there were; two compactions' tails stay.
    assert len(os.listdir(f"{filled}/tail")) <= 8
    files = [file for file in store.rows().inputFiles() if "segment-" in file]
    assert len(files) == len(set(files)) <= len(store.segments) * 5 * 16
    assert len([x for x in os.listdir(f"{filled}/_versions") if x.endswith(".json")]) <= 3


def test_questions_read_only_files_that_may_hold_an_id(spark, filled):
    store = StatusStore(spark, filled)
    every = len([file for file in store.rows().inputFiles() if "segment-" in file])
    some = asked(spark, 3, 77, 1000)
    assert found(store.known(some)) == sorted([name_of(3), name_of(77)])
    assert len(store.files_for(some)) <= 3 < every
    assert set(store.known(some).inputFiles()) <= {f"file://{filled}/{x}" for x in store.files_for(some)} | set(
        store._read(store._tail_paths()).inputFiles() if store.tail else []
    ) | set(some.inputFiles())
    # Ids that are nowhere: filters let next to none through.
    assert len(store.files_for(asked(spark, *range(10_000, 10_400)))) <= every * 0.1
    assert store.files_for(asked(spark, *range(300))) == sorted(store.files_for(asked(spark, *range(300))))
    assert found(store.known(asked(spark, *range(300)))) == sorted(map(name_of, range(300)))


def test_nothing_recorded_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "status")
    assert status_table(spark, path).count() == 0 and StatusStore(spark, path).known(asked(spark, 1)).count() == 0
    for n in range(3):
        append_status(spark.createDataFrame([(None, "OK"), (name_of(n), "OK")], "submission_id string, state string"), path)
    assert StatusStore(spark, path).compact(after=2)
    assert status_table(spark, path).count() == 6
    assert found(StatusStore(spark, path).known(asked(spark, 0, 1, 5))) == sorted([name_of(0), name_of(1)])
    assert status_table(spark, path).schema == spark.createDataFrame([], STATUS_DDL).schema


def test_an_addition_under_way_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "status")
    append_status_rows(spark, [record(1)], path)
    append_status_rows(spark, [record(2)], path)
    unfinished = sorted(os.listdir(f"{path}/tail"))[0]
    os.remove(f"{path}/tail/{unfinished}/_SUCCESS")
    assert status_table(spark, path).count() == 1


@pytest.mark.parametrize("step", ["segment", "version", "deletion"])
def test_compaction_that_stops_at_any_step(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "status")
    for n in range(4):
        append_status_rows(spark, [record(n)], path)
    StatusStore(spark, path).compact(after=4)
    for n in range(4, 8):
        append_status_rows(spark, [record(n)], path)

    def stop(*_args):
        raise KeyboardInterrupt

    target = {"segment": (StatusStore, "_write_segment"), "version": (status.VersionLog, "commit"), "deletion": (status, "remove")}
    monkeypatch.setattr(*target[step], stop)
    with pytest.raises(KeyboardInterrupt):
        StatusStore(spark, path).compact(after=4)
    monkeypatch.undo()
    assert found(status_table(spark, path)) == sorted(map(name_of, range(8)))
    assert StatusStore(spark, path).compact(after=4)
    assert found(status_table(spark, path)) == sorted(map(name_of, range(8)))


def test_of_two_compactions_one_counts(spark, tmp_path):
    path = str(tmp_path / "status")
    for n in range(4):
        append_status_rows(spark, [record(n)], path)
    one, other = StatusStore(spark, path), StatusStore(spark, path)
    real = other._write_segment

    def later(source, folder):
        real(source, folder)
        assert one.compact(after=4)

    other._write_segment = later
    latest = other.log.latest
    assert latest() is None
    assert other.compact(after=4) is False
    assert found(status_table(spark, path)) == sorted(map(name_of, range(4)))
