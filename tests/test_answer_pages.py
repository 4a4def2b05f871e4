"""Pages of an inline answer, by position."""

import json

import pytest

from slipway import Runner
from slipway.operators import runner as runner_module


@pytest.fixture
def answered(spark, tmp_path, monkeypatch):
    """An answer of 1,003 rows over several partitions, in files of 100 lines at most."""
    monkeypatch.setattr(runner_module, "ANSWER_BLOCK", 100)
    runner = Runner(str(tmp_path), setup=lambda s: s.range(1003).createOrReplaceTempView("t"))
    text = json.dumps({"type": "SQL", "code": "select id * 7 % 1003 as v from t order by v", "resultFormat": "csv"})
    status = runner.run(spark.createDataFrame([(text,)], "value string")).first()
    assert status.state == "OK", status
    return runner, status.submission_id


@pytest.mark.parametrize(("first", "count"), [(0, 1), (0, 100), (99, 2), (250, 333), (1000, 50), (0, 5000), (5000, 10), (7, 0)])
def test_pages(spark, answered, first, count):
    runner, submission = answered
    rows = runner.answer_page(spark, submission, first, count).collect()
    assert [(row.position, row.value) for row in rows] == [(n, str(n)) for n in range(first, min(first + count, 1003))]


def test_a_page_reads_its_files_only(spark, answered):
    runner, submission = answered
    assert [row.value for row in runner.answer_rows(spark, submission).collect()] == [str(n) for n in range(1003)]
    files = len(spark.read.text(runner.inline_path(submission)).inputFiles())
    page = runner.answer_page(spark, submission, 250, 20)
    assert files >= 11 and page.count() == 20 and len([f for f in page.inputFiles() if f.endswith(".txt")]) <= 2


def test_wrong_pages(spark, answered):
    runner, submission = answered
    for first, count in ((-1, 1), (0, -1)):
        with pytest.raises(ValueError):
            runner.answer_page(spark, submission, first, count)
