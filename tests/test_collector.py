"""Figures of a collector: nulls, families without a column, facts of the future and empty families."""

from datetime import datetime, timedelta

from tidemark.plans import report

NOW = datetime(2024, 1, 1, 12)


def test_figures(spark):
    ago = lambda s: None if s is None else NOW - timedelta(seconds=s)
    rows = [(ago(10), "A", True, ago(5), 1.0), (ago(60), "A", None, ago(-5), None), (ago(3599), None, True, None, 3.0), (ago(3600), "B", True, ago(100), 5.0), (ago(-1), "A", True, ago(9), 99.0), (None, "A", True, None, 9.0)]
    polls = spark.createDataFrame(rows, "at timestamp, state string, failed boolean, due_at timestamp, figure double")
    empty = spark.createDataFrame([], "at timestamp, coverage_class string")
    bare = spark.createDataFrame([(ago(0),), (ago(0),)], "at timestamp")
    got = {(r.family, r.level, r.state): r for r in report.collector_figures({"polls": polls, "none": empty, "bare": bare}, "2024-01-01 12:00:00").collect()}
    assert set(got) == {("polls", "all", None), ("polls", "state", "A"), ("polls", "state", "B"), ("polls", "state", None), ("bare", "all", None)}
    r = got["polls", "all", None]
    assert (r.rows, r.last_minute, r.last_hour, r.failed_last_hour, r.overdue, r.most_overdue_seconds) == (4, 1, 3, 2, 2, 100.0)
    assert (r.mean_figure, r.largest_figure, r.idle_seconds, r.rows_per_minute) == (3.0, 5.0, 10.0, 0.05) and abs(r.p95_figure - 4.8) < 1e-9
    assert got["polls", "state", "A"].rows == 2 and got["polls", "state", "A"].p95_figure is None and got["polls", "state", None].failed_last_hour == 1
    assert (got["bare", "all", None].rows, got["bare", "all", None].mean_figure, got["bare", "all", None].overdue) == (2, None, 0)
