from __future__ import annotations

import datetime as dt

import pytest

from tallymint.operators import audit, backfill, versions

D = dt.date
SCHEMA = "price_date date, product_id long, sub_type_name string, market_price double, category_id long, group_id long"


def day_rows(day, n, price=1.0):
    return [(D(2025, 1, day), i, "Normal", price, 3, 7) for i in range(n)]


@pytest.fixture
def where(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "log")


def counts(spark, table):
    return {r.price_date.day: r["count"] for r in versions.read(spark, table).groupBy("price_date").count().collect()}


def test_backfill_stops_and_goes_on(spark, rows, where):
    table, log = where
    spine = backfill.days_between(spark, D(2025, 1, 1), D(2025, 1, 5))
    source = rows(day_rows(1, 3) + day_rows(2, 1) + day_rows(3, 4) + day_rows(5, 2, price=-1.0), SCHEMA)

    def run(run_id, data=source, **how):
        found = backfill.backfill(spark, data, spine, table, log, run_id, least=2, most=9, **how)
        return {d.day: s for d, s in found.items()}

    assert run("a", limit=2) == {1: "completed", 2: "failed"}
    assert counts(spark, table) == {1: 3}
    asked = []
    # Days that were not tried yet come first.
    assert run("b", lambda days: asked.extend(days) or source, limit=2) == {3: "completed", 4: "failed"}
    assert [d.day for d in asked] == [3, 4]
    assert run("c") == {2: "failed", 4: "failed", 5: "failed"}
    assert counts(spark, table) == {1: 3, 3: 4}
    failures = {(r.date.day, r.context["run_id"]): r for r in backfill.failure_log(spark, log).collect()}
    assert set(failures) == {(2, "a"), (4, "b"), (2, "c"), (4, "c"), (5, "c")}
    assert failures[2, "c"].error_message == "Low record count: 1" and failures[2, "c"].retry_count == 1
    assert (failures[4, "b"].failure_type, failures[4, "b"].error_message) == ("download", "No rows")
    assert "Price out of range: 2" in failures[5, "c"].error_message
    # The missing days arrive; nothing is left, and a further run does nothing.
    late = rows(day_rows(2, 5) + day_rows(4, 5) + day_rows(5, 5), SCHEMA)
    assert set(run("d", late).values()) == {"completed"} and run("e", late) == {}
    assert counts(spark, table) == {1: 3, 2: 5, 3: 4, 4: 5, 5: 5}
    report = audit.run_report(audit.run_status(backfill.run_log(spark, log), order=("event_time", "run_id"))).first()
    assert (report.total_dates, report.completed_dates, report.failed_dates, report.total_records) == (5, 5, 0, 22)


@pytest.mark.parametrize("lost", ["write_batch", "commit", "log"])
def test_run_that_broke_off_is_repeated(spark, rows, where, monkeypatch, lost):
    table, log = where
    spine = backfill.days_between(spark, D(2025, 1, 6), D(2025, 1, 12), skip_weekends=True)
    source = rows(day_rows(6, 3) + day_rows(7, 3) + day_rows(11, 3), SCHEMA)

    def broken(*args, **kwargs):
        original(*args, **kwargs)
        raise RuntimeError("lost")

    module, name = (backfill, "_write_log") if lost == "log" else (versions, lost)
    original = getattr(module, name)
    monkeypatch.setattr(module, name, broken)
    with pytest.raises(RuntimeError):
        backfill.backfill(spark, source, spine, table, log, "a", least=1, most=9)
    monkeypatch.setattr(module, name, original)
    backfill.backfill(spark, source, spine, table, log, "a", least=1, most=9)
    assert counts(spark, table) == {6: 3, 7: 3}  # the 11th is a Saturday
    status = {r.date.day: (r.status, r.record_count) for r in audit.run_status(backfill.run_log(spark, log)).collect()}
    if lost == "log":  # the second try found the first one's log and only tried what had failed
        assert {d for d, s in status.items() if s[0] == "failed"} == {8, 9, 10}
    else:
        assert status == {6: ("completed", 3), 7: ("completed", 3), 8: ("failed", 0), 9: ("failed", 0), 10: ("failed", 0)}
