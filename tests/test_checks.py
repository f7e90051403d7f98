"""Data tests by changed days, against the tests over all rows."""

import glob
import shutil

import pytest

from tidemark.operators import quality, sinks
from tidemark.plans import checks
from tidemark.sources.layers import read_warehouse
from test_incremental import load_sales, sale

SPEC = {"fact_sales": quality.CHECKS["fact_sales"]}


def numbered(key, day, amount=10):
    """A sale whose id is the same on every day."""
    return (key, *sale("o", day, amount=10)[1:7], None if amount is None else float(amount), *sale("o", day)[8:])


def checked(spark, root):
    report = sorted(map(tuple, checks.run_checks_by_day(spark, root, f"{root}/checks", SPEC).collect()))
    assert report == sorted(map(tuple, quality.run_checks({"fact_sales": read_warehouse(spark, root, "fact_sales")}, SPEC).collect()))
    keys = {r.sale_id: r.rows for r in checks.repeated_keys(spark, "fact_sales", "sale_id", f"{root}/checks").collect()}
    want = quality.check_unique(read_warehouse(spark, root, "fact_sales"), "sale_id").collect()
    assert keys == {r.sale_id: r.rows for r in want}
    return keys


def test_report_equals_the_one_over_all_rows(spark, folder):
    load_sales(spark, folder, 1, numbered("a", 1), numbered("b", 1), numbered(None, 1), numbered(None, 1))
    load_sales(spark, folder, 2, numbered("c", 2, None))
    assert checked(spark, folder) == {}
    load_sales(spark, folder, 3, numbered("a", 3), numbered("d", 3), numbered("d", 3), numbered("e", 3, None))
    assert checked(spark, folder) == {"a": 2, "d": 2}
    load_sales(spark, folder, 3, numbered("b", 3), numbered("c", 3), numbered("a", 3), numbered("a", 3))  # delivered again
    assert checked(spark, folder) == {"a": 3, "b": 2, "c": 2}
    load_sales(spark, folder, 1, numbered("f", 1))
    assert checked(spark, folder) == {"a": 2, "c": 2}
    sinks.remove_folder(spark, f"{folder}/fact_sales/_p=202401/date_key=20240103")
    assert checked(spark, folder) == {}
    load_sales(spark, folder, 2)  # an empty day
    assert checked(spark, folder) == {}


def test_only_changed_days_are_opened(spark, folder):
    load_sales(spark, folder, 1, numbered("a", 1), numbered("b", 1))
    load_sales(spark, folder, 2, numbered("c", 2))
    checked(spark, folder)
    for file in glob.glob(f"{folder}/fact_sales/_p=202401/date_key=20240101/*.parquet"):
        open(file, "wb").write(b"unreadable")
    load_sales(spark, folder, 3, numbered("a", 3))
    state, days = checks.update_index(spark, "fact_sales", "sale_id", ["sale_id", "total_amount"], folder, f"{folder}/checks")
    assert days == [20240103] and state["failures"] == 1
    assert checks.update_index(spark, "fact_sales", "sale_id", ["sale_id", "total_amount"], folder, f"{folder}/checks") == (state, [])


def test_a_check_that_died_leaves_the_last_state(spark, folder, monkeypatch):
    load_sales(spark, folder, 1, numbered("a", 1))
    load_sales(spark, folder, 2, numbered("a", 2))
    checked(spark, folder)
    load_sales(spark, folder, 2, numbered("b", 2))

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(checks, "_switch", fail)
        with pytest.raises(RuntimeError):
            checks.run_checks_by_day(spark, folder, f"{folder}/checks", SPEC)
    assert checked(spark, folder) == {}
    shutil.rmtree(f"{folder}/checks")
    assert checked(spark, folder) == {}


def test_unused_folders_are_removed(spark, folder):
    for _ in range(3):
        for day in (1, 2):
            load_sales(spark, folder, day, numbered("a", day), numbered(str(_), day))
        checked(spark, folder)
    index = f"{folder}/checks/fact_sales/sale_id"
    assert len(glob.glob(f"{index}/repeated-*")) == 1 and len(glob.glob(f"{index}/keys/*/date_key=*")) == 2


def test_a_table_without_unique_column_is_refused(spark, folder):
    with pytest.raises(ValueError):
        checks.run_checks_by_day(spark, folder, f"{folder}/checks", {"fact_sales": {"total_amount": ("not_null",)}})
