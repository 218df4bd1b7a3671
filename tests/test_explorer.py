"""Stored results of free SQL: pages in order, time limits, cancellation."""

from __future__ import annotations

import threading
import time

import pytest

from wardflow.plans.explorer import MAX_PAGE, execute, explore, page, stop
from wardflow.session import table_exists

ENDLESS = "SELECT max(a.id ^ b.id) AS m FROM range(10000000) a CROSS JOIN range(10000000) b"


def test_pages_keep_the_order_of_the_query(spark, tmp_path):
    text = "SELECT id, id % 7 AS place FROM range(0, 1000, 1, 8) ORDER BY id % 7 DESC, id"
    result = execute(spark, text, str(tmp_path / "r"))
    want = sorted(((k, k % 7) for k in range(1000)), key=lambda r: (-r[1], r[0]))
    assert result.frame.columns == ["id", "place"] and result.row_count == 1000
    for number in (1, 2, 7, 11, 12):
        got = [tuple(r) for r in page(spark, result, number, 90).collect()]
        assert got == want[(number - 1) * 90 : number * 90]
    assert page(spark, result, 40, 90).count() == 0


def test_pages_are_bounded(spark, tmp_path):
    result = execute(spark, "SELECT 1 AS a WHERE false", str(tmp_path / "r"))
    assert page(spark, result, 1).count() == 0
    for number, size in ((0, 10), (1, 0), (1, MAX_PAGE + 1)):
        with pytest.raises(ValueError, match="pages"):
            page(spark, result, number, size)
    with pytest.raises(ValueError, match="executed"):
        page(spark, explore(spark, "SELECT 1 AS a"), 1)


def test_a_time_limit_ends_the_query_alone(spark, tmp_path):
    start, path = time.time(), str(tmp_path / "r")
    result = execute(spark, ENDLESS, path, seconds=2)
    assert result.frame is None and result.error == "stopped after 2 seconds" and time.time() - start < 60
    assert not table_exists(spark, path)
    again = execute(spark, "SELECT sum(id) AS s FROM range(10)", path, seconds=600)
    assert again.frame.first()["s"] == 45


def test_another_thread_stops_a_query(spark, tmp_path):
    ending = threading.Timer(2, stop, [spark, "mine"])
    ending.start()
    result = execute(spark, ENDLESS, str(tmp_path / "r"), tag="mine")
    ending.join()
    assert result.frame is None and "cancel" in result.error.lower()
    assert spark.range(5).count() == 5


def test_a_stored_result_is_not_lost_to_an_error(spark, tmp_path):
    path = str(tmp_path / "r")
    first = execute(spark, "SELECT 1 AS a", path)
    second = execute(spark, "SELECT 2 AS a", path)
    assert second.frame is None and first.frame.first()["a"] == 1
