import threading

import pytest

from saleslane.session import child_session, setting, side_by_side

KEY = "spark.sql.shuffle.partitions"


def test_options_of_a_child_are_its_own(spark):
    before = dict(spark.conf.getAll)
    with setting(spark, KEY, "7"):
        child = child_session(spark)
        assert child.conf.get(KEY) == "7"
        child.conf.set(KEY, "9")
        assert spark.conf.get(KEY) == "7"
    assert dict(spark.conf.getAll) == before and child.conf.get(KEY) == "9"


def test_jobs_run_side_by_side_and_in_order(spark):
    both = threading.Barrier(2, timeout=60)
    active = spark.getActiveSession()

    def work(own, number):
        own.conf.set(KEY, str(number))
        both.wait()  # neither goes on before the other is there
        assert own.conf.get(KEY) == str(number)
        return own.range(number).count()

    assert side_by_side(spark, work, [3, 5]) == [3, 5]
    assert side_by_side(spark, lambda own, n: n, list(range(9)), at_once=2) == list(range(9))
    assert side_by_side(spark, work, []) == []
    assert spark.getActiveSession() is active


def test_errors_come_through_when_all_have_ended(spark):
    ended = []

    def work(own, number):
        if number == 1:
            raise ValueError("one")
        ended.append(own.range(number).count())

    with pytest.raises(ValueError, match="one"):
        side_by_side(spark, work, [1, 2, 3])
    assert sorted(ended) == [2, 3]
