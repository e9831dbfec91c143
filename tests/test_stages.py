"""Intermediate tables: scopes of jobs that run at the same time, and what is handed out of one."""

import os
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest

from tallyroom.plans.stages import scratch_folder, stage_scope, staged, staged_together


def folders(spark) -> set[str]:
    folder = scratch_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("tallyroom-stage-")}


def test_jobs_in_two_threads_keep_their_own_tables(spark):
    before, opened, closed = folders(spark), Barrier(2), Barrier(2)

    def first():
        with stage_scope(spark):
            opened.wait()
            kept = staged(spark.range(5))
            closed.wait()  # the other job has ended
            return kept.count()

    def second():
        with stage_scope(spark):
            opened.wait()
            n = staged_together(a=spark.range(3), b=spark.range(4))["b"].count()
        closed.wait()
        return n

    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(first), pool.submit(second)]
        assert [job.result(timeout=60) for job in jobs] == [5, 4]
    assert folders(spark) == before


def test_tables_staged_together_go_with_the_scope_around_them(spark):
    before = folders(spark)
    with stage_scope(spark):
        staged_together(a=spark.range(3), b=spark.range(4))
        assert len(folders(spark) - before) == 2
    assert folders(spark) == before


def test_a_released_table_outlives_its_scope(spark):
    before = folders(spark)
    with stage_scope(spark):
        with stage_scope(spark) as inner:
            staged(spark.range(1))
            kept = staged(spark.range(7))
            inner.released()
        assert kept.count() == 7 and len(folders(spark) - before) == 1
    assert folders(spark) == before


def test_a_failed_job_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), stage_scope(spark):
        staged(spark.range(1))
        raise ZeroDivisionError
    assert folders(spark) == before
