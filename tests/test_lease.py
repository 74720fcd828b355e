import datetime as dt
import threading

import pytest
from landing import land

from logweir.operators.schedules import parse_schedules
from logweir.plans.collect import collect_history, collect_landed
from logweir.sources.lease import Lease, StoreBusy, writing
from logweir.sources.store import read_logs


class Clock:
    now = 1000.0

    def __call__(self):
        return self.now


def test_one_holder_release_expiry_and_takeover(spark, tmp_path):
    store, clock = str(tmp_path / "store"), Clock()
    with writing(spark, store, "one", 60, clock) as first:
        with pytest.raises(StoreBusy, match="held by one"):
            with writing(spark, store, "two", 60, clock):
                pass
        first.make_sure()
    with writing(spark, store, "two", 60, clock) as second:
        clock.now += 50
        second.make_sure()  # renewed: it lasts from now on
        clock.now += 50
        with pytest.raises(StoreBusy):
            Lease(spark, store, "three", 60, clock).take()
        clock.now += 20  # expired
        third = Lease(spark, store, "three", 60, clock)
        third.take()
        with pytest.raises(StoreBusy, match="two has lost"):
            second.make_sure()
    # The release of the one that lost it does not free the other's.
    with pytest.raises(StoreBusy, match="held by three"):
        Lease(spark, store, "four", 60, clock).take()
    third.make_sure()


def test_a_stale_listing_takes_nothing(spark, tmp_path):
    store, clock = str(tmp_path / "store"), Clock()
    slow = Lease(spark, store, "slow", 60, clock)
    for _ in range(3):
        with writing(spark, store, "quick", 60, clock):
            pass
    holder = Lease(spark, store, "holder", 60, clock)
    holder.take()
    seen = iter([[2]])
    numbers = slow._numbers
    slow._numbers = lambda: next(seen, None) or numbers()
    slow._read = lambda number: {"until": 0, "owner": "old", "token": None}
    with pytest.raises(StoreBusy):
        slow.take()
    assert numbers() == [4]
    holder.make_sure()


def test_two_jobs_at_once_give_one_set_of_rows(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    record = "@@@[2026/06/12 04:56:07.089][정보][A]|x|@@@\n"
    land(landed, "s", "/a.log", (record * 5).encode())
    line = "[s][ip][/a.log][주기|*|080000|1|235959]"
    due = parse_schedules(spark.createDataFrame([(line,)], "line string"))
    collect_landed(spark, store, landed, due.limit(0), dt.datetime(2026, 6, 12, 8))
    outcomes, together = [], threading.Barrier(2)

    def job(minute):
        together.wait()
        try:
            collect_landed(spark, store, landed, due, dt.datetime(2026, 6, 12, 9, minute))
            outcomes.append("done")
        except StoreBusy as refused:
            outcomes.append(str(refused))

    threads = [threading.Thread(target=job, args=(minute,)) for minute in (0, 1)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(o == "done" for o in outcomes) == [False, True]
    assert read_logs(spark, store).count() == 5
    assert collect_history(spark, store).count() == 1
