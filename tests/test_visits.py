import random

import pytest

from rows import page, pages, values
from tidemart.operators import visits

DAY = 86_400_000


def test_entry_pages(spark):
    df = pages(spark, [page(ts=1), page(ts=2, last=""), page(ts=3, last="home")])
    assert values(visits.entry_pages(df), "ts") == [(1,), (2,)]


def test_unique_visitor_once_per_day_in_any_order(spark):
    rows = [page("a", DAY - 1), page("a", DAY), page("a", DAY + 5), page("a", 3 * DAY),
            page("a", 5), page("a", 2, last="home"), page("b", 7), page("b", 7, seq=3)]
    first = visits.unique_visitors(pages(spark, rows))
    assert values(first, "common.mid", "ts", "seq") == sorted(
        [("a", 5, 5), ("a", DAY, DAY), ("a", 3 * DAY, 3 * DAY), ("b", 7, 3)], key=repr)
    assert first.columns == pages(spark, rows).columns


def test_day_may_start_elsewhere(spark):
    rows = [page("a", 16 * 3_600_000 - 1), page("a", 16 * 3_600_000), page("a", DAY)]
    first = visits.unique_visitors(pages(spark, rows), day_start="16 hours")
    assert values(first, "ts") == [(16 * 3_600_000 - 1,), (16 * 3_600_000,)]


@pytest.mark.parametrize("gap, bounced", [(0, False), (9_999, False), (10_000, True),
                                          (10_001, True)])
@pytest.mark.parametrize("start", [0, 1, 9_999, 10_000, 15_000])
def test_jump_bounds(spark, start, gap, bounced):
    df = pages(spark, [page(ts=start), page(ts=start + gap, last="home", seq=start + gap + 1)])
    assert visits.user_jumps(df).count() == int(bounced)


def test_two_entries_and_one_page(spark):
    df = pages(spark, [page(ts=0), page(ts=4_000), page(ts=9_000, last="x"),
                       page("b", 0), page("b", 5_000), page("b", 12_000, last="x")])
    assert values(visits.user_jumps(df), "common.mid", "ts") == [("b", 0)]


def test_jumps_against_brute_force(spark):
    rng = random.Random(7)
    rows = [page(rng.choice("abc"), rng.randrange(400_000), rng.choice([None, "", "x"]), seq=i)
            for i in range(600)]
    want = sorted(
        (e["common"]["mid"], e["ts"], e["seq"]) for e in rows if not e["page"]["last_page_id"]
        and not any(f["page"]["last_page_id"] and f["common"]["mid"] == e["common"]["mid"]
                    and e["ts"] <= f["ts"] < e["ts"] + 7_000 for f in rows))
    jumps = visits.user_jumps(pages(spark, rows), "7 seconds")
    assert values(jumps, "common.mid", "ts", "seq") == sorted(want, key=repr)
