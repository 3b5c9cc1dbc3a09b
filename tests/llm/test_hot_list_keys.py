"""The temporal list join with a key that holds most captures."""

from __future__ import annotations

import collections
import datetime
import random

import pytest

from caudal.llm import listjoin
from caudal.llm.common import ship_package


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


def test_a_key_that_holds_most_captures(llm):
    """A hot key is dealt by hours and groups, and gives what going through all entries in order gives."""
    random.seed(11)
    minute = lambda: datetime.datetime(2024, 1, random.choice((30, 31)), random.randrange(24), random.randrange(60))
    entries = [("com", random.choice(("block", "allow", "withdraw")), minute() - datetime.timedelta(days=random.choice((0, 0, 40))), i) for i in range(300)]
    entries += [(f"h{i % 7}.com", random.choice(("block", "allow", "withdraw")), minute(), 1000 + i) for i in range(40)]
    captures = [(f"http://h{i % 50}.com/x", minute()) for i in range(2000)] + [("http://h.org/", minute()) for _ in range(50)]
    rows = llm.createDataFrame(captures, "url string, fetched_at timestamp").repartition(3)
    said = llm.createDataFrame(entries, "key string, action string, day timestamp, nth int")
    found = collections.Counter((r.url, r.fetched_at, r.blocked, r.list_key, r.list_since) for r in listjoin.judge(rows, said).collect())
    wanted = collections.Counter()
    for url, at in captures:
        host, best = url.split("/")[2], (False, None, None)
        for key in ("com", host):
            held = max(((t, nth, action) for k, action, t, nth in entries if k == key and t <= at), default=None)
            if held and held[2] != "withdraw" and (host == key or host.endswith("." + key)):
                best = (held[2] == "block", key, held[0])
        wanted[url, at, *best] += 1
    assert found == wanted
    # Suffixes that no list names never meet the entries: the keys asked for are joined with those listed first.
    plan = listjoin.judge(rows, said)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
