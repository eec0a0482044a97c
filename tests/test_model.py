"""Whole checks and merges against a plain Python model on random small feeds."""

import datetime as dt
import random
from collections import Counter

import pytest

from feedwright.limits import Limits
from feedwright.operators.lookups import Lookup
from feedwright.operators.merge import append_distinct, replace_range, upsert
from feedwright.plans.enriching import clean_rows, judge, judged_errors
from feedwright.plans.spec import FeedSpec, LookupSpec, dates

NAMES = ("item", "store", "day", "units")
SPEC = FeedSpec(
    "sales",
    "/Raw/sales*.csv",
    4,
    "range",
    NAMES,
    before=dates(("yyyy-M-d",), "day"),
    keys=("item", "store", "day"),
    date_keys=("day",),
    lookups=(LookupSpec("item", "items", "id"), LookupSpec("store", "stores", "id")),
    range_date="day",
)


def random_feed(rng, n):
    days = ["2017-01-07", "2017-1-14", "2017-01-21", "2017-02-30", "", None]
    # A third of the rows share one key.
    items = ["i1"] * 6 + ["i2", "i3", "i9", "0", "", None]
    stores = ["s1", "s1", "s2", "s9", None]
    return [(rng.choice(items), rng.choice(stores), rng.choice(days), rng.choice("123")) for _ in range(n)]


def conformed(row):
    item, store, day, units = row
    try:
        day = dt.datetime.strptime(day or "", "%Y-%m-%d").strftime("%m/%d/%Y")
    except ValueError:
        day = "Unparceable"
    return item, store, day, units


def model(feed, items, stores):
    rows = [conformed(r) for r in feed]
    bad = [r for r in rows if any(k in (None, "", "0") for k in r[:3]) or r[2] == "Unparceable"]
    good = [r for r in rows if r not in bad]
    clean = [r for r in good if r[0] in items and r[1] in stores]
    failed = [("item", r) for r in {r for r in good if r[0] not in items}]
    failed += [("store", r) for r in {r for r in good if r[1] not in stores}]
    return bad, clean, failed


def line(row):
    return ",".join("null" if v is None else v for v in row)


@pytest.mark.parametrize("seed, limits", [(1, Limits()), (2, Limits(rows=0, hot_share=3)), (3, Limits(rows=1))])
def test_judged_feed_matches_the_model(text, seed, limits):
    rng = random.Random(seed)
    feed = random_feed(rng, 120)
    items, stores = {"i1", "i2", "i3"}, {"s1", "s2"}
    lookups = [
        Lookup("item", text(["id"], [(i,) for i in items] * 2), "id"),
        Lookup("store", text(["id"], [(s,) for s in stores] + [(None,)]), "id"),
    ]
    judged = judge(text(NAMES, feed), SPEC, lookups, limits)
    bad, clean, failed = model(feed, items, stores)
    assert judged.count() == len(feed)
    assert Counter(map(tuple, clean_rows(judged, SPEC, lookups).collect())) == Counter(clean)
    want = Counter(("Columns: item,store,day is not proper(null/blank/0/Unparceable)", line(r)) for r in bad)
    want += Counter((f"Refrential Integrity failed at column: {c}", line(r)) for c, r in failed)
    errors = judged_errors(judged, SPEC, lookups).collect()
    assert Counter((r["Error_Description"], r["Error_Record"]) for r in errors) == want


@pytest.mark.parametrize("seed", [4, 5])
def test_merges_match_the_model_and_repeat(text, seed):
    rng = random.Random(seed)
    days = ["01/07/2017", "01/14/2017", "01/21/2017", "01/28/2017", "Unparceable", None]
    history = [(str(i), rng.choice(days)) for i in range(30)]
    clean = [(str(i), rng.choice(days[1:3])) for i in range(20, 40)]
    h, c = text(["k", "day"], history), text(["k", "day"], clean)

    appended = append_distinct(h, c)
    assert set(map(tuple, appended.collect())) == set(history) | set(clean)

    keys = {k for k, _ in clean}
    want = {r for r in history if r[0] not in keys} | set(clean)
    once = upsert(h, c, ["k"])
    assert set(map(tuple, once.collect())) == want
    assert set(map(tuple, upsert(once, c, ["k"]).collect())) == want

    lo, hi = min(d for _, d in clean), max(d for _, d in clean)
    want = {r for r in history if r[1] not in days[:4] or r[1] < lo or r[1] > hi} | set(clean)
    for distinct in (True, False):
        once = replace_range(h, c, SPEC.day(), distinct=distinct)
        assert Counter(map(tuple, once.collect())) == Counter(want)
    assert set(map(tuple, replace_range(once, c, SPEC.day()).collect())) == want
