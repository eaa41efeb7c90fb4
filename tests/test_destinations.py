"""The seven-level fallback against a row-by-row evaluation in plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, as_set
from totelane.functions import fixed
from totelane.operators.destinations import tote_destinations
from totelane.operators.measures import hot_items, measure
from totelane.operators.picks import hot_transactions, pick_locations
from totelane.operators.routes import planned_routes, tote_routes, tote_zone_sets, tote_zones
from totelane.operators.zones import ZoneLookup, location_zone_map
from totelane.settings import PUTAWAY, SINGLE, RouterSettings, SkewSettings

BOTH = (SINGLE, PUTAWAY)
NO_SPLITS = SkewSettings(min_rows=10**9)
SPLIT_ALL = SkewSettings(min_rows=0)
NO_BROADCAST = SkewSettings(min_rows=0, broadcast_rows=0)


def canonical(text):
    return None if text is None else text.strip().upper()


def by_hand(rows, states):
    """Every combination of joined rows, as the seven-way outer join defines it."""

    def matches(table, at, wanted):
        if wanted is None:
            return []
        return [row for row in rows[table] if canonical(row[at]) == wanted]

    def pick_rule(location):
        if location is None:
            return None
        if location[:2] in fixed.NONCON_AREAS:
            return "NC"
        if "1UA" <= location[:3] <= "1XG":
            return location
        return "NC" if "00" <= location[:2] <= "99" else location

    picks = {t[0] for t in rows["trans"] if canonical(t[1]) == "PICK"}
    found = set()
    for tote, item in rows["tote_detail"]:
        tote, item = canonical(tote), canonical(item)
        if tote is None:
            continue
        lines = [r for r in matches("trans_detail", 1, item) if r[0] in picks and item > ""]
        level1 = {pick_rule(canonical(r[2])) for r in lines} or {None}

        def moves(kind, wanted, at):
            hits = matches("trans", 2, wanted) if wanted else []
            return {canonical(r[at]) for r in hits if canonical(r[1]) == kind} or {None}

        statuses = {canonical(r[1]) for r in matches("orders", 0, item)} or {None}
        levels = [
            level1,
            moves("REPL", tote, 3),
            moves("PUTAWAY", tote, 4),
            moves("PUTAWAY", item, 4),
            {canonical(r[1]) for r in matches("multi_home_loc", 0, item)} or {None},
            {s and ("PACKING" if s == "PICKED" else "NC") for s in statuses},
            {"HOSPITAL"},
        ]

        def combine(level, tote=tote, item=item, levels=levels):
            for value in levels[level]:
                if value is None:
                    combine(level + 1)
                else:
                    state = SINGLE if level == 0 else PUTAWAY
                    if state in states:
                        found.add((tote, item, state, level + 1, value))

        combine(0)
    return found


def random_rows(seed):
    rng = random.Random(seed)
    totes = ["T1", "t2 ", "T3", " T4", "T", None]
    items = ["O1", "o2", "O3 ", "P1", "P2", ""]
    places = ["1UA-01", "1vb-02", "MZ-1", "mz-2", "RANDOM", "ww-9", "packing", None, None, "10-1"]

    def some(n, *choices):
        return [tuple(rng.choice(c) for c in choices) for _ in range(n)]

    return {
        "tote_detail": some(14, totes, items),
        "trans": some(
            18,
            list(range(8)),
            ["pick", "PICK ", "repl", "putaway", "other"],
            [t for t in totes if t] + items,
            places,
            places,
        ),
        "trans_detail": some(14, list(range(8)), items, places),
        "orders": some(4, items, ["picked", "Picked ", "open", None]),
        "multi_home_loc": some(3, items, places),
        "zone": [("AA", 1), ("ab", 1), ("AC", 0), ("Hospital", 1), ("fb", 1)],
        "zone_locations": [
            ("MZ-1", "AA"), ("mz-1 ", "AB"), ("MZ-1", "AC"), ("MZ-2", "AC"),
            ("HOSPITAL", "Hospital"), ("NC", "FB"),
        ],
    }


def destinations(wh, states, skew):
    return tote_destinations(
        wh, states, hot_transactions(wh, skew), hot_items(wh, states, skew), skew
    )


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("skew", [NO_SPLITS, SPLIT_ALL], ids=["plain", "split"])
def test_destinations_match_row_by_row(warehouse, seed, skew):
    rows = random_rows(seed)
    found = destinations(warehouse(**rows), BOTH, skew)
    assert as_set(found) == by_hand(rows, BOTH)


@pytest.mark.parametrize("states", [(SINGLE,), (PUTAWAY,), BOTH], ids="-".join)
@pytest.mark.parametrize("skew", [NO_SPLITS, SPLIT_ALL, NO_BROADCAST], ids=["plain", "split", "shuffled"])
@pytest.mark.parametrize("seed", range(2))
def test_zones_match_destinations(warehouse, states, skew, seed):
    """Zones computed level by level before the join equal those of the located rows."""
    rows = random_rows(100 + seed)
    wh = warehouse(**rows)
    zone_of = {"MZ-1": "AB", "HOSPITAL": "Hospital", "NC": "FB", "PACKING": "Packing",
               "1UA-01": "FB", "1VB-02": "FD"}
    expected = set()
    for tote, _, _, _, location in by_hand(rows, states):
        expected.add((tote, "?" if location == "RANDOM" else zone_of.get(location, "NC")))
    settings = RouterSettings(AS_OF, states=states, skew=skew)
    sets = tote_zone_sets(wh, settings, measure(wh, settings))
    found = as_set(tote_zones(sets))
    spread = {(t, "?" if z in fixed.SPREAD_ZONES else z) for t, z in found}
    assert spread == expected


def test_pick_locations_collapse_and_skip_blank_orders(warehouse):
    wh = warehouse(
        trans=[(1, "pick", None, None, None), (2, "PICK ", None, None, None), (3, "repl", "T1", "A", "B")],
        trans_detail=[
            (1, "O1", "ww-1"), (1, "o1", "XX-2"), (2, "O1 ", "10-1"), (2, "O1", "MZ-1"),
            (3, "O1", "MZ-2"), (1, "", "MZ-3"), (1, None, "MZ-4"), (1, "O2", None), (9, "O9", "MZ-1"),
        ],
    )
    assert as_set(pick_locations(wh, [])) == {("O1", "NC"), ("O1", "MZ-1"), ("O2", None)}


def test_zone_map_takes_the_last_picking_zone(warehouse):
    wh = warehouse(
        zone=[("AA", 1), ("ab", 1), ("ZZ", 0), ("jd", 1), ("XX", None)],
        zone_locations=[
            ("L1", "AA"), ("l1 ", "AB"), ("L1", "ZZ"), ("L2", "ZZ"), ("L3", "none"), ("L4", "JD "),
            ("L5", "XX"),
        ],
    )
    assert as_set(location_zone_map(wh, NO_SPLITS)) == {("L1", "AB"), ("L4", "JD")}


@pytest.mark.parametrize(
    ("zone", "listed", "planned"),
    [
        ("Hospital", "hospital", ("hospital", "hospital", 3, 0)),
        ("anc", "ANC", ("ANC", "A-", 3, 4)),
        ("HOSPITAL", "Hospital", ("Hospital", "-", 4, 4)),
    ],
)
def test_routes_spell_zones_as_listed(warehouse, spark, zone, listed, planned):
    """The rewriting rules look at the case of the listed zone."""
    wh = warehouse(
        tote_detail=[("T1", "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "MZ-1")],
        zone=[(zone, 1)],
        zone_locations=[("MZ-1", listed)],
    )
    settings = RouterSettings(AS_OF)
    sets = tote_zone_sets(wh, settings, measure(wh, settings))
    found = planned_routes(tote_routes(sets)).select("origroute", "route", "chute", "noncon")
    assert [tuple(r) for r in found.collect()] == [planned]


def test_one_zone_under_two_spellings_is_one_stop(warehouse):
    wh = warehouse(
        tote_detail=[("T1", "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "MZ-1"), (1, "O1", "MZ-2"), (1, "O1", "1UA-1")],
        zone=[("fb", 1)],
        zone_locations=[("MZ-1", "fb"), ("MZ-2", "Fb")],
    )
    settings = RouterSettings(AS_OF)
    sets = tote_zone_sets(wh, settings, measure(wh, settings))
    assert [r["zones"] for r in sets.collect()] == [["FB"]]


def test_zone_lookup_keeps_rows_without_location(warehouse, spark):
    wh = warehouse(zone=[("AA", 1)], zone_locations=[("L1", "AA")])
    rows = spark.createDataFrame([(1, "L1"), (2, "L2"), (3, None), (4, "RANDOM")], "n int, location_key string")
    for skew in (NO_SPLITS, NO_BROADCAST):
        found = ZoneLookup(wh, skew).add_to(rows).select("n", "zone", "spread")
        assert as_set(found) == {(1, "AA", False), (2, "NC", False), (3, None, False), (4, None, True)}


def test_states_are_checked():
    with pytest.raises(ValueError):
        RouterSettings(AS_OF, states=("OTHER",))
    with pytest.raises(ValueError):
        RouterSettings(AS_OF, states=())
    with pytest.raises(ValueError):
        RouterSettings(AS_OF, random_mode="dice")


def test_one_tote_under_two_spellings_is_one_tote(warehouse):
    wh = warehouse(
        tote_detail=[("t1 ", "O1"), ("T1", "O2")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1"), (1, "O2", "1VB-1"), (1, "O2", "1UA-2")],
    )
    settings = RouterSettings(AS_OF)
    sets = tote_zone_sets(wh, settings, measure(wh, settings))
    rows = sets.select("tote_key", "tote_id", F.array_join("zones", "-")).collect()
    assert [tuple(r) for r in rows] == [("T1", "T1", "FB-FD")]
