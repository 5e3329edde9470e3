"""The catalogs against totals that were counted by hand from their source."""

from __future__ import annotations

from campuslake.sources import catalogs as cat


def test_grade_scales():
    assert {k: len(b) for k, (_, b) in cat.SCALES.items()} == {"standard40": 4, "pku40": 9, "improved40v1": 3, "improved40v2": 3, "canada43": 9, "ustc43": 12, "wes40": 3}
    assert sum(p for _, b in cat.SCALES.values() for _, p in b) == 100 + 235 + 90 + 90 + 270 + 308 + 90
    assert cat.SCALE_NAMES.keys() == cat.SCALES.keys()


def test_costs():
    assert [sum(c[k] for c in cat.COUNTRIES) for k in (5, 6)] == [5300, 38000] and round(sum(c[4] for c in cat.COUNTRIES), 2) == 22.52
    assert len(cat.CITIES) == 7 and round(sum(c[4] for c in cat.CITIES), 1) == 8.1 and sum(c[5] for c in cat.CITIES) == 15200
    assert len(cat.DEGREES) == 16 and sum(d[2] for d in cat.DEGREES) == 791200 and sum(d[3] for d in cat.DEGREES) == 946200 and sum(d[4] for d in cat.DEGREES) == 42.5
    assert [sum(a[2] for a in cat.ACCOMMODATIONS), len(cat.DEGREE_TYPES), len(cat.SCHOOL_TYPES)] == [3.3, 4, 3]


def test_schools_and_backgrounds():
    rows = cat.school_rows()
    assert len(rows) == 26 and [sum(r[4] == c for r in rows) for c in ("US", "UK", "HK")] == [11, 9, 6]
    assert round(sum(r[6] for r in rows), 1) == 93.3 and sum(r[7] or 0 for r in rows) == 1120 and all(len(r[9]) == 2 for r in rows)
    assert len(cat.BACKGROUNDS) == 20 and round(sum(a for _, a in cat.BACKGROUNDS), 2) == 0.95


def test_visas_and_timelines():
    items = cat.flat_visa_rows()
    assert {v: sum(r[1] == v for r in items) for v in ("us-f1", "us-j1", "uk-student", "au-500")} == {"us-f1": 17, "us-j1": 7, "uk-student": 11, "au-500": 11}
    assert len({r[4] for r in items}) == 46 and sum(v[7][2] for v in cat.VISAS) == 1340 + 1340 + 4500 + 3400
    assert [sum(r[0] == t for r in cat.TIMELINES) for t in ("US-undergrad", "US-master", "HK-master")] == [7, 4, 3]


def test_event_sites():
    assert len(cat.EVENT_SITES) == 14 and len({s[0] for s in cat.EVENT_SITES}) == 11 and sum(s[1] == "Conversion" for s in cat.EVENT_SITES) == 3
