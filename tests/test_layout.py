"""Seat layout golden values and run detection."""

import math

from pyspark.sql import functions as F

from vigil.operators.layout import (PARTY_COLORS, color_seats, party_runs, ring_seats,
                                    rings_frame)

# an invented chamber of 230 seats, as a rule: seat -> party
def _party(seat):
    if seat == 230:
        return "PAN"
    return ["PS", "PSD", "CH"][(seat - 1) // 40 % 3] if seat <= 200 else "IL" if seat % 2 else "L"


def _seats(spark):
    return spark.createDataFrame([(i, _party(i)) for i in range(1, 231)], "seat_nmr int, party string")


def test_ring_geometry(spark):
    seats = ring_seats(rings_frame(spark)).orderBy("seat_nmr").collect()
    assert len(seats) == 230 and [s.seat_nmr for s in seats] == list(range(1, 231))
    assert seats[0].seat_x == 3.674170788271024 and seats[0].seat_y == 0.9697778192018411
    assert math.isclose(seats[-1].seat_x, -7.840660488739147, abs_tol=1e-12)
    assert math.isclose(seats[100].seat_x, 3.8627580285028573, abs_tol=1e-12)
    per_ring = {}
    for s in seats:
        per_ring[s.ring] = per_ring.get(s.ring, 0) + 1
    assert per_ring == {1: 24, 2: 30, 3: 36, 4: 38, 5: 46, 6: 56}


def test_party_counts_colors_and_runs(spark):
    seats = color_seats(_seats(spark))
    counts = {r.party: r["count"] for r in seats.groupBy("party").count().collect()}
    assert counts == {"PS": 80, "PSD": 80, "CH": 40, "IL": 15, "L": 14, "PAN": 1}
    assert all(r.color == PARTY_COLORS[r.party] for r in seats.select("party", "color").distinct().collect())
    runs = party_runs(seats.withColumn("chamber", F.lit(1)), ["chamber"], ["seat_nmr"]) \
        .orderBy("start_seq").collect()
    # five blocks of 40, then single seats
    assert [(r.party, r.n_rows) for r in runs[:5]] == [("PS", 40), ("PSD", 40), ("CH", 40), ("PS", 40), ("PSD", 40)]
    assert len(runs) == 35 and {r.n_rows for r in runs[5:]} == {1} and runs[-1].party == "PAN"
    assert runs[-1].end_seq == 230


def test_unknown_party_gets_null_color(spark):
    df = spark.createDataFrame([("XX",), ("PS",)], "party string")
    assert {r.party: r.color for r in color_seats(df).collect()} == {"XX": None, "PS": "#F74B71"}


def test_seat_map_joins_coordinates_by_number(spark):
    from vigil.operators.layout import seat_map
    m = {r.seat_nmr: r for r in seat_map(_seats(spark), rings_frame(spark)).collect()}
    assert len(m) == 230 and m[1].party == "PS" and m[1].color == PARTY_COLORS["PS"]
    assert m[1].seat_x == 3.674170788271024 and m[230].party == "PAN"


def test_lookup_join(spark):
    from vigil.operators.lookup import lookup_join
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", "A")], "k string, v string")
    got = {r.k: r.out for r in lookup_join(df, table, "k", "v", "out", default="?").collect()}
    assert got == {"a": "A", "b": "?", None: "?"}


def test_single_ring_coordinates(spark):
    import math as m
    from vigil.operators.layout import ring_coordinates
    rows = ring_coordinates(spark, 24, 3.8, [6, 14, 22], angle_offset=m.pi / 20).orderBy("position").collect()
    assert len(rows) == 24 and 6 not in [r.position for r in rows]
    assert rows[0].seat_x == 3.674170788271024
    plain = ring_coordinates(spark, 2, 1.0, []).orderBy("position").collect()
    assert [round(r.seat_x, 12) for r in plain] == [0.5, -0.5]


def test_landed_files_are_written_by_several_tasks(spark, monkeypatch):
    from tests.conftest import SF_SMOKE
    from vigil.plans import catalog
    from vigil.plans.tables import load
    n = load(spark, SF_SMOKE, "supplier").count()
    cls, dealt = type(spark.range(1)), []
    plain = cls.repartition
    monkeypatch.setattr(catalog, "FILES_PER_TASK", 3, raising=False)
    monkeypatch.setattr(cls, "repartition", lambda df, k, *c: (dealt.append(k), plain(df, k, *c))[1])
    assert catalog.q_landed_files(spark, SF_SMOKE).count() == n
    assert dealt == [1 + n // 3]
