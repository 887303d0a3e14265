"""Hemicycle seat layout: ring geometry, seat numbering, colours, runs.

A ring with ``n_seats`` seats and corridor positions C spreads
``n_seats + |C|`` positions over the half circle (minus ``angle_offset`` at
both ends); corridor positions stay empty. Position p sits at angle
``p * (pi - 2*offset) / (1 + n_seats + |C|) + offset`` on radius ``distance``.
Seat numbers run ring by ring, inside a ring by position, computed in closed
form (ring offset + position − corridors before it) rather than by a global
window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField,
                               StructType)

from vigil.operators.lookup import map_with_default
from vigil.operators.sequence import ordered_index, runs

# The six rings of the 230-seat chamber
# (ring, n_seats, distance, corridor positions), common angle offset pi/20.
RINGS = [
    (1, 24, 3.8, [6, 14, 22]),
    (2, 30, 4.6, [7, 17, 27]),
    (3, 36, 5.4, [7, 20, 33]),
    (4, 38, 6.4, [5, 9, 14, 19, 24, 29, 34, 39, 43]),
    (5, 46, 7.2, [5, 10, 16, 22, 28, 34, 40, 46, 51]),
    (6, 56, 8.0, [6, 12, 19, 26, 33, 40, 47, 54, 60]),
]
ANGLE_OFFSET = math.pi / 20

# Party colours of the seat map.
PARTY_COLORS = {
    "PS": "#F74B71", "PSD": "#F28C26", "CH": "#202056", "IL": "#00AFF1",
    "PCP": "#DB241C", "BE": "#000000", "PAN": "#0A6580", "L": "#77BD4A",
}

RING_SCHEMA = StructType([
    StructField("ring", IntegerType(), False),
    StructField("n_seats", IntegerType(), False),
    StructField("distance", DoubleType(), False),
    StructField("corridors", ArrayType(IntegerType()), False),
    StructField("angle_offset", DoubleType(), False),
    StructField("seat_offset", IntegerType(), False),
])


def rings_frame(spark: SparkSession, rings=RINGS, angle_offset: float = ANGLE_OFFSET) -> DataFrame:
    """Ring configuration with ``seat_offset`` = seats in the rings before it
    (the configuration is a handful of rows, so offsets are computed here
    rather than by a window over the whole table)."""
    rows, before = [], 0
    for r, n, d, c in sorted(rings):
        rows.append((r, n, d, list(c), angle_offset, before))
        before += n
    return spark.createDataFrame(rows, RING_SCHEMA)


def ring_seats(rings: DataFrame) -> DataFrame:
    """(ring, position, seat_nmr, seat_x, seat_y) for every seat of every ring."""
    r = rings.withColumn("_before", F.col("seat_offset"))
    slots = F.col("n_seats") + F.size("corridors")
    pos = (r.withColumn("position", F.explode(F.sequence(F.lit(1), slots)))
             .where(~F.array_contains("corridors", F.col("position"))))
    angle = ((F.lit(math.pi) - 2 * F.col("angle_offset")) / (1 + slots)) * F.col("position") \
        + F.col("angle_offset")
    return pos.select(
        "ring", "position",
        (F.col("_before") + F.col("position")
         - F.size(F.filter("corridors", lambda c: c < F.col("position")))).cast("int").alias("seat_nmr"),
        (F.col("distance") * F.cos(angle)).alias("seat_x"),
        (F.col("distance") * F.sin(angle)).alias("seat_y"))


def ring_coordinates(spark: SparkSession, n_seats: int, distance: float, corridors: list[int],
                     angle_offset: float = 0.0) -> DataFrame:
    """(position, seat_x, seat_y) of one ring, seats in position order."""
    one = rings_frame(spark, [(1, n_seats, float(distance), list(corridors))], angle_offset)
    return ring_seats(one).select("position", "seat_x", "seat_y")


def color_seats(seats: DataFrame, party_col: str = "party", colors=PARTY_COLORS,
                default=None) -> DataFrame:
    """Colour per party; unknown parties get ``default`` (NULL by default)."""
    return seats.withColumn("color", map_with_default(party_col, colors, default))


def seat_map(seats: DataFrame, rings: DataFrame, party_col: str = "party", colors=PARTY_COLORS,
             default=None) -> DataFrame:
    """Seat table with colour and coordinates: seats are matched to the ring
    layout by seat number (an explicit key instead of list position). The
    layout has a fixed number of seats, so it is broadcast."""
    tpl = F.broadcast(ring_seats(rings).select("seat_nmr", "seat_x", "seat_y"))
    return color_seats(seats, party_col, colors, default).join(tpl, "seat_nmr", "left")


def assign_seats(members: DataFrame, template: DataFrame, group: list[str],
                 order: list[str]) -> DataFrame:
    """Give each member of a group the next seat of the template, in order.

    Members beyond the template's capacity continue in a further block of the
    same layout (``block`` 0, 1, ...). The template is the fixed-size seat
    table, so broadcasting it is bounded by construction.
    """
    cap = template.count()
    seq = ordered_index(members, group, order, "_seq")
    t = F.broadcast(template.select("seat_nmr", "ring", "seat_x", "seat_y"))
    return (seq.withColumn("block", ((F.col("_seq") - 1) / cap).cast("long"))
               .withColumn("seat_nmr", (((F.col("_seq") - 1) % cap) + 1).cast("int"))
               .join(t, "seat_nmr")
               .drop("_seq"))


def party_runs(seats: DataFrame, group: list[str], order: list[str],
               party_col: str = "party") -> DataFrame:
    """Consecutive seats of one party as runs (start seat, end seat, length).
    The final run is its own run even when the party changes on the last seat."""
    return runs(seats, group, order, party_col)
