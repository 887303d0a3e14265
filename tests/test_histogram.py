"""Per-group equal-width histogram against numpy.histogram (10 bins)."""

import random

import numpy as np

from vigil.operators.histogram import group_histogram


def test_matches_numpy(spark):
    rnd = random.Random(3)
    data = []
    groups = {"A": lambda: rnd.randint(0, 7), "B": lambda: rnd.randint(1, 3), "C": lambda: 4,
              "D": lambda: rnd.choice([0, 13, 5, 7, 2]), "E": lambda: rnd.randint(0, 100)}
    for g, f in groups.items():
        for _ in range(rnd.randint(5, 60)):
            data.append((g, f()))
    df = spark.createDataFrame(data, "party string, number_authors int")
    got = {}
    for r in group_histogram(df, "party", "number_authors", 10).collect():
        got.setdefault(r.party, [0] * 10)[r.bin - 1] = r["count"]
    for g in groups:
        vals = [v for p, v in data if p == g]
        ref, _edges = np.histogram(vals, bins=10)
        assert got[g] == list(ref), g
