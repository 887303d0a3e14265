"""The near-duplicate stage: five-word shingles at 0.8, against brute force."""

import random

import pytest

import corpus_pipeline as P
from tests.conftest import SF_SMOKE
from tests.llm import cases
from vigil.llm import setjoin


def shingles(text, n=5):
    w = cases.space_words(cases.ascii_lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, num=80, den=100, n=5):
    """Group numbers of rows; rows without words stand alone."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and den * len(s & sets[j]) >= num * len(s | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def table(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def scattered(seed=0, copies=40):
    """Documents of 200 words and copies with one to ten words changed."""
    rng = random.Random(seed)
    rows = []
    for d in range(6):
        base = ["b%d-%d" % (d, i) for i in range(200)]
        for k in range(copies // 6):
            w = list(base)
            for at in rng.sample(range(200), 1 + (k + d) % 10):
                w[at] = "new%d" % rng.randrange(10 ** 6)
            rows.append((1000 * k + d, " ".join(w)))
    return rows


def test_copies_between_the_two_rules_go(spark):
    base = ["w%d" % i for i in range(200)]
    near = list(base)
    for at in (20, 70, 120, 170):
        near[at] = "x%d" % at
    a, b = " ".join(base), " ".join(near)
    assert len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) >= 0.8
    assert len(shingles(a, 3) & shingles(b, 3)) / len(shingles(a, 3) | shingles(b, 3)) < 0.9
    kept = P.one_per_group(spark, table(spark, [(2, b), (1, a)]), SF_SMOKE).collect()
    assert [r["doc_id"] for r in kept] == [1]


@pytest.mark.parametrize("hot", [2, 16])
def test_stage_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(setjoin, "HOT", hot)
    base = ["t%d" % i for i in range(260)]
    rows = scattered() + [(9000 + i, " ".join(base[i:i + 120])) for i in range(0, 100, 6)]
    rows += [(20_000 + i, r[1]) for i, r in enumerate(cases.invented(2))]
    groups, least = brute(rows), {}
    for (d, _), g in zip(rows, groups):
        least[g] = min(d, least.get(g, d))
    assert len({g for g in groups}) != len({g for g in brute(rows, 90, 100, 3)})
    kept = P.one_per_group(spark, table(spark, rows), SF_SMOKE).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(least.values())


def test_a_doc_id_with_two_texts_leaves_a_row_of_each_group(spark):
    a, b = " ".join("a%d" % i for i in range(30)), " ".join("b%d" % i for i in range(30))
    rows = [(5, a), (9, a), (5, b), (3, b), (3, b), (3, "c d e"), (7, None), (7, None), (None, a)]
    kept = P.one_per_group(spark, table(spark, rows), SF_SMOKE).select("doc_id", "text").collect()
    assert cases.bag(kept) == cases.bag([(5, a), (3, b), (3, "c d e"), (7, None), (7, None), (None, a)])


def test_classes_are_one_scan_and_one_join(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "e f g h"), (None, "e f g h"), (3, "x y z"), (4, "")]
    w = setjoin._Work(table(spark, rows), "doc_id", "text", setjoin.Rule())
    plan = w.classes._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Union" not in plan and plan.count("Scan parquet") == 2  # the sets and the list of copies
    got = [r["c"] for r in w.classes.collect()]
    assert len(got) == len(set(got)) == 3
