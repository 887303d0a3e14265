"""Families of near copies in the set join: exact links from differences to a leader."""

import random

import pytest

from tests.llm import cases
from tests.llm.test_near_duplicates import brute, scattered
from vigil.llm import families, setjoin


def family(seed, copies, words=150, most=12, base=None):
    """Copies of one text with one to ``most`` words changed, at random or as another copy did."""
    rng = random.Random(seed)
    base = base or ["f%d-%d" % (seed, i) for i in range(words)]
    out = [base]
    for _ in range(copies):
        w = list(rng.choice(out) if rng.random() < 0.3 else base)
        for at in rng.sample(range(len(w)), rng.randrange(1, most)):
            w[at] = "new%d" % rng.randrange(50 if rng.random() < 0.3 else 10 ** 6)
        out.append(w)
    return [" ".join(w) for w in out]


def drift(n, words=120):
    w = ["d%d" % i for i in range(words)]
    out = []
    for k in range(n):
        out.append(" ".join(w))
        w = list(w)
        w[(k * 7) % words] = "step%d" % k
    return out


def frame(spark, texts, seed=0):
    rows = list(enumerate(texts))
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame([(*r, *([None] * 9)) for r in rows], cases.DOC_SCHEMA)


def agree(spark, texts, rule):
    groups = brute(list(enumerate(texts)), rule.num, rule.den, rule.shingle)
    least = {}
    for i, g in enumerate(groups):
        least.setdefault(g, i)
    got = {r["doc_id"]: r["component_id"] for r in setjoin.jaccard_components(frame(spark, texts), rule=rule).collect()}
    assert got == {i: least[g] for i, g in enumerate(groups)}
    return len(least)


@pytest.mark.parametrize("rule", [setjoin.Rule(), setjoin.Rule(2, 60, 100)])
def test_families_equal_brute_force(spark, monkeypatch, rule):
    monkeypatch.setattr(families, "LONG", 2)
    monkeypatch.setattr(families, "BLOCK", 3)
    monkeypatch.setattr(setjoin, "HOT", 3)
    texts = family(1, 70) + family(2, 40, words=30, most=6) + drift(60) + [t for _, t in scattered()]
    shared = family(3, 1, words=60)[0]
    texts += [shared + " " + " ".join("own%d-%d" % (i, j) for j in range(12)) for i in range(20)]
    assert agree(spark, texts, rule) > 10


def test_a_prefix_longer_than_the_head_is_kept(spark, monkeypatch):
    """A rule of 60 / 100 looks further into a set than the least head."""
    monkeypatch.setattr(setjoin, "WHOLE", 16)
    rng = random.Random(3)
    texts = []
    for f in range(6):
        base = ["p%d-%d" % (f, i) for i in range(400)]
        texts.append(" ".join(base))
        for k in (20, 60, 100, 140):
            w = list(base)
            for at in rng.sample(range(400), k):
                w[at] = "q%d" % rng.randrange(10 ** 6)
            texts.append(" ".join(w))
    agree(spark, texts, setjoin.Rule(1, 60, 100))


def exploded(spark, monkeypatch, texts, rule=setjoin.Rule()):
    """Candidate rows of the index lists that the join lists for ``texts``."""
    rows = []
    for module, name in ((setjoin, "_meet"), (families, "_candidates")):
        def counted(*a, f=getattr(module, name)):
            out = f(*a)
            rows.append(out.count())
            return out
        monkeypatch.setattr(module, name, counted)
    setjoin.jaccard_components(frame(spark, texts), rule=rule).collect()
    return sum(rows)


def test_candidates_grow_with_a_family_not_with_its_square(spark, monkeypatch):
    assert exploded(spark, monkeypatch, family(5, 800)) < 5 * 800
    assert exploded(spark, monkeypatch, drift(600)) < 20 * 600
