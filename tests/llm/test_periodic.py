import hashlib
import random
import zlib

import pytest

from tests.llm import cases
from vigil.llm import periodic


def brute_runs(w):
    """All maximal stretches of at least 12 words and two smallest periods."""
    least = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                least.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in least.items())


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def hard_words(rng):
    kind = rng.randrange(6)
    n = rng.randrange(0, 120)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n + [rng.choice("ab") for _ in range(rng.randrange(9))] + ["a"] * n
    if kind == 2:
        x = [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
        return (x * 9)[:n] + [rng.choice("abc")] + (x * 9)[:n]
    if kind == 3:  # Fibonacci words have many runs
        x, y = ["a"], ["a", "b"]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    if kind == 4:
        x = [rng.choice("abcd") for _ in range(rng.randrange(1, 12))]
        y = x * rng.randrange(1, 5) + [rng.choice("abcd")]
        return (y * rng.randrange(1, 6))[:150]
    return [str(rng.randrange(200)) for _ in range(n)]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        texts = [hard_words(rng) for _ in range(rng.randrange(0, 12))]
        want = [brute_runs(w) for w in texts]
        assert periodic.find_runs(texts) == want
        assert periodic.find_runs(texts, exact=True) == want
        for w, r in zip(texts, want):
            assert periodic.collapse(w, r) == brute_collapse(w, r)


def test_long_texts_in_small_steps(monkeypatch):
    monkeypatch.setattr(periodic, "STEP", 64)
    rng = random.Random(6)
    x = [str(rng.randrange(50)) for _ in range(300)]
    texts = [x * 3 + ["end"] + x[:200] * 2, ["a"] * 1500, ["a", "b"] * 400 + ["a", "a", "b"] * 200, [], ["z"] * 11, ["z"] * 12]
    assert periodic.find_runs(texts) == [brute_runs(w) for w in texts]


def test_one_word_many_times_is_one_run():
    assert periodic.find_runs([["a"] * 300_000]) == [[(0, 300_000, 1)]]


def test_fingerprints_that_collide_are_told_apart_by_the_words(monkeypatch):
    monkeypatch.setattr(periodic, "hash", lambda w: len(w), raising=False)
    rng = random.Random(7)
    texts = [hard_words(rng) for _ in range(30)]
    assert periodic.find_runs(texts) == [brute_runs(w) for w in texts]


def contract(doc, text):
    w = cases.space_words(text)
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(brute_collapse(w, runs))))


def test_report_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [r for r in cases.invented() if len(r[1] or "") < 8000]
    rows += [(1000 + i, " ".join(hard_words(rng)), None, None, 0, "x", 1, "y", 2, 3, 4) for i in range(150)]
    out = periodic.runs_report(spark.createDataFrame(rows, cases.DOC_SCHEMA))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in out.dtypes][1:6] == ["bigint"] * 5
    assert cases.bag(out.collect()) == cases.bag([contract(r[0], r[1]) for r in rows])


def test_spans_and_texts_of_the_operator(spark):
    rows = [(1, "x " + "a\tb " * 9 + "y"), (2, None), (3, " \n"), (4, "naïve one " * 12)]
    out = {r["doc_id"]: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in out[1]["runs"]] == [(1, 18, 2)] and out[1]["collapsed"] == "x a b y"
    assert out[2]["n_words"] == 0 and out[2]["runs"] == [] and out[2]["collapsed"] == "" and out[3]["collapsed"] == ""
    assert out[4]["n_words"] == 12 and out[4]["collapsed"] == "naïve one"


@pytest.mark.parametrize("schema", ["doc_id long, text string", "doc_id string, text string"])
def test_empty_table(spark, schema):
    assert periodic.runs_report(spark.createDataFrame([], schema)).collect() == []
