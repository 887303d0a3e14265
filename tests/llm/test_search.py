"""Substring removal, set join and url filter against brute force."""

import numpy as np
import pytest

from tests.llm import cases
from vigil.llm import components, setjoin, substrings, url_filter


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(cases.invented(), cases.DOC_SCHEMA)


def test_repeats_equal_brute_force(spark, docs):
    got = substrings.remove_repeats(docs).collect()
    want = cases.brute_repeats([r[:2] for r in cases.invented()])
    assert cases.bag(got) == cases.bag(want)
    assert sum(w[2] for w in want) > 300
    assert substrings.remove_repeats(spark.createDataFrame([], cases.DOC_SCHEMA)).count() == 0


def test_split_keys_give_the_same_repeats(spark, docs, monkeypatch):
    monkeypatch.setattr(substrings, "PART_WORDS", 120)
    want = cases.brute_repeats([r[:2] for r in cases.invented(3)])
    some = spark.createDataFrame(cases.invented(3), cases.DOC_SCHEMA)
    assert cases.bag(substrings.remove_repeats(some).collect()) == cases.bag(want)


def test_deep_nodes_are_equal_windows():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 2, 400)
    ends = np.array([100, 130, 400])
    at, rank = substrings.deep_nodes(words, ends, 7)
    assert len(at) == 94 + 24 + 264
    by = {}
    for a, r in zip(at, rank):
        by.setdefault(tuple(words[a:a + 7]), set()).add(r)
    assert all(len(v) == 1 for v in by.values()) and len(by) == len(set(rank))


def test_runs_put_equal_windows_under_one_key():
    rng = np.random.default_rng(0)
    shared = rng.integers(-2 ** 62, 2 ** 62, 60)
    a = np.concatenate([rng.integers(-2 ** 62, 2 ** 62, 31), shared])
    b = np.concatenate([shared, rng.integers(-2 ** 62, 2 ** 62, 17)])
    key = {}
    for text, first, last, k in zip(*substrings.runs(np.concatenate([a, b]), np.array([len(a), len(a) + len(b)]))):
        for i in range(first, last + 1):
            key[text, i] = k
    assert len(key) == len(a) - 49 + len(b) - 49
    assert all(key[0, 31 + i] == key[1, i] for i in range(11))


@pytest.mark.parametrize("seed", [1, 4])
def test_components_equal_brute_force(spark, seed):
    rows = cases.invented(seed)
    got = setjoin.jaccard_components(spark.createDataFrame(rows, cases.DOC_SCHEMA)).collect()
    assert cases.bag(got) == cases.bag(cases.brute_components([r[:2] for r in rows]))


def test_components_of_chains_and_gray_stars(spark, monkeypatch):
    """Sets that slide word by word: stars overlap in part, links run through members."""
    monkeypatch.setattr(setjoin, "HOT", 2)
    base = ["t%d" % i for i in range(260)]
    rows = [(100 - i, " ".join(base[i:i + 120]), *([None] * 9)) for i in range(0, 100, 3)]
    rows += [(500 + i, " ".join(base[2 * i:2 * i + 90][::-1]), *([None] * 9)) for i in range(0, 60, 5)]
    got = setjoin.jaccard_components(spark.createDataFrame(rows, cases.DOC_SCHEMA)).collect()
    want = cases.brute_components([r[:2] for r in rows])
    assert cases.bag(got) == cases.bag(want)


def test_components_empty(spark):
    assert setjoin.jaccard_components(spark.createDataFrame([], cases.DOC_SCHEMA)).count() == 0


def test_connected_components_of_a_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_components_joined_by_further_edges(spark):
    comp = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (9, 8), (8, 8)], "c long, component long")
    edges = spark.createDataFrame([(1, 2), (6, 9), (20, 21), (21, 22), (30, 2), (6, 5)], "a long, b long")
    got = {r["c"]: r["component"] for r in components.joined(comp, edges).collect()}
    assert got == {1: 1, 2: 1, 30: 1, 5: 5, 6: 5, 9: 5, 8: 5, 20: 20, 21: 20, 22: 20}
    assert components.joined(comp, edges.where("a = 1")).collect() == comp.collect()


def test_url_rules(spark):
    rows = [(1, "http://A.Example.NET/en/x?y#z"), (2, "https://b.net/q"), (3, "http://net"), (4, "http://x.org/fr/"), (5, None),
            (6, "no scheme"), (7, "http://example.com/de/1"), (8, "http://myexample.com/de/1"), (9, "ftp://h?x/y"), (2, "https://b.net/q"),
            (10, "http://shop.example.net/en"), (None, "http://a.org/fr/1")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, rule string")
    got = cases.bag(url_filter.filter_urls(df, url_filter.RULES).collect())
    want = [(1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "b.net", "/q", "net/", "block"), (3, "net", "", None, "allow"),
            (4, "x.org", "/fr/", "org/fr/", "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
            (7, "example.com", "/de/1", "example.com/de/", "block"), (8, "myexample.com", "/de/1", None, "allow"),
            (9, "h", "", None, "allow"), (2, "b.net", "/q", "net/", "block"), (10, "shop.example.net", "/en", "net/", "block"),
            (None, "a.org", "/fr/1", "org/fr/", "allow")]
    assert got == cases.bag(want)
    assert url_filter.filter_urls(df.where("false"), []).count() == 0


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    p = tmp_path / "x.bin"
    p.write_bytes(url_filter.build_index([("a.com", "/", "block"), ("b.com", "/", "allow")])[0])
    assert url_filter.DigestArray(str(p)).find(["b.com\n/", "c.com\n/", "a.com\n/"]) == ["allow", None, "block"]


def test_long_rule_lists_make_several_arrays(tmp_path):
    rules = [("d%d.org" % i, "/p%d" % (i % 7), ("block", "allow")[i % 2]) for i in range(300)] + [("org", "/", "block")]
    parts = url_filter.build_index(rules, part_bytes=500)
    assert len(parts) > 10
    arrays = []
    for i, payload in enumerate(parts):
        (tmp_path / f"{i}").write_bytes(payload)
        arrays.append(url_filter.DigestArray(str(tmp_path / f"{i}")))
    hosts, paths = ["x.d%d.org" % i for i in range(300)] + ["org", "a.net"], ["/p%d/z" % (i % 7) for i in range(300)] + ["/", "/"]
    got = url_filter.judge(arrays, hosts, paths)
    assert got[0] == ["d%d.org/p%d" % (i, i % 7) for i in range(300)] + ["org/", None]
    assert got[1] == [("block", "allow")[i % 2] for i in range(300)] + ["block", None]


def test_a_host_of_many_labels_is_probed_for_those_of_the_rules():
    host = ".".join("a" * 8000)
    assert url_filter.host_suffixes(host, [1, 2, 3]) == ["a", "a.a", "a.a.a"]
    assert url_filter.host_suffixes("b.org", [1, 2, 3]) == ["org", "b.org"] and url_filter.host_suffixes("", [1, 2]) == [""]


def test_a_foreign_file_of_the_same_name_is_not_mapped(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.tempfile, "tempdir", str(tmp_path))
    payload = url_filter.build_index([("a.com", "/", "block")])[0]
    url_filter.open_index(payload)
    (name,) = [p for p in tmp_path.iterdir()]
    name.write_bytes(b"other")
    assert url_filter.open_index(payload).find(["a.com\n/"]) == ["block"]
