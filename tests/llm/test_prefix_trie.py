import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_CHECK, SF_SMOKE
from tests.llm import cases
from vigil.llm import prefix_trie as trie
from vigil.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, c int, digest string, depth int, k1 long, `a.b` string"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), sha, (role, text)))
    convs = {c: [t for _, _, t in sorted(x)] for c, x in convs.items()}
    out = {}
    for c, x in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(convs.get(family, [])[:h] + x[h:])
    return out


def brute_nodes(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, x in convs.items():
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def hard_rows(seed=1):
    """Shared openings, equal conversations, one long one, negative ids, gaps, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in list(range(0, 60)) + [103, 104, 207, -7, -5, 10 ** 12]:
        n = rng.randrange(1, 12)
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "é è", "a longer text %d" % rng.randrange(3)])))
    for c in range(300, 340):  # equal ones
        rows += [(c, t, "user", "same %d" % t) for t in range(9)]
    rows += [(500, t, "user", "turn %d" % (t % 7)) for t in range(90)]
    rows += [(501, None, "user", "first"), (501, 3, "b", "tie"), (501, 3, "a", "tie"), (501, 3, "a", "tie"), (501, -1, None, None)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), rows[0], rows[5]]
    rng.shuffle(rows)
    return rows


def framed(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("subtree,portion,block,ids", [(4096, 200_000, 100_000, 4096), (20, 50, 7, 3), (0, 1, 1, 1)])
def test_nodes_equal_brute_force(spark, monkeypatch, subtree, portion, block, ids):
    for k, v in dict(SUBTREE=subtree, PORTION=portion, BLOCK=block, IDS=ids).items():
        monkeypatch.setattr(trie, k, v)
    rows = hard_rows()
    out = trie.trie_report(framed(spark, rows))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert cases.bag(out.collect()) == cases.bag(brute_nodes(rows))


def test_sql_equals_brute_force_and_the_operator(spark):
    con = duckdb.connect()
    for sf in (SF_SMOKE, SF_CHECK):
        con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        want = con.execute(trie.TRIE_SQL).fetchall()
        rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
        assert cases.bag(want) == cases.bag(brute_nodes(rows))
    assert cases.bag(trie.trie_report(table(spark, SF_CHECK, "conversations")).collect()) == cases.bag(want)


def test_perfect_hash_is_minimal_and_tells_strangers():
    rng = np.random.default_rng(1)
    k1, k2 = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, 5000))
    k1[:1000] = 7  # half of the key alone may repeat
    h = trie.PerfectHash(k1, k2)
    slots = h.slots(k1, k2)
    assert sorted(slots.tolist()) == list(range(5000))
    other = h.slots(k2, k1)
    assert ((other >= -1) & (other < 5000)).all()
    assert trie.PerfectHash(k1[:0], k2[:0]).slots(k1[:2], k2[:2]).tolist() == [-1, -1]


def test_prefixes_with_one_digest_are_refused():
    a = lambda *x: np.array(x, dtype=np.int64)
    one = dict(c=a(1, 2), depth=a(1, 1), k1=a(5, 5), k2=a(6, 6), p1=a(0, 0), p2=a(0, 0), size=a(3, 3))
    assert trie.node_table(**one, turn=np.array([b"x", b"x"], dtype="V2"))["n_convs"].tolist() == [2]
    with pytest.raises(ValueError):
        trie.node_table(**one, turn=np.array([b"x", b"y"], dtype="V2"))


def test_no_conversations_no_nodes(spark):
    assert trie.trie_report(framed(spark, [])).collect() == []
    assert trie.trie_report(framed(spark, [(None, 1, "user", "x")])).collect() == []
    only = [(3, 0, None, None)]  # its opening belongs to an absent conversation, or it keeps its turn
    assert cases.bag(trie.trie_report(framed(spark, only)).collect()) == cases.bag(brute_nodes(only))
