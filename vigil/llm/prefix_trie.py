"""Prefix trie of conversations in minimal-perfect-hash node tables.

1. Turns become digests (SHA-256 of role and text) that are numbered without ever holding
   a conversation in one task; texts are not moved.
2. A prefix is named by 128 bits made of running sums of its turns' hashes, each salted with
   its depth. Sums add up across blocks of a long conversation.
3. A node with at most ``SUBTREE`` rows below it is light. The topmost light nodes cut
   the trie into whole subtrees of bounded size, which are dealt to shards; so a first
   turn that a third of all conversations share is split where they part.
4. A shard enumerates its distinct prefix digests, builds a minimal perfect hash over them,
   confirms every row's slot by the stored digest (and a prefix by its parent and last turn, so
   that no two prefixes share a node), scatters the counts into flat numpy arrays and
   accumulates them through the array of parent slots, deepest nodes first.
5. The heavy nodes above the cut are few (rows / ``SUBTREE`` a level). They get what their
   light children carry and pass it on to ancestors at distance 1, 2, 4, ...
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import pick, store
from vigil.operators.sequence import ordered_index
from vigil.session import ship_by_value

#: Turns that a conversation may take from the first one of its family, and conversations in a family.
SHARED, FAMILY = 8, 5
#: Rows below a node up to which its subtree stays whole.
SUBTREE = 4096
#: Rows that a shard's arrays hold, about: whole subtrees are added up to it.
PORTION = 200_000
#: Positions of a conversation that one window holds.
BLOCK = 100_000
#: Consecutive ids whose decimals become one piece of a digest's input.
IDS = 4096
_LANES = ("l1", "l2", "l3", "l4")
_COLLISION = "two prefixes share a digest"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """c, pos (1, 2, ...), digest, bytes of every turn. Null turns come first; turns of one
    number are ordered by their digests, repeated rows are turns of their own; a null role
    or text is empty; rows without a conv_id belong to no conversation and are left out."""
    d = pick(conversations, c="conv_id", turn="turn", role="role", text="text").where("c is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    d = d.select(F.col("c").cast("bigint").alias("c"), "turn", F.sha2(said.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    return ordered_index(d, ["c"], ["turn", "digest"], "pos").select("c", "pos", F.unhex("digest").alias("digest"), "bytes")


def share_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sizes): c, depth, digest, bytes, size of the rebuilt conversations, and c, size
    of all of them. Conversation c opens with the first h turns of conversation c - c % 5 (all
    if it has fewer, none if it is absent) and goes on with its own after its first h;
    h is the unsigned crc32 of the decimal c, modulo 9."""
    heads = turns.where((F.col("pos") <= SHARED) & (F.col("c") % FAMILY == 0)).groupBy(F.col("c").alias("base")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head"))
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.crc32(F.col("c").cast("string")) % (SHARED + 1)) \
        .withColumn("own", F.col("c") - F.col("c") % FAMILY)
    convs = convs.join(heads, F.col("own") == F.col("base"), "left")
    convs = convs.withColumn("opening", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")))
    convs = convs.withColumn("taken", F.size("opening")).withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = store(convs.select("c", "h", "taken", "size", "opening"), "trie-conversations")
    opened = convs.select("c", F.explode("opening").alias("t"), "size").select("c", F.col("t.pos").alias("depth"), "t.digest", "t.bytes", "size")
    later = turns.join(convs.select(F.col("c").alias("cc"), "h", "taken", "size"), F.col("c") == F.col("cc")).where("pos > h") \
        .select("c", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "bytes", "size")
    return opened.unionByName(later), convs.select("c", "size")


def _key(lanes, depth, j: int):
    return F.xxhash64(*lanes, depth.cast("bigint"), F.lit(j))


def prefix_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with the names of the prefix that ends at the row (k1, k2) and of the
    one before it (p1, p2)."""
    half = F.lit((1 << 32) - 1)
    a, b = F.xxhash64("digest", F.col("depth").cast("bigint"), F.lit(1)), F.xxhash64("digest", F.col("depth").cast("bigint"), F.lit(2))
    terms = [F.shiftrightunsigned(a, 32), a.bitwiseAND(half), F.shiftrightunsigned(b, 32), b.bitwiseAND(half)]
    d = rows.withColumns({f"t{n}": t for n, t in zip(_LANES, terms)}).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    inside = Window.partitionBy("c", "block").orderBy("depth")
    d = store(d.withColumns({n: F.sum(f"t{n}").over(inside) for n in _LANES}), "trie-sums")
    # only blocks after a conversation's first one have something before them
    blocks = d.where(F.col("size") > BLOCK).groupBy(F.col("c").alias("bc"), F.col("block").alias("bb")).agg(*[F.sum(f"t{n}").alias(f"b{n}") for n in _LANES])
    before = Window.partitionBy("bc").orderBy("bb").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({f"b{n}": F.sum(f"b{n}").over(before) for n in _LANES}).where("bb > 0")
    d = d.join(blocks, (F.col("c") == F.col("bc")) & (F.col("block") == F.col("bb")), "left")
    now = [F.col(n) + F.coalesce(f"b{n}", F.lit(0)) for n in _LANES]
    then = [x - F.col(f"t{n}") for x, n in zip(now, _LANES)]
    return d.select("c", "depth", "size", "digest", "bytes", *[_key(now, F.col("depth"), j).alias(f"k{j}") for j in (1, 2)],
                    *[_key(then, F.col("depth") - 1, j).alias(f"p{j}") for j in (1, 2)])


def _same(k: str, one: str, two: str):
    return (F.col(f"{k}1") == F.col(one)) & (F.col(f"{k}2") == F.col(two))


class PerfectHash:
    """Minimal perfect hash over distinct 128-bit keys: every level places the keys that
    have a cell of its bit array for themselves and leaves the others to the next one."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        placed, left = 0, np.arange(len(k1))
        while len(left):
            cells = 2 * len(left) + 1
            at = self._cell(k1[left], k2[left], len(self.levels), cells)
            alone = np.bincount(at, minlength=cells) == 1
            self.levels.append((alone, placed + np.cumsum(alone) - 1))
            placed += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def _cell(k1, k2, level: int, cells: int) -> np.ndarray:
        x = (k1.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(32)) ^ k2.view(np.uint64)) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(cells)).astype(np.int64)

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 or the slot of another key if it is none of the hashed ones."""
        out, left = np.full(len(k1), -1, dtype=np.int64), np.arange(len(k1))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._cell(k1[left], k2[left], level, len(alone))
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def node_table(c, depth, k1, k2, p1, p2, turn, size) -> dict[str, np.ndarray]:
    """The nodes of whole subtrees from their rows (numpy arrays; ``turn`` the digests as
    fixed-width bytes, ``size`` the bytes of the last text), one array per column.
    ``parent`` is the parent's slot, -1 for the top of a subtree."""
    order = np.lexsort((k2, k1))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    some = order[new]
    table = PerfectHash(k1[some], k2[some])
    n = len(some)
    node = np.empty(n, dtype=np.int64)  # a row of every node, by slot
    node[table.slots(k1[some], k2[some])] = some
    slot = table.slots(k1, k2)
    one = node[slot]
    if (k1[one] != k1).any() or (k2[one] != k2).any():
        raise ValueError("the hash is not perfect")
    if (turn[one] != turn).any() or (p1[one] != p1).any() or (p2[one] != p2).any() or (depth[one] != depth).any():
        raise ValueError(_COLLISION)
    convs = np.bincount(slot, minlength=n)
    conv = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(conv, slot, c)
    parent = table.slots(p1[node], p2[node])
    known = node[parent]
    parent[(k1[known] != p1[node]) | (k2[known] != p2[node])] = -1  # the slot of another prefix, or none
    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves, saved = (children == 0).astype(np.int64), (convs - 1) * size[node]
    deepest = np.argsort(-depth[node], kind="stable")
    deepest = deepest[parent[deepest] >= 0]
    levels = np.flatnonzero(np.diff(depth[node][deepest])) + 1
    for at in np.split(deepest, levels):
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    return {"k1": k1[node], "k2": k2[node], "p1": p1[node], "p2": p2[node], "conv_id": conv, "depth": depth[node], "parent": parent, "n_convs": convs,
            "n_children": children, "n_leaves": leaves, "saved": saved}


_NODE = "k1 long, k2 long, p1 long, p2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, top boolean"


def _light_nodes(batches):
    """Rows sorted by subtree to nodes; a portion ends where a subtree does."""
    held: list[pa.RecordBatch] = []

    def nodes(rows: pa.Table):
        x = {n: rows.column(n).to_numpy() for n in ("c", "depth", "k1", "k2", "p1", "p2", "bytes")}
        turn = np.array(rows.column("digest").to_pylist(), dtype="V32")
        t = node_table(x["c"], x["depth"], x["k1"], x["k2"], x["p1"], x["p2"], turn, x["bytes"])
        top = t["parent"] < 0
        t["parent"] = pa.array(t["conv_id"][t["parent"]], mask=top)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in t.values()] + [pa.array(top)], names=[f.split()[0] for f in _NODE.split(", ")])

    for b in batches:
        held.append(b)
        if sum(map(len, held)) < PORTION:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        r1, r2 = rows.column("r1").to_numpy(), rows.column("r2").to_numpy()
        ends = np.flatnonzero((r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1]))
        if len(ends):
            yield nodes(rows.slice(0, int(ends[-1]) + 1))
            held = rows.slice(int(ends[-1]) + 1).to_batches()
    if sum(map(len, held)):
        yield nodes(pa.Table.from_batches(held).combine_chunks())


def _list_digests(batches):
    """Pieces of id lists, sorted by node and piece, to one SHA-256 per node; only the
    state of the digest is held."""
    key, sha = None, None
    for b in batches:
        out: list[tuple] = []
        for k1, k2, ids in zip(*[b.column(n).to_pylist() for n in ("k1", "k2", "ids")]):
            if (k1, k2) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (k1, k2), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if out:
            yield _digests(out)
    if key is not None:
        yield _digests([(*key, sha.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    a, b, h = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(h)], names=["e1", "e2", "ends_sha256"])


def _passed_up(heavy: DataFrame) -> DataFrame:
    """Sums of n_leaves and saved over the subtrees of ``heavy`` (k1, k2, p1, p2, ...): what a
    node has gathered goes to its ancestor at distance 1, 2, 4, ..., until none has one."""
    acc = store(heavy.select("k1", "k2", "n_leaves", "saved", "p1", "p2"), "trie-sum")
    while not acc.where("p1 is not null").isEmpty():
        more = acc.where("p1 is not null").groupBy(F.col("p1").alias("m1"), F.col("p2").alias("m2")) \
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jump = acc.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        nxt = acc.join(more, _same("k", "m1", "m2"), "left").join(jump, _same("p", "j1", "j2"), "left")
        acc = store(nxt.select("k1", "k2", (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                               (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.col("q1").alias("p1"), F.col("q2").alias("p2")), "trie-sum")
    return acc.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.col("n_leaves").alias("all_leaves"), F.col("saved").alias("all_saved"))


def trie_nodes(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (c, depth, digest, bytes, size), with the
    root that all of ``sizes`` (c, size) belong to; no conversations, no nodes."""
    t = store(prefix_rows(rows), "trie-rows")
    spark = t.sparkSession
    nothing = [F.lit(0).cast("bigint")] * 4
    r1, r2 = spark.range(1).select(*[_key(nothing, F.lit(0), j) for j in (1, 2)]).first()
    below = t.groupBy("k1", "k2").agg(F.sum(F.col("size") - F.col("depth") + 1).alias("below")).where(F.col("below") > SUBTREE)
    heavy = store(below.select(F.col("k1").alias("h1"), F.col("k2").alias("h2")), "trie-heavy")
    marked = t.select("c", "depth", "k1", "k2").join(heavy, _same("k", "h1", "h2"), "left")
    # nodes get lighter with depth: the first light one of a conversation is the top of its subtree
    cut = marked.groupBy("c").agg(F.min_by(F.struct("k1", "k2", "depth"), F.when(F.col("h1").isNull(), F.col("depth"))).alias("cut"),
                                  F.count("h1").alias("n_heavy"), F.count(F.lit(1)).alias("n"))
    cut = cut.where("n_heavy < n").select(F.col("c").alias("cc"), F.col("cut.k1").alias("r1"), F.col("cut.k2").alias("r2"), F.col("cut.depth").alias("from"))
    light = t.join(cut, (F.col("c") == F.col("cc")) & (F.col("depth") >= F.col("from"))) \
        .select("r1", "r2", "c", F.col("depth").cast("bigint").alias("depth"), "k1", "k2", "p1", "p2", "bytes", "digest")
    light = store(light.repartition("r1", "r2").sortWithinPartitions("r1", "r2").mapInArrow(_light_nodes, _NODE), "trie-light")

    def agreed(name: str, *cols: str):
        x = F.struct(*cols) if len(cols) > 1 else F.col(cols[0])
        return F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.raise_error(F.lit(_COLLISION))).alias(name)

    top = t.join(heavy, _same("k", "h1", "h2"), "left_semi").groupBy("k1", "k2").agg(
        agreed("parent", "p1", "p2"), F.min("c").alias("conv_id"), agreed("depth", "depth"), F.count(F.lit(1)).alias("n_convs"), agreed("same", "digest"), F.max("bytes").alias("bytes"))
    top = top.select("k1", "k2", "parent.p1", "parent.p2", "conv_id", F.when(F.col("same").isNotNull(), F.col("depth")).cast("bigint").alias("depth"), "n_convs", "bytes")
    none = F.lit(None).cast("bigint")
    root = sizes.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(r1).alias("k1"), F.lit(r2).alias("k2"), none.alias("p1"), none.alias("p2"), "conv_id", F.lit(0).cast("bigint").alias("depth"), "n_convs", F.lit(0).cast("bigint").alias("bytes"))
    top = store(top.unionByName(root), "trie-top")
    carried = light.where("top").select("p1", "p2", "n_leaves", "saved").unionByName(
        top.where("p1 is not null").select("p1", "p2", F.lit(0).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved")))
    carried = carried.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved").alias("below_saved"))
    top = top.join(carried, _same("k", "c1", "c2"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    top = store(top.select("k1", "k2", "p1", "p2", "conv_id", "depth", "n_convs", "n_children",
                           F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("below_leaves")).cast("bigint").alias("n_leaves"),
                           ((F.col("n_convs") - 1) * F.col("bytes") + F.coalesce("below_saved", F.lit(0))).alias("saved")), "trie-top")
    top = top.join(_passed_up(top), _same("k", "s1", "s2")).withColumn("n_leaves", F.col("all_leaves")).withColumn("saved", F.col("all_saved"))
    above = top.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("conv_id").alias("above_id"))
    cols = ["k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    hung = light.where("top").drop("parent_conv_id", "top").unionByName(top.select(*[n for n in light.drop("parent_conv_id", "top").columns]))
    hung = hung.join(above, _same("p", "a1", "a2"), "left").withColumn("parent_conv_id", F.col("above_id")).select(*cols)
    nodes = light.where("not top").select(*cols).unionByName(hung)
    ends = t.where("depth = size").select("k1", "k2", "c").unionByName(sizes.where("size = 0").select(F.lit(r1).alias("k1"), F.lit(r2).alias("k2"), "c"))
    pieces = ends.groupBy("k1", "k2", F.floor(F.col("c") / IDS).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece").select("k1", "k2", "ids")
    lists = pieces.mapInArrow(_list_digests, "e1 long, e2 long, ends_sha256 string")
    return nodes.join(lists, _same("k", "e1", "e2"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def trie_report(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256: one row per node of the trie of the rebuilt conversations.

    See ``turn_rows`` for nulls, ties and repeated rows and ``share_openings`` for how
    conversations are rebuilt. Empty texts save nothing. An empty table, or one without
    any conv_id, gives an empty table. The ids that end at one node are hashed in order, in pieces of
    at most ``IDS`` ids made in parallel; one task reads the pieces of a node one by one."""
    return trie_nodes(*share_openings(turn_rows(conversations)))


ship_by_value(sys.modules[__name__])

TRIE_SQL = r"""
WITH t AS (SELECT conv_id AS c, turn, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS e,
                  octet_length(encode(coalesce(text, ''))) AS b FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(struct_pack(e := e, b := b) ORDER BY turn NULLS FIRST, e) AS l, c::VARCHAR AS s FROM t GROUP BY c),
h AS (SELECT c, l, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(s, ''), lambda ch: ascii(ch)::BIGINT)),
          lambda v, x: list_reduce(list_prepend(xor(v, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
              lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END)), 4294967295::BIGINT) % 9 AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(q.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN o q ON q.c = h.c - h.c % 5),
p AS (SELECT c, list_transform(l, lambda x: x.e) AS k, list_transform(l, lambda x: x.b) AS b, len(l) AS n FROM r),
m AS (SELECT c, d, n, k[1:d] AS k, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS b FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM p)),
v AS (SELECT k, d, min(c) AS c, count(*) AS n, max(b) AS b, sha256(coalesce(string_agg(CASE WHEN d = n THEN c::VARCHAR END, ',' ORDER BY c), '')) AS s
      FROM m GROUP BY k, d),
f AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY 1, 2),
u AS (SELECT v.*, coalesce(f.n, 0) AS kids FROM v LEFT JOIN f ON f.k = v.k AND f.d = v.d),
a AS (SELECT k[1:e] AS k, e AS d, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * b) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM u) GROUP BY 1, 2)
SELECT u.c AS conv_id, u.d::BIGINT AS depth, w.c AS parent_conv_id, u.n::BIGINT AS n_convs, u.kids::BIGINT AS n_children, a.leaves::BIGINT AS n_leaves,
       a.saved::BIGINT AS saved_tokens, u.s AS ends_sha256
FROM u JOIN a ON a.k = u.k AND a.d = u.d LEFT JOIN v w ON u.d > 0 AND w.d = u.d - 1 AND w.k = u.k[1:u.d - 1]"""
