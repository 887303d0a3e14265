"""Co-author weighting of member activities.

The source question: an activity (type, subtype, id) may be signed by several
members; every member's share of an activity is 1 / (number of distinct
members that share any activity with the same id). A literal self-join on the
activity key is quadratic in the members of a key, and one popular key can
hold a large part of all rows.

Here the distinct co-author count is computed exactly without pairs.
For member m and activity id a let K(m, a) be the set of (type, subtype) keys
m holds for a. The co-authors of (m, a) are the members c with
K(c, a) ∩ K(m, a) ≠ ∅. Members with equal key sets for an id are one class, weighted by
how many they are, and the classes are numbered. Then

- a key's holders are a bitmap of classes: one 64-bit word per 64 of them;
- a class meets the classes in the union (OR) of its keys' bitmaps;
- the members in a union are counted by weight: the binary digits of the weights are
  bitmaps too, so digit b adds 2^b times the number of common bits.

For an id of few classes the union is an aggregate: one row per (class, key) and word. For an id
of more than ``WIDE`` that would be a row for every class, key and word of all its classes, so there
the bitmaps are cut into blocks, and every pair of blocks (one asks, one is met) is one group whose
unions numpy takes in memory. Between tasks go only the bitmaps, once per block of the id, and
one count per class and block. Every other shuffle is a partial (map-side combined)
aggregate or an equi-join on (id, key) or word, which AQE's skew-join splits when one id is hot.

Null rules follow the source: keys match NULL to NULL (the key token below is
null-safe), groups with a NULL member or id are dropped, and NULL members are
never counted as co-authors.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir, ship_by_value

#: Classes of one id up to which unions are rows; ids of more are counted by blocks.
WIDE = 1024
#: Words of a block of bitmaps, as a power of two (64 classes a word).
BLOCK = 9
#: Words that a task unites at once, about; what fits a core's cache is several times as fast.
_ROOM = 1 << 16
_SEP = "|"  # tokens are length-prefixed, so joining them stays unambiguous


def key_token(*cols) -> "F.Column":
    """Injective, null-safe string token of key values: each part is written
    as ``<length>:<text>`` and NULL as ``~``, so no two key tuples collide."""
    parts = []
    for c in cols:
        t = c.cast("string")
        parts.append(F.when(t.isNull(), F.lit("~"))
                     .otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)))
    return F.concat(*parts)


def member_act_groups(df: DataFrame, member: str = "mp_name", act_id: str = "act_id",
                      key_cols: tuple[str, ...] = ("act_type", "act_subtype"),
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per (member, act_id) with the distinct (carry + key) combinations
    it holds (``_combos``). The partial collect_set runs map-side, so a hot
    (member, act_id) ships only its distinct combinations across the shuffle;
    the set is bounded by the distinct type/subtype (and carried) values of one
    member's activity id."""
    m, a = F.col(member), F.col(act_id)
    return (df.where(m.isNotNull() & a.isNotNull())
              .groupBy(member, act_id)
              .agg(F.collect_set(F.struct(*carry, *key_cols)).alias("_combos")))


def _materialize(groups: DataFrame, key_cols: tuple[str, ...], carried: bool = True) -> DataFrame:
    """Checkpoint of the groups with their sorted key sets (``_keys``) to the shared
    folder: the aggregate is read several times and its lineage is cut there.
    ``_combos`` is only written if it is ``carried`` on."""
    ensure_checkpoint_dir(groups.sparkSession)
    keys = F.array_sort(F.array_distinct(F.transform("_combos", lambda c: key_token(*[c[k] for k in key_cols]))))
    keyed = groups.withColumn("_keys", keys)
    return (keyed if carried else keyed.drop("_combos")).checkpoint(eager=True)


def _numbered_classes(groups: DataFrame, act_id: str) -> DataFrame:
    """act_id, _keys, _w, _word, _bit: the distinct (id, key set) classes with their number of
    members and a position in a bitmap. Classes of one id get consecutive numbers: they are
    range-partitioned by id, and a task numbers its own on. The checkpoint fixes the numbers."""
    classes = groups.groupBy(act_id, "_keys").agg(F.count(F.lit(1)).alias("_w"))
    order = F.array_join("_keys", _SEP)
    numbered = (classes.repartitionByRange(F.col(act_id), order).sortWithinPartitions(F.col(act_id), order)
                .withColumn("_i", F.monotonically_increasing_id()).checkpoint(eager=True))
    return numbered.withColumn("_word", F.shiftright("_i", 6)) \
        .withColumn("_bit", F.expr("shiftleft(1L, cast(_i & 63 as int))"))


def _met_in_block(asking: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
    """_i, _n: how many members of the block ``met`` each class of ``asking`` meets. Rows are bitmaps,
    as their words with a bit (``_at``) and the words' values (``_bits``), of a key's
    holders or, in ``met``, of a binary digit of the classes' weights."""
    held = met[met["_digit"].isna()]
    number = {k: j for j, k in enumerate(held["_key"])}
    asking = asking[asking["_key"].isin(number)]
    if asking.empty:
        return pd.DataFrame({"_i": np.array([], "int64"), "_n": np.array([], "int64")})
    at, of = np.concatenate(list(asking["_at"])), np.repeat([number[k] for k in asking["_key"]], [len(x) for x in asking["_at"]])
    row, bit = np.nonzero(np.unpackbits(np.concatenate(list(asking["_bits"])).astype("<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little"))
    i = at[row] * 64 + bit
    order = np.argsort(i, kind="stable")
    i, key = i[order], of[row][order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    ends = np.r_[starts[1:], len(i)]
    words = np.unique(np.concatenate(list(held["_at"])))
    n, step = np.zeros(len(starts), "int64"), max(1, _ROOM // len(held))
    for lo in range(0, len(words), step):
        part = words[lo:lo + step]

        def dense(rows):
            out = np.zeros((len(rows), len(part)), "u8")
            for r, (w, v) in enumerate(zip(rows["_at"], rows["_bits"])):
                here = (w >= part[0]) & (w <= part[-1])
                slot = np.searchsorted(part, w[here])
                same = part[slot] == w[here]
                out[r, slot[same]] = v[here][same].astype("i8").view("u8")
            return out

        holders, ones = dense(held), met[met["_digit"].notna()]
        digits = list(zip(ones["_digit"].astype(int), dense(ones)))
        c = 0
        while c < len(starts):  # as many classes at once as have room, at least one
            d = max(c + 1, int(np.searchsorted(ends, starts[c] + _ROOM // len(part), "right")))
            both = np.bitwise_or.reduceat(holders[key[starts[c]:ends[d - 1]]], starts[c:d] - starts[c], axis=0)
            for b, mask in digits:
                n[c:d] += np.bitwise_count(both & mask).sum(axis=1, dtype="int64") << b
            c = d
    return pd.DataFrame({"_i": i[starts], "_n": n})


def _wide_counts(holders: DataFrame, digits: DataFrame, act_id: str) -> DataFrame:
    """_i, _n: rows that sum up to the co-authors of each class, by pairs of blocks of one id.

    holders: act_id, _key, _hw, _holders; digits: act_id, _b, _hw, _ones."""
    def packed(rows, name, value):
        mine = F.sort_array(F.collect_list(F.struct(F.col("_hw"), F.col(value))))
        return rows.groupBy(act_id, F.shiftright("_hw", BLOCK).alias("_block"), name).agg(mine.alias("_w")) \
            .select(act_id, "_block", name, F.col("_w._hw").alias("_at"), F.col(f"_w.{value}").alias("_bits"))

    maps = packed(holders, "_key", "_holders").withColumn("_digit", F.lit(None).cast("int")).unionByName(
        packed(digits, "_b", "_ones").withColumnRenamed("_b", "_digit").withColumn("_key", F.lit(None).cast("string"))).checkpoint(eager=True)
    blocks = maps.select(act_id, "_block").distinct()
    pair, sides = [act_id, "_asks", "_meets"], []
    for mine, other in (("_asks", "_meets"), ("_meets", "_asks")):
        further = blocks.withColumnRenamed("_block", other)
        side = maps.withColumnRenamed("_block", mine).join(further, act_id)
        sides.append(side.select(*[F.col(c).alias(c) for c in pair + ["_key", "_digit", "_at", "_bits"]]))  # names of its own
    asks, meets = sides[0].where("_digit is null").groupBy(*pair), sides[1].groupBy(*pair)
    return asks.cogroup(meets).applyInPandas(_met_in_block, "_i long, _n long")


def _key_set_counts(groups: DataFrame, act_id: str, out: str) -> DataFrame:
    """(act_id, _keys, out): co-authors of a member with this key set for the id."""
    classes = _numbered_classes(groups, act_id)
    wide = classes.groupBy(act_id).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > WIDE).select(act_id).checkpoint(eager=True)
    by_key = classes.select(act_id, "_i", "_word", "_bit", F.explode("_keys").alias("_key"))
    holders = by_key.groupBy(act_id, "_key", F.col("_word").alias("_hw")).agg(F.bit_or("_bit").alias("_holders"))
    digits = (classes.select(act_id, "_word", "_bit", F.posexplode(F.split(F.reverse(F.bin("_w")), "")).alias("_b", "_digit"))
              .where("_digit = '1'"))
    has_wide = not wide.isEmpty()
    few = (lambda rows: rows.join(wide, act_id, "left_anti")) if has_wide else (lambda rows: rows)
    union = (few(by_key).select(act_id, "_i", "_key").join(few(holders), [act_id, "_key"])
             .groupBy("_i", "_hw").agg(F.bit_or("_holders").alias("_met")))
    ones = digits.groupBy(F.col("_word").alias("_hw"), "_b").agg(F.bit_or("_bit").alias("_ones"))
    n = union.join(ones, "_hw").select("_i", F.expr("shiftleft(cast(bit_count(_met & _ones) as bigint), _b)").alias("_n"))
    if has_wide:
        mine = digits.join(wide, act_id, "left_semi").groupBy(act_id, F.col("_word").alias("_hw"), "_b").agg(F.bit_or("_bit").alias("_ones"))
        n = n.unionByName(_wide_counts(holders.join(wide, act_id, "left_semi"), mine, act_id))
    n = n.groupBy("_i").agg(F.sum("_n").alias(out))
    return classes.select(act_id, "_keys", "_i").join(n, "_i").drop("_i")


def coauthor_counts(df: DataFrame, member: str = "mp_name", act_id: str = "act_id",
                    key_cols: tuple[str, ...] = ("act_type", "act_subtype"),
                    out: str = "n_coauthors") -> DataFrame:
    """Distinct co-authors (member included) per (member, act_id)."""
    groups = _materialize(member_act_groups(df, member, act_id, key_cols), key_cols, carried=False)
    return groups.join(_key_set_counts(groups, act_id, out), [act_id, "_keys"]).select(member, act_id, out)


def coauthor_weights(df: DataFrame, decimals: int = 6,
                     id_cols: tuple[str, ...] = ("act_id",)) -> DataFrame:
    """Sum of 1/co-authors per (party, member), ascending.

    Equivalent to: self-merge on (type, subtype, id); distinct co-authors per
    (member, id); weight = 1/n; distinct 7-column rows; sum per (party, member).
    The input is read once: one aggregate per (member, id) carries both the
    key set for the co-author count and the distinct rows to be weighted.

    ``id_cols`` is what co-authors are counted per. The default pools ids that
    collide across activity types, as the source analysis does;
    ``("act_type", "act_id")`` counts them per type instead.
    """
    keys = ("act_type", "act_subtype")
    id_col = "act_id"
    if tuple(id_cols) != ("act_id",):
        present = None
        for c in id_cols:
            present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
        df = df.withColumn("_aid", F.when(present, key_token(*[F.col(c) for c in id_cols])))
        id_col = "_aid"
    groups = _materialize(member_act_groups(df, "mp_name", id_col, keys, carry=("mp_id", "mp_party")), keys)
    n = _key_set_counts(groups, id_col, "n_coauthors")
    w = (groups.join(n, [id_col, "_keys"])
               .select("mp_name", "n_coauthors", F.explode("_combos").alias("_c"))
               .select(F.col("_c")["mp_party"].alias("mp_party"), "mp_name",
                       (F.lit(1.0) / F.col("n_coauthors")).alias("act_weight")))
    return (w.where(F.col("mp_party").isNotNull())
             .groupBy("mp_party", "mp_name")
             .agg(F.round(F.sum("act_weight"), decimals).alias("act_weight"))
             .orderBy("act_weight", "mp_party", "mp_name"))


def coauthor_pair_counts(df: DataFrame, type_col: str = "act_type",
                         key_cols: tuple[str, ...] = ("act_subtype", "act_id"),
                         member: str = "mp_name") -> DataFrame:
    """Size of the self-join on the activity key, per type, without building it.

    ``n_pair_rows`` = rows the self-merge produces (Σ r_k²) and
    ``n_member_pairs`` = distinct (member, co-member) pairs per key (Σ d_k²),
    both summed over the keys of a type. Keys match NULL to NULL.
    """
    per_key = (df.where(F.col(type_col).isNotNull())
                 .groupBy(type_col, *key_cols)
                 .agg(F.count(F.lit(1)).alias("_r"),
                      F.countDistinct(member).alias("_d")))
    return (per_key.groupBy(type_col)
            .agg(F.sum(F.col("_r") * F.col("_r")).cast("long").alias("n_pair_rows"),
                 F.sum(F.col("_d") * F.col("_d")).cast("long").alias("n_member_pairs")))


ship_by_value(sys.modules[__name__])
