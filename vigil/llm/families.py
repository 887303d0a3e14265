"""Links inside families of near copies, from differences to one leader.

All sets that share a token of a long index list are compared with one set, the
list's leader L, once. For a member i let D(i) be the tokens in which it and L
differ, u of them its own and d of them lacking, and

    F(i) = num u + den d,     C = (den - num) |L|.

Two members with x differences in common overlap in |L| - d(i) - d(j) + x tokens, so
they link exactly if (num + den) x >= F(i) + F(j) - C. Hence

- members with F <= C link to the leader itself: one star, however many they are;
- any other link needs x >= 1 differences in common, and at least one of the two has
  F > C. Differences are rare tokens (a copy's own changes), so an index of their
  prefixes, ordered by how many members have them, holds few candidates: of a set with F > C any
  partner shares x >= (F - C) / den differences (since num x <= F(j)), of the others
  x >= (F + 1) / (num + den).

The lists are cut into blocks of equal room and about equal F. A probe skips blocks that
these do not allow to hold a link, and blocks that lie in its own component; members are
tested inside the block, before they become rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import store
from vigil.llm.components import joined

#: Entries of a list from which it is read as a family.
LONG = 32
#: Members of an index block, about.
BLOCK = 256


def long_tokens(by_star: DataFrame) -> DataFrame:
    """long: tokens whose lists have at least LONG entries, of several components."""
    m = by_star.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    return m.where((F.col("m") >= LONG) & (F.col("c0") < F.col("c1"))).select(F.col("token").alias("long"))


def _differences(w, post: DataFrame) -> DataFrame:
    """l, c, n, nl, d, dif, f, room: every member of a long list against the list's leader,
    the set with the fewest tokens before the long lists' in its order."""
    first = post.groupBy("c").agg(F.min("pos").alias("first"))
    post = store(post.join(first, "c").select("token", "c", "first"), "family-postings")
    lead = post.groupBy("token").agg(F.min_by("c", F.struct("first", "c")).alias("l"))
    pairs = store(post.select("token", "c").join(lead, "token").where("c <> l").select("l", "c").distinct(), "family-pairs")
    sets = w.full_sets(pairs.select("c").union(pairs.select(F.col("l").alias("c"))))
    sets = store(sets, "family-sets")
    mine = pairs.join(sets.select("c", F.col("tokens").alias("t")), "c")
    both = mine.join(sets.select(F.col("c").alias("l"), F.col("tokens").alias("tl")), "l")
    x = both.select("l", "c", F.size("t").alias("n"), F.size("tl").alias("nl"), F.array_except("t", "tl").alias("own"), F.array_except("tl", "t").alias("lacks"))
    rule = w.rule
    return store(x.select("l", "c", "n", "nl", F.size("lacks").alias("d"), F.concat("own", F.transform("lacks", F.bitwise_not)).alias("dif"),
                          (rule.num * F.size("own") + rule.den * F.size("lacks")).cast("bigint").alias("f"),
                          ((rule.den - rule.num) * F.col("nl")).cast("bigint").alias("room")), "family-differences")


def _entries(dif: DataFrame, rule) -> DataFrame:
    """l, token, c, f, room, rest, comp, open: prefixes of the differences as far as another
    member of the family shares the token. rest: differences from this one on."""
    token = dif.select("l", "c", F.explode("dif").alias("token"))
    shared = token.groupBy("l", "token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    ranked = token.join(shared, ["l", "token"]).groupBy("l", "c").agg(F.sort_array(F.collect_list(F.struct("m", "token"))).alias("order"))
    x = dif.drop("dif").join(ranked, ["l", "c"])
    need = F.greatest(F.lit(1), F.when(F.col("open"), F.ceil((F.col("f") - F.col("room")) / rule.den)).otherwise(F.ceil((F.col("f") + 1) / (rule.num + rule.den))))
    # unshared differences come first, so the shared ones are the last ``size(order)``
    x = x.withColumn("need", need)
    x = x.select("l", "c", "f", "room", "comp", "open", "need", F.size("order").alias("s"), F.posexplode("order").alias("i", "o"))
    return x.where(F.col("s") - F.col("i") >= F.col("need")) \
        .select("l", F.col("o.token").alias("token"), "c", "f", "room", "comp", "open", (F.col("s") - F.col("i")).alias("rest"))


def _candidates(e: DataFrame, rule) -> DataFrame:
    """l, a, b: members of different components whose differences may be enough in common."""
    weight = rule.num + rule.den
    many = e.groupBy("l", "token").agg(F.count(F.lit(1)).alias("m"), F.count_if("open").alias("k"), F.min("comp").alias("c0"), F.max("comp").alias("c1")) \
        .where("m > 1 and k > 0 and c0 < c1").select("l", "token", F.ceil(F.col("m") / BLOCK).cast("int").alias("slots"))
    held = store(e.join(many, ["l", "token"]), "family-index")
    blocks = held.groupBy("l", "token", "room", "rest", F.floor(F.col("f") / weight).alias("fb"), F.pmod(F.xxhash64("c"), F.col("slots")).alias("slot")).agg(
        F.min("f").alias("bf"), F.min("comp").alias("b0"), F.max("comp").alias("b1"), F.collect_list(F.struct("c", "f", "comp", "open")).alias("members"))
    probe = held.where("open").select(F.col("l").alias("pl"), F.col("token").alias("pt"), F.col("c").alias("pc"), F.col("f").alias("pf"),
                                      F.col("comp").alias("pcomp"), F.col("rest").alias("prest"))
    enough = lambda f: weight * F.least("rest", "prest") >= f + F.col("pf") - F.col("room")
    j = blocks.join(probe, (F.col("l") == F.col("pl")) & (F.col("token") == F.col("pt")) & enough(F.col("bf"))
                    & ~((F.col("b0") == F.col("pcomp")) & (F.col("b1") == F.col("pcomp"))))
    met = F.filter("members", lambda m: enough(m["f"]) & (m["comp"] != F.col("pcomp")) & (~m["open"] | (m["c"] < F.col("pc"))))
    return j.select("l", "pc", F.explode(F.transform(met, lambda m: m["c"])).alias("a")).select("l", "a", F.col("pc").alias("b")).distinct()


def family_links(w, post: DataFrame, comp: DataFrame) -> DataFrame:
    """a, b, na, nb, o: links that connect all members of the long lists ``post``
    (token, c, pos) that any links between them connect; each is exact.

    ``comp`` (c, component) are components known before."""
    rule = w.rule
    dif = _differences(w, post)
    star = dif.where("f <= room").select(F.col("c").alias("a"), F.col("l").alias("b"), F.col("n").alias("na"), F.col("nl").alias("nb"), (F.col("nl") - F.col("d")).alias("o"))
    now = joined(comp, star).select(F.col("c").alias("cc"), F.col("component").alias("comp"))
    dif = dif.withColumn("open", F.col("f") > F.col("room")).join(now, F.col("c") == F.col("cc"), "left").withColumn("comp", F.coalesce("comp", "c")).drop("cc")
    live = dif.groupBy("l").agg(F.max("open").alias("any"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("any and c0 < c1").select("l")
    dif = store(dif.join(live, "l", "left_semi"), "family-open")
    met = store(_candidates(_entries(dif, rule), rule), "family-candidates")
    one = dif.select("l", F.col("c").alias("a"), F.col("n").alias("na"), F.col("d").alias("da"), F.col("dif").alias("xa"), F.col("f").alias("fa"), "nl", "room")
    two = dif.select("l", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("d").alias("db"), F.col("dif").alias("xb"), F.col("f").alias("fb"))
    both = met.join(one, ["l", "a"]).join(two, ["l", "b"]).withColumn("x", F.size(F.array_intersect("xa", "xb")))
    found = both.where((rule.num + rule.den) * F.col("x") >= F.col("fa") + F.col("fb") - F.col("room")) \
        .select("a", "b", "na", "nb", (F.col("nl") - F.col("da") - F.col("db") + F.col("x")).alias("o"))
    return store(star.unionByName(found), "family-links")
