"""Exact Jaccard join of word-shingle sets with set-relation skipping.

1. Equal sets are one class; only classes are joined.
2. Relations: classes that share one of a few min-hash keys are compared with
   the key's least class (the leader). A class within the threshold joins that
   leader's star, with both set differences recorded.
3. Index: prefix tokens (rare, long shingles first, tokens of many components
   last) point to stars. Lists are cut into blocks by size and position with the
   extremes of each block, and a probe skips blocks that cannot reach the
   threshold before any member is read.
4. Answers: leaders of stars that meet are compared once. What a member could
   share with another star follows from its leader's answer and the recorded
   differences; only members that this leaves open are compared themselves.
   Stars already known to be connected are skipped altogether.
5. Long lists are families of near copies. They are not met in pairs: all members
   get their differences to the list's leader, and their mutual answers follow
   from those (``families``).

Every skip is a proven bound, so no link between components is lost; inside a
component no pairs are listed, however many copies it has.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, pick, space_words, store
from vigil.llm.components import components, joined
from vigil.llm.families import family_links, long_tokens

SHINGLE = 3
#: The contract of op10: two sets link when NUM * union <= DEN * intersection.
NUM, DEN = 90, 100
#: Tokens in more components than this go last in the token order.
HOT = 16
#: Members of an index block, about.
BLOCK = 256
#: Rows of a key list up to which it is broadcast; longer ones are shuffled.
BROADCAST_ROWS = 300_000
#: Sets up to this size are kept whole; of larger ones the first 0.3 of their order, or the prefix if it is longer.
WHOLE = 256
_ALL = 9223372036854775807


def token_set(text: Column, n: int = SHINGLE) -> Column:
    """Sorted distinct 63-bit tokens of the text's n-word shingles.

    The high byte falls with the shingle's length in characters, so the
    natural order puts long shingles, which are rare, first; the rest is a
    hash. Fewer words than ``n`` make one token, none an empty set.
    """
    words = space_words(ascii_lower(text))

    def token(size, *hashed):
        return F.shiftleft(F.lit(127) - F.least(size, F.lit(127)).cast("bigint"), 56).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64(*hashed), 8))

    def build(w):
        full = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: token(
            sum((F.length(F.get(w, i + k)) for k in range(1, n)), F.length(F.get(w, i))), *[F.get(w, i + k) for k in range(n)]))
        short = F.array(token(F.lit(0), F.size(w), F.array_join(w, " ")))
        return F.when(F.size(w) >= n, F.sort_array(F.array_distinct(full))).when(F.size(w) > 0, short) \
            .otherwise(F.array().cast("array<bigint>"))

    return words, build


def read_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
              **more: Column) -> DataFrame:
    """doc_id, tokens, n, c (the set's 64-bit digest) and ``more``, columns made of
    doc_id and text; one row per input row."""
    words, build = token_set(F.col("text"), shingle)
    d = pick(docs, doc_id=id_col, text=text_col).select("doc_id", words.alias("words"), *[v.alias(k) for k, v in more.items()])
    d = d.select("doc_id", build(F.col("words")).alias("tokens"), *more)
    return d.select("doc_id", "tokens", F.size("tokens").alias("n"), F.xxhash64("tokens").alias("c"), *more)


def _min_hashes(tokens: str) -> list[Column]:
    """Three keys that sets share about as often as they share tokens. All but the high byte of a
    token is a hash already: its least and greatest values, and the least of its low bits."""
    low = F.transform(tokens, lambda t: F.shiftleft(t, 8))
    return [F.array_min(low), F.array_max(low), F.array_min(F.transform(tokens, lambda t: F.shiftleft(t, 30)))]


class Rule(NamedTuple):
    """Sets of ``shingle``-word shingles link when num * union <= den * intersection."""

    shingle: int = SHINGLE
    num: int = NUM
    den: int = DEN

    def prefix_len(self, n: Column) -> Column:
        """Tokens of a set of which a linked set must hold at least one."""
        return n - F.ceil(n * self.num / self.den).cast("int") + 1

    def links(self, o: Column, n1: Column, n2: Column) -> Column:
        return o * (self.num + self.den) >= self.num * (n1 + n2)

    def room(self, mine: Column, other: Column) -> Column:
        """What a member's own tokens (``mine``) and lacking ones (``other``) are worth
        towards a link, against its leader. With overlap o of two leaders of n1 and
        n2 tokens, members a and b share at most o + mine_a + mine_b tokens and hold
        n1 + mine_a - other_a and n2 + mine_b - other_b, so they link only if
        (num + den) o + room_a + room_b >= num (n1 + n2)."""
        return self.den * mine + self.num * other

    def may_link(self, o: Column, room: Column, n1: Column, n2: Column) -> Column:
        return o * (self.num + self.den) + room >= self.num * (n1 + n2)


def _by_key(big: DataFrame, keys: DataFrame, on: Column) -> DataFrame:
    """Inner join that broadcasts ``keys``, a stored table, while it is short."""
    short = keys.count() <= BROADCAST_ROWS
    return big.join(F.broadcast(keys) if short else keys, on)


class _Work:
    """The tables that the steps share."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, rule: Rule, **more: Column):
        self.docs, self.id_col, self.text_col, self.rule = docs, id_col, text_col, rule
        s = read_sets(docs, id_col, text_col, rule.shingle, **more)
        head = F.slice("tokens", 1, F.greatest(F.lit(WHOLE), F.ceil(F.col("n") * 0.3).cast("int") + 2, rule.prefix_len(F.col("n"))))
        s = s.select("doc_id", "n", "c", head.alias("head"), *more)
        s = s.select("*", *[k.alias(f"key{j}") for j, k in enumerate(_min_hashes("head"), 1)], F.monotonically_increasing_id().alias("row"))
        self.light = store(s, "sets")
        sets = self.light.where("n > 0")
        reps = sets.groupBy("c").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("m"), F.min("row").alias("kept"))
        self.reps = store(reps, "reps")
        #: one row per distinct set, its first; a scan and a join, as it is read by many steps
        more = store(self.reps.where("m > 1").select(F.col("c").alias("dc"), "kept"), "copied")
        short = more.count() <= BROADCAST_ROWS
        flagged = sets.join(F.broadcast(more) if short else more, F.col("c") == F.col("dc"), "left")
        self.classes = flagged.where("dc is null or row = kept").select("c", "n", "head", "key1", "key2", "key3") \
            .withColumn("full", F.size("head") == F.col("n"))

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """c, tokens of the wanted classes, built again from the texts of one
        document each; texts are only moved if the list is too long to broadcast."""
        keys = store(wanted.select("c").distinct().join(self.reps, "c").select(F.col("c").alias("wc"), F.col("rep")), "wanted")
        text = pick(self.docs, doc_id=self.id_col, text=self.text_col)
        mine = _by_key(text, keys, F.col("doc_id").eqNullSafe(F.col("rep"))).select("doc_id", "text", "wc")
        words, build = token_set(F.col("text"), self.rule.shingle)
        s = mine.select("wc", words.alias("words")).select("wc", build(F.col("words")).alias("tokens"))
        # stored before it is filtered: a filter would be pushed below the sets and build them again per token
        s = store(s.select("tokens", "wc", F.xxhash64("tokens").alias("c")), "full-sets")
        return s.where("c = wc").select("c", "tokens").dropDuplicates(["c"])

    def verified(self, pairs: DataFrame) -> DataFrame:
        """a, b, na, nb, o: the exact overlap of each pair of classes."""
        pairs = store(pairs.select("a", "b").distinct(), "pairs")
        sets = self.full_sets(pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))))
        one = sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
        two = sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
        return store(pairs.join(one, "a").join(two, "b").select(
            "a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), F.size(F.array_intersect("ta", "tb")).alias("o")), "overlaps")

    def not_ruled_out(self, pairs: DataFrame, room: Column) -> DataFrame:
        """Pairs (a, b, ...) whose heads allow a link of them, or of members of
        their stars that deviate by ``room`` (see ``Rule.room``) in all. In the part
        of the order that both heads reach, tokens of one set that the other
        lacks bound the overlap from above."""
        pairs = store(pairs, "maybe")
        keys = store(pairs.select(F.col("a").alias("wc")).union(pairs.select("b")).distinct(), "maybe-sets")
        h = _by_key(self.classes.select("c", "n", "head", "full"), keys, F.col("c") == F.col("wc")).drop("wc")
        one = h.select(*[F.col(x).alias(x + "1") for x in h.columns])
        two = h.select(*[F.col(x).alias(x + "2") for x in h.columns])
        p = pairs.join(one, F.col("a") == F.col("c1")).join(two, F.col("b") == F.col("c2"))
        last = lambda k: F.when(F.col("full" + k), F.lit(_ALL)).otherwise(F.element_at("head" + k, -1))
        p = p.withColumn("reach", F.least(last("1"), last("2")))
        p = p.withColumn("in1", F.filter("head1", lambda t: t <= F.col("reach"))).withColumn("in2", F.filter("head2", lambda t: t <= F.col("reach")))
        p = p.withColumn("common", F.size(F.array_intersect("in1", "in2")))
        most = F.least(F.col("n1") - F.size("in1") + F.col("common"), F.col("n2") - F.size("in2") + F.col("common"))
        return p.where(self.rule.may_link(most, room, F.col("n1"), F.col("n2"))).select(*pairs.columns)


def _attach(w: _Work) -> DataFrame:
    """a (class), b (leader), na, nb, o: verified links of classes to the leaders
    of their keys; at most one pair per class and key."""
    found = None
    for j in (1, 2, 3):
        k = w.classes.select(F.col(f"key{j}").alias("key"), "c", "n")
        lead = k.groupBy("key").agg(F.min_by(F.struct("c", "n"), "c").alias("l"), F.count(F.lit(1)).alias("m")).where("m > 1")
        p = k.join(lead, "key").where((F.col("c") != F.col("l.c")) & w.rule.links(F.least("n", "l.n"), F.col("n"), F.col("l.n"))) \
            .select(F.col("c").alias("a"), F.col("l.c").alias("b"))
        found = p if found is None else found.union(p)
    near = w.not_ruled_out(found.distinct(), F.lit(0))
    return w.verified(near).where(w.rule.links(F.col("o"), F.col("na"), F.col("nb")))


def _shared(prefixes: DataFrame) -> DataFrame:
    """token, m: tokens that prefixes of several components hold, and how many do."""
    return (prefixes.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
            .where("c0 < c1").select("token", "m"))


def _prefixes(w: _Work, comp: DataFrame) -> DataFrame:
    """c, n, comp, pos, token: prefixes under the order that puts tokens of many
    sets last, as far as other components hold the token too."""
    short = comp.count() <= BROADCAST_ROWS
    base = w.classes.select("c", "n", "head", "full").join(F.broadcast(comp) if short else comp, "c", "left") \
        .withColumn("comp", F.coalesce("component", "c")).drop("component")
    plain = base.select("c", "n", "comp", F.slice("head", F.lit(1), w.rule.prefix_len(F.col("n"))).alias("prefix"))
    many = lambda x: _shared(x).where(F.col("m") > HOT).select(F.col("token").alias("hot"))

    def holding(hot: DataFrame) -> DataFrame:
        return store(_by_key(plain.select("c", F.explode("prefix").alias("token")), hot, F.col("token") == F.col("hot"))
                     .select(F.col("c").alias("hc")).distinct(), "hot-sets")

    hot = store(many(plain.select("comp", F.explode("prefix").alias("token"))), "hot-tokens")
    # what sets with a hot token would move up to is counted as well
    heads = _by_key(base, holding(hot), F.col("c") == F.col("hc")).select("comp", F.explode("head").alias("token"))
    hot = store(hot.union(many(heads)).distinct(), "hot-tokens")
    # only sets with a hot token in the prefix are ordered again
    hit = holding(hot)
    again = _by_key(base, hit, F.col("c") == F.col("hc"))
    short = hit.count() <= BROADCAST_ROWS
    plain = plain.join(F.broadcast(hit) if short else hit, F.col("c") == F.col("hc"), "left_anti")

    def ordered(sets: DataFrame, tokens: str) -> DataFrame:
        held = _by_key(sets.select("c", F.explode(tokens).alias("token")), hot, F.col("token") == F.col("hot")) \
            .groupBy("c").agg(F.collect_set("token").alias("hots"))
        return (sets.join(held, "c", "left").withColumn("hots", F.coalesce("hots", F.array().cast("array<bigint>")))
                .withColumn("cold", F.array_except(tokens, "hots"))
                .withColumn("prefix", F.slice(F.concat("cold", F.sort_array("hots")), F.lit(1), w.rule.prefix_len(F.col("n")))))

    new = ordered(again, "head").withColumn("enough", F.col("full") | (F.size("cold") >= w.rule.prefix_len(F.col("n"))))
    new = store(new.select("c", "n", "comp", "enough", "prefix"), "new-prefixes")
    out = plain.union(new.where("enough").select("c", "n", "comp", "prefix"))
    lack = new.where("not enough").select("c", "n", "comp")
    if not lack.isEmpty():  # the head holds too few cold tokens: order the whole set
        out = out.union(ordered(lack.join(w.full_sets(lack), "c"), "tokens").select("c", "n", "comp", "prefix"))
    post = out.select("c", "n", "comp", F.posexplode("prefix").alias("pos", "token"))
    shared = store(_shared(post).select(F.col("token").alias("shared")), "shared-tokens")
    # a plain join at every size: the list grows with the corpus
    return post.join(shared, F.col("token") == F.col("shared")).drop("shared")


def _meet(lists: DataFrame, rule: Rule) -> DataFrame:
    """a, b: entries of different components that meet in an index list and that
    size and position allow to link.

    ``lists``: token, e (entry), comp, lo, hi (its least and greatest set size),
    rest (most tokens that a member has from its position on). A list is cut by
    size, position and, if long, hash; a block knows its extremes, and a probe
    reads only blocks that these allow to hold a link.
    """
    size_block = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(rule.den / rule.num))).cast("int")
    many = lists.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1")) \
        .where("m > 1 and c0 < c1").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("slots"))
    # entries of several sizes stand in every size block they reach
    held = lists.join(many, "token").select("token", "e", "comp", "lo", "hi", "rest", "slots")
    index = held.withColumn("sb", F.explode(F.sequence(size_block("lo"), size_block("hi"))))
    index = index.groupBy("token", "sb", "lo", (F.col("hi") - F.col("rest")).alias("pb"),
                          F.pmod(F.xxhash64("e"), F.col("slots")).alias("slot")) \
        .agg(F.min("lo").alias("blo"), F.max("hi").alias("bhi"), F.max("rest").alias("brest"),
             F.collect_list(F.struct("e", "comp", "lo", "hi", "rest")).alias("members"))
    probe = held.select(F.col("token").alias("pt"), F.col("e").alias("pe"), F.col("comp").alias("pc"), F.col("lo").alias("plo"),
                        F.col("hi").alias("phi"), F.col("rest").alias("prest"),
                        F.explode(F.sequence(size_block("lo") - 1, size_block("hi") + 1)).alias("psb"))

    def may(lo1, hi1, rest1, lo2, hi2, rest2):
        return rule.links(F.least(hi1, hi2), lo1, lo2) & rule.links(F.least(rest1, rest2), lo1, lo2) \
            & rule.links(lo1, lo1, lo2 * 0 + F.least(lo1, hi2)) & (rule.num * lo1 <= rule.den * hi2) & (rule.num * lo2 <= rule.den * hi1)

    j = index.join(probe, (F.col("token") == F.col("pt")) & (F.col("sb") == F.col("psb"))
                   & may(F.col("blo"), F.col("bhi"), F.col("brest"), F.col("plo"), F.col("phi"), F.col("prest")))
    met = F.filter("members", lambda m: (m["e"] < F.col("pe")) & (m["comp"] != F.col("pc"))
                   & may(m["lo"], m["hi"], m["rest"], F.col("plo"), F.col("phi"), F.col("prest")))
    return j.select("pe", F.explode(F.transform(met, lambda m: m["e"])).alias("a")).select("a", F.col("pe").alias("b")).distinct()


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule(), **more: Column):
    """(links, comp, members): links (a, b, na, nb, o) between classes, enough to
    connect every component, each verified; comp (c, component) of the linked
    classes; members (doc_id, n, c and ``more``) of all rows."""
    w = _Work(docs, id_col, text_col, rule, **more)
    near = _attach(w)
    comp = store(components(near).select(F.col("node").alias("c"), "component"), "components")
    # each class in the star of one leader; a leader that is itself attached keeps a star of its own
    star = near.groupBy("a").agg(F.min_by(F.struct("b", (F.col("na") - F.col("o")).alias("mine"), (F.col("nb") - F.col("o")).alias("other")),
                                          F.col("b")).alias("s"))
    leads = near.select(F.col("b").alias("lead")).distinct()
    star = store(star.join(leads, F.col("a") == F.col("lead"), "left_anti").select(
        F.col("a").alias("c"), F.col("s.b").alias("star"), w.rule.room(F.col("s.mine"), F.col("s.other")).alias("room")), "stars")
    post = store(_prefixes(w, comp).join(star, "c", "left").withColumn("star", F.coalesce("star", "c"))
                 .withColumn("room", F.coalesce("room", F.lit(0))), "postings")
    by_star = post.groupBy("token", F.col("star").alias("e")).agg(
        F.min("comp").alias("comp"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    by_star = store(by_star, "lists")
    long = store(long_tokens(by_star), "long-tokens")
    is_long = F.col("token") == F.col("long")
    if not long.isEmpty():
        found = family_links(w, post.join(long, is_long, "left_semi").select("token", "c", "pos"), comp)
        near, comp = near.unionByName(found), joined(comp, found)
        now = comp.select("c", F.col("component").alias("now"))
        by_star = by_star.join(long, is_long, "left_anti").join(now, F.col("e") == F.col("c"), "left").withColumn("comp", F.coalesce("now", "comp")).drop("c", "now")
    met = _meet(by_star, rule)
    most = star.groupBy("star").agg(F.max("room").alias("room"))
    of = lambda k: most.select(F.col("star").alias(k), F.col("room").alias("room_" + k))
    met = met.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("room_a", F.lit(0)).alias("room_a"), F.coalesce("room_b", F.lit(0)).alias("room_b"))
    met = store(w.not_ruled_out(met, F.col("room_a") + F.col("room_b")), "star-pairs")
    answers = store(w.verified(met).join(met, ["a", "b"]), "answers")
    linked = w.rule.links(F.col("o"), F.col("na"), F.col("nb"))
    links = near.unionByName(answers.where(linked).drop("room_a", "room_b"))
    comp = joined(comp, answers.where(linked))
    # open: stars of different components whose members may still link
    lab = lambda k: comp.select(F.col("c").alias(k), F.col("component").alias("comp_" + k))
    still = answers.where(~linked & w.rule.may_link(F.col("o"), F.col("room_a") + F.col("room_b"), F.col("na"), F.col("nb")))
    still = store(still.join(lab("a"), "a", "left").join(lab("b"), "b", "left")
                  .where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).drop("comp_a", "comp_b"), "open-stars")
    if still.isEmpty():
        return links, comp, w.light.select("doc_id", "n", "c", *more)
    # derived: what a member deviates from its leader bounds what it can share with the other star
    member = post.groupBy("c", "star", "room", "n").agg(F.collect_list(F.struct("token", "pos")).alias("prefix"))
    one = member.select(*[F.col(x).alias(x + "1") for x in member.columns])
    two = member.select(*[F.col(x).alias(x + "2") for x in member.columns])
    side = lambda room: w.rule.may_link(F.col("o"), room, F.col("na"), F.col("nb"))
    left = still.join(one, (F.col("a") == F.col("star1")) & side(F.col("room1") + F.col("room_b")))
    right = still.join(two, (F.col("b") == F.col("star2")) & side(F.col("room2") + F.col("room_a")))
    left = left.select("a", "b", "o", "na", "nb", "c1", "n1", "room1", F.explode("prefix1").alias("p1"))
    right = right.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "c2", "n2", "room2", F.explode("prefix2").alias("p2"))
    rest = F.least(F.col("n1") - F.col("p1.pos"), F.col("n2") - F.col("p2.pos"))
    pairs = left.join(right, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")) & (F.col("p1.token") == F.col("p2.token"))
                      & side(F.col("room1") + F.col("room2")) & w.rule.links(rest, F.col("n1"), F.col("n2")))
    pairs = w.not_ruled_out(pairs.select(F.col("c1").alias("a"), F.col("c2").alias("b")).distinct(), F.lit(0))
    found = store(w.verified(pairs).where(linked), "member-links")
    if not found.isEmpty():
        links = links.unionByName(found)
        comp = joined(comp, found)
    return links, comp, w.light.select("doc_id", "n", "c", *more)


def _first(docs: DataFrame, id_col: str, text_col: str, rule: Rule, **more: Column) -> DataFrame:
    """doc_id, n, ``more`` and first, the least doc_id of the row's component, with
    ``more`` a struct of it and them; null for empty sets."""
    _, comp, members = jaccard_links(docs, id_col, text_col, rule, **more)
    name = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *more)) if more else F.col("doc_id")
    classes = members.where("n > 0").groupBy("c").agg(F.min(name).alias("least"))
    named = classes.join(comp, "c", "left").withColumn("component", F.coalesce("component", "c"))
    names = named.groupBy("component").agg(F.min("least").alias("first"))
    named = store(named.join(names, "component").select(F.col("c").alias("cc"), "first"), "component-names")
    return members.join(named, (F.col("c") == F.col("cc")) & (F.col("n") > 0), "left").drop("c", "cc")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Links join classes of equal sets; the component is the least doc_id that
    links reach. Null or blank texts have empty sets and stay alone. Rows that
    repeat a doc_id each have the component of their own text; null doc_ids take
    part but give no component its name. An empty table gives an empty result.
    """
    out = _first(docs, id_col, text_col, rule)
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, with its columns: that of the least doc_id, of
    its rows the least text digest, of equal texts the least row. Rows are told
    apart by doc_id and text, so a doc_id repeated with another text is judged by
    each text. Rows without a doc_id or without words stay."""
    digest = F.xxhash64(F.col(f"`{text_col}`"))
    rows = _first(docs, id_col, text_col, rule, digest=F.xxhash64("text")).where("doc_id is not null and first is not null")
    rows = store(rows.select("doc_id", "digest", (F.struct("doc_id", "digest") == F.col("first")).alias("stays")), "near-duplicates")
    key = [F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")]
    here = (F.col(f"`{id_col}`") == F.col("_id")) & (digest == F.col("_digest"))
    kept = docs.join(store(rows.where("not stays").select(*key).distinct(), "near-copies"), here, "left_anti")
    twice = rows.where("stays").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    twice = store(twice.select(*key), "repeated-rows")
    if twice.isEmpty():
        return kept
    least = kept.join(twice, here, "inner").groupBy("_id", "_digest").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return kept.join(twice, here, "left_anti").unionByName(least.select("_row.*"))


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN array_to_string(w[i:i + 2], ' ') ELSE array_to_string(w, ' ') END AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.m AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) c ON c.x = d.doc_id"""
