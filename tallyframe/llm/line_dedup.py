"""Line deduplication by an exact set-similarity join of lines' token sets."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, text_of, written

#: Pairs are sought in so many parts of the prefix tokens, one after the other, so that the tokens of one part are on disk at a time.
PARTS = 2
#: Sets of which so many share a prefix token are compared by their differences from what most of them have.
CROWD = 64
#: Crowds are found by one in so many sets, and what most of a crowd have by about so many of its sets; neither has a bearing on the result.
SPARSE, JURY = 8, 32


def words_of(line: Column) -> Column:
    """A line's words: lower-cased runs of letters and digits; blank ones come along."""
    return F.split(F.lower(line), r"[^\p{L}\p{N}]+")


def token_set(line: Column) -> Column:
    """A line's distinct words as sorted longs: seven bits of length in bytes, long words first since those are rare, then 57 of hash."""
    token = lambda w: F.shiftleft(F.bitwise_not(F.octet_length(w).cast("long")), 57).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 7))
    return F.sort_array(F.array_remove(F.array_distinct(F.transform(words_of(line), token)), token(F.lit(""))))


def parities(tokens: Column) -> Column:
    """64 bits, each flipped once for every token that falls on it: two sets differ in at least as many tokens as in bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))


def most(votes: DataFrame, of: str, name: str) -> DataFrame:
    """For each ``of`` the crowd that most of its rows name, and how many do; ties to the smaller."""
    best = votes.groupBy(of, "crowd").count().groupBy(of).agg(F.min(F.struct((-F.col("count")).alias("v"), "crowd")).alias("best"))
    return best.select(of, F.col("best.crowd").alias(name), (-F.col("best.v")).alias("named"))


def crowds(some: DataFrame, neighbours: Callable[..., DataFrame], upto: Column, k: float) -> DataFrame:
    """Sets that lie in a crowd, and how each differs from it.

    Of each prefix token that is frequent among some of the sets, the first of
    those gives a crowd its number; a set is of the crowd that most of its
    frequent tokens name. Then each of those tokens names the crowd that most of
    its sets are of, and the sets are dealt out once more, so that a group of
    near copies is one crowd. Sets of whose prefix tokens less than a quarter
    name their crowd are of none. The tokens that most sets of a crowd have are
    its base, of size p. For a set of n tokens, d of the
    base missing, ``apart`` is d + k n - p/2: two sets of the crowd match if the
    sum of both is at most the number of differences they share, since they
    share p - d - d' tokens and those differences, whatever the base. Sets that differ from the
    base in more than half its size are of no crowd.
    """
    few = neighbours(some.where(F.pmod("l1", F.lit(SPARSE)) == 0)).groupBy("gram").agg(F.count("*").alias("sets"), F.min("sid").alias("crowd"))
    many = written(few.where(F.col("sets") * SPARSE >= CROWD).select("gram", "crowd"))
    hits = written(neighbours(some).join(many, "gram").select("sid", "n", "gram", "crowd"))
    named = hits.drop("crowd").join(most(hits, "sid", "crowd").drop("named"), "sid")
    again = written(most(named, "gram", "crowd").drop("named"))
    of = most(hits.select("sid", "gram").join(again, "gram"), "sid", "crowd").join(hits.select("sid", "n").distinct(), "sid")
    of = written(of.where(4 * F.col("named") > upto).select("sid", "crowd"))
    sizes = written(of.groupBy("crowd").agg(F.count("*").alias("sets")).where(F.col("sets") >= CROWD))
    members = written(some.join(of, "sid").join(sizes, "crowd").select("sid", "crowd", "sets", "n", "first", "tokens"))
    jury = members.where(F.pmod(F.xxhash64("sid"), F.greatest(F.lit(1), F.floor(F.col("sets") / JURY))) == 0)
    tokens = jury.select("crowd", F.explode("tokens").alias("token")).groupBy("crowd", "token").count()
    seats = jury.groupBy("crowd").agg(F.count("*").alias("seats"))
    base = tokens.join(seats, "crowd").where(2 * F.col("count") > F.col("seats")).groupBy("crowd").agg(F.collect_list("token").alias("base"))
    told = members.join(base, "crowd").withColumn("lost", F.array_except("base", "tokens")).withColumn("more", F.array_except("tokens", "base"))
    p = F.size("base")
    near = told.where(2 * (F.size("lost") + F.size("more")) <= p)
    found = written(near.select("sid", "crowd", "first", (F.size("lost") + F.lit(k) * F.col("n") - p / 2).alias("apart"), F.concat("lost", "more").alias("own")))
    discard(many, hits, again, of, sizes, members)
    return found


def links_in_crowds(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links inside crowds: by set the number of those that hold whatever the differences are, and as pairs those that shared differences make."""
    some = members.groupBy("crowd", "apart").agg(F.count("*").alias("sets"), F.min("first").alias("first"))
    sum_of = F.col("a.apart") + F.col("b.apart")
    sure = (
        some.alias("a").join(some.alias("b"), (F.col("a.crowd") == F.col("b.crowd")) & (sum_of <= 1e-9))
        .groupBy(F.col("a.crowd").alias("crowd"), F.col("a.apart").alias("apart")).agg(F.sum("b.sets").alias("links"), F.min("b.first").alias("other"))
    )
    itself = F.when(2 * F.col("apart") <= 1e-9, 1).otherwise(0)
    counted = members.join(sure, ["crowd", "apart"]).select("sid", "other", (F.col("links") - itself).alias("links"))
    # The differences of a set, the rarest of its crowd first; of f, sets that must share r have one of the first f - r + 1 in common.
    each = members.select("crowd", "sid", F.explode("own").alias("token"))
    ranked = each.join(each.groupBy("crowd", "token").agg(F.count("*").alias("n")).where("n > 1"), ["crowd", "token"])
    ranked = ranked.groupBy("sid").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("own"))
    least = members.groupBy("crowd").agg(F.min("apart").alias("least"))
    must = F.greatest(F.lit(1), F.ceil(F.col("apart") + F.col("least") - 1e-9))
    known = written(members.drop("own").join(ranked, "sid").join(least, "crowd").withColumn("upto", (F.size("own") - must + 1).cast("int")).where("upto > 0"))
    keys = known.select("crowd", "sid", "first", "apart", "own", F.posexplode(F.slice("own", F.lit(1), F.col("upto"))).alias("i", "token"))
    ia, ib = F.col("a.i"), F.col("b.i")
    can = F.least(ia, ib) + F.least(F.size("a.own") - ia, F.size("b.own") - ib)
    shared = F.array_intersect("a.own", "b.own")
    by_own = (
        keys.alias("a").join(keys.alias("b"), (F.col("a.crowd") == F.col("b.crowd")) & (F.col("a.token") == F.col("b.token")) & (F.col("a.sid") < F.col("b.sid"))
            & (sum_of > 1e-9) & (can >= sum_of - 1e-9) & (F.size(shared) >= sum_of - 1e-9) & (F.get(shared, F.lit(0)) == F.col("a.token")))
        .select(F.col("a.sid").alias("a"), F.col("b.sid").alias("b"), F.col("a.first").alias("fa"), F.col("b.first").alias("fb"))
    )
    pairs = written(by_own)
    discard(known)
    return counted, pairs


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: its lines, links, and the lines to remove.

    Two lines match if the Jaccard similarity of their sets of words is
    ``threshold`` or more; a line is removed if a line before it, by id, then
    line number, matches it, whether that one stays or not. Lines without words
    (blank ones, those of null or empty texts) match nothing. Rows with a null
    id come last; rows that repeat an id are one document, whose lines do not
    precede each other. ``n_links`` counts, over the lines, the other token sets
    that match. Texts and lines may be of any length; other columns of ``docs``,
    whatever their names, are not touched. An empty table gives no rows.

    Equal lines are one, combined before the shuffle, so a line that very many
    documents share is one row; of lines with equal sets the first one stands
    for all in the join. Each set's tokens are
    ordered by length, long words first, since those are rare; ties go by hash,
    so the order is total. Sets of sizes n and m that match share
    c = ceil(t/(1+t)(n+m)) tokens and have d = n+m-2c others, so some two
    neighbours in that order are neighbours in both sets before place
    n-c+d of the one and m-c+d of the other (d others part at most d shared
    tokens, c is at least d+2). The join is on such pairs of prefix tokens, with
    bounds on sizes and places as its conditions; sets too small for that bound
    join on single prefix tokens. Pairs whose parities of token bits differ more
    than the sets may are left out there, and what is left is verified by the
    exact Jaccard of the sets, whose tokens are told apart by 57 bits of their
    hash and their length. Sets of one crowd of near copies (``crowds``) are not paired so: links
    that their differences cannot undo are counted, others are pairs that share
    a difference.
    """
    t = threshold
    k = t / (1 + t)
    # Sets of together fewer tokens may have no two neighbours in common.
    few = math.ceil(2 * (1 + t) / (2 * t - 1) - 1e-9) if t > 0.5 else 1 << 30
    text = text_of(docs, text_col)
    numbered = docs.select(docs[id_col].alias("_id"), text.alias("_whole")).withColumn("_row", F.monotonically_increasing_id())
    said = numbered.select("_id", "_row", F.posexplode(F.split("_whole", "\n")).alias("_line", "_text"))
    line = F.col("_text")
    lines = said.select("_id", "_row", "_line", "_text", F.xxhash64(line).alias("l1"), F.xxhash64(F.lit(7), line).alias("l2"))
    place = F.struct(F.col("_id").isNull().alias("e"), F.col("_id").alias("d"), F.col("_line").alias("l"))

    # Words are cut once, of each different line; the number keeps the filter behind that.
    different = lines.select("l1", "l2", place.alias("at"), "_text").groupBy("l1", "l2").agg(F.min("at").alias("first"), F.count("*").alias("times"), F.first("_text").alias("_text"))
    cut = different.select("l1", "l2", "first", "times", token_set(F.col("_text")).alias("tokens"), F.monotonically_increasing_id().alias("sid"))
    key = (F.xxhash64("tokens").alias("k1"), F.xxhash64(F.lit(7), "tokens").alias("k2"))
    forms = written(cut.select("*", *key, F.size("tokens").alias("n"), parities(F.col("tokens")).alias("bits")).where("n > 0"), compression="zstd")
    # Of different lines with equal sets all but the first are the other forms of that one.
    twice = written(forms.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2"))
    alike = written(forms.select("k1", "k2", "l1", "l2", "first", "sid").join(twice, ["k1", "k2"]))
    head = alike.groupBy("k1", "k2").agg(F.min(F.struct("first", "sid")).alias("head"))
    other_forms = written(alike.join(head, ["k1", "k2"]).where("sid <> head.sid").select(F.col("sid").alias("form"), F.col("head.sid").alias("sid"), "l1", "l2", "head.first"))
    sets = forms.drop("k1", "k2").join(other_forms.select(F.col("form").alias("sid")), "sid", "left_anti")
    n = F.col("n")
    some = sets.where(n >= t / (1 - t) - 1e-9) if t < 1 else sets.where("false")
    i = F.col("i")
    upto = F.least(n - 2, F.floor(2 * (1 - t) * n + 1e-9).cast("int"))

    def neighbours(of: DataFrame, *more: str) -> DataFrame:
        each = of.where("n > 1").select("sid", "n", *more, "tokens", F.explode(F.sequence(F.lit(0), upto)).alias("i"))
        return each.select("sid", "n", *more, "i", F.xxhash64(F.get("tokens", i), F.get("tokens", i + 1)).alias("gram"))

    def alone(of: DataFrame, *more: str) -> DataFrame:
        each = of.where(n < few).select("sid", "n", *more, "tokens", F.explode(F.sequence(F.lit(0), F.floor((1 - t) * n + 1e-9).cast("int"))).alias("i"))
        return each.select("sid", "n", *more, (-1 - i).alias("i"), F.xxhash64(F.get("tokens", i)).alias("gram"))

    members = crowds(some, neighbours, upto, k)
    counted, by_own = links_in_crowds(members)
    crowded = some.join(members.select("sid", "crowd"), "sid", "left")
    grams = neighbours(crowded, "crowd", "bits").unionByName(alone(crowded, "crowd", "bits"))

    na, nb, ia, ib = F.col("a.n"), F.col("b.n"), F.col("a.i"), F.col("b.i")
    c = F.ceil(F.lit(k) * (na + nb) - 1e-9).cast("int")
    others = na + nb - 2 * c
    # i counts neighbours from 0, single tokens from -1 downwards.
    near = F.when(ia >= 0, (ia <= na - c + others) & (ib <= nb - c + others) & (F.least(ia, ib) + F.least(na - ia, nb - ib) >= c)).otherwise(
        (na + nb < few) & (F.least(na + ia, nb + ib) + 1 >= c)
    )
    # Sets of one crowd are compared by their differences.
    apart = F.col("a.crowd").isNull() | F.col("b.crowd").isNull() | (F.col("a.crowd") != F.col("b.crowd"))
    unlike = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    can = (F.col("a.sid") < F.col("b.sid")) & apart & ((ia >= 0) | (ib < 0)) & ((ib >= 0) | (ia < 0)) & (F.least(na, nb) >= F.lit(t) * F.greatest(na, nb) - 1e-9) & near & (unlike <= others)

    def met(part: int) -> DataFrame:
        """The pairs that share a prefix token of the part, written; the shuffled tokens are gone by then."""
        own = grams.where(F.pmod("gram", F.lit(PARTS)) == part)
        both = own.alias("a").join(own.alias("b"), (F.col("a.gram") == F.col("b.gram")) & can)
        return written(both.select(F.col("a.sid").alias("a"), F.col("b.sid").alias("b")).distinct(), compression="zstd")

    found = [met(part) for part in range(PARTS)]
    pairs = reduce(DataFrame.unionByName, found).distinct()
    ends = reduce(DataFrame.unionByName, found)
    ends = written(ends.select(F.col("a").alias("sid")).unionByName(ends.select(F.col("b").alias("sid"))).distinct())
    # Only sets that occur in pairs go on with their tokens.
    paired = written(sets.join(ends, "sid", "left_semi").select("sid", "n", "first", "tokens"), compression="zstd")

    one_of = lambda x: paired.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"), F.col("first").alias(f"f{x}"))
    both = F.size(F.array_intersect("ta", "tb"))
    # Sets with their tokens are shuffled for one part of the pairs at a time.
    def matching(part: int) -> DataFrame:
        own = pairs.where(F.pmod(F.xxhash64("a"), F.lit(PARTS)) == part)
        return written(own.join(one_of("a"), "a").join(one_of("b"), "b").where(both >= F.lit(k) * (F.col("na") + F.col("nb")) - 1e-9).select("a", "b", "fa", "fb"))

    matched = [matching(part) for part in range(PARTS)]
    links = reduce(DataFrame.unionByName, [*matched, by_own])
    each = links.select(F.col("a").alias("sid"), F.col("fb").alias("other")).unionByName(links.select(F.col("b").alias("sid"), F.col("fa").alias("other")))
    each = each.withColumn("links", F.lit(1).cast("long")).unionByName(counted)
    earliest = each.groupBy("sid").agg(F.min("other").alias("other"), F.sum("links").alias("links"))
    # Only lines that occur again, in whatever form, or have links decide anything.
    since = (F.least("first", F.coalesce("other", "first")).alias("since"), F.coalesce("links", F.lit(0)).alias("links"))
    earliest = written(earliest)
    verdict = written(
        sets.select("sid", "l1", "l2", "first", "times").join(earliest, "sid", "left").where("times > 1 or links is not null").select("l1", "l2", *since)
        .unionByName(other_forms.join(earliest, "sid", "left").select("l1", "l2", *since))
    )
    discard(forms, twice, alike, other_forms, members, by_own, ends, paired, earliest, *found, *matched)
    judged = lines.select("_id", "_row", "_line", place.alias("at"), "l1", "l2").join(verdict, ["l1", "l2"], "left")
    gone = F.when(F.coalesce(F.col("since") < F.col("at"), F.lit(False)), F.col("_line"))
    return judged.groupBy("_row", "_id").agg(
        F.count("*").alias("n_lines"), F.count(gone).alias("n_removed"), F.coalesce(F.sum("links"), F.lit(0)).alias("n_links"),
        F.array_join(F.sort_array(F.collect_list(gone)).cast("array<string>"), ",").alias("removed_lines"),
    ).select(F.col("_id").alias(id_col), "n_lines", "n_removed", "n_links", "removed_lines")
