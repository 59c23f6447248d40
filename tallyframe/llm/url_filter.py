"""URL filter: rules by host and path, and naive Bayes over segmented names for the rest."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Fixed by the contract: verdict, host and path of each rule.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Part of the model: letters of the longest word that a name is cut into. Longer title words are not counted, as no cut could use them.
LONGEST_WORD = 24


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(has, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1)).otherwise("")
    before_query = F.substring_index(rest, "?", 1)
    host = F.translate(F.substring_index(before_query, "/", 1), UPPER, LOWER)
    path = F.regexp_replace(before_query, "(?s)^[^/]*", "")
    return host, path


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest fitting rule as (rule, verdict), or null."""
    out = F.lit(None)
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def names_of(host: Column, path: Column) -> Column:
    """The names in a host and path: runs of letters, lower-cased; a run of digits is ``0``."""
    plain = F.regexp_replace(F.lower(F.concat(host, F.lit(" "), path)), "[0-9]+", " 0 ")
    return F.array_remove(F.split(plain, r"[^\p{L}0]+"), "")


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, parts): each name of ``names`` split into words by unigram Viterbi.

    ``words`` has (word, n). Every substring of a name, up to ``LONGEST_WORD``
    letters, is joined with the word counts, so that no vocabulary is sent
    anywhere; a name's known substrings then go through the recursion. Letters
    in no known word cost more the longer their run is.
    """
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] + 1
    size = F.length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    longest = F.least(F.lit(LONGEST_WORD), size - F.col("at") + 1)
    cuts = starts.select("name", "at", F.explode(F.sequence(F.lit(1), longest)).alias("k")).select("name", "at", "k", F.expr("substring(name, at, k)").alias("word"))
    known = cuts.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("at", "k", "n")).alias("found"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for name, found in zip(pdf["name"], pdf["found"], strict=True):
                ends: dict[int, list[tuple[int, float]]] = {}
                for x in found if found is not None else ():
                    ends.setdefault(x["at"] - 1 + x["k"], []).append((x["at"] - 1, np.log(x["n"] / total)))
                best, back = np.full(len(name) + 1, -np.inf), [0] * (len(name) + 1)
                best[0] = 0
                for end in range(1, len(name) + 1):
                    unknown = [(at, -np.log(total) - 2.3 * (end - at)) for at in range(max(0, end - LONGEST_WORD), end)]
                    for at, score in ends.get(end, []) + unknown:
                        if best[at] + score > best[end]:
                            best[end], back[end] = best[at] + score, at
                cut, end = [], len(name)
                while end:
                    cut.append(name[back[end] : end])
                    end = back[end]
                parts.append(cut[::-1])
            yield pd.DataFrame({"name": pdf["name"], "parts": parts})

    return names.join(known, "name", "left").mapInPandas(split, "name string, parts array<string>")


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: tuple = RULES,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict and the score of the method.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest fitting one decides. Elsewhere multinomial naive Bayes decides,
    learnt from the pages that rules decided: block if its log odds are above 0.
    Its tokens are the names in host and path, split into words by unigram
    Viterbi with the word counts of all page titles. Null urls and urls without
    ``://`` have an empty host and path, no tokens, and so the larger class's
    verdict; without any ruled page everything is allowed. Repeated rows are
    judged each for itself; urls may be of any length (a name of n letters has at
    most 24 n substrings); of equally good cuts of a name the one with the
    earliest known word decides; other columns of ``pages``, whatever their names,
    are not touched; an empty table gives no rows.

    Pages are first reduced to distinct (host, names, rule verdict) with counts,
    combined before the shuffle, so a host with a third of all pages is one row
    in what follows. Every join is on a key; nothing is collected but three sums.
    """
    url = pages[url_col]
    host, path = host_and_path(url)
    rows = pages.select(pages[id_col].alias("_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_names", names_of(F.col("host"), F.col("path")))
    rows = rows.select("_id", "host", "path", "_rule.rule", "_rule.verdict", F.array_join("_names", " ").alias("_text"))
    kinds = written(rows.groupBy("_text", "verdict").agg(F.count("*").alias("n")))

    title = F.regexp_extract(F.coalesce(pages[html_col], F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)
    words = written(
        pages.select(F.explode(F.split(F.lower(title), r"[^\p{L}]+")).alias("word")).where(f"length(word) between 1 and {LONGEST_WORD}")
        .groupBy("word").agg(F.count("*").alias("n"))
    )
    texts = kinds.select("_text").distinct()
    names = texts.select("_text", F.explode(F.split("_text", " ")).alias("name")).where("name <> ''")
    parts = written(segmented(names.select("name").distinct(), words))
    tokens = written(names.join(parts, "name").select("_text", F.explode("parts").alias("token")).groupBy("_text", "token").agg(F.count("*").alias("k")))

    learnt = kinds.where("verdict is not null")
    counts = (
        tokens.join(learnt, "_text").groupBy("token")
        .agg(F.sum(F.when(F.col("verdict") == "block", F.col("k") * F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("verdict") == "allow", F.col("k") * F.col("n")).otherwise(0)).alias("good"))
    )
    counts = written(counts)
    sums = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("*").alias("v")).first()
    held = {r["verdict"]: r["n"] for r in learnt.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    prior = float(np.log((held.get("block", 0) + 1) / (held.get("allow", 0) + 1))) if held else -1.0
    rate = lambda n, total: F.log((F.col(n) + 1) / F.lit(float(total + sums["v"] + 1)))
    known = F.coalesce(F.col("k") * (rate("bad", sums["bad"]) - rate("good", sums["good"])), F.lit(0.0))
    odds = written(
        texts.join(tokens, "_text", "left").join(counts, "token", "left").groupBy("_text").agg((F.sum(known) + prior).alias("score"))
    )
    judged = rows.join(odds, "_text", "left")
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        F.round("score", 6).alias("log_odds"),
    )
