"""Phrase collocation mining: word-id suffix arrays of shards, whose LCP intervals are counts of phrases, merged by key."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_of, written

#: Fixed by the contract: what ends a piece, what separates its words (space and tab), and the language of rows without one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

#: A byte that UTF-8 never uses: it stands for the end of a piece.
END = b"\xff"
TO_END = bytes.maketrans(PIECE_ENDS, END * len(PIECE_ENDS))
SHARD_BYTES = 4 << 20
#: Keys that one group of the merge holds, about; a shard has at most ``longest`` keys for each word.
KEYS_A_GROUP = 1 << 21


def shard_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of (_lang, _text) as shards of one language each: its words, and the text as their numbers, 0 where a piece ends."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)
    first, made, total = TaskContext.get().partitionId() << 32, 0, 0

    def shard(lang: str, raw: bytes) -> pd.DataFrame:
        nonlocal made
        numbers = {END: 0}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in raw.replace(END, b" \xff ").split()], np.int32)
        made += 1
        return pd.DataFrame({"shard": [first + made], "lang": [lang], "words": [END.join(list(numbers)[1:])], "ids": [ids.tobytes()], "n_words": [int((ids > 0).sum())]})

    def emptied(lang: str) -> Iterator[pd.DataFrame]:
        nonlocal total
        raw = END.join(held.pop(lang))
        total -= sizes.pop(lang)
        lo = 0
        while lo < len(raw):
            # A text that is longer than a shard goes on in the next one, cut where a piece ends.
            hi = len(raw) if len(raw) - lo <= 2 * SHARD_BYTES else raw.find(END, lo + SHARD_BYTES)
            hi = len(raw) if hi < 0 else hi
            yield shard(lang, raw[lo:hi] + END)
            lo = hi + 1

    for batch in batches:
        for lang, text in zip(batch["_lang"], batch["_text"], strict=True):
            raw = text.encode().lower().translate(TO_END)  # of bytes, lower() changes A-Z only
            held[lang].append(raw)
            sizes[lang] += len(raw) + 1
            total += len(raw) + 1
            if total >= 2 * SHARD_BYTES or sizes[lang] >= SHARD_BYTES:
                yield from emptied(max(sizes, key=sizes.get))
    for lang in list(held):
        yield from emptied(lang)


def suffix_array(ids: np.ndarray, longest: int) -> np.ndarray:
    """Places of ``ids`` in the order of their suffixes, by the first ``longest`` numbers or more: prefix doubling."""
    rank, depth, order = ids.astype(np.int64), 1, np.argsort(ids, kind="stable")
    while depth < longest:
        ahead = np.zeros_like(rank)
        ahead[:-depth] = rank[depth:]
        key = rank * (int(rank.max()) + 1) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == len(rank) - 1:  # all suffixes differ already
            break
        depth *= 2
    return order


def phrase_counts(ids: np.ndarray, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``longest`` words: a place of each distinct phrase in ``ids``, and how often it is there.

    Neighbours in the suffix array have the first words of their longest common
    prefix in common, so the suffixes of one phrase are an interval in which no
    prefix is shorter than the phrase. Phrases never reach over a 0.
    """
    ids = ids.astype(np.int64)
    order = suffix_array(ids, longest)
    padded = np.concatenate((ids, np.zeros(longest, np.int64)))
    lcp, alike = np.zeros(len(ids), np.int64), np.ones(len(ids) - 1, bool)
    for k in range(longest):
        at = padded[order + k]
        alike &= at[1:] == at[:-1]
        lcp[1:] += alike
    out, whole = [], np.ones(len(ids), bool)
    for k in range(1, longest + 1):
        whole &= padded[np.arange(len(ids)) + k - 1] > 0
        starts = np.flatnonzero(lcp < k)
        heads, counts = order[starts], np.diff(np.append(starts, len(ids)))
        good = whole[heads]
        out.append((heads[good], counts[good]))
    return out


def word_keys(lang: str, words: list[bytes]) -> np.ndarray:
    """A 64-bit key for each word of a language, 0 for the end of a piece."""
    person = hashlib.blake2b(lang.encode(), digest_size=16).digest()
    return np.array([0, *(int.from_bytes(hashlib.blake2b(w, digest_size=8, person=person).digest(), "little") for w in words)], np.uint64)


def counted(row: dict, longest: int, groups: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a shard and its phrases in the order of their group and key: ids, heads, sizes, counts, groups, keys."""
    words = row["words"].split(END) if row["words"] else []
    ids = np.frombuffer(row["ids"], np.int32)
    of_word = word_keys(row["lang"], words)
    padded = np.concatenate((ids, np.zeros(longest, np.int32)))
    parts = []
    for k, (heads, counts) in enumerate(phrase_counts(ids, longest), 1):
        h = np.full(len(heads), k, np.uint64)
        for j in range(k):
            h = (h ^ of_word[padded[heads + j]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        parts.append((heads.astype(np.int32), np.full(len(heads), k, np.int8), counts.astype(np.int32), h))
    heads, sizes, counts, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    group = ((h >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    key = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    order = np.argsort(group.astype(np.uint64) << np.uint64(32) | key)
    return words, ids, heads[order], sizes[order], counts[order], group[order], key[order]


def key_blocks(longest: int, groups: int, least: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For each shard and group: the sorted keys of its phrases, byte by byte, and their counts up to ``least``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                _, _, _, _, counts, group, key = counted(row, longest, groups)
                few = np.minimum(counts, least).astype(np.uint8)
                cuts = np.flatnonzero(np.diff(group, prepend=-1))
                ends = np.append(cuts[1:], len(group))
                yield pd.DataFrame({
                    "grp": group[cuts], "shard": row["shard"],
                    "keys": [np.ascontiguousarray(key[a:b].view(np.uint8).reshape(-1, 4).T).tobytes() for a, b in zip(cuts, ends, strict=True)],
                    "counts": [few[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
                })

    return run


def merged(least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of one group: for each shard, a bit for each of its keys, set where the counts of all shards reach ``least``.

    Counts are kept up to ``least`` each, which changes no sum below it; a key that two phrases share only sets a bit too many.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.ascontiguousarray(np.frombuffer(k, np.uint8).reshape(4, -1).T).view(np.uint32)[:, 0] for k in pdf["keys"]]
        every = np.concatenate(keys)
        _, at = np.unique(every, return_inverse=True)
        total = np.bincount(at, np.frombuffer(b"".join(pdf["counts"]), np.uint8))
        often = total[at] >= least
        ends = np.cumsum([len(k) for k in keys])
        bits = [np.packbits(often[e - len(k) : e]).tobytes() if often[e - len(k) : e].any() else None for k, e in zip(keys, ends, strict=True)]
        return pd.DataFrame({"shard": pdf["shard"], "grp": pdf["grp"], "bits": bits}).dropna()

    return run


def frequent_phrases(longest: int, groups: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For each shard and group: the phrases whose bits are set, as text, and their counts in the shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                words, ids, heads, sizes, counts, group, _ = counted(row, longest, groups)
                out = []
                for m in row["marks"]:
                    a, b = np.searchsorted(group, [m["grp"], m["grp"] + 1])
                    at = a + np.flatnonzero(np.unpackbits(np.frombuffer(m["bits"], np.uint8), count=b - a))
                    phrases = [b" ".join([words[i - 1] for i in ids[h : h + k].tolist()]) for h, k in zip(heads[at].tolist(), sizes[at].tolist(), strict=True)]
                    out.append((m["grp"], row["lang"], END.join(phrases), counts[at].tobytes()))
                yield pd.DataFrame(out, columns=["grp", "lang", "phrases", "counts"])

    return run


def added(least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of one group: the phrases of all shards with their counts added, those below ``least`` left out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[tuple[str, bytes], int] = defaultdict(int)
        for lang, phrases, counts in zip(pdf["lang"], pdf["phrases"], pdf["counts"], strict=True):
            for p, n in zip(phrases.split(END), np.frombuffer(counts, np.int32).tolist(), strict=True):
                total[lang, p] += n
        often = [(lang, p.decode(), p.count(b" ") + 1, n) for (lang, p), n in total.items() if n >= least]
        return pd.DataFrame(often, columns=["lang", "phrase", "size", "f"])

    return run


def phrase_frequencies(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and (lang, phrase, size, f): all word occurrences, and the phrases of 1 to ``longest`` words found ``least`` times or more.

    1. Tasks gather texts into shards of one language and number their words.
    2. Each shard's suffix array, by prefix doubling, and its LCP intervals give
       the counts of its phrases. Their keys, 32 bits and a group, go to the group,
       one for each phrase and shard, packed by shard; there the counts are
       merged, and each shard is told by a bit which of its phrases may be frequent.
    3. These, and no others, leave the shard as text with their counts, packed
       by group again, and are added there by language and phrase. Keys are
       never taken for phrases.

    No task holds more than a shard or a group: groups grow in number with the words.
    """
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG)).alias("_lang"), text_of(docs, text_col).alias("_text"))
    with small_batches(docs.sparkSession):
        shards = written(rows.mapInPandas(shard_rows, "shard long, lang string, words binary, ids binary, n_words long"))
    totals = shards.groupBy("lang").agg(F.sum("n_words").alias("n")).where("n > 0")
    words = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    groups = max(256, -(-longest * words // KEYS_A_GROUP))
    filled = shards.where("n_words > 0")
    blocks = filled.mapInPandas(key_blocks(longest, groups, least), "grp long, shard long, keys binary, counts binary")
    marks = blocks.groupBy("grp").applyInPandas(merged(least), "shard long, grp long, bits binary")
    told = marks.groupBy("shard").agg(F.collect_list(F.struct("grp", "bits")).alias("marks"))  # at most a bit for each phrase of the shard
    found = filled.join(told, "shard").mapInPandas(frequent_phrases(longest, groups), "grp long, lang string, phrases binary, counts binary")
    counts = found.groupBy("grp").applyInPandas(added(least), "lang string, phrase string, size int, f long")
    with small_batches(docs.sparkSession):  # of shards, a few
        return totals, written(counts)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4, least: int = 30, scale: int = 2_000_000, swallowed: int = 80, most: int = 2000
) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are cut into pieces at sentence marks and line ends, pieces into words
    at spaces and tabs; A-Z are lower-cased. A candidate is a phrase of two to
    ``longest`` words found ``least`` times or more. Cutting it in two gives
    ``floor(scale * a / (l + r))`` from the counts of both parts; the lowest cut
    counts, of equal ones the first. A candidate inside a longer one that is
    found in ``swallowed`` of a hundred of its occurrences or more is dropped.

    A null text counts as empty and has no words, a null language is ``und``
    (and joins rows that say so); a language without candidates gives no rows,
    nor does an empty table. Repeated rows count each for itself. Texts and
    pieces may be of any length; other columns, whatever their names, are not
    touched. Ties of the order are settled by the phrase's bytes.
    """
    totals, counts = phrase_frequencies(docs, lang_col, text_col, longest, least)
    long = counts.where("size > 1")
    words = F.split("phrase", " ")
    part = lambda start, n: F.array_join(F.slice("_w", start, n), " ")
    cut = F.col("_k")
    cuts = long.select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("_w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("_k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "_k", part(F.lit(1), cut).alias("_left"), part(cut + 1, F.col("size") - cut).alias("_right"))
    known = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    # Parts of a frequent phrase are frequent, so both are among the counts.
    cuts = cuts.join(known("_left", "l"), ["lang", "_left"]).join(known("_right", "r"), ["lang", "_right"])
    exact = F.expr(f"(cast({scale} as decimal(10, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    lowest = F.min(F.struct(exact.alias("score"), F.col("_k").alias("k"), "l", "r")).alias("_c")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "a", "_c.l", "_c.r", "_c.score")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: F.array_join(F.slice("_w", s, n), " "))))
    longer = long.where("size > 2").select("lang", "size", "f", words.alias("_w")).select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("_over"))
    alone = scored.join(longer, ["lang", "phrase"], "left").where(F.expr(f"_over is null or cast(100 as decimal(3, 0)) * cast(_over as decimal(19, 0)) < cast({swallowed} as decimal(3, 0)) * cast(a as decimal(19, 0))"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")  # with the limit on ranks each task passes on no more than that many
    ranked = alone.select("lang", "phrase", "a", "l", "r", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(longest: int = 4) -> str:
    """The query in DuckDB's SQL, counting every phrase at every place."""
    shapes = " union all ".join(f"select lang, array_to_string(ws[s : s + {k - 1}], ' ') phrase, {k} size from places where s + {k - 1} <= len(ws)" for k in range(1, longest + 1))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
        with pieces as (
            select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') ws
            from (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) p from documents)
        ), places as (select lang, ws, unnest(range(1, len(ws) + 1)) s from pieces where len(ws) > 0),
        totals as (select lang, sum(len(ws))::bigint n from pieces group by 1),
        f as (select lang, phrase, size, count(*) f from ({shapes}) group by 1, 2, 3 having count(*) >= 30),
        c as (select lang, phrase, f a, size, string_split(phrase, ' ') w from f where size > 1),
        cuts as (select *, unnest(range(1, size)) k from c),
        scores as (
            select cuts.lang, cuts.phrase, a, k, x.f l, y.f r, (2000000::hugeint * a // (x.f + y.f))::bigint score from cuts
            join f x on x.lang = cuts.lang and x.phrase = array_to_string(w[1 : k], ' ') join f y on y.lang = cuts.lang and y.phrase = array_to_string(w[k + 1 : cuts.size], ' ')
        ), lowest as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        spans as (select lang, a f, w, size, unnest(range(1, size + 1)) s from c where size > 2),
        ends as (select *, unnest(range(s + 1, size + 1)) e from spans),
        over_ as (select lang, array_to_string(w[s : e], ' ') phrase, max(f) g from ends where e - s + 1 < size group by 1, 2),
        kept as (select lowest.* from lowest left join over_ o on o.lang = lowest.lang and o.phrase = lowest.phrase where g is null or 100 * g < 80 * a),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from kept)
        select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
    """
