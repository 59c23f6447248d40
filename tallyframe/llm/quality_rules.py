"""Quality rules as a ledger of bits: every rule evaluated once, policies and ablations read from the bits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

#: Fixed by the contract: white space, symbols, and the size of the window in which words repeat.
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: A character of a word that is no ASCII digit, mark or control.
LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"

#: (name, when a text fails it) in the order of bits; a rule's place never changes, new ones are added at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    ("shouting", "10 * n_upper > 4 * n_letters"),
    ("exclamations", "10 * n_exclaims > 2 * n_words"),
    ("few_letters", "100 * n_letter_words < 70 * n_words"),
    ("bullets", "10 * n_bullet_lines > 9 * n_lines and n_lines > 1"),
    ("ellipses", "10 * n_open_lines > 3 * n_lines and n_lines > 1"),
    ("echoes", "100 * n_echo_words > 20 * n_words"),
)
BASE = ("few_words", "repeated_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_exclaims", "n_letter_words", "n_bullet_lines", "n_open_lines", "n_echo_words")


def mask_of(names: tuple[str, ...]) -> int:
    places = {name: k for k, (name, _) in enumerate(RULES)}
    return sum(1 << places[n] for n in set(names))


@dataclass(frozen=True)
class Policy:
    """A version of what makes a document fail: any rule of ``hard``, or more than ``most_soft`` rules of ``soft``."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    most_soft: int = 0


POLICIES: dict[str, Policy] = {
    p.version: p
    for p in (
        Policy("1", BASE),
        Policy("2", tuple(name for name, _ in RULES)),
        Policy("3", (*BASE, "symbols", "shouting"), ("short_words", "long_words", "duplicate_lines", "exclamations", "few_letters", "bullets", "ellipses", "echoes"), 1),
    )
}
CURRENT = "2"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, though it is used again and again."""
    return F.transform(F.array(value), use)[0]


def covered(windows: Column, size: int) -> Column:
    """How many words lie in windows of ``size`` words that are found again, given the texts of all windows in order."""

    def repeated(order: Column) -> Column:
        same = lambda a, b: order[a]["w"] == order[b]["w"]
        last = F.size(order) - 1
        at = F.filter(F.sequence(F.lit(0), last), lambda k: ((k > 0) & same(F.greatest(k - 1, F.lit(0)), k)) | ((k < last) & same(F.least(k + 1, last), k)))
        return F.sort_array(F.transform(at, lambda k: order[k]["p"]))

    def reach(starts: Column) -> Column:
        steps = F.zip_with(F.slice(starts, 1, F.size(starts) - 1), F.slice(starts, 2, F.size(starts) - 1), lambda a, b: F.least(b - a, F.lit(size)))
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(size), lambda a, x: a + x))

    order = F.sort_array(F.transform(windows, lambda w, p: F.struct(w.alias("w"), p.alias("p"))))
    return let(order, lambda o: let(repeated(o), reach))


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words found twice or more in the text, the first included.

    Windows whose 64-bit hashes are all different are all different: most texts
    end there. Otherwise the windows' texts are sorted and compared.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(size))))
    texts = F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))
    again = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < size, F.lit(0)).when(again, covered(texts, size)).otherwise(F.lit(0))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: the id, columns of ``keep``, all measurements, and ``failed_bits``, bit k for rule k of ``RULES``.

    One pass and no shuffle: whatever a policy may ask for later is in the ledger.
    Null and empty texts have no words, lines or letters and fail
    ``few_words`` (and, all shares being of nothing, no other rule).
    Repeated rows and ids, null ones too, have a row each. A text of any length
    is measured whole, in its own row. An empty table gives an empty ledger;
    columns of ``docs`` that are not named are never touched, whatever their names.
    """
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("_id"), *(docs[c].alias(f"_keep_{i}") for i, c in enumerate(keep)), text.alias("_text"))
    kept = [f"_keep_{i}" for i in range(len(keep))]
    t = F.col("_text")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR))
    rows = rows.select("_id", *kept, "_text", F.array_remove(F.split(t, SPACE), "").alias("_words"), lines.alias("_lines"))
    chars = lambda others: F.length(F.regexp_replace(t, others, ""))
    trimmed = lambda x: F.regexp_replace(x, rf"^{SPACE}|{SPACE}$", "")
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": chars(f"[^{SYMBOLS}]+"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeat_words(F.col("_words")),
        "n_lines": F.size("_lines"),
        "n_upper": chars("[^A-Z]+"),
        "n_letters": chars("[^A-Za-z]+"),
        "n_exclaims": F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))),
        "n_letter_words": F.size(F.filter("_words", lambda w: w.rlike(LETTER))),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: trimmed(x).rlike("^[-*•]"))),
        "n_open_lines": F.size(F.filter("_lines", lambda x: trimmed(x).rlike(r"(\.\.\.|…)$"))),
        "n_echo_words": F.size(F.filter("_words", lambda w, i: F.get("_words", i - 1) == w)),
    }
    measured = rows.select("_id", *kept, *(measures[m].cast("long").alias(m) for m in MEASURES))
    bits = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(RULES):
        bits = bits + F.when(F.expr(fails), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    out = measured.withColumn("failed_bits", bits)
    return out.select(F.col("_id").alias(id_col), *(F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)), *MEASURES, "failed_bits")


def fails(policy: Policy, bits: Column | None = None, dropped: int = 0) -> Column:
    """Whether ``failed_bits`` fail a policy, the rules of the mask ``dropped`` left out of it."""
    bits = F.col("failed_bits") if bits is None else bits
    own = lambda names: F.lit(mask_of(names) & ~dropped).cast("long")
    return (bits.bitwiseAND(own(policy.hard)) != 0) | (F.bit_count(bits.bitwiseAND(own(policy.soft))) > policy.most_soft)


def judged(rows: DataFrame, policy: Policy) -> DataFrame:
    """A ledger with ``base_failed`` and ``kept``; the base rules count in every policy."""
    base = F.col("failed_bits").bitwiseAND(F.lit(mask_of(BASE)).cast("long")) != 0
    return rows.withColumns({"base_failed": base, "kept": ~base & ~fails(policy)})


def patterns(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows for each pattern of failed bits: at most two to the number of rules, combined before the shuffle."""
    return rows.groupBy(*by, "failed_bits").agg(F.count("*").alias("n_rows"), F.sum("n_words").alias("n_words"))


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = tuple(POLICIES.values())) -> DataFrame:
    """Per policy and rule of it: rows that fail the rule, that fail it alone, and that stay with and without it.

    Read from the counts of bit patterns: the texts are not looked at again, nor
    the ledger once for each rule.
    """
    counted, out = patterns(rows), None
    for p in policies:
        used = mask_of(p.hard) | mask_of(p.soft)
        bits = F.col("failed_bits")
        sums = lambda c: F.coalesce(F.sum(F.when(c, F.col("n_rows"))), F.lit(0))
        cells = []
        for k, (name, _) in enumerate(RULES):
            one = 1 << k
            if used & one:
                cells.append(F.struct(
                    F.lit(name).alias("rule"), sums(bits.bitwiseAND(F.lit(one).cast("long")) != 0).alias("n_failed"),
                    sums(bits.bitwiseAND(F.lit(used).cast("long")) == one).alias("n_failed_alone"), sums(~fails(p)).alias("n_kept"), sums(~fails(p, dropped=one)).alias("n_kept_without"),
                ))
        own = counted.agg(F.array(*cells).alias("c")).select(F.lit(p.version).alias("version"), F.explode("c").alias("c")).select("version", "c.*")
        out = own if out is None else out.unionByName(own)
    return out


def fired(rows: DataFrame, by: str) -> DataFrame:
    """Per value of ``by``: the rules that any row fails, that every row fails, and that an odd number of rows fails."""
    return rows.groupBy(by).agg(F.count("*").alias("n_rows"), F.bit_or("failed_bits").alias("any_bits"), F.bit_and("failed_bits").alias("all_bits"), F.bit_xor("failed_bits").alias("odd_bits"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The stored ledger of ``docs`` with the verdict of one policy."""
    return judged(written(ledger(docs, id_col, text_col)), policy)


def oracle_sql() -> str:
    """The query in DuckDB's SQL, with measurements and windows of its own."""
    bits = " + ".join(f"case when {fails} then {1 << k} else 0 end" for k, (_, fails) in enumerate(RULES))
    return rf"""
        with d as (
            select row_number() over () id, doc_id, coalesce(text, '') t from documents
        ), s as (
            select *, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda w: w <> '') ws,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{SPACE}', '', 'g') <> '') ls from d
        ), w as (
            select id, unnest(range(1, len(ws) - 3)) p, unnest(list_transform(range(1, len(ws) - 3), lambda p: array_to_string(ws[p : p + 4], ' '))) g from s where len(ws) >= 5
        ), again as (select id, g from w group by 1, 2 having count(*) > 1),
        words as (select distinct id, p + k as place from w join again using (id, g), range(0, 5) r(k)),
        rep as (select id, count(*) n from words group by 1),
        m as (
            select doc_id, len(ws)::bigint n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::bigint word_chars,
                   (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines,
                   coalesce(n, 0)::bigint n_repeat_words, len(ls)::bigint n_lines,
                   (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::bigint n_upper, (length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')))::bigint n_letters,
                   (length(t) - length(replace(t, '!', '')))::bigint n_exclaims, len(list_filter(ws, lambda w: regexp_matches(w, '{LETTER}')))::bigint n_letter_words,
                   len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::bigint n_bullet_lines,
                   len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::bigint n_open_lines,
                   len(list_filter(range(2, len(ws) + 1), lambda k: ws[k] = ws[k - 1]))::bigint n_echo_words
            from s left join rep using (id)
        ), f as (select *, ({bits})::bigint failed_bits from m)
        select *, (failed_bits & {mask_of(BASE)}) <> 0 base_failed, failed_bits = 0 kept from f
    """
