"""The corpus operators' queries, as registered in ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .licences import oracle_sql as licences_sql
from .licences import scan_licences
from .line_dedup import line_dedup
from .near_dedup import near_dedup
from .packing import pack
from .phrases import collocations
from .phrases import oracle_sql as phrases_sql
from .pii import find_pii
from .quality_rules import oracle_sql as quality_sql
from .quality_rules import quality_verdicts
from .resampling import resample
from .substring_dedup import dedup_substrings
from .toxicity import score_toxicity
from .url_filter import filter_urls


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("removed")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_licences": op4_licences,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_toxicity": op9_toxicity,
    "op10_pack": op10_pack,
    "op11_quality_rules": op11_quality_rules,
    "op12_phrases": op12_phrases,
    "op13_resample": op13_resample,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        with d as (
            select doc_id, coalesce(text, '') t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') n from documents
        ), g as (
            select doc_id, n, first_value(doc_id) over (partition by n order by length(t) desc, doc_id) keep_id, count(*) over (partition by n) group_size from d
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(n) as text_sha256 from g
    """,
    "op4_licences": licences_sql(),
    "op11_quality_rules": quality_sql(),
    "op12_phrases": phrases_sql(),
    "op6_line_dedup": r"""
        with l as (
            select row, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) t, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) l
            from (select row_number() over () as row, * from documents)
        ), s as (
            select row, doc_id, l, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(t), '[^\p{L}\p{N}]+'), lambda w: w <> ''))) h from l
        ), d as (
            select h, len(h) n, min((doc_id, l)) f, row_number() over () as sid from s where len(h) > 0 group by h
        ), p as (select sid, n, unnest(h) w from d),
        o as (select a.sid x, b.sid y, count(*) c from p a join p b on a.w = b.w and a.sid <> b.sid and a.n >= 0.8 * b.n and b.n >= 0.8 * a.n group by 1, 2),
        k as (
            select x, min(dy.f) f, count(*) links from o join d dx on dx.sid = x join d dy on dy.sid = y where 5 * c >= 4 * (dx.n + dy.n - c) group by 1
        ), v as (select h, least(d.f, coalesce(k.f, d.f)) since, coalesce(links, 0) links from d left join k on k.x = d.sid)
        select doc_id, count(*) n_lines, count(*) filter (since < (doc_id, l)) n_removed, coalesce(sum(links), 0)::bigint n_links,
               coalesce(string_agg(l::varchar, ',' order by l) filter (since < (doc_id, l)), '') removed_lines
        from s left join v using (h) group by row, doc_id
    """,
    "op8_decontaminate": r"""
        with d as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') ws from documents
        ), b as (
            select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') ws from benchmark
        ), w as (
            select distinct item_id, array_to_string(ws[s : s + 12], ' ') win, least(len(ws), 13) k
            from (select item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) s from b where len(ws) > 0)
        ), ks as (select distinct k from w), starts as (
            select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) s from d, ks where len(ws) >= k
        ), hits as (
            select doc_id, s, starts.k, item_id from starts join w on w.win = array_to_string(ws[s : s + starts.k - 1], ' ') and w.k = starts.k
        ), pos as (
            select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + k)) p from hits) group by 1
        ), its as (
            select doc_id, count(*) n_items, string_agg(i, ',' order by i) ids from (select distinct doc_id, item_id::varchar i from hits) group by 1
        )
        select d.doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
               sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) contaminated
        from d left join pos using (doc_id) left join its using (doc_id)
    """,
}
