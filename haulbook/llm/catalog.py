"""The registered queries of the training-data operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from haulbook.llm import (exact_dedup, language_model, licenses, mixing, near_dedup, page_text, periodic, quality, tokens, topk, toxicity, warc,
                          whitening)


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def op1_license_scan(spark: SparkSession, path: str) -> DataFrame:
    return licenses.license_scan(_table(spark, path, "documents"))


def op2_top_k(spark: SparkSession, path: str) -> DataFrame:
    return topk.top_k(_table(spark, path, "embeddings"))


def op3_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, path, "documents"))


def op4_class_model(spark: SparkSession, path: str) -> DataFrame:
    return language_model.class_model_scores(_table(spark, path, "documents"))


def op5_byte_bpe(spark: SparkSession, path: str) -> DataFrame:
    return tokens.bpe_round_trip(_table(spark, path, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN)


def op6_pareto_mixing(spark: SparkSession, path: str) -> DataFrame:
    return mixing.mix_report(_table(spark, path, "documents"))


def op7_bag_minhash(spark: SparkSession, path: str) -> DataFrame:
    return near_dedup.near_classes(_table(spark, path, "documents"))


def op8_toxicity(spark: SparkSession, path: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, path, "documents"), _table(spark, path, "labels"))


def op9_warc_records(spark: SparkSession, path: str) -> DataFrame:
    return warc.record_report(_table(spark, path, "pages"))


def op10_page_text(spark: SparkSession, path: str) -> DataFrame:
    return page_text.extract_pages(_table(spark, path, "pages"))


def op11_periodic_runs(spark: SparkSession, path: str) -> DataFrame:
    return periodic.run_report(_table(spark, path, "documents"))


def op12_quality_rules(spark: SparkSession, path: str) -> DataFrame:
    return quality.quality_report(_table(spark, path, "documents"))


def op13_whitening(spark: SparkSession, path: str) -> DataFrame:
    return whitening.whitened_report(_table(spark, path, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_top_k, op3_exact_dedup, op4_class_model, op5_byte_bpe, op6_pareto_mixing, op7_bag_minhash,
                                 op8_toxicity, op9_warc_records, op10_page_text, op11_periodic_runs, op12_quality_rules, op13_whitening)}

ORACLES = {
    "op2_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as v from embeddings
                   where vec_id is not null and embedding is not null
                         and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
              from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
        select query_id, rank, vec_id, score from (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) where rank <= 5""",
    "op3_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))""",
    "op6_pareto_mixing": r"""
        with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
        s as (select source, sum(size)::bigint as source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as w
              from d group by source),
        r as (select *, (3 * source_size)::double as most, (3 * source_size)::double / w as ratio from s),
        l as (select *, (sum(source_size) over () - coalesce(sum(most) over (order by ratio, source nulls last
                         rows between unbounded preceding and 1 preceding), 0.0))
                        / sum(w) over (order by ratio, source nulls last rows between current row and unbounded following) as lev from r),
        t as (select source, source_size, least(most, coalesce((select arg_min(lev, ratio) from l where lev <= ratio), 0.0) * w) as target from l),
        f as (select *, case when source_size > 0 then target / source_size else 0.0 end as ratio from t),
        g as (select *, least(floor(ratio), 3)::bigint as whole from f),
        h as (select *, greatest(target - whole * source_size, 0.0) as wanted, greatest(ratio - whole, 0.0) as share from g),
        q as (select d.doc_id, d.size, h.*, (('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::varchar, '')), 1, 12))::bigint::double + 0.5)
                     / 281474976710656.0 as u
              from d join h on d.source is not distinct from h.source),
        k as (select *, (u / (1.0 - u)) / (share / (1.0 - share)) as odds from q),
        o as (select *, odds / (1.0 + odds) as rank from k),
        c as (select *, coalesce(sum(size) over (partition by source order by rank, doc_id, size
                        rows between unbounded preceding and 1 preceding), 0) as before from o)
        select doc_id, size, source_size, target,
               size * (whole + case when share > 0 and before + size / 2.0 <= wanted then 1 else 0 end) as taken from c""",
    "op12_quality_rules": r"""
        with d as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
        lines as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
                  from (select r, unnest(string_split(t, chr(10))) as line from d)
                  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
        w as (select r, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as word,
                     generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) as i from d),
        c as (select r, count(*) as n_words, sum(length(word))::bigint as word_chars from w group by r),
        three as (select r, i, word || ' ' || lead(word) over (partition by r order by i) || ' '
                         || lead(word, 2) over (partition by r order by i) as window3 from w),
        twice as (select r, i from (select r, i, window3, count(*) over (partition by r, window3) as n from three) where window3 is not null and n > 1),
        again as (select r, count(*) as n_repeat_words from (select distinct r, i + k as i from twice, (values (0), (1), (2)) as v(k)) group by r),
        b as (select d.r, doc_id, lang, source, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
                     len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
                     coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines
              from d left join c using (r) left join lines using (r) left join again using (r)),
        m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
                     case when n_words > 0 then 1000 * word_chars // n_words else 0 end as word_length,
                     case when n_words > 0 then 1000 * n_symbols // n_words else 0 end as symbols,
                     case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_lines,
                     case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeats from b),
        v as (select lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) as measure,
                     unnest([word_length, symbols, dup_lines, repeats]) as value from m where not base_failed),
        k as (select lang, source, measure, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) as bucket, count(*) as n
              from v group by all),
        levels as (select 2 as level, lang, source, measure, bucket, n from k union all select 1, lang, null, measure, bucket, sum(n) from k group by all
                   union all select 0, null, null, measure, bucket, sum(n) from k group by all),
        cum as (select level, lang, source, measure, bucket, sum(n) over (partition by level, lang, source, measure order by bucket) as upto,
                       sum(n) over (partition by level, lang, source, measure) as total from levels),
        q as (select level, lang, source, measure, total, min(bucket) filter (4 * upto >= total) as q1,
                     min(bucket) filter (4 * upto >= 3 * total) as q3 from cum group by all),
        f as (select level, lang, source, measure, total, q1, q3, greatest(3 * (q3 - q1), case measure when 'word_length' then 2000 when 'symbols' then 50
                     when 'dup_lines' then 400 else 300 end) as reach from q),
        t as (select level, lang, source, max(total) as total, max(q1 - reach) filter (measure = 'word_length') as wl,
                     max(q3 + reach) filter (measure = 'word_length') as wh, max(q3 + reach) filter (measure = 'symbols') as sh,
                     max(q3 + reach) filter (measure = 'dup_lines') as dh, max(q3 + reach) filter (measure = 'repeats') as rh from f group by all),
        j as (select m.*, case when g.total >= 200 then struct_pack(wl := g.wl, wh := g.wh, sh := g.sh, dh := g.dh, rh := g.rh)
                               when l.total >= 200 then struct_pack(wl := l.wl, wh := l.wh, sh := l.sh, dh := l.dh, rh := l.rh)
                               else struct_pack(wl := a.wl, wh := a.wh, sh := a.sh, dh := a.dh, rh := a.rh) end as x
              from m left join t g on g.level = 2 and g.lang is not distinct from m.lang and g.source is not distinct from m.source
              left join t l on l.level = 1 and l.lang is not distinct from m.lang left join t a on a.level = 0)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and word_length between x.wl and x.wh and symbols <= x.sh and dup_lines <= x.dh and repeats <= x.rh as kept from j""",
}
