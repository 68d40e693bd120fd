"""The opN_ queries of the corpus operators: thin bindings of the operators to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, filter_audit, html_extract, langid, licenses, lm, mixing, neardup, quality_knn, quality_rules, source_audit, tokenbin, urls
from .common import bucket_of, scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fit_and_score(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.train(docs, held_out=(3, 1)))
    return out.select("doc_id", (bucket_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "cosine", "rejected")


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weigh(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("posteriors")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_knn.score(docs, quality_knn.train(docs, table(spark, sf_dir, "labels"), held_out=(5, 0)))
    return out.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "nearest")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    folder = scratch(spark, "ids")
    tokenbin.write(table(spark, sf_dir, "documents"), folder, path("word_bpe_49k.json"), end_id=1, by_words=True)
    return tokenbin.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_language_id": op3_language_id,
        "op4_minhash_neardup": op4_minhash_neardup,
        "op5_decontamination": op5_decontamination,
        "op6_mixing": op6_mixing,
        "op7_quality_rules": op7_quality_rules,
        "op8_url_filters": op8_url_filters,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_html_extraction": op10_html_extraction,
        "op11_token_ids": op11_token_ids,
        "op12_filter_audit": op12_filter_audit,
        "op13_source_divergence": op13_source_divergence,
    }


#: op4 by brute force: every pair of documents that share a shingle. The other queries rest on trained models or edit distances; tests/llm holds them against brute force.
_NEARDUP_SQL = r"""
with recursive words as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) w from documents),
shingles as (select distinct doc_id, s from (select doc_id, unnest(case when len(w) >= 5 then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from words)),
sizes as (select d.doc_id, count(s) n from documents d left join shingles using (doc_id) group by 1),
pairs as (select x.doc_id a, y.doc_id b, count(*) c from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from pairs join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 75 * (p.n + q.n - c)),
reach(k, c) as (select doc_id, doc_id from documents union select b, c from reach join links on a = k)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from sizes join (select k as doc_id, min(c) as component_id from reach group by 1) using (doc_id)
"""


_AUDIT_SQL = r"""
with words as (select *, coalesce(text, '') t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) w from documents),
flags as (select doc_id, max(coalesce(quality = 1, false)::int) good, max(coalesce(toxic = 1, false)::int) toxic from labels group by 1),
firsts as (select t, min(doc_id) first from words group by 1),
masks as (
  select coalesce(source, '') part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] f
  from words left join firsts using (t) left join flags using (doc_id)),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) l),
orders as (select a.l || b.l || c.l || d.l || e.l filter_order from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (select filter_order, step, ascii(filter_order[step]) - 64 own, list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) before from orders, (select unnest(range(1, 6))::int step)),
counts as (select part, f, count(*) n, sum(good) good, sum(toxic) toxic from masks group by 1, 2),
cells as (select *, f[own] fails, len(list_filter(before, lambda i: f[i])) > 0 gone, len(list_filter(f, lambda x: x)) = 1 alone from counts, steps),
figures as (
  select part, filter_order, step, own, coalesce(sum(n) filter (not fails and not gone), 0)::bigint kept, coalesce(sum(n) filter (fails and not gone), 0)::bigint removed,
    coalesce(sum(n) filter (fails and gone), 0)::bigint redundant, coalesce(sum(n) filter (fails and alone), 0)::bigint unique_fails,
    coalesce(sum(good) filter (fails and not gone), 0)::bigint good_lost, coalesce(sum(toxic) filter (fails and not gone), 0)::bigint toxic_lost from cells group by 1, 2, 3, 4)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, own))::bigint shapley from figures
"""

_DIVERGENCE_SQL = r"""
with docs as (select doc_id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), []) terms, row_number() over () r from documents),
words as (select r, lang, source, unnest(terms) term from docs),
kept as (select lang, term, count(*) lang_n from words group by 1, 2 having count(distinct r) >= 30),
langs as (select lang, count(*) v, sum(lang_n)::bigint lang_total from kept group by 1),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) n from words join kept using (lang, term) group by 1, 2, 3),
sizes as (select lang, source, sum(n)::bigint total from counts group by 1, 2),
shares as (
  select lang, source, term, coalesce(n, 0) n, 1 + 1000000000 * (coalesce(n, 0) + 5) // (coalesce(total, 0) + 5 * v) p, 1 + 1000000000 * (lang_n + 5) // (lang_total + 5 * v) q
  from groups join kept using (lang) join langs using (lang) left join counts using (lang, source, term) left join sizes using (lang, source)),
pairs as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term group by 1, 2, 3, 4),
every as (select * from pairs union all select lang, source, 'term', term, p - q from shares where n > 0 and p > q)
select *, (row_number() over (partition by lang, source, part order by value desc, item))::int rank from every qualify part = 'pair' or rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash_neardup": _NEARDUP_SQL, "op12_filter_audit": _AUDIT_SQL, "op13_source_divergence": _DIVERGENCE_SQL}
