"""The columns of op2, op7 and op8 that need no model, against DuckDB on the driver's smallest tables."""

import os

import pytest

from caudal.llm import queries

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")

RULES = r"""
with words as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) w, coalesce(text, '') t from documents),
lines as (select doc_id, count(*) - count(distinct l) dup from (select doc_id, unnest(string_split(t, chr(10))) l from words) where regexp_matches(l, '[^\x20\x09-\x0D]') group by 1),
windows as (select doc_id, i, w[i:i + 2] g from words, unnest(range(1, len(w) - 1)) u(i)),
repeated as (select doc_id, count(distinct p) n from (select doc_id, unnest([i, i + 1, i + 2]) p from windows join (select doc_id, g from windows group by 1, 2 having count(*) > 1) using (doc_id, g)) group by 1)
select doc_id, len(w) n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols, coalesce(dup, 0) n_dup_lines, coalesce(n, 0) n_repeat_words,
  len(w) < 50 or 100 * coalesce(n, 0) > 50 * len(w) base_failed
from words left join lines using (doc_id) left join repeated using (doc_id)
"""

BASE = r"""
with words as (select doc_id, list_append(coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []), ' ') w from documents),
tokens as (select doc_id, unnest(w) t from words),
counts as (select t, count(*) c from tokens where doc_id not in (select unnest($held)) group by 1),
sums as (select sum(c)::bigint n, count(*) v from counts)
select doc_id, count(*) n_tokens, count(c) n_known, any_value(n) train_tokens, sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (v + 1)))) base_score from tokens left join counts using (t), sums group by 1
"""

HOSTS = r"""
with parts as (select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') h, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') p from pages)
select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, p as path from parts
"""


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for n in ("documents", "pages"):
        con.execute(f"create view {n} as select * from '{DATA}/{n}.parquet'")
    return con


def rows(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_quality_counts(spark, db):
    want = db.execute(RULES)
    columns = [d[0] for d in want.description]
    assert rows(queries.op7_quality_rules(spark, DATA), columns) == sorted(want.fetchall())


def test_base_scores(spark, db):
    out = queries.op2_lm_scoring(spark, DATA).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()
    want = {r[0]: r[1:] for r in db.execute(BASE, {"held": [r.doc_id for r in out if r.held_out]}).fetchall()}
    assert len(out) == len(want)
    for r in out:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and abs(r.base_score - want[r.doc_id][3]) < 1e-6 * max(1, abs(r.base_score))


def test_hosts_and_paths(spark, db):
    assert rows(queries.op8_url_filters(spark, DATA), ["page_id", "host", "path"]) == sorted(db.execute(HOSTS).fetchall())
