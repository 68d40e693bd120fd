import importlib.util

import __spark_entry__ as entry


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_corpus_queries_only_with_their_subpackage():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    if importlib.util.find_spec("caudal.llm") is None:
        assert not names
    else:
        assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_entry(spark):
    df = entry.entry(spark)
    assert "o_orderkey" in df.columns and df.limit(1).count() == 1
