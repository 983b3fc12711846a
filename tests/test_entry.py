import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"c_mktsegment", "fiscal_year", "orders", "revenue"}


def test_every_query_has_oracle_or_is_listed():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def test_the_other_queries_do_without_the_training_data(monkeypatch):
    """A missing module that the subpackage imports costs only its queries."""
    import sys
    for name in [m for m in sys.modules if m.startswith("tessera.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    q = E.queries()
    assert len(q) >= 130 and not any(n.startswith("op") and n[2].isdigit() for n in q) and "pipeline" not in q
    assert set(E.oracle_sql()) <= set(q)
