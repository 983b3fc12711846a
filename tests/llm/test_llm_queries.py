"""Registered queries against their SQL and, without SQL, against brute force."""

import re

import duckdb
import public_tokenizers
import pytest
from brute import components
from oracle import compare
from tessera.llm.queries import ORACLE, PIECE_MODEL, QUERIES

BASE = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{BASE}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    problems, rows = compare(spark, name, QUERIES[name], ORACLE[name], BASE, verbose=False)
    assert not problems and rows > 0


def test_near_dedup_equals_all_pairs(spark):
    want = components([(r[0], r[1]) for r in table("documents")])
    got = {r["doc_id"]: r for r in QUERIES["op5_minhash_near_dedup"](spark, BASE).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_html_extraction_equals_the_article(spark):
    """The tables' pages mark their article; the tree doesn't know that."""
    from html import unescape
    got = {r["page_id"]: r for r in QUERIES["op4_html_extraction"](spark, BASE).collect()}
    rows = table("pages")
    assert len(got) == len(rows)
    for page, url, html in rows:
        inner = html[html.index("<article>") + 9:].split("</article>")[0]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(p for p in parts if p)
        assert (got[page]["url"], got[page]["text"], got[page]["n_chars"]) == (url, want, len(want))


def test_token_counts_equal_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    got = {r["doc_id"]: r for r in QUERIES["op8_token_counts"](spark, BASE).collect()}
    rows = table("documents")
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        n = len(sp.encode(text))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len(text.encode()), n, n > 4096)


def test_sentencepiece_comes_back(spark):
    rows = QUERIES["op10_sentencepiece"](spark, BASE).collect()
    assert len(rows) == len(table("documents")) and all(r["round_trip"] for r in rows)
