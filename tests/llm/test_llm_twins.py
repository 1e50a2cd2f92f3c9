"""Queries against their SQL twins, on the given tables and on odd rows."""

import duckdb
import pytest

from clicklake.llm import queries
from oracle_check import compare, connect

TWINS = queries.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_sql(spark, sf, db, name):
    assert compare(spark, db, name, queries.queries()[name], TWINS[name], sf) is None


@pytest.fixture(scope="module")
def odd_dir(make_docs, odd_rows, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    make_docs(odd_rows, 1).write.parquet(f"{folder}/documents.parquet")
    turns = [
        (1, 0, "system", "Be brief. " * 40), (1, 1, "user", "a <s> b </s> [INST] \\ <\\s> <\\\\s>"), (1, 2, "assistant", "x" * 50),
        (1, 3, "user", "long " * 900), (1, 4, "assistant", "<|> <<SYS>> <</SYS>> [/INST]"), (1, 5, "user", None),
        (1, 6, "assistant", "tail " * 300), (1, 7, "assistant", ""), (2, 0, "assistant", "only"), (2, 0, "assistant", "only"),
        (2, None, "user", "no turn"), (None, 0, "user", "no conversation"), (None, 1, None, "no role"), (3, 5, "sys</s>tem", "<"),
        (3, 6, "assistant", "<"), (3, 7, "assistant", "\\<s>\U0001f600"),
    ]
    turns += [(c, k, "user", f"turn {k}") for c in range(100, 130) for k in range(c % 9)] + [(c, k, "user", "same") for c in (200, 204, 205, 299) for k in range(4)]
    # Further columns have names that the operators use inside.
    wide = [(*t, 1, 2, 3) for t in turns]
    spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, place int, chars int, depth int").coalesce(1).write.parquet(
        f"{folder}/conversations.parquet"
    )
    page = "<p>" + "copied " * 30
    pages = [
        (4, "http://a.example/4", page), (2, "http://a.example/2", page), (9, None, page), (None, "http://a.example/n", page), (5, "u", None), (6, "u", ""),
        (7, "line\r\nbreak", "short"), (8, "u", "short"), (10, "u", "é" * 49 + "x"), (11, "u", "é" * 49 + "x"), (12, "u", "é" * 50), (13, "u", "é" * 50),
        (14, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (15, "u", "long " * 400_000), (16, "u", "long " * 400_000), (2, "http://a.example/2", page),
        (None, None, "only null ids " * 20), (None, None, "only null ids " * 20),
    ]
    wide = [(*p, 1, "x", b"y") for p in pages]
    spark.createDataFrame(wide, "page_id long, url string, html string, first_id int, payload_digest string, payload binary").coalesce(2).write.parquet(
        f"{folder}/pages.parquet"
    )
    return folder


@pytest.mark.parametrize("name", sorted(TWINS))
def test_odd_rows_equal_sql(spark, odd_dir, name):
    db = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd_dir}/{table}.parquet/*.parquet'")
    assert compare(spark, db, name, queries.queries()[name], TWINS[name], odd_dir) is None


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op11_warc", "op12_prefix_trie", "op13_spelling"])
def test_empty_tables_give_no_rows(spark, odd_dir, tmp_path, name):
    for table in ("documents", "conversations", "pages"):
        spark.read.parquet(f"{odd_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).collect() == []
