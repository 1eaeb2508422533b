"""Registered corpus queries against their SQL twins in DuckDB."""

import glob
import os

import duckdb
import pytest

from tallyframe.llm import queries

TABLES = {
    "conversations": "conv_id long, turn int, role string, text string", "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string", "benchmark": "item_id string, text string",
}


def check(spark, folder, name):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{files}')")
    found = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    want = sorted(map(repr, found.fetchall()))
    df = queries.QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(repr(tuple(r)) for r in df.select(columns).collect())
    assert got == want
    return got


def write(spark, tmp_path, **tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert check(spark, "/root/testdata/sf0.01", name)


@pytest.mark.parametrize("rows", [
    [(0, 1, "user", "a"), (1, 1, "user", "a")],
    [(0, 1, "user", "a"), (0, 2, "assistant", "é"), (1, 1, "user", "a"), (1, 2, "assistant", "f"), (1, 2, "assistant", "e")],
    [(2, 1, None, None), (3, None, "assistant", "x"), (3, 1, "user", "")],
    [(4, 1, "user", "a"), (4, 2, "assistant", "b"), (5, 1, "user", "a")],
    [(6, 1, "user", "a"), (6, 2, "assistant", "b"), (6, 3, "user", "c"), (7, 1, "user", "a"), (7, 2, "assistant", "z"), (7, 3, "user", "c")],
])
def test_preference_chat_matches_sql_on_odd_rows(spark, tmp_path, rows):
    check(spark, write(spark, tmp_path, conversations=rows), "op8_preference_chat")


def test_repair_matches_sql_on_odd_rows(spark, tmp_path):
    roles = ["user", "assistant", "system", "s", "", None, "User", "tool"]
    texts = ["Yes.", "no", "", None, " \n", "é!", "Yes.", "1?  ", "."]
    rows = [(c if c < 60 else None, (c * t) % 5 if (c + t) % 7 else None, roles[(c * 3 + t * t) % (3 + c % 6)], texts[(c + 2 * t) % (2 + c % 8)]) for c in range(61) for t in range(1 + c % 9)]
    check(spark, write(spark, tmp_path, conversations=rows), "op12_conversation_repair")


ODD_DOCS = [
    (None, None, None, None, None), (None, "x", None, "a", 1), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "é ç", "de", "b:", None), (2, "\U0001f600", "de", "-", 5), (2**40, "a b" * 9, "é", "c", 7),
    *((i, f"w{i % 3} same old words again and " * (i % 4), "en", "d", i) for i in range(3, 40)),
]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_quality_rules"])
def test_documents_match_sql_on_odd_rows(spark, tmp_path, name):
    check(spark, write(spark, tmp_path, documents=ODD_DOCS), name)


def test_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, documents=[], conversations=[])
    for name in ("op11_merkle_manifest", "op12_conversation_repair", "op13_quality_rules"):
        assert queries.QUERIES[name](spark, folder).count() == 0
