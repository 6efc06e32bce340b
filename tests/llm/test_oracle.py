"""Operators against their SQL twins, on the smallest driver tables and on odd rows."""

import os

import pytest

from ledgerlake.llm.queries import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
ON_TEXTS = ("op2_jaccard_join", "op4_substring_dedup", "op5_suffix_dedup", "op11_minhash")


def _same(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        if os.path.exists(f"{folder}/{table}.parquet"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet{_part(folder, table)}')")
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(str(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert sorted(tuple(str(row[c]) for c in columns) for row in df.collect()) == want


def _part(folder, table):
    return "/*.parquet" if os.path.isdir(f"{folder}/{table}.parquet") else ""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    _same(spark, FOLDER, name)


@pytest.mark.parametrize("name", ON_TEXTS)
def test_matches_sql_on_odd_rows(spark, tmp_path, name):
    many = " ".join(f"Wort{i}" for i in range(60))
    texts = [
        None, "", " \t\n", "Ein", "ein", "zwei Wörter", many, many + " ende", many.upper(), "ü" * 250, "xü" + "ü" * 249,
        "aaaa" * 200, " ".join(["da"] * 300), "vor " + many + " nach " + many, "ß x " * 80,
    ]
    rows = [(i, t, "de", "web", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    _same(spark, str(tmp_path), name)
