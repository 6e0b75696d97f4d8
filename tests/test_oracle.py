"""Every registered query against DuckDB running its SQL on the same tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value.isoformat() if hasattr(value, "isoformat") else value


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    got = duck.execute(oracle_sql()[name])
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert table([tuple(r) for r in df.collect()], df.columns) == table(got.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql_twin(spark, sf, name):
    assert queries()[name](spark, sf).columns


def test_text_quality_bands_of_empty_and_odd_texts(spark, tmp_path):
    """An empty text has no share of letters to divide: its size alone decides, in the SQL too."""
    cases = [
        ("", 0, "ocr_failure"), ("", 700, "medium"), ("", None, "high"), (None, 700, "medium"), (None, None, "high"), ("ab c", 1000, "high"),
        ("AB\n\t12", 1000, "ocr_failure"), ("\n\nab\r\n", 1000, "low"), ("é😀漢字 abcde", 1000, "medium"), ("a" * 1000 + "B" * 4000, 5000, "low"),
    ]
    data = [(i, text, "en", f"s{i}", n) for i, (text, n, _) in enumerate(cases)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted((f"s{i}", band, 1) for i, (_, _, band) in enumerate(cases))
    assert sorted(con.execute(oracle_sql()["text_quality_bands"]).fetchall()) == want
    found = queries()["text_quality_bands"](spark, str(tmp_path)).select("case_id", "text_quality", "n")
    assert sorted(tuple(r) for r in found.collect()) == want


def test_entry(spark):
    assert entry(spark).count() > 0
