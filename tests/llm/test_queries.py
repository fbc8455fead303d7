import duckdb
import pytest

from sparkfolio.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def cells(rows, columns):
    return sorted(tuple(repr(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert cells([r.asDict() for r in got.collect()], sorted(got.columns)) == cells([dict(zip(want.columns, r)) for r in want.fetchall()], sorted(got.columns))


@pytest.mark.parametrize("name,columns", [
    ("op1_isolation_forest", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]),
    ("op3_counterfactual_toxicity", ["doc_id", "held_out", "score", "predicted"]), ("op5_external_shuffle", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
    ("op6_line_chunks", ["doc_id", "text", "n_lines", "n_removed"]), ("op9_linear_grouping_packing", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]),
    ("op10_cross_parsing", ["doc_id", "held_out", "lang_pred", "score"]), ("op4_bpe_round_trip", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])])
def test_columns_and_rows(spark, name, columns):
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    ids = {r["doc_id"] for r in got.select("doc_id").collect()}
    assert got.columns[:len(columns)] == columns and ids == {r["doc_id"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
