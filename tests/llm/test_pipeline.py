import collections

import pytest
from llm_frames import SCHEMA, prose
from pyspark.sql import functions as F

import corpus_pipeline as C
from sparkfolio.llm import line_dedup

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output over the whole documents table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, f in C.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        f(spark, docs, SF).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def test_names_and_columns(stages, spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "line_dedup", "near_duplicates", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.dtypes == columns, name


def test_toxic_documents_go_and_clean_ones_stay(stages, spark):
    before, after = stages["toxicity"]
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    clean = [i for i in toxic if not toxic[i]]
    assert sum(i in kept for i in clean) >= 0.995 * len(clean)
    bad = [i for i in toxic if toxic[i]]
    assert sum(i not in kept for i in bad) > 0.8 * len(bad) and after.count() < before.count()
    assert after.exceptAll(before).count() == 0


def test_line_stage_is_the_operator(stages):
    before, after = stages["line_dedup"]
    want = {r["record"]["doc_id"]: r["text"] for r in line_dedup.dedup_lines(before).collect()}
    got = after.collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_one_of_each_group_stays(stages):
    from test_jaccard import brute
    before, after = stages["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    want = {c for _, _, c in brute(rows)}
    assert {r["doc_id"] for r in after.collect()} == want and after.exceptAll(before).count() == 0


def test_packing_holds_every_token(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
    per = collections.Counter()
    for r in after.collect():
        per[r["sequence_id"]] += r["length"]
    assert max(per.values()) <= 2048 and len(per) <= sum(per.values()) / 2048 + 2


def test_odd_rows_pass(spark, odd_rows, labels):
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    sf = "/root/testdata/sf0.001"
    for df in (docs, docs.limit(0)):
        for name, f in C.STAGES:
            df = f(spark, df, sf)
            rows = df.collect()
    # blank texts and those without a letter go with the language stage; repeated rows leave one
    kept = [r["doc_id"] for r in C.near_duplicates(spark, C.language(spark, docs, sf), sf).collect()]
    assert kept.count(1) == 1 and 3 not in kept and 4 not in kept and 5 not in kept


def test_columns_of_any_name_pass(spark, odd, odd_rows):
    """Extra columns with the names that the stages use inside keep their values."""
    from llm_frames import CLASH
    out = C.near_duplicates(spark, C.line_dedup(spark, odd, ""), "").collect()
    assert out and all([r[c] for c in CLASH] == list(range(len(CLASH))) for r in out)


def test_language_stage_rejects_unknown_scripts(spark, documents):
    extra = documents.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("漢字仮名交" * 40).alias("text"), F.lit(None).cast("string").alias("lang"), "source", "n_chars")
    filled = documents.limit(1).select(F.lit(-2).cast("long").alias("doc_id"), F.lit(prose(1, 3, "the and of")).alias("text"), F.lit(None).cast("string").alias("lang"), "source", "n_chars")
    out = {r["doc_id"]: r["lang"] for r in C.language(spark, documents.unionByName(extra).unionByName(filled), "").collect()}
    assert -1 not in out and len(out) >= documents.count() and out.get(-2) == "en"


def test_run_equals_stages(stages, spark):
    got = C.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(stages["packing"][1].select("doc_id", "piece", "length", "ids_crc32").collect())
