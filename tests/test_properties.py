"""Property tests: distributed slicing equals Python slicing; the C1 text
number rule equals Python's own int()/float() reading."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfolio.functions.coerce import try_num
from sparkfolio.operators.rows import slice_rows

SETTINGS = dict(max_examples=25, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(n=st.integers(0, 40),
       start=st.one_of(st.none(), st.integers(-50, 50)),
       stop=st.one_of(st.none(), st.integers(-50, 50)),
       step=st.one_of(st.none(), st.integers(-7, 7).filter(lambda s: s != 0)))
def test_slice_equals_python(spark, n, start, stop, step):
    df = spark.range(n).repartition(3).withColumnRenamed("id", "k")
    got = [r.k for r in slice_rows(df, start, stop, step, order_by=["k"]).collect()]
    assert got == list(range(n))[slice(start, stop, step)]


def _python_c1(x: str):
    try:
        v = float(x) if "." in x else int(x)
    except Exception:
        return None
    return None if v != v else float(v)  # NaN -> NULL


@settings(max_examples=60, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="0123456789.+-eE_ a", max_size=8), min_size=1, max_size=40))
def test_try_num_equals_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.o for r in df.select(try_num(F.col("v")).alias("o")).collect()]
    assert got == [_python_c1(t) for t in texts]


def _python_c3(x: str):
    s = x.replace(",", "").replace("(", "-").replace(")", "").strip()
    try:
        v = float(s)
    except Exception:
        return None
    return None if v != v else v


@settings(max_examples=60, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="0123456789.,()-+ eEd_n", max_size=9), min_size=1, max_size=40))
def test_accounting_number_equals_python(spark, texts):
    from sparkfolio.functions.coerce import accounting_number
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.o for r in df.select(accounting_number(F.col("v")).alias("o")).collect()]
    assert got == [_python_c3(t) for t in texts]


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 99)),
                     min_size=0, max_size=60))
def test_keep_first_equals_pandas(spark, rows):
    import pandas as pd
    from sparkfolio.operators.rows import keep_first
    data = [(i, a, b, v) for i, (a, b, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "pos long, a int, b int, v int").repartition(3)
    got = sorted(tuple(r) for r in keep_first(df, ["a", "b"], "pos").select("a", "b", "pos", "v").collect())
    pdf = pd.DataFrame(data, columns=["pos", "a", "b", "v"]).drop_duplicates(subset=["a", "b"], keep="first")
    assert got == sorted((int(r.a), int(r.b), int(r.pos), int(r.v)) for r in pdf.itertuples())
