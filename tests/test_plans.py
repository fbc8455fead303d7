"""Plan lint: no registered query plans a cartesian product, a nested-loop
join or a row-at-a-time Python UDF, and every parquet scan is pruned to the
columns the query needs (never all columns of a wide table)."""

import contextlib
import io
import re

import pytest

from sparkfolio.plans import QUERIES, activity, churn, engine, kpi, series

SF = "/root/testdata/sf0.001"
TRAINING = {"leaderboard", "model_params", "score_fitted", "score_stream", "onehot_matrix"}
# reading all columns of a table is what these are for
WHOLE = {"drop_add_columns", "frame_shape", "churn.build_doc_features"}
BUILDERS = {f"{m.__name__.split('.')[-1]}.{n}": f for m in (activity, churn, engine, kpi, series) for n, f in vars(m).items() if n.startswith("build_")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
WIDTH = {"lineitem": 11, "orders": 6, "events": 6, "documents": 5, "customer": 5, "supplier": 4}


def lint(name, df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    for m in re.finditer(r"Location: [^\[]*\[file:[^\]]*/(\w+)\.parquet\]\s*\n(?:.*\n)*?ReadSchema: struct<([^\n]*)>", plan):
        table, schema = m.group(1), m.group(2)
        if table in WIDTH and name not in WHOLE:
            assert schema.count(":") < WIDTH[table], f"{name}: full scan of {table}"
    return plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINING))
def test_plan_lint(spark, name):
    lint(name, QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_stage_builder_lint(spark, name):
    """The stages' own joins and aggregates, with broadcast off."""
    lint(name, BUILDERS[name](spark, SF))


def test_kpi_builder_moves_sums_not_lines(spark):
    """Beyond the order join, what is shuffled are aggregates: the supplier
    join's left side comes from a partial aggregation."""
    plan = lint("kpi", kpi.build_entity_year_sums(spark, SF))
    assert re.search(r"keys=\[l_suppkey[^\]]*\]|Keys \[3\]: \[l_suppkey", plan)
