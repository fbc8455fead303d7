"""Financial-statement KPI operators.

Tables here are small *after* aggregation (entities x years), but the inputs
(statement lines) can be large, so every step that touches lines is a single
grouped pass: one conditional-sum aggregation builds all metrics at once
instead of one scan per metric, year and synonym.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.arith import EPS, eps_ratio
from sparkfolio.functions.coerce import accounting_number
from sparkfolio.functions.synonyms import EXACT_ACCOUNT_MAP, exact_match, map_label

# Ratio definitions (name, numerator, denominator) of the
# entity KPI table and of the peer table.
ENTITY_RATIOS = [("OpMargin", "OperatingIncome", "Revenue"),
                 ("SGA_ratio", "SGA", "Revenue"),
                 ("Ad_ratio", "Advertising", "Revenue"),
                 ("CurrentRatio", "CurrentAssets", "CurrentLiabilities"),
                 ("DebtToEquity", "TotalLiabilities", "TotalEquity"),
                 ("CFO_margin", "CFO", "Revenue")]
PEER_KPIS = ["sales", "op_margin", "sga_ratio", "ad_ratio", "current_ratio",
             "debt_to_equity", "cfo_margin", "inventory"]
# Entity column -> peer KPI name used for the comparison.
ALIGN = {"sales": "Revenue", "op_margin": "OpMargin", "sga_ratio": "SGA_ratio",
         "ad_ratio": "Ad_ratio", "current_ratio": "CurrentRatio",
         "debt_to_equity": "DebtToEquity", "cfo_margin": "CFO_margin",
         "inventory": "Inventory"}
YOY_METRICS = ["Revenue", "OperatingIncome", "SGA", "Advertising", "Inventory", "CFO",
               "OpMargin", "SGA_ratio", "Ad_ratio", "CurrentRatio", "DebtToEquity", "CFO_margin"]
PEER_METRIC_LIST = ["Sales", "CostOfSales", "OperatingIncome", "SGA", "Advertising",
                    "Inventory", "CurrentAssets", "CurrentLiabilities", "TotalLiabilities",
                    "TotalEquity", "CashAndCashEquivalents", "ShortTermBorrowings", "CFO"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def melt_statement(df: DataFrame, current_year, prior_year, statement=None,
                   keep: list[str] | None = None) -> DataFrame:
    """(account_en, current_amount, prior_amount) -> (year, statement,
    account_en, amount); amounts parsed with C3, rows without amount or label
    dropped.  Years may be literals or columns."""
    keep = keep or []
    cy = current_year if isinstance(current_year, Column) else F.lit(int(current_year))
    py = prior_year if isinstance(prior_year, Column) else F.lit(int(prior_year))
    st = statement if isinstance(statement, Column) else (
        F.lit(statement) if statement is not None else F.col("statement"))
    both = F.array(F.struct(cy.cast("int").alias("year"),
                            F.col("current_amount").cast("string").alias("amount_text")),
                   F.struct(py.cast("int").alias("year"),
                            F.col("prior_amount").cast("string").alias("amount_text")))
    long = df.select(*keep, st.alias("statement"), "account_en", F.inline(both))
    long = long.withColumn("amount", accounting_number("amount_text")).drop("amount_text")
    return (long.dropna(subset=["amount", "account_en"])
                .select(*keep, "year", "statement", "account_en", "amount"))


def compute_kpis(long: DataFrame, keys: list[str] | None = None,
                 mapping: dict[str, list[str]] | None = None, unit: float = 1e8) -> DataFrame:
    """A11 + C13 + C16: one conditional-sum pass; a metric with no matching
    line is 0; values are summed first, then divided by ``unit``."""
    keys = (keys or []) + ["year"]
    mapping = mapping or EXACT_ACCOUNT_MAP
    aggs = [(F.coalesce(F.sum(F.when(exact_match("account_en", names), F.col("amount"))),
                        F.lit(0.0)) / F.lit(float(unit))).alias(m)
            for m, names in mapping.items()]
    return long.groupBy(*keys).agg(*aggs)


def add_ratios(wide: DataFrame, ratios=ENTITY_RATIOS, eps: float = EPS) -> DataFrame:
    """C17: ``num / (den + eps)`` for each ratio."""
    return wide.withColumns({n: eps_ratio(a, b, eps) for n, a, b in ratios})


def pct_change(df: DataFrame, metrics: list[str], keys: list[str] | None = None,
               order: str = "year", suffix: str = "_YoY", pad: bool = True) -> DataFrame:
    """``x / previous(x) - 1`` per entity in ``order``; first is NULL and
    a zero prior gives NULL (pandas gives inf).  ``pad`` forward-fills missing
    values first, as pandas' default ``fill_method='pad'`` does
    ([1, NaN, 3] -> [NaN, 0, 2])."""
    w = Window.partitionBy(*(keys or [])).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for m in metrics:
        if pad:
            cur = F.last(m, ignorenulls=True).over(upto)
            prev = F.last(m, ignorenulls=True).over(before)
        else:
            cur, prev = F.col(m), F.lag(m).over(w)
        out[f"{m}{suffix}"] = F.try_divide(cur, prev) - F.lit(1.0)
    return df.withColumns(out)


def first_last_change(df: DataFrame, metrics: list[str], keys: list[str] | None = None,
                      order: str = "year") -> DataFrame:
    """One row per (entity, Metric) with the first and last period values
    and ``(v1 - v0) / |v0| * 100`` (NULL when v0 = 0)."""
    keys = keys or []
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    long = df.selectExpr(*[f"`{k}`" for k in keys], f"`{order}`",
                         f"stack({len(metrics)}, {stack}) AS (Metric, v)")
    g = long.groupBy(*keys, "Metric").agg(
        F.min(order).alias("first_year"), F.max(order).alias("last_year"),
        F.min_by("v", F.col(order)).alias("v_first"), F.max_by("v", F.col(order)).alias("v_last"))
    v0, v1 = F.col("v_first"), F.col("v_last")
    change = F.when(v0 != 0, (v1 - v0) / F.abs(v0) * F.lit(100.0))
    return g.withColumn("Change_pct", change)


def first_last_wide(long_change: DataFrame) -> DataFrame:
    """Golden-file layout of W2 for one entity: ``Metric, <y0>, <y1>, Change_pct``
    (reads the two years, a one-row action)."""
    y = long_change.select("first_year", "last_year").first()
    return long_change.select("Metric", F.col("v_first").alias(str(y[0])),
                              F.col("v_last").alias(str(y[1])), "Change_pct")


def process_peers_raw(raw: DataFrame, report_code: int = 11011, mode: str = "substring",
                      unit: float = 1e8, eps: float = EPS,
                      metric_list=PEER_METRIC_LIST) -> DataFrame:
    """C14 + C3 + A12 + C17: annual rows only, label -> metric (first synonym
    in map order wins), amount text -> number / unit, pivot-sum per
    (name, code, year) over a fixed metric list (present-but-NULL cells sum to
    0, absent cells stay NULL), then the eight peer KPIs."""
    r = (raw.where(F.col("reprt_code").cast("bigint") == report_code)
            .withColumn("metric", map_label("account_nm", mode=mode))
            .dropna(subset=["metric"])
            .withColumn("amount", accounting_number("thstrm_amount", unit))
            .dropna(subset=["peer_corp_name", "peer_stock_code", "bsns_year"]))
    p = (r.groupBy("peer_corp_name", "peer_stock_code", F.col("bsns_year").alias("year"))
          .pivot("metric", list(metric_list))
          .agg(F.sum(F.coalesce(F.col("amount"), F.lit(0.0)))))
    s = F.col("Sales")
    return p.select(
        "peer_corp_name", "peer_stock_code", "year",
        s.alias("sales"),
        eps_ratio("OperatingIncome", s, eps).alias("op_margin"),
        eps_ratio("SGA", s, eps).alias("sga_ratio"),
        eps_ratio("Advertising", s, eps).alias("ad_ratio"),
        eps_ratio("CurrentAssets", "CurrentLiabilities", eps).alias("current_ratio"),
        eps_ratio("TotalLiabilities", "TotalEquity", eps).alias("debt_to_equity"),
        eps_ratio("CFO", s, eps).alias("cfo_margin"),
        F.col("Inventory").alias("inventory"))


def peer_mean_by_year(kpis: DataFrame, metrics=PEER_KPIS, carry_forward: bool = True) -> DataFrame:
    """A13 + W4: per-year mean of each KPI (NULLs skipped), ``{m}_mean``;
    the last year's row is copied to the next year when that year is absent."""
    means = kpis.groupBy(F.col("year").cast("int").alias("year")).agg(
        *[F.avg(F.col(m).cast("double")).alias(f"{m}_mean") for m in metrics])
    if not carry_forward:
        return means
    return carry_last_forward(means, "year")


def carry_last_forward(df: DataFrame, year: str = "year") -> DataFrame:
    """Append a copy of the max-year row as max-year + 1.

    The input is a per-period summary (one row per year), so the un-partitioned
    window that finds the last year sees a handful of rows; the copy is made in
    the same pass (explode of [year, year + 1] on the last row), with no self-join
    that would re-evaluate the summary's lineage."""
    marked = df.withColumn("_last", F.max(year).over(Window.partitionBy()))
    years = (F.when(F.col(year) == F.col("_last"), F.array(F.col(year), F.col(year) + F.lit(1)))
              .otherwise(F.array(F.col(year))))
    others = [c for c in df.columns if c != year]
    out = marked.select(F.explode(years).alias("_year"), *others)
    return out.select(*[F.col("_year").alias(year) if c == year else F.col(c) for c in df.columns])


def align_to_peers(entity: DataFrame, align: dict[str, str] = ALIGN) -> DataFrame:
    """R3 alignment: peer KPI names as copies of the entity columns."""
    return entity.withColumns({k: F.col(v) for k, v in align.items()})


def vs_peer(entity: DataFrame, peer_avg: DataFrame, metrics=PEER_KPIS,
            align: dict[str, str] = ALIGN) -> DataFrame:
    """J4 + R3: left join per-year peer means (one row per year: a bounded
    broadcast) and ``{m}_vs_peer_mean = m - m_mean``."""
    aligned = align_to_peers(entity, align)
    j = aligned.join(F.broadcast(peer_avg), "year", "left")
    return j.withColumns({f"{m}_vs_peer_mean": F.col(m) - F.col(f"{m}_mean")
                          for m in metrics if f"{m}_mean" in peer_avg.columns})


# ---- pipelines over reference-format files -------------------------------------------
def entity_kpis_from_files(spark, statements: dict[str, str], current_year: int,
                           prior_year: int, company: str, ticker: str,
                           unit: float = 1e8) -> tuple[DataFrame, DataFrame]:
    """Statement files (one per IS / BS / CF, columns ``account_en,
    current_amount, prior_amount``, landed as CSV - S9 re-aimed) -> tidy lines
    (R1 + C3 + U2) and the KPI table with ratios (A11 + C13 + C16 + C17).
    Returns (long, kpis)."""
    from functools import reduce
    from sparkfolio.sources.readers import read_csv_typed
    schema = "account_en string, current_amount string, prior_amount string"
    parts = [melt_statement(read_csv_typed(spark, path, schema), current_year, prior_year, st)
             for st, path in statements.items()]
    long = reduce(lambda a, b: a.unionByName(b), parts)
    kpis = add_ratios(compute_kpis(long, unit=unit))
    kpis = kpis.select(F.lit(company).alias("company"), F.lit(ticker).alias("ticker"), "*")
    return long, kpis


def peer_kpis_from_dirs(spark, dirs: list[str], mode: str = "substring") -> DataFrame | None:
    """Raw peer files (``*_IS_raw.csv`` / ``*_BS_raw.csv`` / ``*_CF_raw.csv``,
    first folder with hits wins - S6) -> per-peer KPI table (C14 + C3 + A12 +
    C17); None when no file is found."""
    from sparkfolio.sources.readers import read_statement_globs
    raw = read_statement_globs(spark, dirs)
    if raw is None:
        return None
    return process_peers_raw(raw, mode=mode)
