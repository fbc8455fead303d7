"""KPI segment on lineitem x orders x supplier x nation (R1, C3, C12-C17,
A11-A13, W1, W2, W4, J4, R3).

Stand-in mapping: entity = supplier nation, year = order year.  One grouped
pass sums exact DECIMAL line measures per (nation, year)
(``net = price * (1 - discount)``, ``disc = price * discount``,
``tax = price * tax``, ``gross = price``, ``open_q`` = quantity of open lines);
statement lines are fixed linear combinations of those sums, rounded to whole
currency units.  English-labelled lines feed the exact-synonym KPI table; a
Korean-labelled copy with annual (11011) and quarterly (11014) report codes
and accounting-format text amounts feeds the substring-synonym peer table.
Statement "files" pair an even report year (current) with the odd year
before it (prior), amounts written as accounting text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_half, round_sql
from sparkfolio.functions.coerce import zero_pad
from sparkfolio.functions.synonyms import EXACT_ACCOUNT_MAP
from sparkfolio.operators import kpi
from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import landed_split, stage
from sparkfolio.sources.tables import load

# Stand-in statement lines: (statement, label, amount expression over the
# per-(nation, year) sums).  Includes a label variant (" revenue "), a line
# that maps to nothing ("Other income") and a second TotalLiabilities label.
EN_LINES = [
    ("IS", "Revenue", "net"),
    ("IS", " revenue ", "tax"),
    ("IS", "Cost of sales", "net * 0.6"),
    ("IS", "Selling, general and administrative expenses", "disc"),
    ("IS", "Advertising and promotion expenses", "disc * 0.25"),
    ("IS", "Operating profit (loss)", "net * 0.4 - disc"),
    ("IS", "Other income", "tax * 0.5"),
    ("BS", "Inventories", "open_q * 100"),
    ("BS", "Current assets", "gross + tax"),
    ("BS", "Current liabilities", "tax * 5"),
    ("BS", "Total liabilities", "tax * 8"),
    ("BS", "부 채", "disc * 2"),
    ("BS", "Total equity", "gross * 0.3"),
    ("BS", "Cash and cash equivalents", "net * 0.1"),
    ("BS", "Short-term borrowings", "tax * 2"),
    ("CF", "Cash flows from operating activities", "net * 0.4 - disc - tax"),
]
KO_LINES = [
    ("매출액", "net"), ("매출원가", "net * 0.6"), ("영업이익", "net * 0.4 - disc"),
    ("판매비와관리비", "disc"), ("광고선전비", "disc * 0.25"), ("재고자산", "open_q * 100"),
    ("유동자산", "gross + tax"), ("비유동자산", "gross * 0.5"), ("유동부채", "tax * 5"),
    ("부채총계", "tax * 8"), ("자본총계", "gross * 0.3"), ("현금및현금성자산", "net * 0.1"),
    ("단기차입금", "tax * 2"), ("영업활동현금흐름", "net * 0.4 - disc - tax"),
    ("기타수익", "tax * 0.5"),
]
# statement of each Korean line (the landing split key)
KO_STATEMENT = {"재고자산": "BS", "유동자산": "BS", "비유동자산": "BS", "유동부채": "BS",
                "부채총계": "BS", "자본총계": "BS", "현금및현금성자산": "BS", "단기차입금": "BS",
                "영업활동현금흐름": "CF"}
REPORT_CODES = [(11011, "1"), (11014, "0.25")]
PEER_DIGITS = 8


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SALT = 64


def entity_year_sums(spark, sf):
    """Stage table (one row per nation and year), built once per input version."""
    return stage(spark, sf, "entity_year_sums", ["lineitem", "orders", "supplier", "nation"],
                 lambda: build_entity_year_sums(spark, sf))


def build_entity_year_sums(spark, sf):
    """Exact per-(nation, year) money sums.

    Per line the work is 64-bit integer arithmetic (cents x basis points).
    After the order join the lines are summed per (supplier, year) and ``SALT``
    hash buckets of the order key, map-side first, so what goes on to the
    supplier join is sums, not lines; a hot supplier is split across buckets
    and every bucket sum stays far below the long range.  These partials are
    then added as DECIMAL(38), which keeps the totals exact at any size."""
    cents = lambda c: F.round(F.col(c) * F.lit(100.0)).cast("bigint")
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linestatus",
        cents("l_extendedprice").alias("e"), cents("l_discount").alias("dp"),
        cents("l_tax").alias("tp"), F.col("l_quantity").cast("bigint").alias("q"))
    o = load(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    s = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = load(spark, sf, "nation").select("n_nationkey", "n_name")
    part = (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("l_suppkey", "year", F.pmod(F.xxhash64("l_orderkey"), F.lit(SALT)).alias("_salt")).agg(
                F.sum("e").alias("e"), F.sum(F.col("e") * F.col("dp")).alias("ed"),
                F.sum(F.col("e") * F.col("tp")).alias("et"),
                F.sum(F.when(F.col("l_linestatus") == "O", F.col("q")).otherwise(0)).alias("oq")))
    j = (part.join(s, part.l_suppkey == s.s_suppkey)
         # nation is a fixed 25-row dimension: bounded broadcast
         .join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")))
    dec = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    tot = j.groupBy(F.col("n_name").alias("entity"), "n_nationkey", "year").agg(
        dec("e").alias("e"), dec("ed").alias("ed"), dec("et").alias("et"), dec("oq").alias("oq"))
    return tot.selectExpr(
        "entity", "n_nationkey", "year",
        "CAST(e * 0.01 AS DECIMAL(30,2)) - CAST(ed * 0.0001 AS DECIMAL(30,4)) AS net",
        "CAST(ed * 0.0001 AS DECIMAL(30,4)) AS disc",
        "CAST(et * 0.0001 AS DECIMAL(30,4)) AS tax",
        "CAST(e * 0.01 AS DECIMAL(30,2)) AS gross",
        "CAST(oq AS DECIMAL(30,0)) AS open_q")


def _amount(expr: str) -> str:
    return f"CAST(ROUND({expr}, 0) AS DOUBLE)"


def statement_long(spark, sf, sums=None):
    """Tidy lines (entity, year, statement, account_en, amount)."""
    sums = entity_year_sums(spark, sf) if sums is None else sums
    stack = ", ".join(f"{_q(st)}, {_q(lab)}, {_amount(ex)}" for st, lab, ex in EN_LINES)
    return sums.selectExpr("entity", "year",
                           f"stack({len(EN_LINES)}, {stack}) AS (statement, account_en, amount)")


def _accounting_text(c):
    """Amount as statement text: thousands separators, negatives in ()."""
    return (F.when(c < 0, F.concat(F.lit("("), F.format_number(-c, 0), F.lit(")")))
             .otherwise(F.format_number(c, 0)))


def statement_files(spark, sf, sums=None):
    """(entity, report_year, statement, account_en, current_amount, prior_amount)
    as text; report years are even, the prior year is the odd year before."""
    long = statement_long(spark, sf, sums).withColumn(
        "report_year", F.col("year") + F.col("year") % 2)
    g = long.groupBy("entity", "report_year", "statement", "account_en").agg(
        F.max(F.when(F.col("year") == F.col("report_year"), F.col("amount"))).alias("cur"),
        F.max(F.when(F.col("year") == F.col("report_year") - 1, F.col("amount"))).alias("pri"))
    return g.select("entity", "report_year", "statement", "account_en",
                    _accounting_text(F.col("cur")).alias("current_amount"),
                    _accounting_text(F.col("pri")).alias("prior_amount"))


def peer_raw(spark, sf, sums=None):
    """Raw peer filing lines (Korean labels, text amounts, two report codes)."""
    sums = entity_year_sums(spark, sf) if sums is None else sums
    parts = []
    for code, k in REPORT_CODES:
        for lab, ex in KO_LINES:
            st = KO_STATEMENT.get(lab, "IS")
            parts.append(f"{code}, {_q(st)}, {_q(lab)}, {_amount(f'({ex}) * {k}')}")
    long = sums.selectExpr(
        "entity", "n_nationkey", "year",
        f"stack({len(parts)}, {', '.join(parts)}) AS (reprt_code, requested_sj_div, account_nm, amt)")
    return long.select(
        F.col("entity").alias("peer_corp_name"),
        zero_pad(F.col("n_nationkey").cast("string"), 6).alias("peer_stock_code"),
        F.col("year").alias("bsns_year"), "reprt_code", "requested_sj_div", "account_nm",
        _accounting_text(F.col("amt")).alias("thstrm_amount"))


PEER_RAW_SCHEMA = ("peer_corp_name string, bsns_year int, reprt_code int, account_nm string, "
                   "thstrm_amount string, peer_stock_code string, requested_sj_div string")


def peer_raw_landed(spark, sf, sums=None):
    """The raw peer lines landed once as header CSV split by (stock code,
    statement) (S12), read back with partition discovery and a declared
    schema, so zero-padded codes stay text."""
    path = landed_split(spark, sf, "peer_raw", ["lineitem", "orders", "supplier", "nation"],
                        lambda: peer_raw(spark, sf, sums), ["peer_stock_code", "requested_sj_div"])
    return spark.read.option("header", True).schema(PEER_RAW_SCHEMA).csv(path)


def melted(spark, sf, sums=None):
    files = statement_files(spark, sf, sums)
    return kpi.melt_statement(files, F.col("report_year"), F.col("report_year") - 1,
                              keep=["entity"])


def kpi_table(spark, sf, sums=None):
    return kpi.add_ratios(kpi.compute_kpis(melted(spark, sf, sums), keys=["entity"]))


def peer_kpis(spark, sf, sums=None):
    return kpi.process_peers_raw(peer_raw_landed(spark, sf, sums))


def peer_avg(spark, sf, sums=None):
    return kpi.peer_mean_by_year(peer_kpis(spark, sf, sums))


# ---- oracle SQL -----------------------------------------------------------------
SUMS_CTE = """
sums AS (
  SELECT n.n_name AS entity, n.n_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS net,
         SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2))) AS disc,
         SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2))) AS tax,
         SUM(CAST(l.l_extendedprice AS DECIMAL(12,2))) AS gross,
         COALESCE(SUM(CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_quantity AS DECIMAL(12,0)) END), 0) AS open_q
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name, n.n_nationkey, CAST(year(o.o_orderdate) AS INTEGER))"""

LONG_CTE = SUMS_CTE + """,
long AS (
""" + "\n  UNION ALL ".join(
    f"SELECT entity, year, {_q(st)} AS statement, {_q(lab)} AS account_en, {_amount(ex)} AS amount FROM sums"
    for st, lab, ex in EN_LINES) + ")"


def _kpi_select(keys="entity, year"):
    cols = []
    for m, names in EXACT_ACCOUNT_MAP.items():
        lst = ", ".join(_q(n.strip().lower()) for n in names)
        cols.append(f"COALESCE(SUM(CASE WHEN lower(trim(account_en)) IN ({lst}) THEN amount END), 0) "
                    f"/ 100000000.0 AS {m}")
    return f"SELECT {keys}, " + ",\n       ".join(cols) + f" FROM long GROUP BY {keys}"


KPI_CTE = LONG_CTE + """,
kw AS (""" + _kpi_select() + """),
kpis AS (SELECT *,
  OperatingIncome / (Revenue + 1e-9) AS OpMargin,
  SGA / (Revenue + 1e-9) AS SGA_ratio,
  Advertising / (Revenue + 1e-9) AS Ad_ratio,
  CurrentAssets / (CurrentLiabilities + 1e-9) AS CurrentRatio,
  TotalLiabilities / (TotalEquity + 1e-9) AS DebtToEquity,
  CFO / (Revenue + 1e-9) AS CFO_margin
FROM kw)"""

PEER_RAW_CTE = SUMS_CTE + """,
praw AS (
""" + "\n  UNION ALL ".join(
    f"SELECT entity AS peer_corp_name, CASE WHEN length(CAST(n_nationkey AS VARCHAR)) < 6 THEN lpad(CAST(n_nationkey AS VARCHAR), 6, '0') ELSE CAST(n_nationkey AS VARCHAR) END AS peer_stock_code, "
    f"year AS bsns_year, {code} AS reprt_code, {_q(lab)} AS account_nm, "
    f"{_amount(f'({ex}) * {k}')} AS amount FROM sums"
    for code, k in REPORT_CODES for lab, ex in KO_LINES) + ")"


def _peer_metric_case():
    from sparkfolio.functions.synonyms import SUBSTRING_ACCOUNT_MAP
    whens = []
    for m, names in SUBSTRING_ACCOUNT_MAP.items():
        cond = " OR ".join(f"contains(account_nm, {_q(n)})" for n in names)
        whens.append(f"WHEN {cond} THEN {_q(m)}")
    return "CASE " + " ".join(whens) + " END"


def _pcell(m):
    return f"SUM(CASE WHEN metric = {_q(m)} THEN amount END)"


PEER_KPI_CTE = PEER_RAW_CTE + f""",
pm AS (SELECT peer_corp_name, peer_stock_code, bsns_year AS year, {_peer_metric_case()} AS metric,
              amount / 100000000.0 AS amount
       FROM praw WHERE reprt_code = 11011),
pv AS (SELECT peer_corp_name, peer_stock_code, year,
              {_pcell('Sales')} AS Sales, {_pcell('OperatingIncome')} AS OperatingIncome,
              {_pcell('SGA')} AS SGA, {_pcell('Advertising')} AS Advertising,
              {_pcell('Inventory')} AS Inventory, {_pcell('CurrentAssets')} AS CurrentAssets,
              {_pcell('CurrentLiabilities')} AS CurrentLiabilities,
              {_pcell('TotalLiabilities')} AS TotalLiabilities, {_pcell('TotalEquity')} AS TotalEquity,
              {_pcell('CFO')} AS CFO
       FROM pm WHERE metric IS NOT NULL GROUP BY peer_corp_name, peer_stock_code, year),
peers AS (SELECT peer_corp_name, peer_stock_code, year, Sales AS sales,
              OperatingIncome / (Sales + 1e-9) AS op_margin, SGA / (Sales + 1e-9) AS sga_ratio,
              Advertising / (Sales + 1e-9) AS ad_ratio,
              CurrentAssets / (CurrentLiabilities + 1e-9) AS current_ratio,
              TotalLiabilities / (TotalEquity + 1e-9) AS debt_to_equity,
              CFO / (Sales + 1e-9) AS cfo_margin, Inventory AS inventory
       FROM pv),
pmean AS (SELECT year, {', '.join(f'AVG({m}) AS {m}_mean' for m in kpi.PEER_KPIS)}
          FROM peers GROUP BY year),
pavg AS (SELECT * FROM pmean
         UNION ALL
         SELECT year + 1 AS year, {', '.join(f'{m}_mean' for m in kpi.PEER_KPIS)} FROM pmean
         WHERE year = (SELECT MAX(year) FROM pmean))"""


@query("melt", "WITH " + LONG_CTE + "\nSELECT entity, year, statement, account_en, amount FROM long")
def melt(spark, sf):
    """R1 + C3: statement files (current/prior accounting text) -> tidy lines."""
    return melted(spark, sf)


_KPI_COLS = list(EXACT_ACCOUNT_MAP)


@query("kpi_wide", "WITH " + KPI_CTE + f"\nSELECT entity, year, {', '.join(_KPI_COLS)} FROM kpis")
def kpi_wide(spark, sf):
    """A11 + C13 + C16: 13 metrics per (entity, year) in one conditional pass."""
    return kpi.compute_kpis(melted(spark, sf), keys=["entity"])


_RATIO_COLS = [r[0] for r in kpi.ENTITY_RATIOS]


@query("ratios", "WITH " + KPI_CTE + f"\nSELECT entity, year, {', '.join(_RATIO_COLS)} FROM kpis")
def ratios(spark, sf):
    """C17: epsilon ratios."""
    return kpi_table(spark, sf).select("entity", "year", *_RATIO_COLS)


@query("yoy", "WITH " + KPI_CTE + "\nSELECT entity, year, " + ", ".join(
    f"{m} / NULLIF(LAG({m}) OVER (PARTITION BY entity ORDER BY year), 0) - 1.0 AS {m}_YoY"
    for m in kpi.YOY_METRICS) + " FROM kpis")
def yoy(spark, sf):
    """Period-over-period change per entity."""
    t = kpi.pct_change(kpi_table(spark, sf), kpi.YOY_METRICS, keys=["entity"])
    return t.select("entity", "year", *[f"{m}_YoY" for m in kpi.YOY_METRICS])


@query("first_last_change", "WITH " + KPI_CTE + """,
lng AS (SELECT entity, year, Metric, v FROM kpis
        UNPIVOT INCLUDE NULLS (v FOR Metric IN (""" + ", ".join(kpi.YOY_METRICS) + """)))
SELECT entity, Metric, MIN(year) AS first_year, MAX(year) AS last_year,
       arg_min(v, year) AS v_first, arg_max(v, year) AS v_last,
       CASE WHEN arg_min(v, year) <> 0
            THEN (arg_max(v, year) - arg_min(v, year)) / abs(arg_min(v, year)) * 100.0 END AS Change_pct
FROM lng GROUP BY entity, Metric""")
def first_last_change(spark, sf):
    """First-vs-last period change table per entity and metric."""
    return kpi.first_last_change(kpi_table(spark, sf), kpi.YOY_METRICS, keys=["entity"])


@query("peer_kpis", "WITH " + PEER_KPI_CTE + "\nSELECT * FROM peers")
def peer_kpis_q(spark, sf):
    """C12 + C14 + C3 + A12 + C17: raw peer lines -> per-peer KPI table."""
    return peer_kpis(spark, sf)


@query("peer_mean_carry", "WITH " + PEER_KPI_CTE + "\nSELECT year, " + ", ".join(
    f"{round_sql(f'{m}_mean', PEER_DIGITS)} AS {m}_mean" for m in kpi.PEER_KPIS) + " FROM pavg")
def peer_mean_carry(spark, sf):
    """A13 + W4: per-year peer means, last year carried one year forward."""
    p = peer_avg(spark, sf)
    return p.select("year", *[round_half(f"{m}_mean", PEER_DIGITS).alias(f"{m}_mean")
                              for m in kpi.PEER_KPIS])


@query("vs_peer", "WITH " + KPI_CTE + ",\n" + PEER_KPI_CTE.split(SUMS_CTE + ",", 1)[1] + """
SELECT k.entity, k.year, """ + ", ".join(
    f"k.{v} AS {m}" for m, v in kpi.ALIGN.items()) + ",\n  " + ", ".join(
    f"{round_sql(f'p.{m}_mean', PEER_DIGITS)} AS {m}_mean" for m in kpi.PEER_KPIS) + ",\n  " + ", ".join(
    f"{round_sql(f'k.{kpi.ALIGN[m]} - p.{m}_mean', PEER_DIGITS)} AS {m}_vs_peer_mean"
    for m in kpi.PEER_KPIS) + """
FROM kpis k LEFT JOIN pavg p ON k.year = p.year""")
def vs_peer(spark, sf):
    """J4 + R3: entity KPIs vs the per-year peer mean."""
    # one aggregate of the large join feeds both sides (the same plan
    # subtree, so its shuffle stage is computed once and reused)
    sums = entity_year_sums(spark, sf)
    v = kpi.vs_peer(kpi_table(spark, sf, sums), peer_avg(spark, sf, sums))
    return v.select("entity", "year", *kpi.PEER_KPIS,
                    *[round_half(f"{m}_mean", PEER_DIGITS).alias(f"{m}_mean") for m in kpi.PEER_KPIS],
                    *[round_half(f"{m}_vs_peer_mean", PEER_DIGITS).alias(f"{m}_vs_peer_mean")
                      for m in kpi.PEER_KPIS])
