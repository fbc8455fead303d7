"""Account-label synonym maps (C13 exact, C14 substring).

The maps are turned into one CASE / conditional-aggregate expression, so a
statement table is scanned once no matter how many metrics there are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkfolio.functions.coerce import strip

# Canonical KPI -> English statement labels (matched exactly
# after trim + lower-case), in this order.
EXACT_ACCOUNT_MAP = {
    "Revenue": ["Revenue"],
    "CostOfSales": ["Cost of sales"],
    "OperatingIncome": ["Operating profit (loss)", "Operating income"],
    "SGA": ["Selling, general and administrative expenses"],
    "Advertising": ["Advertising and promotion expenses"],
    "Inventory": ["Inventories"],
    "CurrentAssets": ["Current assets"],
    "CurrentLiabilities": ["Current liabilities"],
    "TotalLiabilities": ["Total liabilities", "부 채"],
    "TotalEquity": ["Total equity"],
    "CashAndCashEquivalents": ["Cash and cash equivalents"],
    "ShortTermBorrowings": ["Short‑term borrowings", "Short-term borrowings"],
    "CFO": ["Cash flows from operating activities"],
}

# Canonical KPI -> Korean label fragments (substring match,
# first metric in this order wins).
SUBSTRING_ACCOUNT_MAP = {
    "Sales": ["매출액", "매출", "영업수익"],
    "CostOfSales": ["매출원가"],
    "OperatingIncome": ["영업이익"],
    "SGA": ["판매비와관리비", "판매비및관리비"],
    "Advertising": ["광고선전비", "판매촉진비", "마케팅비"],
    "Inventory": ["재고자산"],
    "CurrentAssets": ["유동자산"],
    "CurrentLiabilities": ["유동부채"],
    "TotalLiabilities": ["부채총계", "부 채", "총부채"],
    "TotalEquity": ["자본총계", "총자본"],
    "CashAndCashEquivalents": ["현금및현금성자산", "현금및현금성"],
    "ShortTermBorrowings": ["단기차입금"],
    "CFO": ["영업활동으로인한현금흐름", "영업활동현금흐름", "영업활동으로 인한 현금흐름"],
}

METRICS = list(EXACT_ACCOUNT_MAP)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_match(label, names: list[str]) -> Column:
    """``lower(trim(label))`` equals one of ``names`` (also trimmed)."""
    return F.lower(strip(label)).isin([n.strip().lower() for n in names])


def map_label(label, mapping: dict[str, list[str]] | None = None,
              mode: str = "substring") -> Column:
    """C14: label -> metric name, first metric in dict order wins, else NULL.

    ``mode='substring'`` reproduces containment matching (so ``매출`` also
    hits ``매출원가``); ``mode='exact'`` compares trimmed lower-case text.
    """
    mapping = mapping or SUBSTRING_ACCOUNT_MAP
    lab = _col(label)
    out = None
    for metric, names in mapping.items():
        if mode == "substring":
            cond = None
            for nm in names:
                c = lab.contains(nm)
                cond = c if cond is None else (cond | c)
        elif mode == "exact":
            cond = exact_match(lab, names)
        else:
            raise ValueError(f"unknown mode {mode!r}")
        out = F.when(cond, F.lit(metric)) if out is None else out.when(cond, F.lit(metric))
    return out
