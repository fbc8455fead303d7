"""One-hot encoding and scoring with categories and weights held in tables.

The dictionary (feature, value, slot) is a written table: no category reaches
the driver or the plan, so a feature may have any number of values.  A row's
encoding is the list of its non-zero slots, and an artifact is a table of
weights by slot, so scoring is a join and a sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.operators.rows import with_row_index
from sparkfolio.sources.sinks import written_once


class Dictionary(NamedTuple):
    features: Sequence[str]
    slots: DataFrame        # feature (its place in ``features``), value, slot (dense, by feature and value)
    modes: DataFrame        # feature, mode: one row a feature


def _cells(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row a cell: ``keep``, the feature's place and its value as text."""
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(features)])
    return df.select(*keep, F.inline(cells))


def fit_dictionary(train: DataFrame, features: Sequence[str]) -> Dictionary:
    """Slots of all values in ``train`` and the most frequent one of each
    feature (ties: the smallest); a missing value is the mode, so it has no
    slot of its own.  A feature without values has neither slots nor a mode.

    Cells are counted before the shuffle, so a value that a third of the rows
    hold is a row a task; the dense numbers come from one range sort of the
    distinct values."""
    counts = written_once(_cells(train, features).where(F.col("value").isNotNull())
                          .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    modes = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("k"), "value"))["value"].alias("mode"))
    slots = with_row_index(counts.select("feature", "value"), ["feature", "value"], name="slot")
    return Dictionary(tuple(features), written_once(slots, "slots"), written_once(modes, "modes"))


def encode(df: DataFrame, dictionary: Dictionary, row_id: str, impute: bool = True) -> DataFrame:
    """``row_id`` (unique) and ``slots``: a row's slots, ascending.  A missing
    value is the mode if ``impute``, else nothing, as is a value that the
    dictionary lacks.  A row's list is as long as there are features at most.

    The join with the dictionary is left to the planner: a small one is
    broadcast after its size is known, a large one meets the cells by value,
    and the skew join splits a value that many rows hold (its dictionary side
    is one row)."""
    return (_slots(df, dictionary, row_id, impute).groupBy(row_id)
            .agg(F.array_sort(F.collect_list("slot")).alias("slots")))


def _slots(df: DataFrame, dictionary: Dictionary, row_id: str, impute: bool) -> DataFrame:
    """One row a cell: ``row_id`` and ``slot``, null where there is none."""
    cells = _cells(df, dictionary.features, [F.col(f"`{row_id}`")])
    if impute:
        # a mode joins by feature, few and hot: one row a feature goes along as a map instead
        modes = dictionary.modes.agg(F.map_from_entries(F.collect_list(F.struct("feature", "mode"))).alias("modes"))
        cells = cells.withColumn("value", F.coalesce("value", F.try_element_at(modes.scalar(), F.col("feature"))))
    return cells.join(dictionary.slots, ["feature", "value"], "left").select(row_id, "slot")


def score_by_slot(df: DataFrame, dictionary: Dictionary, weights: DataFrame, row_id: str, base: Column | float = 0.0,
                  prob: str = "probability", label: str = "label") -> DataFrame:
    """M15, M16 with an artifact of any size: ``row_id``, the sigmoid of
    ``base`` (a number, or a column of ``df`` such as the numeric part) plus
    the weights (``slot``, ``weight``) of the row's slots, and whether it is
    0.5 or more.  Unknown and missing categories add nothing; so do slots
    without a weight."""
    known = dictionary.slots.join(weights, "slot").select("feature", "value", F.col("weight").cast("double").alias("weight"))
    base = base if isinstance(base, Column) else F.lit(float(base))
    cells = _cells(df.withColumn("_base", base.cast("double")), dictionary.features, [F.col(f"`{row_id}`"), F.col("_base")])
    total = (cells.join(known, ["feature", "value"], "left").groupBy(row_id)
             .agg((F.first("_base") + F.coalesce(F.sum("weight"), F.lit(0.0))).alias("_z")))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))
    return total.select(row_id, p.alias(prob), (p >= 0.5).cast("int").alias(label))
