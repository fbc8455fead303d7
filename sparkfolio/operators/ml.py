"""Tabular model benchmarking.

* Preprocessing statistics are computed with distributed aggregates (exact
  median via the distributed quantile operator, population std, mode by
  grouped counts) into a *params table* of one row per feature - bounded by
  the number of features and categories, never by the rows.
* The composite preprocessor is then a list of column expressions (impute,
  standardise, one-hot) evaluated inside whole-stage codegen.
* Models are Spark ML estimators (distributed training); scores are
  evaluated with an exact rank-sum AUC built from a distributed running sum.
* Scoring from exported parameters (M15) is again plain expressions; there is
  no Python UDF on the scoring path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.arith import sigmoid_dot
from sparkfolio.functions.coerce import python_float
from sparkfolio.operators.profile import wide_quantiles
from sparkfolio.operators.rows import with_running_sum
from sparkfolio.sources.sinks import written_once


# ---- M6 stratified split ----------------------------------------------------------
def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, out: str = "split", exact: bool = True) -> DataFrame:
    """Repeatable stratified split: inside each label, rows ordered by
    ``md5(id:seed)``; the first ``ceil(n * test_fraction)`` are validation.
    Rows are counted per (label, hash prefix); only the one prefix of a label
    that holds the cut is ranked, so no sort covers a label.  ``exact=False``
    is the shuffle-free path for very large inputs: a per-row hash threshold,
    whose per-label validation share holds in expectation (as with ``sampleBy``)."""
    if not exact:
        h = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_000))
        return df.withColumn(out, F.when(h < F.lit(int(round(test_fraction * 1_000_000))),
                                         "validation").otherwise("train"))
    key = F.coalesce(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), F.lit(""))
    hashed = df.withColumn("_h", key).withColumn("_p", F.substring("_h", 1, 4))
    before = Window.partitionBy(label).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)        # 65,536 prefixes at most
    counts = hashed.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_c")).select(
        F.col(label).alias("_label"), F.col("_p").alias("_prefix"), "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_from"),
        F.ceil(F.round(F.sum("_c").over(Window.partitionBy(label)) * F.lit(float(test_fraction)), 6)).alias("_cut"))
    placed = hashed.join(counts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_p") == F.col("_prefix"))).drop("_label", "_prefix")
    held = (F.col("_from") < F.col("_cut")) & (F.col("_cut") < F.col("_from") + F.col("_c"))
    inside = F.row_number().over(Window.partitionBy(label, "_p").orderBy("_h", id_col)) - 1
    sides = placed.where(~held).withColumn(out, F.when(F.col("_from") < F.col("_cut"), "validation").otherwise("train"))
    cut = placed.where(held).withColumn("_i", inside).withColumn(
        out, F.when(F.col("_from") + F.col("_i") < F.col("_cut"), "validation").otherwise("train")).drop("_i")
    return sides.unionByName(cut).drop("_h", "_p", "_c", "_from", "_cut")


# ---- M1-M4 preprocessing statistics -------------------------------------------------
def numeric_stats(train: DataFrame, numeric: list[str], exact: bool = True) -> DataFrame:
    """M1 + M2: (feature, median, mean, scale) per numeric column; mean and
    population std of the median-imputed values; zero std -> scale 1.
    ``exact=False`` takes the median from a bounded-memory sketch."""
    cell = {c: F.col(f"`{c}`").cast("double") for c in numeric}
    cell = {c: F.when(~F.isnan(v), v) for c, v in cell.items()}
    if exact:
        median = {c: q[0] for c, q in wide_quantiles(train.select(*[v.alias(c) for c, v in cell.items()])).items()}
    else:
        median = dict(zip(numeric, train.agg(*[F.percentile_approx(v, 0.5, 100000) for v in cell.values()]).first()))
    # one wide aggregate over the imputed values; a feature without values has no row
    known = [c for c in numeric if median[c] is not None]
    filled = {c: F.coalesce(cell[c], F.lit(float(median[c]))) for c in known}
    wide = train.agg(F.count(F.lit(1)).alias("_n"), *[F.struct(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")).alias(f"_{i}") for i, v in enumerate(filled.values())])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(float(median[c])).alias("median"), F.col(f"_{i}.mean").alias("mean"),
                     F.when(F.col(f"_{i}.std") == 0, F.lit(1.0)).otherwise(F.col(f"_{i}.std")).alias("scale")) for i, c in enumerate(known)]
    none = F.array().cast("array<struct<feature:string,median:double,mean:double,scale:double>>")
    return wide.select(F.inline(F.array(*rows) if rows else none))


def categorical_stats(train: DataFrame, categorical: list[str]) -> DataFrame:
    """M3 + M4: (feature, mode, categories) per categorical column.  Mode =
    most frequent non-null value, ties -> smallest; categories = sorted
    distinct values after mode imputation.  Grouped counts first, so the
    tables that follow have one row per (feature, value)."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in categorical)
    long = train.selectExpr(f"stack({len(categorical)}, {stack}) AS (feature, value)")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    # smallest (-count, value): combined map-side
    mode = (counts.where(F.col("value").isNotNull()).groupBy("feature")
                  .agg(F.min(F.struct((-F.col("n")).alias("k"), "value"))["value"].alias("mode")))
    cats = (counts.join(mode, "feature")
                  .select("feature", F.coalesce("value", "mode").alias("value"))
                  .groupBy("feature").agg(F.array_sort(F.collect_set("value")).alias("categories")))
    return mode.join(cats, "feature")


class Preprocessor:
    """M5: fitted numeric + categorical preprocessing as column expressions."""

    def __init__(self, numeric: list[str], categorical: list[str], num_rows, cat_rows):
        self.numeric, self.categorical = numeric, categorical
        n = {r["feature"]: r for r in num_rows}
        c = {r["feature"]: r for r in cat_rows}
        self.medians = [float(n[f]["median"]) for f in numeric]
        self.means = [float(n[f]["mean"]) for f in numeric]
        self.scales = [float(n[f]["scale"]) for f in numeric]
        self.modes = [c[f]["mode"] for f in categorical]
        self.categories = [list(c[f]["categories"]) for f in categorical]

    @classmethod
    def fit(cls, train: DataFrame, numeric: list[str], categorical: list[str]) -> "Preprocessor":
        # The statistics tables have one row per feature: collecting them is
        # bounded by the schema, not by the data.
        return cls(numeric, categorical, numeric_stats(train, numeric).collect(),
                   categorical_stats(train, categorical).collect())

    @property
    def feature_names(self) -> list[str]:
        return list(self.numeric) + [f"{f}_{v}" for f, cats in zip(self.categorical, self.categories)
                                     for v in cats]

    def feature_columns(self, scoring: bool = False) -> list[Column]:
        """Training transform (M1-M4) or the exported-parameter scoring rule
        (M15: bad/missing number -> median, scale 0 -> 0, missing category ->
        '' which matches no category)."""
        out = []
        for f, med, mean, sc in zip(self.numeric, self.medians, self.means, self.scales):
            raw = F.col(f"`{f}`")
            x = python_float(raw) if scoring else raw.cast("double")
            x = F.coalesce(F.when(~F.isnan(x), x), F.lit(med))
            out.append(F.lit(0.0) if sc == 0 else (x - F.lit(mean)) / F.lit(sc))
        for f, mode, cats in zip(self.categorical, self.modes, self.categories):
            v = F.col(f"`{f}`").cast("string")
            v = F.coalesce(v, F.lit("")) if scoring else F.coalesce(v, F.lit(mode))
            out.extend(F.when(v == F.lit(c), F.lit(1.0)).otherwise(F.lit(0.0)) for c in cats)
        return out

    def transform(self, df: DataFrame, out: str = "features", scoring: bool = False) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        return df.withColumn(out, array_to_vector(F.array(*self.feature_columns(scoring))))

    def params_row(self, coef: list[float], intercept: float) -> dict:
        """The exported artifact as a flat record."""
        return {"numeric_features": list(self.numeric), "numeric_imputer_medians": self.medians,
                "numeric_means": self.means, "numeric_scales": self.scales,
                "categorical_features": list(self.categorical), "categories": self.categories,
                "coef": [float(c) for c in coef], "intercept": float(intercept)}


# ---- M7-M11 models ----------------------------------------------------------------
def model_zoo(n_features: int, n_rows: int, label: str = "label", seed: int = 42, c: float = 1.0):
    """(name, type, estimator) for the benchmark (Spark ML analogues).  ``c``
    is the inverse L2 strength of the logistic regression on a sum of losses;
    on Spark's mean loss the penalty is 1 / (c * training rows)."""
    from pyspark.ml.classification import (
        GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
        RandomForestClassifier)
    common = dict(featuresCol="features", labelCol=label)
    return [
        ("LogisticRegression", "sklearn", LogisticRegression(maxIter=500, regParam=1.0 / (c * max(n_rows, 1)), **common)),
        ("RandomForestClassifier", "sklearn",
         RandomForestClassifier(numTrees=100, seed=seed, **common)),
        ("GradientBoostingClassifier", "sklearn",
         GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=seed, **common)),
        ("SGDClassifier", "sklearn",
         LogisticRegression(maxIter=100, regParam=1e-4, elasticNetParam=0.0, **common)),
        ("MLP_32_16_8", "keras",
         MultilayerPerceptronClassifier(layers=[n_features, 32, 16, 8, 2], maxIter=100,
                                        seed=seed, **common)),
    ]


def positive_probability(pred: DataFrame, out: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


# ---- A20 exact AUC / accuracy -----------------------------------------------------
def auc_exact(df: DataFrame, score: str, label: str, cut: float | None = None) -> DataFrame:
    """ROC AUC by the rank-sum rule with ties counted half.

    Scores are first reduced to (score, positives, negatives) by a grouped
    aggregate; the negatives below each score come from a distributed running
    sum over the sorted distinct scores.  Integer arithmetic until the final
    division, so the result is exact and order-independent.  With ``cut`` the
    same pass also gives the accuracy of the classifier ``score >= cut``."""
    per = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("_pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("bigint").alias("_neg"))
    run = with_running_sum(per, ["_s"], "_neg", "_below")
    aggs = [F.sum(F.col("_pos") * (F.lit(2) * F.col("_below") + F.col("_neg"))).alias("_twice"),
            F.sum("_pos").alias("P"), F.sum("_neg").alias("N")]
    if cut is not None:
        hit = F.when(F.col("_s") >= F.lit(cut), F.col("_pos")).otherwise(F.col("_neg"))
        aggs.append(F.sum(hit).alias("_hits"))
    tot = run.agg(*aggs)
    out = [F.try_divide(F.col("_twice").cast("double"),
                        (F.lit(2) * F.col("P") * F.col("N")).cast("double")).alias("auc"),
           F.col("P").alias("positives"), F.col("N").alias("negatives")]
    if cut is not None:
        out.append(F.try_divide(F.col("_hits").cast("double"),
                                (F.col("P") + F.col("N")).cast("double")).alias("accuracy"))
    return tot.select(*out)


def accuracy_at(df: DataFrame, prob: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy of ``prob >= threshold``."""
    hit = ((F.col(prob) >= F.lit(threshold)).cast("int") == F.col(label)).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"))


def leaderboard(results: list[tuple]) -> list[tuple]:
    """M12 + M13 (O6): (name, type, auc, accuracy) sorted by AUC descending,
    name for ties, each with whether it is the picked model: the first."""
    ordered = sorted(results, key=lambda r: (-(r[2] if r[2] is not None else -1), r[0]))
    return [(*r, i == 0) for i, r in enumerate(ordered)]


def score_from_params(df: DataFrame, params: dict, prob: str = "probability",
                      label: str = "label") -> DataFrame:
    """M15 + C18 + M16: score records with an exported artifact as one
    expression (no UDF): impute/scale numerics, one-hot categoricals,
    sigmoid of the dot product, label = prob >= 0.5."""
    feats = []
    for f, med, mean, sc in zip(params["numeric_features"], params["numeric_imputer_medians"],
                                params["numeric_means"], params["numeric_scales"]):
        if f in df.columns and isinstance(df.schema[f].dataType, T.NumericType):
            x = F.col(f"`{f}`").cast("double")
            x = F.when(~F.isnan(x), x)
        else:
            # missing, blank or non-numeric text -> median (Python float() rules)
            x = python_float(F.col(f"`{f}`") if f in df.columns else F.lit(None).cast("string"))
        x = F.coalesce(x, F.lit(float(med)))
        feats.append(F.lit(0.0) if sc == 0 else (x - F.lit(float(mean))) / F.lit(float(sc)))
    for f, cats in zip(params["categorical_features"], params["categories"]):
        raw = F.col(f"`{f}`") if f in df.columns else F.lit(None).cast("string")
        v = F.coalesce(raw.cast("string"), F.lit(""))
        feats.extend(F.when(v == F.lit(str(c)), F.lit(1.0)).otherwise(F.lit(0.0)) for c in cats)
    p = sigmoid_dot(params["coef"], feats, params["intercept"])
    return df.withColumn(prob, p).withColumn(label, (F.col(prob) >= F.lit(0.5)).cast("int"))


def sample_row(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """One repeatable pseudo-random row (top-1 by hash: no full sort)."""
    return df.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))).limit(1)




# ---- M5 as a Spark ML Pipeline -------------------------------------------------------
def spark_ml_preprocessor(numeric: list[str], categorical: list[str], out: str = "features",
                          median_error: float = 0.001):
    """M5 with Spark ML stages: median Imputer -> StandardScaler (mean
    centred; note Spark scales by the *sample* std) for numerics,
    StringIndexer (alphabetical, unseen -> extra index) -> OneHotEncoder
    (dropLast, so an unseen category is all zeros) for categoricals, then a
    VectorAssembler.  ``median_error`` is the Imputer's quantile error bound
    (0 = exact, at the cost of a full sort)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer,
                                    VectorAssembler)
    imp_out = [f"{c}__imp" for c in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=imp_out, strategy="median",
                      relativeError=median_error),
              VectorAssembler(inputCols=imp_out, outputCol="_num_vec"),
              StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True,
                             withStd=True)]
    idx_out = [f"{c}__idx" for c in categorical]
    oh_out = [f"{c}__oh" for c in categorical]
    if categorical:
        stages += [StringIndexer(inputCols=list(categorical), outputCols=idx_out,
                                 stringOrderType="alphabetAsc", handleInvalid="keep"),
                   # the indexer's extra "unseen" index is the last category, which
                   # dropLast removes: unseen -> all zeros ("keep" here would add a slot)
                   OneHotEncoder(inputCols=idx_out, outputCols=oh_out, dropLast=True)]
    stages.append(VectorAssembler(inputCols=["_num_scaled"] + oh_out, outputCol=out))
    return Pipeline(stages=stages)


def vector_feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Feature names of an assembled vector, read from its ML attribute metadata."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    pairs = [(a["idx"], a.get("name", str(a["idx"]))) for group in attrs.values() for a in group]
    return [n for _, n in sorted(pairs)]


def load_churn_csv(spark, path: str, target: str = "Churn", drop=("customerID",),
                   numeric_text=("TotalCharges",)) -> DataFrame:
    """Churn table loader: header CSV with inferred types, text totals
    coerced to numbers (C4: blanks -> NULL), Yes/No target -> 1/0 (C15), the
    id column dropped if present (P4)."""
    from sparkfolio.functions.coerce import to_number, yes_no_flag
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    for c in numeric_text:
        if c in df.columns:
            df = df.withColumn(c, to_number(c))
    df = df.withColumn(target, yes_no_flag(target))
    return df.drop(*[c for c in drop if c in df.columns])


def run_benchmark(train: DataFrame, val: DataFrame, numeric: list[str], categorical: list[str],
                  label: str = "label", id_col: str | None = None, seed: int = 42):
    """M5 + M7-M13 + A20: fit the preprocessor on ``train``, train every model
    of the zoo, score ``val`` with the exact AUC and the accuracy at 0.5.
    Returns (preprocessor, leaderboard rows (name, type, auc, accuracy, picked)
    best first, {name: fitted model}, scores): the scores of all models are
    written once, and the figures come from that table."""
    prep = Preprocessor.fit(train, numeric, categorical)
    tr, va = prep.transform(train), prep.transform(val)
    models, parts = {}, []
    zoo = model_zoo(len(prep.feature_names), train.count(), label=label, seed=seed)
    for name, _, est in zoo:
        models[name] = est.fit(tr)
        ids = [F.col(id_col)] if id_col else []
        parts.append(positive_probability(models[name].transform(va)).select(F.lit(name).alias("name"), *ids, F.col(label).alias("label"), "score"))
    scores = written_once(reduce(DataFrame.unionByName, parts), "scores")
    rows = []
    for name, kind, _ in zoo:
        r = auc_exact(scores.where(F.col("name") == name), "score", "label", cut=0.5).first()
        rows.append((name, kind, r["auc"], r["accuracy"]))
    return prep, leaderboard(rows), models, scores
