"""Default models on MLlib.

* balanced class weights are a CASE column from one class-count aggregate;
* the calibrated model is the reference's 3-fold ensemble: for each hash-assigned
  fold, fit the base estimator on the other folds, fit an isotonic map on the
  held-out fold (on the logistic margin for logistic regression, on the
  probability for trees) and average the calibrated outputs of all folds;
* equal rows are counted once and kept as one row with their number, shared by all
  fits; fold fits run concurrently from driver threads (independent Spark jobs);
* logistic regression and isotonic maps weigh a counted row by its number: the same
  sums. A forest whose rows repeat draws each tree's bootstrap on the counted rows
  (Poisson(n) for n equal rows is the sum of their n Poisson(1) draws) and fits its
  trees there one by one, so its passes cost as much as there are distinct rows.
  Boosted trees do the same with the share of rows that each tree sees (Binomial(n,
  share) is the sum of n single draws) and the pseudo-residuals, which equal rows
  share. Trees on rows that hardly repeat are fitted row by row.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import isotonic
from riskframe.operators.split import kfold
from riskframe.session import persist, reliable_checkpoint

VEC = "__features"
WEIGHT = "__weight"
COUNT = "__n"
#: Distinct rows up to which trees are fitted on counted rows, if the rows are REPEATS times as many at least.
COUNTED, REPEATS = 200_000, 4
#: Counted rows that one task reads, about; trees fitted at once.
COUNTED_TASK, TREES_AT_ONCE = 20_000, 4


@dataclass(frozen=True)
class ModelSpec:
    kind: str = "logreg"           # logreg | rf | gbt
    C: float = 1.0                 # logreg inverse regularisation (sklearn convention)
    max_iter: int = 1000
    n_trees: int = 50
    max_depth: int = 8
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42


def class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    r = df.agg(F.count_if(F.col(target) == 0).alias("n0"), F.count_if(F.col(target) == 1).alias("n1")).first()
    return int(r["n0"]), int(r["n1"])


def balanced_weight(target: str, n0: int, n1: int) -> F.Column:
    """M1: w_c = n / (2 n_c)."""
    n = n0 + n1
    return F.when(F.col(target) == 1, F.lit(n / (2.0 * n1))).otherwise(F.lit(n / (2.0 * n0)))


def class_weight_table(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_tot")).withColumn("_k", F.lit(1))
    return (counts.withColumn("_k", F.lit(1)).join(tot, on="_k").drop("_k")
            .select("class", "n", (F.col("_tot") / (F.lit(2.0) * F.col("n"))).alias("weight")))


def _estimator(spec: ModelSpec, n: int, label: str):
    if spec.kind == "logreg":
        # sklearn minimises C * sum(loss) + ||w||^2 / 2; MLlib minimises mean(loss) + reg/2 ||w||^2.
        return LogisticRegression(featuresCol=VEC, labelCol=label, weightCol=WEIGHT, regParam=1.0 / (spec.C * n),
                                  elasticNetParam=0.0, standardization=False, maxIter=spec.max_iter)
    if spec.kind == "rf":
        return RandomForestClassifier(featuresCol=VEC, labelCol=label, weightCol=WEIGHT, numTrees=spec.n_trees,
                                      maxDepth=spec.max_depth, seed=spec.seed)
    if spec.kind == "gbt":
        return GBTClassifier(featuresCol=VEC, labelCol=label, weightCol=WEIGHT, maxIter=spec.n_trees,
                             maxDepth=spec.max_depth, stepSize=spec.learning_rate, subsamplingRate=spec.subsample,
                             featureSubsetStrategy=str(spec.colsample), seed=spec.seed)
    raise ValueError(f"unknown model kind {spec.kind}")


def _drawn(seed: int, trees: int, share: float | None = None):
    """Counted rows with their bootstrap numbers in each tree (or, with ``share``, the numbers drawn without replacement
    at that rate), drawn from the row itself: the same in any partitioning."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            draws = []
            for row, n in zip(b.column("__row").to_pylist(), b.column(COUNT).to_pylist()):
                rng = np.random.default_rng([seed, row & (2**64 - 1)])
                draws.append((rng.poisson(n, trees) if share is None else rng.binomial(n, share, trees)).astype(float))
            yield b.append_column("__draws", pa.array(draws, pa.list_(pa.float64()))).drop_columns(["__row"])
    return run


def _drawn_rows(spec: ModelSpec, counted: DataFrame, features: Sequence[str], weight: F.Column, label: str,
                share: float | None = None) -> DataFrame:
    """Counted rows, assembled and cached, with their weight and ``__draws`` by tree."""
    rows = counted.select(*features, label, COUNT, weight.alias(WEIGHT), F.xxhash64(*features, label, "fold").alias("__row")).sortWithinPartitions("__row")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" if f.name.isidentifier() else f"`{f.name}` {f.dataType.simpleString()}"
                       for f in rows.drop("__row").schema.fields)
    drawn = rows.mapInArrow(_drawn(spec.seed, spec.n_trees, share), f"{fields}, __draws array<double>")
    drawn = persist(VectorAssembler(inputCols=list(features), outputCol=VEC, handleInvalid="error").transform(drawn)
                    .select(VEC, label, WEIGHT, "__draws"))
    drawn.count()
    return drawn


def _fit_forest(spec: ModelSpec, counted: DataFrame, features: Sequence[str], weight: F.Column, label: str):
    """The forest of MLlib's settings on counted rows: every tree weighs a row by its own bootstrap number."""
    drawn = _drawn_rows(spec, counted, features, weight, label)

    def one_tree(t: int):
        sample = drawn.select(VEC, label, (F.col(WEIGHT) * F.col("__draws")[t]).alias(WEIGHT)).where(F.col(WEIGHT) > 0)
        # many trees choose among the square root of the features at each node; a single one would take all
        return RandomForestClassifier(featuresCol=VEC, labelCol=label, weightCol=WEIGHT, numTrees=1, maxDepth=spec.max_depth,
                                      bootstrap=False, featureSubsetStrategy="sqrt", seed=spec.seed + t).fit(sample)

    with ThreadPoolExecutor(max_workers=TREES_AT_ONCE) as pool:
        fitted = list(pool.map(one_tree, range(spec.n_trees)))
    drawn.unpersist()
    return _joined(counted.sparkSession, fitted)


def _joined(spark: SparkSession, forests: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the trees of several."""
    sc = spark.sparkContext
    made = sc._jvm.org.apache.spark.ml.classification
    trees = [t._java_obj for f in forests for t in f.trees]
    array = sc._gateway.new_array(made.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t
    first = forests[0]
    forest = RandomForestClassificationModel(made.RandomForestClassificationModel(
        first.uid, array, first.numFeatures, first.numClasses))
    return first._copyValues(forest, {first.numTrees: len(trees)})


def _fit_boosted(spec: ModelSpec, counted: DataFrame, features: Sequence[str], weight: F.Column, label: str, n: int):
    """MLlib's boosted trees on counted rows: every tree weighs a row by the number of its equal rows that it draws. The
    first fits the classes as -1 and 1, the next ones the pseudo-residuals of the log loss, with the learning rate."""
    drawn = _drawn_rows(spec, counted, features, weight, label, spec.subsample)
    sign = F.lit(2.0) * F.col(label) - F.lit(1.0)
    trees, model = [], None
    for t in range(spec.n_trees):
        if model is None:
            rows, target = drawn, sign
        else:
            rows = _with_cols(model, "__g").transform(drawn)
            target = F.lit(4.0) * sign / (F.lit(1.0) + F.exp(F.lit(2.0) * sign * vector_to_array("__g_raw")[1]))
        sample = rows.select(VEC, target.alias("__residual"), (F.col(WEIGHT) * F.col("__draws")[t]).alias(WEIGHT)).where(F.col(WEIGHT) > 0)
        trees.append(RandomForestRegressor(
            featuresCol=VEC, labelCol="__residual", weightCol=WEIGHT, numTrees=1, maxDepth=spec.max_depth, bootstrap=False,
            featureSubsetStrategy=str(spec.colsample), seed=spec.seed + t).fit(sample))
        model = _estimator(spec, n, label)._copyValues(_summed(counted.sparkSession, trees, spec.learning_rate))
    drawn.unpersist()
    return model


def _summed(spark: SparkSession, trees: list[RandomForestRegressionModel], learning_rate: float) -> GBTClassificationModel:
    """Boosted model of single trees: the first counts in full, the others by the learning rate."""
    sc = spark.sparkContext
    array = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, t in enumerate(trees):
        array[i], weights[i] = t.trees[0]._java_obj, learning_rate if i else 1.0
    first = trees[0]
    return GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        first.uid.replace("RandomForestRegressor", "GBTClassifier"), array, weights, first.numFeatures, 2))


def _weight_for(spec: ModelSpec, target: str, n0: int, n1: int) -> F.Column:
    if spec.kind == "gbt":  # positive-class weight n_neg / n_pos, negatives 1
        return F.when(F.col(target) == 1, F.lit(n0 / max(n1, 1))).otherwise(F.lit(1.0))
    return balanced_weight(target, n0, n1)


def _raw_score(model, kind: str, col: str) -> F.Column:
    """Calibration input: logistic margin for logreg, P(class 1) for trees."""
    if kind == "logreg":
        return vector_to_array(F.col(f"{col}_raw"))[1]
    return vector_to_array(F.col(f"{col}_prob"))[1]


def _with_cols(model, tag: str):
    model = model.copy()
    model.setPredictionCol(f"{tag}_pred").setProbabilityCol(f"{tag}_prob").setRawPredictionCol(f"{tag}_raw")
    return model


@dataclass
class CalibratedModel:
    spec: ModelSpec
    features: list[str]
    bases: list = field(default_factory=list)
    calibrators: list = field(default_factory=list)

    def _assembled(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.features, outputCol=VEC, handleInvalid="error").transform(df)

    def score(self, df: DataFrame, out: str = "pd") -> DataFrame:
        """M7: add ``out`` = mean of the fold-calibrated probabilities (or the base probability
        when not calibrated). One projection chain, no shuffle."""
        cur = self._assembled(df)
        parts = []
        for k, base in enumerate(self.bases):
            tag = f"__m{k}"
            cur = _with_cols(base, tag).transform(cur)
            if self.calibrators:
                cur = cur.withColumn(f"{tag}_x", _raw_score(base, self.spec.kind, tag))
                iso = self.calibrators[k].copy()
                iso.setFeaturesCol(f"{tag}_x").setPredictionCol(f"{tag}_cal")
                cur = iso.transform(cur)
                parts.append(F.col(f"{tag}_cal"))
            else:
                parts.append(vector_to_array(F.col(f"{tag}_prob"))[1])
        score = parts[0]
        for p in parts[1:]:
            score = score + p
        score = score / float(len(parts))
        keep = [c for c in df.columns]
        return cur.select(*keep, score.alias(out))

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """M8: tree importances or |coefficients|, averaged over the fold models, sorted desc."""
        import numpy as np
        vals = []
        for base in self.bases:
            if isinstance(base, LogisticRegressionModel):
                vals.append(np.abs(base.coefficients.toArray()))
            else:
                vals.append(base.featureImportances.toArray())
        imp = np.mean(vals, axis=0)
        rows = [(f, float(v)) for f, v in zip(self.features, imp)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")

    # Each fold's base model and calibrator through MLlib writers, plus the spec.
    def save(self, path: str) -> None:
        for k, (b, c) in enumerate(zip(self.bases, self.calibrators or [None] * len(self.bases))):
            b.write().overwrite().save(f"{path}/fold{k}/base")
            if c is not None:
                c.write().overwrite().save(f"{path}/fold{k}/iso")
        meta = {"spec": asdict(self.spec), "features": self.features, "folds": len(self.bases),
                "calibrated": bool(self.calibrators)}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CalibratedModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        spec = ModelSpec(**meta["spec"])
        loader = {"logreg": LogisticRegressionModel, "rf": RandomForestClassificationModel,
                  "gbt": GBTClassificationModel}[spec.kind]
        bases = [loader.load(f"{path}/fold{k}/base") for k in range(meta["folds"])]
        cals = [IsotonicRegressionModel.load(f"{path}/fold{k}/iso") for k in range(meta["folds"])] if meta["calibrated"] else []
        return cls(spec, meta["features"], bases, cals)


def score_all(df: DataFrame, models: dict[str, CalibratedModel]) -> DataFrame:
    """M7 for several models: a score column by name. Where the rows have up to COUNTED different feature vectors, each
    vector is scored once and the rows look their scores up (broadcast, no shuffle); else every row is scored."""
    def chain(rows: DataFrame) -> DataFrame:
        for name, m in models.items():
            rows = m.score(rows, out=name)
        return rows

    feats = list(dict.fromkeys(f for m in models.values() for f in m.features))
    vectors = reliable_checkpoint(df.select(*feats).distinct().limit(COUNTED + 1))
    if vectors.count() > COUNTED:
        return chain(df)
    scored = reliable_checkpoint(chain(vectors.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))))
    scored = F.broadcast(scored.select(*[F.col(f).alias(f"__of_{i}") for i, f in enumerate(feats)], *models))
    same = [F.col(f).eqNullSafe(F.col(f"__of_{i}")) for i, f in enumerate(feats)]
    return df.join(scored, same, "left").select(*df.columns, *models)


def fit_model(df: DataFrame, features: Sequence[str], target: str, spec: ModelSpec = ModelSpec(),
              calibrate: bool = True, folds: int = 3, keys: Sequence[str] | None = None,
              parallelism: int = 3) -> CalibratedModel:
    """M2-M6: fit the base estimator (and the isotonic fold ensemble when ``calibrate``).

    ``keys`` (a row key) makes the fold assignment reproducible; without it the
    features themselves are hashed."""
    features = list(features)
    label = "__label"
    base = df.select(*(keys or []), *features, F.col(target).cast("double").alias(label))
    base = kfold(base, list(keys or features), folds, spec.seed, target=label) if calibrate else base.withColumn("fold", F.lit(-1))
    # Equal rows become one first: the input is read and encoded once, and the fits share what is left.
    counted = reliable_checkpoint(base.groupBy(*features, label, "fold").agg(F.count(F.lit(1)).alias(COUNT)))
    by_fold = {r["fold"]: r for r in counted.groupBy("fold").agg(
        F.sum(F.when(F.col(label) == 0, F.col(COUNT)).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col(label) == 1, F.col(COUNT)).otherwise(0)).alias("n1"), F.sum(COUNT).alias("n"),
        F.count(F.lit(1)).alias("distinct")).collect()}
    classes = {k: (int(r["n0"]), int(r["n1"])) for k, r in by_fold.items()}
    n0, n1 = (sum(n[c] for n in classes.values()) for c in (0, 1))
    if n0 == 0 or n1 == 0:
        raise ValueError("Target must contain both classes (0 and 1)")
    rows, distinct = (sum(int(r[c]) for r in by_fold.values()) for c in ("n", "distinct"))
    counted = counted.coalesce(max(1, math.ceil(distinct / COUNTED_TASK)))
    by_count = distinct <= COUNTED and distinct * REPEATS <= rows
    trees_by_count = by_count and spec.kind != "logreg"
    if spec.kind != "logreg" and not by_count:
        counted = counted.withColumn(COUNT, F.explode(F.array_repeat(F.lit(1), F.col(COUNT).cast("int"))))
    cached = persist(VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="error").transform(counted)
                     .select(*(features if trees_by_count else []), VEC, label, "fold", COUNT))

    def fit(part: DataFrame, m0: int, m1: int, n: int):
        weight = _weight_for(spec, label, m0, m1)
        if trees_by_count:
            return (_fit_forest(spec, part, features, weight, label) if spec.kind == "rf"
                    else _fit_boosted(spec, part, features, weight, label, n))
        return _estimator(spec, n, label).fit(part.withColumn(WEIGHT, weight * F.col(COUNT)))

    model = CalibratedModel(spec, features)
    if not calibrate:
        model.bases = [fit(cached, n0, n1, n0 + n1)]
        cached.unpersist()
        return model

    def one_fold(k: int):
        # class weights and regularisation follow the classes of the fold's own training rows
        held0, held1 = classes.get(k, (0, 0))
        ho = cached.where(F.col("fold") == k)
        m = fit(cached.where(F.col("fold") != k), max(n0 - held0, 1), max(n1 - held1, 1), n0 + n1 - held0 - held1)
        tag = "__c"
        scored = _with_cols(m, tag).transform(ho).withColumn("__x", _raw_score(m, spec.kind, tag))
        return m, isotonic.fit(scored, "__x", label, weight=COUNT)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, folds))) as pool:
        fitted = list(pool.map(one_fold, range(folds)))
    model.bases = [m for m, _ in fitted]
    model.calibrators = [c for _, c in fitted]
    cached.unpersist()
    return model


def out_of_fold_scores(df: DataFrame, features: Sequence[str], target: str, spec: ModelSpec, folds: int = 5,
                       keys: Sequence[str] | None = None, calibrate: bool = False, out: str = "oof") -> DataFrame:
    """M12 core: each row scored by the model fitted without its fold (union of fold predictions)."""
    k_cols = list(keys or features)
    lab = kfold(df, k_cols, folds, spec.seed + 1, target=target, out="cv_fold")
    lab = persist(lab)

    def fold_fit(k: int):  # independent Spark jobs, run concurrently from driver threads
        return fit_model(lab.where(F.col("cv_fold") != k), features, target, spec, calibrate=calibrate, keys=keys,
                         parallelism=1)

    with ThreadPoolExecutor(max_workers=min(folds, 4)) as pool:
        fitted = list(pool.map(fold_fit, range(folds)))
    parts = [m.score(lab.where(F.col("cv_fold") == k), out=out) for k, m in enumerate(fitted)]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def evaluate_cv(df: DataFrame, features: Sequence[str], target: str, spec: ModelSpec, folds: int = 5,
                keys: Sequence[str] | None = None) -> DataFrame:
    """All metrics on out-of-fold predictions, plus fold AUC mean and population std;
    brier_mean = OOF Brier and brier_std = 0 (as in the reference)."""
    from riskframe.operators.curves import ranking_metrics
    from riskframe.operators.metrics import evaluate_all
    oof = persist(out_of_fold_scores(df, features, target, spec, folds, keys))
    allm = evaluate_all(oof, target, "oof")
    per_fold = ranking_metrics(oof, target, "oof", by=["cv_fold"])
    fstats = per_fold.agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std")).withColumn("_k", F.lit(1))
    return (allm.withColumn("_k", F.lit(1)).join(fstats, on="_k").drop("_k")
            .withColumn("brier_mean", F.col("brier")).withColumn("brier_std", F.lit(0.0)))


def pick_best(metrics: DataFrame, model_col: str = "model", order: Sequence[str] | None = None,
              ece_penalty: float = 2.0) -> DataFrame:
    """Highest auc - 2 * ece; ties go to the earlier model in ``order``."""
    score = F.col("auc") - F.lit(ece_penalty) * F.col("ece")
    m = metrics.withColumn("selection_score", score)
    if order:
        pos = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(model_col))
        m = m.withColumn("_pos", pos)
    else:
        m = m.withColumn("_pos", F.lit(0))
    return m.orderBy(F.col("selection_score").desc(), F.col("_pos")).limit(1).drop("_pos")
