"""Detection models: fitting, search, scoring, components, rules and versions."""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.functions.domains import FEATURES, feature_columns, with_domain_parts
from siltwatch.plans.training import SEED, balanced_weights, binary_label, preprocess
from siltwatch.sources.staging import staged

# Model names a configuration may use.
MODEL_NAMES = ("rf", "xg", "gbm")


def training_rows(labelled: DataFrame) -> DataFrame:
    """Features, binary label and balanced weight of labelled domains."""
    parts = with_domain_parts(preprocess(labelled).select("query", "class"), "query")
    features = parts.select("query", binary_label(F.col("class")).alias("label"), *feature_columns("query"))
    return balanced_weights(features, "label")


def scoring_rows(lines: DataFrame, name: str = "domain_name") -> DataFrame:
    return with_domain_parts(lines, name).select(*lines.columns, *feature_columns(name))


def classifier(model: str, trees: int = 50, depth: int = 5, seed: int = SEED):
    """MLlib estimator for a configured model name; both boosted names map to GBT."""
    common = {"featuresCol": "scaled", "labelCol": "label", "weightCol": "weight", "seed": seed}
    if model == "rf":
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, **common)
    if model in ("xg", "gbm"):
        return GBTClassifier(maxIter=trees, maxDepth=depth, **common)
    raise NotImplementedError(f"model {model!r}; known: {MODEL_NAMES}")


def model_pipeline(estimator) -> Pipeline:
    """Assemble, standardise and classify; the scaler is applied in training and scoring."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
            estimator,
        ]
    )


def fit_domain_model(labelled: DataFrame, model: str = "rf", trees: int = 50, depth: int = 5) -> PipelineModel:
    return model_pipeline(classifier(model, trees, depth)).fit(training_rows(labelled))


def positive_probability(column: str = "probability") -> Column:
    return F.element_at(vector_to_array(column), 2)


def score_lines(lines: DataFrame, model: PipelineModel, name: str = "domain_name") -> DataFrame:
    """Add the probability of class 1 to every line."""
    scored = model.transform(scoring_rows(lines, name))
    return scored.withColumn("probability", positive_probability()).select(*lines.columns, "probability")


class DiscoveryEvaluator(Evaluator):
    """1 - false discovery rate, larger is better; computed in one aggregation."""

    def _evaluate(self, dataset: DataFrame) -> float:
        hit = F.col("prediction") == 1
        row = dataset.agg(
            F.count_if(hit & (F.col("label") == 1)).alias("tp"), F.count_if(hit & (F.col("label") == 0)).alias("fp")
        ).first()
        return 1.0 if row.tp + row.fp == 0 else row.tp / (row.tp + row.fp)

    def isLargerBetter(self) -> bool:  # noqa: N802  (name set by MLlib)
        return True


# Search ranges.
RF_SPACE = {"numTrees": (50, 300), "maxDepth": (2, 20), "minInstancesPerNode": (1, 20)}
GBT_SPACE = {"maxIter": (100, 1000), "maxDepth": (3, 12), "stepSize": (1e-3, 0.2)}


def random_grid(estimator, space: dict, trials: int, seed: int = SEED) -> list:
    """Seeded random settings; a range below 1 is drawn on a log scale."""
    rng = random.Random(seed)
    grids = []
    for _ in range(trials):
        builder = ParamGridBuilder()
        for name, (low, high) in space.items():
            if isinstance(low, int):
                value = rng.randint(low, high)
            else:
                value = math.exp(rng.uniform(math.log(low), math.log(high)))
            builder = builder.addGrid(estimator.getParam(name), [value])
        grids += builder.build()
    return grids


def search(
    rows: DataFrame, model: str = "rf", trials: int = 50, folds: int = 5, space: dict | None = None, parallelism: int = 4
):
    """Cross-validated random search; with one fold a single split is used."""
    estimator = classifier(model)
    grid = random_grid(estimator, space or (RF_SPACE if model == "rf" else GBT_SPACE), trials)
    shared = {
        "estimator": model_pipeline(estimator), "estimatorParamMaps": grid,
        "evaluator": DiscoveryEvaluator(), "parallelism": parallelism, "seed": SEED,
    }
    if folds > 1:
        return CrossValidator(numFolds=folds, **shared).fit(rows)
    return TrainValidationSplit(trainRatio=0.8, **shared).fit(rows)


@dataclass
class Searched:
    """Outcome of a search: the best model, its settings, and (settings, folds seen, mean score) of every trial."""

    bestModel: PipelineModel  # noqa: N815  (as MLlib names it)
    best: dict
    trials: list[tuple[dict, int, float]]


def halving_search(
    rows: DataFrame,
    model: str = "rf",
    trials: int = 50,
    folds: int = 5,
    space: dict | None = None,
    parallelism: int = 8,
    seconds: float = 600,
    keep: int = 3,
    key: str = "query",
) -> Searched:
    """Random search by successive halving over cross-validation folds.

    All trials are judged on the first fold, the best ``1 / keep`` of them on the next
    ones, and so on; those that remain have seen every fold. After ``seconds`` no fit is
    started any more, and the best trial of those that saw most folds counts. Features
    are scaled once per fold, on its training part.
    """
    estimator, evaluator = classifier(model), DiscoveryEvaluator()
    grid = random_grid(estimator, space or (RF_SPACE if model == "rf" else GBT_SPACE), trials)
    placed = staged(rows.withColumn("_fold", F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(folds))), "search-rows")
    prepare = Pipeline(stages=model_pipeline(estimator).getStages()[:-1])
    ready: dict[int, tuple[DataFrame, DataFrame]] = {}

    def fold(k: int) -> tuple[DataFrame, DataFrame]:
        if k not in ready:
            train, test = placed.where(F.col("_fold") != k), placed.where(F.col("_fold") == k)
            fitted = prepare.fit(train)
            columns = ["scaled", "label", "weight"]
            ready[k] = tuple(staged(fitted.transform(part).select(*columns), f"fold-{k}") for part in (train, test))
        return ready[k]

    ends, scores, alive = time.monotonic() + seconds, [[] for _ in grid], list(range(len(grid)))

    def judge(job: tuple[int, int]) -> tuple[int, float] | None:
        trial, k = job
        if time.monotonic() > ends and any(scores):
            return None
        train, test = ready[k]
        return trial, evaluator.evaluate(estimator.fit(train, grid[trial]).transform(test))

    steps, done = [1, *range(min(2, folds), folds, 2), folds], 0
    with ThreadPool(parallelism) as pool:
        for step, upto in enumerate(steps):
            for k in range(done, upto):
                fold(k)
                for found in pool.map(judge, [(t, k) for t in alive], chunksize=1):
                    if found:
                        scores[found[0]].append(found[1])
            done = upto
            if time.monotonic() > ends:
                break
            if step < len(steps) - 1:
                alive = sorted(alive, key=lambda t: -_mean(scores[t]))[: max(1, -(-len(alive) // keep))]
    settings = [{p.name: v for p, v in g.items()} for g in grid]
    first = max(range(len(grid)), key=lambda t: (len(scores[t]), _mean(scores[t]), -t))
    best = model_pipeline(estimator.copy(grid[first])).fit(rows)
    return Searched(best, settings[first], [(s, len(x), _mean(x)) for s, x in zip(settings, scores, strict=True)])


def _mean(values: Sequence[float]) -> float:
    return sum(values) / len(values) if values else 0.0


def components(rows: DataFrame, k: int, columns: Sequence[str] = tuple(FEATURES)):
    """Fitted principal components of the features."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)
    return PCA(k=k, inputCol="features", outputCol="pca").fit(assembled), assembled


def _mean_array(rows: DataFrame, columns: Sequence[str]) -> Column:
    means = rows.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return F.array(*[F.lit(float(means[c])) for c in columns])


def _dot(values: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(values, weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)


def _vector_literal(model, component: int) -> Column:
    matrix = model.pc.toArray()
    return F.array(*[F.lit(float(v)) for v in matrix[:, component]])


def project(rows: DataFrame, k: int, keep: Sequence[str], columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Coordinates of every row on the first ``k`` components, rows centred first."""
    model, _ = components(rows, k, columns)
    centred = F.zip_with(F.array(*columns), _mean_array(rows, columns), lambda x, m: x - m)
    placed = rows.select(*keep, centred.alias("_c"))
    return placed.select(*keep, *[_dot(F.col("_c"), _vector_literal(model, i)).alias(f"pc{i + 1}") for i in range(k)])


def explained_variance(rows: DataFrame, k: int, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Share of variance per component."""
    model, _ = components(rows, k, columns)
    shares = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return rows.sparkSession.createDataFrame(shares, "component int, share double")


def without_component(rows: DataFrame, component: int, keep: Sequence[str], columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Rows minus their (centred) projection on one component."""
    model, _ = components(rows, component + 1, columns)
    direction = _vector_literal(model, component)
    values = F.array(*columns)
    centred = F.zip_with(values, _mean_array(rows, columns), lambda x, m: x - m)
    part = rows.select(*keep, values.alias("_x"), _dot(centred, direction).alias("_t"))
    removed = F.zip_with("_x", direction, lambda x, d: x - F.col("_t") * d)
    return part.select(*keep, removed.alias("values"))


def tree_rules(model: PipelineModel, columns: Sequence[str] = tuple(FEATURES)) -> list[dict]:
    """Readable positive rules of a forest or of boosted trees, thresholds in original units.

    Trees are small and already on the driver; only the rules' scores touch data.
    """
    scaler = next(s for s in model.stages if s.__class__.__name__ == "StandardScalerModel")
    forest = model.stages[-1]
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    seen: dict[tuple, dict] = {}
    for tree in forest.trees:
        rows = tree._call_java("toDebugString")
        for conditions in _debug_paths(rows):
            plain = tuple(
                (columns[f], op, round(float(v * std[f] + mean[f]), 3)) for f, op, v in conditions
            )
            seen.setdefault(plain, {"conditions": plain, "rule": " and ".join(f"{n} {op} {v}" for n, op, v in plain)})
    return list(seen.values())


def _debug_paths(text: str) -> list[list[tuple[int, str, float]]]:
    """Conditions of every leaf that speaks for class 1 (a vote of 1, or a positive step of a boosted tree)."""
    found, stack = [], []
    for line in text.splitlines()[1:]:
        depth = len(line) - len(line.lstrip())
        body = line.strip()
        if body.startswith("Predict:"):
            if float(body.split(":")[1]) > 0:
                found.append([c for d, c in stack if d < depth])
            continue
        words = body.split("(feature ")[1].rstrip(")").split()
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(words[0]), words[1], float(words[2]))))
    return [c for c in found if c]


def score_rules(rows: DataFrame, rules: Sequence[dict], label: str = "label") -> DataFrame:
    """Support and precision of every rule over labelled rows, in one pass."""
    listed = list(rules)
    if not listed:
        return rows.sparkSession.createDataFrame([], "rule string, support bigint, precision double")

    def holds(rule):
        test = F.lit(True)
        for name, op, value in rule["conditions"]:
            test = test & ((F.col(name) <= value) if op == "<=" else (F.col(name) > value))
        return test

    fired = F.array_compact(F.array(*[F.when(holds(r), F.lit(r["rule"])) for r in listed]))
    hits = rows.select(F.explode(fired).alias("rule"), F.col(label).alias("y"))
    return hits.groupBy("rule").agg(
        F.count(F.lit(1)).alias("support"), F.avg(F.col("y").cast("double")).alias("precision")
    )


class WrongChecksum(ValueError):
    """Saved model files do not match their version."""


def _digest(spark: SparkSession, path: str) -> str:
    """SHA-256 over the contents of a saved model's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    hashes = files.filter(~F.col("path").rlike(r"_SUCCESS$|\.crc$")).select(F.sha2("content", 256).alias("h"))
    return hashlib.sha256("\n".join(sorted(r.h for r in hashes.collect())).encode()).hexdigest()


def save_version(spark: SparkSession, model: PipelineModel, root: str, name: str) -> str:
    """Save a model and file it under its content digest, which is returned."""
    files = f"{root}/{name}/files/{uuid.uuid4().hex}"
    model.write().save(files)
    version = _digest(spark, files)
    manifest = json.dumps({"name": name, "version": version, "files": files})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{root}/{name}/{version}")
    return version


def load_version(spark: SparkSession, root: str, name: str, version: str) -> PipelineModel:
    """Load a version after checking its files against the digest."""
    files = json.loads(spark.read.text(f"{root}/{name}/{version}").first()[0])["files"]
    if _digest(spark, files) != version:
        raise WrongChecksum(f"{files} does not match version {version}")
    return PipelineModel.load(files)
