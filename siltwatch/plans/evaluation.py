"""Evaluation of predictions and distribution distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.plans.quantiles import borders, described, slot_of
from siltwatch.sources.staging import small_side, staged


def _counts() -> list[Column]:
    y, p = F.col("y"), F.col("y_pred")
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def discovery_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False discovery rate and false-to-true-alarm ratio, 0 where undefined."""
    counts = pairs.groupBy(*by).agg(*_counts())
    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        _ratio(F.col("fp"), F.col("fp") + F.col("tp")).alias("fdr"),
        _ratio(F.col("fp"), F.col("tp")).alias("fttar"),
    )


def classification_report(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per true class.

    Each row is counted once as truth and once as prediction; one aggregation
    serves every class.
    """
    roles = F.explode(
        F.array(
            F.struct(F.col("y").alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"), (F.col("y") == F.col("y_pred")).cast("int").alias("hit")),
            F.struct(F.col("y_pred").alias("class"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("hit")),
        )
    ).alias("r")
    sums = pairs.select(*by, roles).groupBy(*by, F.col("r.class").alias("class")).agg(
        F.sum("r.t").alias("support"), F.sum("r.p").alias("predicted"), F.sum("r.hit").alias("hit")
    )
    precision, recall = _ratio(F.col("hit"), F.col("predicted")), _ratio(F.col("hit"), F.col("support"))
    return (
        sums.filter("support > 0")
        .withColumns({"precision": precision, "recall": recall})
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .select(*by, "class", "precision", "recall", "f1", "support")
    )


def mispredictions(pairs: DataFrame) -> DataFrame:
    """Rows whose prediction differs from the truth."""
    return pairs.filter(F.col("y") != F.col("y_pred"))


def mispredicted_classes(dataset: DataFrame, wrong: DataFrame, key: str = "query") -> DataFrame:
    """True classes of the mispredicted queries."""
    return dataset.join(wrong.select(key), key, "left_semi").select("class").distinct()


def label_distribution(df: DataFrame, column: str = "class") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def long_form(df: DataFrame, side: Column, features: Sequence[str]) -> DataFrame:
    """(feature, side, value) rows; infinities and missing values leave."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]))
    rows = df.select(side.alias("side"), cells.alias("c")).select("side", "c.feature", "c.value")
    v = F.col("value")
    return rows.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))


def without_outliers(rows: DataFrame, percentile: float = 0.99) -> DataFrame:
    """Values up to the exact percentile of their feature and side."""
    found = described(rows, ("feature", "side"), "value", [percentile])
    cuts = small_side(found.select("feature", "side", F.col("q")[0].alias("cut")), "cuts")
    return rows.join(cuts, ["feature", "side"]).filter(F.col("value") <= F.col("cut")).drop("cut")


def distribution_distances(rows: DataFrame, percentile: float | None = 0.99, slots: int = 256) -> DataFrame:
    """Kolmogorov-Smirnov statistic, its asymptotic p-value, and earth mover's distance.

    ``side`` is true or false. Equal values are counted before anything is
    ordered, and a feature's values are cut into slots of about as many values
    each, whose sums are chained; so they never all meet in one task.
    """
    kept = without_outliers(rows, percentile) if percentile is not None else rows
    hit = F.col("side").cast("boolean")
    points = kept.groupBy("feature", "value").agg(F.count_if(hit).alias("n1"), F.count_if(~hit).alias("n2"))
    points = staged(points, "points")
    sizes = points.groupBy("feature").agg(F.sum("n1").alias("size1"), F.sum("n2").alias("size2")).filter("size1 > 0 AND size2 > 0")
    cuts = borders(points.withColumnRenamed("value", "v"), ["feature"], slots)
    both = small_side(sizes.join(cuts, "feature"), "sizes")
    slotted = points.join(both, "feature").withColumn("slot", slot_of(F.col("value"), F.col("cuts"))).drop("cuts")
    by_slot = slotted.groupBy("feature", "slot").agg(F.sum("n1").alias("m1"), F.sum("n2").alias("m2"), F.min("value").alias("first"))
    slot_order = Window.partitionBy("feature").orderBy("slot")
    before = slot_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = by_slot.select(
        "feature",
        "slot",
        F.coalesce(F.sum("m1").over(before), F.lit(0)).alias("s1"),
        F.coalesce(F.sum("m2").over(before), F.lit(0)).alias("s2"),
        F.lead("first").over(slot_order).alias("next_first"),
    )
    along = Window.partitionBy("feature", "slot").orderBy("value")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    running = slotted.select(
        "feature", "slot", "size1", "size2", "value",
        F.sum("n1").over(upto).alias("c1"),
        F.sum("n2").over(upto).alias("c2"),
        F.lead("value").over(along).alias("next"),
    ).join(starts, ["feature", "slot"])
    gap = F.abs((F.col("s1") + F.col("c1")) / F.col("size1") - (F.col("s2") + F.col("c2")) / F.col("size2"))
    width = F.coalesce(F.col("next"), F.col("next_first")) - F.col("value")
    found = running.groupBy("feature", "size1", "size2").agg(
        F.max(gap).alias("ks_statistic"), F.sum(gap * F.coalesce(width, F.lit(0.0))).alias("emd")
    )
    effective = F.sqrt(F.col("size1") * F.col("size2") / (F.col("size1") + F.col("size2")))
    return found.select(
        "feature", "ks_statistic", _ks_p_value(F.col("ks_statistic") * effective).alias("ks_p_value"), "emd",
        F.col("size1").alias("n_condition1"), F.col("size2").alias("n_condition2"),
    )


def _ks_p_value(x: Column, terms: int = 100) -> Column:
    """Tail of the Kolmogorov distribution; 1 where the series does not converge."""
    k = F.sequence(F.lit(1), F.lit(terms))
    sign = lambda i: F.when(i % 2 == 1, 1.0).otherwise(-1.0)
    total = F.aggregate(F.transform(k, lambda i: sign(i) * F.exp(-2.0 * i * i * x * x)), F.lit(0.0), lambda a, b: a + b)
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))
