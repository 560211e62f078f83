from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltwatch.plans import evaluation as E
from siltwatch.plans import models as M
from siltwatch.plans import rollups
from siltwatch.plans import training as TR
from siltwatch.plans.dashboards import detector_outputs, granularity, listed_domains
from siltwatch.plans.latency import server_log_states

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("name,want", [("a b-c", "a_b_c"), ("x(y)%", "xy"), ("2nd col", "f_2nd_col"), ("ok_1", "ok_1")])
def test_clean_names(name, want):
    assert TR.clean_name(name) == want


def test_preprocess_by_hand(spark):
    df = spark.createDataFrame([("", "x"), ("one", "x"), ("a.b", "z"), ("a.b", "y"), ("a.b.c.d", "x")], "query string, class string")
    rows = {r.query: r for r in TR.preprocess(df).collect()}
    assert set(rows) == {"a.b", "a.b.c.d"}
    assert (rows["a.b"].secondleveldomain, rows["a.b"].thirdleveldomain, rows["a.b"]["class"]) == ("a", "", "y")
    assert (rows["a.b.c.d"].secondleveldomain, rows["a.b.c.d"].thirdleveldomain, rows["a.b.c.d"].tld) == ("c", "a.b", "d")
    assert TR.preprocess(df, keep_all=True).count() == 3


def test_splits_are_stratified_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("query"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("class"))
    first = TR.stratified_split(df, "query", "class", sample=0.5)
    sizes = {(r["class"], r.split): r["count"] for r in first.groupBy("class", "split").count().collect()}
    assert sizes == {("a", "train"): 360, ("a", "val"): 45, ("a", "test"): 45, ("b", "train"): 40, ("b", "val"): 5, ("b", "test"): 5}
    again = TR.stratified_split(df.repartition(7), "query", "class", sample=0.5)
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_metrics_without_alarms(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, y_pred int")
    row = E.discovery_metrics(df).first()
    assert (row.fdr, row.fttar, row.fn) == (0.0, 0.0, 1)
    report = {r["class"]: r for r in E.classification_report(df).collect()}
    assert (report[1].precision, report[1].recall, report[1].f1) == (0.0, 0.0, 0.0)
    assert M.DiscoveryEvaluator().evaluate(df.select(F.col("y").alias("label"), F.col("y_pred").alias("prediction"))) == 1.0


def test_distances_by_hand(spark):
    rows = [(True, 1.0), (True, 2.0), (True, float("inf")), (False, 2.0), (False, 4.0), (False, float("nan")), (False, None)]
    df = spark.createDataFrame(rows, "s boolean, x double")
    long = E.long_form(df, F.col("s"), ["x"])
    row = E.distribution_distances(long, None).first()
    assert (row.ks_statistic, row.n_condition1, row.n_condition2) == (0.5, 2, 2)
    assert row.emd == pytest.approx(1.5)
    assert 0 < row.ks_p_value <= 1


def labelled(spark, n=200):
    made = [(f"{'good' if i % 2 else 'x7q9z'}{i}{'' if i % 2 else 'kq8w2'}.com", "legit" if i % 2 else "dga") for i in range(n)]
    return spark.createDataFrame(made, "query string, class string")


def test_models_score_save_and_verify(spark, tmp_path):
    data = labelled(spark)
    model = M.fit_domain_model(data, trees=5, depth=3)
    lines = data.select(F.col("query").alias("domain_name"), "class")
    mean = {r["class"]: r.p for r in M.score_lines(lines, model).groupBy("class").agg(F.avg("probability").alias("p")).collect()}
    assert mean["dga"] > 0.8 > 0.2 > mean["legit"]
    root = str(tmp_path / "models")
    version = M.save_version(spark, model, root, "rf")
    again = M.load_version(spark, root, "rf", version)
    assert M.score_lines(lines, again).exceptAll(M.score_lines(lines, model)).isEmpty()
    part = next(p for p in (tmp_path / "models" / "rf" / "files").rglob("part-*") if "metadata" in str(p))
    part.write_text(part.read_text() + "\n{}")
    crc = part.with_name(f".{part.name}.crc")
    if crc.exists():
        crc.unlink()
    with pytest.raises(M.WrongChecksum):
        M.load_version(spark, root, "rf", version)


@pytest.mark.parametrize("name", ["rf", "gbm"])
def test_rules_hold_on_their_rows(spark, name):
    rows = M.training_rows(labelled(spark))
    model = M.model_pipeline(M.classifier(name, trees=3, depth=2)).fit(rows)
    rules = M.tree_rules(model)
    scored = M.score_rules(rows, rules).collect()
    assert rules and scored and max(r.precision for r in scored) > 0.9
    with pytest.raises(NotImplementedError):
        M.classifier("other")


def test_random_settings_stay_in_range():
    estimator = M.classifier("gbm")
    grid = M.random_grid(estimator, M.GBT_SPACE, 5)
    assert len(grid) == 5
    for setting in grid:
        for param, value in setting.items():
            low, high = M.GBT_SPACE[param.name]
            assert low <= value <= high


def test_removed_component_leaves_no_variance_along_it(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i + (i % 3)) for i in range(30)], "id int, a double, b double")
    model, _ = M.components(df, 1, ("a", "b"))
    d = model.pc.toArray()[:, 0]
    out = M.without_component(df, 0, ["id"], ("a", "b")).collect()
    along = [r["values"][0] * d[0] + r["values"][1] * d[1] for r in out]
    assert max(along) - min(along) < 1e-9
    share = M.explained_variance(df, 2, ("a", "b")).agg(F.sum("share")).first()[0]
    assert share == pytest.approx(1.0)


def test_sketch_states_merge_to_the_exact_median(spark):
    df = spark.range(100).select((F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).alias("timestamp"), F.lit("s").alias("stage"),
                                 F.lit("e").alias("entry_type"), F.col("id").alias("entry_count"))
    merged = rollups.finish_fill_states(rollups.merge_fill_states(rollups.fill_state(df, 1), 60)).first()
    assert (merged.min_count, merged.max_count, merged.avg_count) == (0, 99, 49.5)
    assert abs(merged.median_count - 49.5) <= 1
    assert rollups.backfill_rows(df, df, "timestamp", T0, 1) is None
    assert rollups.coarser_alerts(spark.createDataFrame([(T0, "a", 2), (T0 + dt.timedelta(minutes=1), "a", 3)], "time_bucket timestamp, src_ip string, alert_count bigint"), 60).first().alert_count == 5


def test_start_is_not_lost_when_sides_merge(spark):
    logs = spark.createDataFrame([("m", T0)], "message_id string, timestamp_in timestamp")
    outs = spark.createDataFrame([("m", "timestamp_out", T0 + dt.timedelta(seconds=1)), ("m", "x", T0 + dt.timedelta(seconds=9))], "message_id string, event string, event_timestamp timestamp")
    row = server_log_states(logs, outs).first()
    assert (row.end_timestamp - row.start_timestamp).total_seconds() == 1


@pytest.mark.parametrize("span,want", [(dict(minutes=5), "second"), (dict(minutes=6), "minute"), (dict(hours=6), "minute"), (dict(hours=7), "hour"), (dict(hours=72), "hour"), (dict(hours=73), "day")])
def test_granularity(span, want):
    assert granularity(T0, T0 + dt.timedelta(**span)) == want


def test_alert_json_shapes(spark):
    texts = ['["a.com", {"domain_name": "b.com"}, ["c.com", {"domain_name": "a.com"}], ""]', "[]", "nonsense", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", listed_domains(F.col("t"))).orderBy("i").collect()]
    assert got == [["a.com", "b.com", "c.com"], [], [], []]


def test_detector_outputs_fall_back(spark):
    result = '[{"detector_name":"","name":"n","score":0.51239,"attributes":[{"a":1}],"raw_detector_output":{"k":1}},{"class_probabilities":[1]}]'
    df = spark.createDataFrame([("1.1.1.1", T0, "b", 0.5, "[]", result)], "src_ip string, alert_timestamp timestamp, suspicious_batch_id string, overall_score double, domain_names string, result string")
    rows = detector_outputs(df, T0, T0).collect()
    assert (rows[0].detector_name, rows[0].score, rows[0].class_output, rows[0].raw_detector_output) == ("n", 0.5124, '[{"a":1}]', '{"k":1}')
    assert (rows[1].detector_name, rows[1].score, rows[1].class_output) == ("", 0.0, "[1]")
    assert rows[1].raw_detector_output == '{"class_probabilities":[1]}'


@pytest.mark.parametrize("slots", [2, 7, 4096])
def test_slots_do_not_change_distances(spark, slots):
    df = spark.range(400).select((F.col("id") % 3 == 0).alias("s"), (F.pow(F.col("id") % 97, F.lit(2)) + F.col("id") % 5).alias("x"))
    long = E.long_form(df, F.col("s"), ["x"])
    got = E.distribution_distances(long, None, slots=slots).first()
    rows = [(r.s, r.x) for r in df.collect()]
    a, b = sorted(x for s, x in rows if s), sorted(x for s, x in rows if not s)
    grid = sorted(set(a + b))
    gaps = [abs(sum(v <= g for v in a) / len(a) - sum(v <= g for v in b) / len(b)) for g in grid]
    assert got.ks_statistic == pytest.approx(max(gaps))
    assert got.emd == pytest.approx(sum(g * (hi - lo) for g, lo, hi in zip(gaps, grid, grid[1:])))


def test_halving_search_judges_survivors_on_every_fold(spark):
    rows = spark.createDataFrame([(f"q{i}{'.' * (i % 3)}", "legit" if i % 2 else "dga") for i in range(40)], "query string, class string")
    rows = M.training_rows(rows.withColumn("query", F.concat(F.when(F.col("class") == "legit", "www.shop").otherwise("x7f3k9q2z8"), "query", F.lit(".com"))))
    found = M.halving_search(rows, "rf", trials=6, folds=3, space={"numTrees": (2, 4), "maxDepth": (1, 3)}, keep=2)
    seen = sorted(n for _, n, _ in found.trials)
    assert seen == [1, 1, 1, 2, 3, 3]
    assert found.best in [s for s, n, _ in found.trials if n == 3]
    assert found.bestModel.transform(rows).filter("prediction = label").count() >= 36
    short = M.halving_search(rows, "rf", trials=4, folds=3, space={"numTrees": (2, 3)}, seconds=0, parallelism=1)
    assert max(n for _, n, _ in short.trials) == 1 and short.best in [s for s, n, _ in short.trials if n == 1]
