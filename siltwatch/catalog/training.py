"""Queries: training data, models and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltwatch.catalog.registry import query
from siltwatch.catalog.views import COMMON, DNS, TUNNEL, entropy, with_
from siltwatch.functions.domains import FEATURES, LETTERS, LEVELS, ENTROPY_LEVELS, feature_columns
from siltwatch.functions.similarity import METRICS
from siltwatch.plans import evaluation as E
from siltwatch.plans import models as M
from siltwatch.plans import training as TR
from siltwatch.sources import testbed as tb

LABELLED = """
labelled AS (
  SELECT query, CASE WHEN len(string_split(query, '.')) = 2 THEN 'legit' ELSE 'family_' || CAST(first_page % 3 AS VARCHAR) END AS class
  FROM (SELECT replace(regexp_extract(url, '://([^/?#:]+)', 1), '.example.', '.') AS query, min(page_id) AS first_page FROM pages GROUP BY 1)
)"""
# Line level rows of the same shape: one per log line.
LINES = DNS + """,
rows AS (SELECT logline_id, ts, src_ip AS user, domain_name AS query, CASE WHEN len(string_split(domain_name, '.')) = 2 THEN 'legit' ELSE 'malicious' END AS class FROM dns_log)"""


def parts_sql(source, extra=""):
    return f"""
parts AS (
  SELECT *, labels[-1] AS tld, query AS fqdn, CASE WHEN len(labels) = 2 THEN labels[1] ELSE labels[-2] END AS secondleveldomain,
    CASE WHEN len(labels) = 2 THEN '' ELSE array_to_string(labels[1:len(labels) - 2], '.') END AS thirdleveldomain
  FROM (SELECT *, string_split(query, '.') AS labels FROM {source} WHERE length(query) > 0 {extra}) WHERE len(labels) <> 1
)"""


_PARTS = "query, class, tld, fqdn, secondleveldomain, thirdleveldomain"


@query(
    "i1_preprocess",
    with_(LINES, "firsts AS (SELECT query, min(class) AS class FROM rows GROUP BY query)", parts_sql("firsts")) + f" SELECT {_PARTS} FROM parts",
)
def preprocess(spark, sf):
    """Distinct queries of all lines with their parts."""
    rows = tb.user_domain_lines(spark, sf).select("query", "class")
    return TR.preprocess(rows).select(*_PARTS.split(", "))


@query("i1_preprocess_keep_all", with_(LINES, parts_sql("rows")) + f" SELECT logline_id, {_PARTS} FROM parts")
def preprocess_all(spark, sf):
    rows = tb.user_domain_lines(spark, sf).select("logline_id", "query", "class")
    return TR.preprocess(rows, keep_all=True).select("logline_id", *_PARTS.split(", "))


def _share(count, text):
    return f"CASE WHEN length({text}) > 0 THEN ({count}) / length({text})::DOUBLE ELSE 0.0 END"


_SIGN = {"alpha": "[a-zA-Z]", "numeric": "[0-9]", "special": r"[^A-Za-z0-9_\s]"}
_TRAIN = {
    "label_length": "len(labels)::DOUBLE",
    "label_max": "length(list_aggregate(labels, 'max'))::DOUBLE",
    "label_average": "length(trim(query, '.'))::DOUBLE",
    **{f"freq_{c}": _share(f"length(query) - length(replace(lower(query), '{c}', ''))", "query") for c in LETTERS},
}
for _level in LEVELS:
    _TRAIN[f"{_level}_full_count"] = f"CASE WHEN length({_level}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    for _kind, _p in _SIGN.items():
        _TRAIN[f"{_level}_{_kind}_count"] = _share(f"length({_level}) - length(regexp_replace({_level}, '{_p}', '', 'g'))", _level)
for _level in ENTROPY_LEVELS:
    _TRAIN[f"{_level}_entropy"] = entropy(_level)


@query(
    "i2_training_features",
    with_(LABELLED, parts_sql("labelled")) + " SELECT query, class, " + ", ".join(f"round({v}, 9)::DOUBLE AS {k}" for k, v in _TRAIN.items()) + " FROM parts",
)
def training_features(spark, sf):
    """The training form of all 44 features."""
    rows = TR.preprocess(tb.labelled_domains(spark, sf).select("query", "class"))
    made = rows.select("query", "class", *feature_columns("query", "train"))
    return made.select("query", "class", *[F.round(c, 9).alias(c) for c in FEATURES])


def training_windows(spark, sf):
    rows = TR.preprocess(tb.user_domain_lines(spark, sf), keep_all=True)
    return TR.training_windows(rows)


_CHUNKS = """,
domains AS (SELECT *, secondleveldomain || '.' || tld AS domain FROM parts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user, domain ORDER BY ts, logline_id) AS rn FROM domains),
classes AS (SELECT domain, min(class) AS class FROM domains GROUP BY 1),
chunks AS (
  SELECT user, domain, CAST((rn - 1) // 10 AS BIGINT) AS window_no, list(thirdleveldomain ORDER BY rn) AS subs FROM ranked GROUP BY 1, 2, 3 HAVING count(*) > 3
)"""


@query(
    "i3_training_windows",
    with_(LINES, parts_sql("rows")) + _CHUNKS + """ SELECT user, c.domain, window_no, k.class, array_to_string(subs, ',') AS subdomains
FROM chunks c JOIN classes k ON c.domain = k.domain""",
)
def windows(spark, sf):
    return training_windows(spark, sf).select("user", "domain", "window_no", "class", F.array_join("subdomains", ",").alias("subdomains"))


_WINDOWS = """, windows AS (
  SELECT user || '|' || c.domain || '|' || window_no AS logline_id, subs, c.domain, k.class, window_no FROM chunks c JOIN classes k ON c.domain = k.domain),
""" + TUNNEL[TUNNEL.index("places AS") : TUNNEL.index(",\nwindow_scores AS")] + "," + COMMON


@query(
    "i3_window_features",
    with_(LINES, parts_sql("rows")) + _CHUNKS + _WINDOWS + " SELECT w.domain AS query, w.class, w.window_no, "
    + ", ".join(f"round({m}, 8) AS {m}" for m in METRICS)
    + " FROM windows w JOIN window_jaro j ON w.logline_id = j.logline_id JOIN window_common c ON w.logline_id = c.logline_id",
)
def window_features(spark, sf):
    scored = TR.tunnel_training_features(training_windows(spark, sf))
    return scored.select("query", "class", "window_no", *[F.round(m, 8).alias(m) for m in METRICS])


_CODES = """, codes AS (
  SELECT class, CAST(CASE WHEN class = 'legit' THEN 0 ELSE dense_rank() OVER (PARTITION BY class = 'legit' ORDER BY class) END AS BIGINT) AS code
  FROM (SELECT DISTINCT class FROM labelled))"""


@query("i4_label_codes", with_(LABELLED) + _CODES + " SELECT l.query, l.class, c.code FROM labelled l JOIN codes c ON l.class = c.class")
def label_codes(spark, sf):
    rows = tb.labelled_domains(spark, sf).select("query", "class")
    return TR.encode(rows, TR.label_codes(rows)).select("query", "class", "code")


@query(
    "i5_binary_labels",
    with_(LABELLED) + _CODES + " SELECT l.query, CAST(CASE WHEN c.code <> 0 THEN 1 ELSE 0 END AS BIGINT) AS label FROM labelled l JOIN codes c ON l.class = c.class",
)
def binary_labels(spark, sf):
    rows = tb.labelled_domains(spark, sf).select("query", "class")
    return TR.encode(rows, TR.label_codes(rows)).select("query", TR.binarise(F.col("code")).alias("label"))


@query(
    "i6_standard_scale",
    with_(LABELLED, parts_sql("labelled")) + ", f AS (SELECT query, " + ", ".join(f"{v} AS {c}" for c, v in _TRAIN.items()) + " FROM parts), m AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + " FROM f) SELECT query, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 8) + 0.0::DOUBLE AS {c}" for c in FEATURES) + " FROM f, m",
)
def standard_scale(spark, sf):
    rows = TR.preprocess(tb.labelled_domains(spark, sf).select("query", "class"))
    made = rows.select("query", *feature_columns("query", "train"))
    return TR.standard_scaled(made, FEATURES).select("query", *[(F.round(c, 8) + F.lit(0.0)).alias(c) for c in FEATURES])


@query(
    "i7_split",
    with_(LINES) + """, drawn AS (
  SELECT logline_id, class, ('0x' || substr(sha256(CAST(logline_id AS VARCHAR) || '|108'), 1, 12))::BIGINT / 281474976710656.0 AS u FROM rows),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY u, CAST(logline_id AS VARCHAR)) AS r, count(*) OVER (PARTITION BY class) AS size FROM drawn),
sized AS (SELECT *, floor(size * 0.25) AS used, floor(floor(size * 0.25) * 0.8) AS n1 FROM ranked)
SELECT CAST(logline_id AS VARCHAR) AS logline_id, class, CASE WHEN r <= n1 THEN 'train' WHEN r <= n1 + floor((used - n1) / 2) THEN 'val' ELSE 'test' END AS split
FROM sized WHERE r <= used""",
)
def split(spark, sf):
    """Stratified sample and split of all lines."""
    rows = tb.user_domain_lines(spark, sf).select(F.col("logline_id").cast("string").alias("logline_id"), "class")
    return TR.stratified_split(rows, "logline_id", "class").select("logline_id", "class", "split")


@query(
    "i8_class_weights",
    with_(LINES) + """, n AS (SELECT class, count(*) AS n FROM rows GROUP BY 1)
SELECT class, n, round((SELECT sum(n) FROM n) / (2.0 * n), 9)::DOUBLE AS weight FROM n""",
)
def class_weights(spark, sf):
    rows = tb.user_domain_lines(spark, sf)
    return TR.class_weights(rows, "class").withColumn("weight", F.round("weight", 9))


@query(
    "i8_positive_scale",
    with_(LINES) + " SELECT round(count(*) FILTER (WHERE class = 'legit') / count(*) FILTER (WHERE class <> 'legit')::DOUBLE, 9) AS scale_pos_weight FROM rows",
)
def positive_scale(spark, sf):
    rows = tb.user_domain_lines(spark, sf).select(TR.binary_label(F.col("class")).alias("label"))
    return TR.positive_scale(rows, "label").select(F.round("scale_pos_weight", 9).alias("scale_pos_weight"))


def model_rows(spark, sf):
    return M.training_rows(tb.labelled_domains(spark, sf).select("query", "class"))


def _fitted(name):
    @query(f"i10_model_{name}")
    def fitted(spark, sf):
        """Fit on the labelled domains, predict them."""
        rows = model_rows(spark, sf)
        model = M.model_pipeline(M.classifier(name)).fit(rows)
        return model.transform(rows).select("query", F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("y_pred"))


for _name in ("rf", "gbm"):
    _fitted(_name)


@query("i11_search")
def search(spark, sf):
    """Fifty trials on five folds, by successive halving within 600 s; the best model's predictions."""
    rows = model_rows(spark, sf)
    best = M.halving_search(rows, "rf")
    return best.bestModel.transform(rows).select("query", F.col("prediction").cast("int").alias("y_pred"))


PAIRS = "pairs AS (SELECT doc_id, CAST(toxic AS INTEGER) AS y, CAST(1 - quality AS INTEGER) AS y_pred FROM labels)"
_METRICS = """CAST(count(*) FILTER (WHERE y = 1 AND y_pred = 1) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND y_pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE y = 1 AND y_pred = 0) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE y = 0 AND y_pred = 0) AS BIGINT) AS tn,
  CASE WHEN count(*) FILTER (WHERE y_pred = 1) > 0 THEN round(count(*) FILTER (WHERE y = 0 AND y_pred = 1) / count(*) FILTER (WHERE y_pred = 1)::DOUBLE, 9) ELSE 0.0 END AS fdr,
  CASE WHEN count(*) FILTER (WHERE y = 1 AND y_pred = 1) > 0 THEN round(count(*) FILTER (WHERE y = 0 AND y_pred = 1) / count(*) FILTER (WHERE y = 1 AND y_pred = 1)::DOUBLE, 9) ELSE 0.0 END AS fttar"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("i12_discovery_metrics", with_(PAIRS) + f" SELECT {_METRICS} FROM pairs")
def discovery(spark, sf):
    return _rounded(E.discovery_metrics(tb.evaluation_pairs(spark, sf)), "fdr", "fttar")


_REPORT = """SELECT c.class, round(CASE WHEN p > 0 THEN hit / p::DOUBLE ELSE 0 END, 9) AS precision, round(hit / support::DOUBLE, 9) AS recall,
  round(CASE WHEN hit > 0 THEN 2 * (hit / p::DOUBLE) * (hit / support::DOUBLE) / (hit / p::DOUBLE + hit / support::DOUBLE) ELSE 0 END, 9) AS f1, support
FROM (SELECT y AS class, count(*) AS support, count(*) FILTER (WHERE y = y_pred) AS hit FROM pairs GROUP BY 1) c
LEFT JOIN (SELECT y_pred AS class, count(*) AS p FROM pairs GROUP BY 1) q ON c.class = q.class"""


@query("i13_classification_report", with_(PAIRS) + " " + _REPORT)
def report(spark, sf):
    return _rounded(E.classification_report(tb.evaluation_pairs(spark, sf)), "precision", "recall", "f1")


@query("i14_mispredictions", with_(PAIRS) + " SELECT doc_id, y, y_pred FROM pairs WHERE y <> y_pred")
def mispredictions(spark, sf):
    return E.mispredictions(tb.evaluation_pairs(spark, sf))


@query("i14_mispredicted_classes", with_(PAIRS) + " SELECT DISTINCT d.lang AS class FROM documents d JOIN pairs p ON d.doc_id = p.doc_id WHERE p.y <> p.y_pred")
def mispredicted_classes(spark, sf):
    dataset = tb.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("class"))
    return E.mispredicted_classes(dataset, E.mispredictions(tb.evaluation_pairs(spark, sf)), "doc_id")


@query(
    "i15_metrics_per_dataset",
    with_(PAIRS) + f" SELECT d.source AS dataset, {_METRICS} FROM pairs p JOIN documents d ON p.doc_id = d.doc_id GROUP BY 1",
)
def per_dataset(spark, sf):
    pairs = tb.evaluation_pairs(spark, sf).join(tb.table(spark, sf, "documents").select("doc_id", F.col("source").alias("dataset")), "doc_id")
    return _rounded(E.discovery_metrics(pairs, ["dataset"]), "fdr", "fttar")


def _line_features(spark, sf):
    rows = TR.preprocess(tb.labelled_domains(spark, sf).select("query", "class"))
    return rows.select("query", "class", *feature_columns("query", "train"))


@query("i16_components")
def pca(spark, sf):
    """Coordinates on three components; signs are arbitrary."""
    placed = M.project(_line_features(spark, sf), 3, ["query", "class"])
    return placed.select("query", "class", *[F.round(f"pc{i}", 6).alias(f"pc{i}") for i in (1, 2, 3)])


@query("i16_explained_variance")
def variance(spark, sf):
    return M.explained_variance(_line_features(spark, sf), 3)


@query("i17_label_distribution", with_(LINES) + " SELECT class, count(*) AS count FROM rows GROUP BY 1")
def distribution(spark, sf):
    return E.label_distribution(tb.user_domain_lines(spark, sf))


_DIST = """, cells AS (
  SELECT side, feature, value FROM (SELECT toxic = 1 AS side, CAST(n_chars AS DOUBLE) AS n_chars, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id) UNPIVOT (value FOR feature IN (n_chars, n_spaces)))"""
_RUN = """,
cuts AS (SELECT feature, side, quantile_cont(value, 0.99) AS cut FROM cells GROUP BY 1, 2),
kept AS (SELECT c.* FROM cells c JOIN cuts k ON c.feature = k.feature AND c.side = k.side WHERE c.value <= k.cut),
points AS (SELECT feature, value, count(*) FILTER (WHERE side) AS n1, count(*) FILTER (WHERE NOT side) AS n2 FROM kept GROUP BY 1, 2),
run AS (SELECT feature, sum(n1) OVER w / sum(n1) OVER p AS f1, sum(n2) OVER w / sum(n2) OVER p AS f2, lead(value) OVER w - value AS width,
    sum(n1) OVER p AS s1, sum(n2) OVER p AS s2
  FROM points WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature))
SELECT feature, round(max(abs(f1 - f2)), 8) AS ks_statistic, round(sum(abs(f1 - f2) * coalesce(width, 0)), 6) AS emd,
  CAST(max(s1) AS BIGINT) AS n_condition1, CAST(max(s2) AS BIGINT) AS n_condition2 FROM run GROUP BY 1"""


@query("i18_distribution_distances", "WITH dummy AS (SELECT 1)" + _DIST + _RUN)
def distances(spark, sf):
    """Document length and spaces, toxic against other documents."""
    labels = tb.table(spark, sf, "labels").select("doc_id", "toxic")
    docs = tb.table(spark, sf, "documents").select(
        "doc_id", "n_chars", (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("n_spaces")
    )
    rows = E.long_form(docs.join(labels, "doc_id"), F.col("toxic") == 1, ["n_chars", "n_spaces"])
    out = E.distribution_distances(rows)
    return out.select(
        "feature", F.round("ks_statistic", 8).alias("ks_statistic"), F.round("emd", 6).alias("emd"), "n_condition1", "n_condition2"
    )


_FEATURE_CELLS = ", cells AS (SELECT class = 'legit' AS side, feature, round(value, 9) AS value FROM (SELECT class, " + ", ".join(
    f"{v} AS {c}" for c, v in _TRAIN.items()
) + f" FROM parts) UNPIVOT (value FOR feature IN ({', '.join(FEATURES)})))"
_P_VALUE = """, exact AS (SELECT feature, max(abs(f1 - f2)) * sqrt(max(s1)::DOUBLE * max(s2) / (max(s1) + max(s2))) AS x FROM run GROUP BY 1),
tail AS (SELECT feature, CASE WHEN x < 0.2 THEN 1.0::DOUBLE ELSE round(least(1.0, greatest(0.0,
  2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE * exp(-2.0 * k * k * x * x))))), 6) END AS ks_p_value FROM exact),
found AS ("""


@query(
    "i18_feature_distances",
    with_(LABELLED, parts_sql("labelled")) + _FEATURE_CELLS + _RUN.replace("SELECT feature, round", "{}SELECT feature, round").replace("\n{}", _P_VALUE)
    + ") SELECT f.*, t.ks_p_value FROM found f JOIN tail t ON f.feature = t.feature",
)
def feature_distances(spark, sf):
    """All features, legitimate against other domains."""
    rows = _line_features(spark, sf).select("class", *[F.round(c, 9).alias(c) for c in FEATURES])
    out = E.distribution_distances(E.long_form(rows, F.col("class") == "legit", FEATURES))
    rounded = [F.round(c, n).alias(c) for c, n in (("ks_statistic", 8), ("ks_p_value", 6), ("emd", 6))]
    return out.select("feature", *rounded, "n_condition1", "n_condition2")


@query("i19_without_component")
def without_component(spark, sf):
    out = M.without_component(_line_features(spark, sf), 0, ["query"])
    return out.select("query", *[F.round(F.col("values")[i], 6).alias(c) for i, c in enumerate(FEATURES)])


@query("i20_rules")
def rules(spark, sf):
    """Rules of a forest with their support and precision."""
    rows = model_rows(spark, sf)
    model = M.model_pipeline(M.classifier("rf")).fit(rows)
    return M.score_rules(rows, M.tree_rules(model))
