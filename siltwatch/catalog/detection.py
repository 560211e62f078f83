"""Queries: domain features, detectors, warnings and alerts."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.catalog.ingest import BATCHES, SPEC
from siltwatch.catalog.inspection import INSPECT, in_pieces
from siltwatch.catalog.registry import query
from siltwatch.catalog.views import COMMON, DNS, TUNNEL, TUNNEL_LOG, domains, entropy, series, verdicts, with_
from siltwatch.functions import domains as D
from siltwatch.functions.similarity import METRICS
from siltwatch.operators import alerts as A
from siltwatch.operators import detection as X
from siltwatch.operators import routing
from siltwatch.operators import tunnel as T
from siltwatch.operators.inspection import suspicious_lines
from siltwatch.plans import flow
from siltwatch.session import checkpoint_root
from siltwatch.sources import testbed as tb
from siltwatch.sources.staging import staged
from siltwatch.streaming.state import KeyedState

NAMES = with_(DNS, domains())
AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
AT_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def names(spark, sf):
    return D.with_domain_parts(tb.valid_log(spark, sf))


def features(spark, sf, columns):
    df = names(spark, sf).select("logline_id", *D.feature_columns())
    return df.select("logline_id", *[F.round(c, 9).alias(c) for c in columns])


@query("f1_domain_split", NAMES + " SELECT logline_id, fqdn, secondleveldomain, thirdleveldomain FROM split_names")
def domain_split(spark, sf):
    return names(spark, sf).select("logline_id", "fqdn", "secondleveldomain", "thirdleveldomain")


_STATS = {
    "label_length": "len(labels)::DOUBLE",
    "label_max": "length(list_aggregate(labels, 'max'))::DOUBLE",
    "label_average": "length(fqdn)::DOUBLE",
}
_FREQ = {
    f"freq_{c}": f"CASE WHEN length(fqdn) > 0 THEN (length(fqdn) - length(replace(lower(fqdn), '{c}', ''))) / length(fqdn)::DOUBLE ELSE 0.0 END"
    for c in D.LETTERS
}
_CLASS = {"full": "", "alpha": "[A-Za-z]", "numeric": "[0-9]", "special": r"[^A-Za-z0-9\s]"}
_RATIO = {
    f"{level}_{kind}_count": (
        f"CASE WHEN length({level}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        if kind == "full"
        else f"CASE WHEN length({level}) > 0 THEN (length({level}) - length(regexp_replace({level}, '{p}', '', 'g'))) / length({level})::DOUBLE ELSE 0.0 END"
    )
    for level in D.LEVELS
    for kind, p in _CLASS.items()
}
_ENTROPY = {f"{level}_entropy": entropy(level) for level in D.ENTROPY_LEVELS}


def _feature_sql(parts):
    columns = ", ".join(f"round({sql}, 9)::DOUBLE AS {name}" for name, sql in parts.items())
    return NAMES + f" SELECT logline_id, {columns} FROM split_names"


@query("f2_label_stats", _feature_sql(_STATS))
def label_stats(spark, sf):
    return features(spark, sf, list(_STATS))


@query("f3_letter_frequencies", _feature_sql(_FREQ))
def letter_frequencies(spark, sf):
    return features(spark, sf, list(_FREQ))


@query("f4_class_ratios", _feature_sql(_RATIO))
def class_ratios(spark, sf):
    return features(spark, sf, list(_RATIO))


@query("f5_entropy", _feature_sql(_ENTROPY))
def entropies(spark, sf):
    return features(spark, sf, list(_ENTROPY))


@query("f6_feature_vector", _feature_sql({**_STATS, **_FREQ, **_RATIO, **_ENTROPY}))
def feature_vector(spark, sf):
    """All 44 features, taken back out of the model's array."""
    vector = names(spark, sf).select("logline_id", *D.feature_columns()).select("logline_id", D.feature_array().alias("v"))
    return vector.select("logline_id", *[F.round(F.col("v")[i], 9).alias(n) for i, n in enumerate(D.FEATURES)])


_P = f"least(1.0, ({entropy('fqdn')}) / 4.0)"


@query("f7_binary_decision", NAMES + f" SELECT logline_id, round(p, 9) AS probability FROM (SELECT logline_id, {_P} AS p FROM split_names) WHERE p > 0.8")
def binary_decision(spark, sf):
    lines = tb.valid_log(spark, sf).withColumn("suspicious_batch_id", F.lit(""))
    warned = X.dga_warnings(lines, "dga", 0.8)
    return warned.select(
        F.col("request")[0]["logline_id"].cast("bigint").alias("logline_id"), F.round("probability", 9).alias("probability")
    )


@query("f8_flag_all", NAMES + f" SELECT CAST(logline_id AS VARCHAR) AS logline_id, round({_P}, 9) AS probability, 'base' AS name FROM split_names")
def flag_all(spark, sf):
    scored = names(spark, sf).withColumns(
        {"suspicious_batch_id": F.lit(""), "probability": X.entropy_probability(F.col("fqdn"))}
    )
    warned = X.binary_warnings(scored, "base", 0.8, always=True)
    return warned.select(F.col("request")[0]["logline_id"].alias("logline_id"), F.round("probability", 9).alias("probability"), "name")


def windows(spark, sf):
    return T.tunnel_windows(tb.tunnel_log(spark, sf), slot_seconds=86_400, chunk=100)


WINDOWS = with_(DNS, TUNNEL_LOG, domains("tunnel_log"), TUNNEL)


@query("f9_window_key", WINDOWS + " SELECT logline_id, secondleveldomain, arrival FROM windows")
def window_key(spark, sf):
    return windows(spark, sf).select("logline_id", "secondleveldomain", "arrival")


@query(
    "f9_window_key_per_client",
    NAMES + """, t AS (SELECT logline_id, row_number() OVER (PARTITION BY src_ip, secondleveldomain ORDER BY ts, logline_id) AS arrival FROM split_names)
SELECT logline_id, arrival FROM t WHERE arrival >= 3""",
)
def window_key_per_client(spark, sf):
    keyed = T.tunnel_windows(tb.stored_log(spark, sf), ("src_ip", "secondleveldomain"), slot_seconds=86_400)
    return keyed.select("logline_id", "arrival")


@query("f10_window_frame", WINDOWS + " SELECT logline_id, array_to_string(ids, ',') AS window_ids FROM windows")
def window_frame(spark, sf):
    ids = F.array_join(F.transform("request", lambda m: m["logline_id"]), ",")
    return windows(spark, sf).select("logline_id", ids.alias("window_ids"))


@query("f10_resumed_windows", WINDOWS + " SELECT logline_id, arrival, array_to_string(ids, ',') AS window_ids FROM windows")
def resumed_windows(spark, sf):
    """Windows over micro-batches, each with the last queries of those before it, are those of one run."""
    rows = staged(tb.tunnel_log(spark, sf).withColumn("second", F.unix_seconds("ts")), "tunnel-log")
    state = KeyedState(f"{checkpoint_root(spark)}/queues-{uuid.uuid4().hex}", T.KEYS, every=2)
    out = []
    for k, some in enumerate(in_pieces(rows, "second")):
        before = state.before(spark, k)
        arrived = staged(T.arrivals(some.drop("second"), slot_seconds=86_400, before=before), "arrivals")
        windows = T.windows_of(arrived, chunk=100, before=before).select("logline_id", "arrival", "request")
        out.append(staged(windows, "windows"))
        state.put(T.tunnel_state(arrived, before=before), k)
    ids = F.array_join(F.transform("request", lambda m: m["logline_id"]), ",")
    return reduce(DataFrame.unionByName, out).select("logline_id", "arrival", ids.alias("window_ids"))


_JARO = ("jaro", "jaro_reversed", "jaro_winkler", "jaro_winkler_reversed")


@query(
    "f11_jaro_family",
    WINDOWS + " SELECT logline_id, " + ", ".join(f"round({m}, 8) AS {m}" for m in _JARO) + " FROM window_scores",
)
def jaro_family(spark, sf):
    return T.with_similarity(windows(spark, sf)).select("logline_id", *[F.round(m, 8).alias(m) for m in _JARO])


@query(
    "f11_common_substrings",
    WINDOWS + "," + COMMON + " SELECT logline_id, round(levenshtein, 8) AS levenshtein, round(lcs_sequence, 8) AS lcs_sequence, round(lcs_string, 8) AS lcs_string FROM window_common",
)
def common_substrings(spark, sf):
    """Indel ratio and the two common-substring measures."""
    rest = [m for m in METRICS if m not in _JARO]
    return T.with_similarity(windows(spark, sf)).select("logline_id", *[F.round(m, 8).alias(m) for m in rest])


@query(
    "f12_tunnel_decision",
    WINDOWS + """ SELECT round(1 - jaro, 8) AS probability, array_to_string(ids, ',') AS window_ids, src_ip
FROM window_scores WHERE 1 - jaro > 0.5""",
)
def tunnel_decision(spark, sf):
    return tunnel_warned(spark, sf).select(
        F.round("probability", 8).alias("probability"),
        F.array_join(F.transform("request", lambda m: m["logline_id"]), ",").alias("window_ids"),
        "src_ip",
    )


def tunnel_warned(spark, sf):
    scored = T.with_similarity(windows(spark, sf)).withColumns(
        {"probability": 1 - F.col("jaro"), "suspicious_batch_id": F.col("subnet_id")}
    )
    return X.binary_warnings(scored, "tunnel", 0.5, request=F.col("request"))


CLASSES = ("benign", "dnscat2", "iodine")
_PROBS = "jaro / (1 + jaro_reversed / 2), (1 - jaro) / (1 + jaro_reversed / 2), jaro_reversed / 2 / (1 + jaro_reversed / 2)"


@query(
    "f13_attribution",
    WINDOWS + f""", p AS (SELECT logline_id, [{_PROBS}] AS ps FROM window_scores),
q AS (SELECT logline_id, ps, list_aggregate(ps, 'max') AS top FROM p)
SELECT logline_id, ['benign', 'dnscat2', 'iodine'][list_position(ps, top)] AS predicted_class, round(top, 8) AS probability,
  array_to_string(list_transform(list_filter([0, 1, 2], lambda i: ps[i + 1] >= 0.3), lambda i: ['benign', 'dnscat2', 'iodine'][i + 1]), ',') AS attributes
FROM q WHERE list_position(ps, top) > 1 AND top >= 0.3""",
)
def attribution(spark, sf):
    j, r = F.col("jaro"), F.col("jaro_reversed")
    total = 1 + r / 2
    scored = T.with_similarity(windows(spark, sf)).withColumns(
        {"probabilities": F.array(j / total, (1 - j) / total, r / 2 / total), "suspicious_batch_id": F.lit("")}
    )
    warned = X.attribution_warnings(scored, CLASSES, "attributor", 0.3)
    return warned.select(
        F.element_at("request", -1)["logline_id"].cast("bigint").alias("logline_id"),
        "predicted_class",
        F.round("probability", 8).alias("probability"),
        F.array_join(F.transform("attributes", lambda a: a["attribute"]), ",").alias("attributes"),
    )


@query(
    "f14_chained_windows",
    WINDOWS + """, warned AS (SELECT logline_id AS trigger, ts AS arrived_at, ids, window_names FROM window_scores WHERE 1 - jaro > 0.5),
messages AS (SELECT CAST(trigger AS VARCHAR) AS trigger, arrived_at, unnest(range(len(ids))) AS place, unnest(ids) AS logline_id, unnest(window_names) AS domain_name FROM warned),
labelled AS (SELECT *, string_split(domain_name, '.') AS labels FROM messages),
framed AS (
  SELECT trigger, place, list(logline_id) OVER (PARTITION BY labels[-2] ORDER BY arrived_at, trigger, place ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ids FROM labelled
)
SELECT trigger, CAST(place AS INTEGER) AS place, array_to_string(ids, ',') AS window_ids FROM framed WHERE len(ids) >= 3""",
)
def chained_windows(spark, sf):
    """A detector fed by another detector's windows."""
    messages = T.from_requests(tunnel_warned(spark, sf))
    chained = T.tunnel_windows(messages, order=T.CHAINED_ORDER, slot_seconds=86_400)
    ids = F.array_join(F.transform("request", lambda m: m["logline_id"]), ",")
    return chained.select("trigger", "place", ids.alias("window_ids"))


# The generated-domain flow: failed lookups of suspicious batches, scored by entropy.
DGA = with_(DNS, BATCHES, series("sum", "s.status_code = 'NXDOMAIN'"), verdicts("z", 1.5, 0.1)) + f""",
rated AS (
  SELECT *, {entropy("domain_name")} / 4.0 AS raw_p,
    CASE WHEN logline_id % 2 = 0 THEN '00000000-0000-4000-8000-' || lpad(CAST(logline_id AS VARCHAR), 12, '0') ELSE 'line-' || CAST(logline_id AS VARCHAR) END AS server_message_id
  FROM suspicious
),
warned AS (SELECT *, least(1.0, raw_p) AS p FROM rated WHERE least(1.0, raw_p) > 0.8 AND NOT is_buffer)"""


def dga_lines(spark, sf):
    rows = flow.sent_messages(tb.stored_log(spark, sf), SPEC, "check_dga_relevance", tb.DNS_FORMAT)
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("logline_id").cast("string"), 12, "0"))
    other = F.concat(F.lit("line-"), F.col("logline_id").cast("string"))
    rows = rows.withColumn("server_message_id", F.when(F.col("logline_id") % 2 == 0, uuid).otherwise(other))
    return suspicious_lines(rows, flow.inspect(rows, INSPECT))


def dga_warned(spark, sf, include_buffer=False):
    return flow.detect(dga_lines(spark, sf), "DGADetector", include_buffer, name="dga", threshold=0.8)


def dga_alerts(spark, sf):
    return A.build_alerts(dga_warned(spark, sf), "dga", F.lit(AT), A.compact_warning())


@query(
    "f16_alerts",
    DGA + f"""
SELECT suspicious_batch_id, src_ip, round(median(p), 9) AS overall_score, count(*) AS n_warnings, {AT_SQL} AS alert_timestamp, 'dga' AS detector_name
FROM warned GROUP BY suspicious_batch_id, src_ip""",
)
def alerts(spark, sf):
    return dga_alerts(spark, sf).select(
        "suspicious_batch_id", "src_ip", F.round("overall_score", 9).alias("overall_score"), "n_warnings", "alert_timestamp", "detector_name"
    )


@query(
    "f17_alert_domains",
    DGA + " SELECT suspicious_batch_id, array_to_string(list_sort(list(DISTINCT domain_name)), ',') AS domain_names FROM warned GROUP BY suspicious_batch_id",
)
def alert_domains(spark, sf):
    return dga_alerts(spark, sf).select("suspicious_batch_id", F.array_join("domain_names", ",").alias("domain_names"))


_SORTED = "array_to_string(list_sort(list_distinct({})), ',')"


@query(
    "f18_persisted_warning",
    WINDOWS + f"""
SELECT 'tunnel' AS detector_name, round(1 - jaro, 8) AS score, '' AS predicted_class, {_SORTED.format('window_names')} AS domains,
  {_SORTED.format('ids')} AS logline_ids, CAST(len(ids) AS BIGINT) AS request_count
FROM window_scores WHERE 1 - jaro > 0.5""",
)
def persisted_warning(spark, sf):
    w = tunnel_warned(spark, sf).select(A.persisted_warning("tunnel").alias("w"))
    return w.select(
        "w.detector_name",
        F.round("w.score", 8).alias("score"),
        "w.predicted_class",
        F.array_join("w.domains", ",").alias("domains"),
        F.array_join("w.logline_ids", ",").alias("logline_ids"),
        "w.request_count",
    )


@query(
    "f19_compact_warning",
    WINDOWS + f"""
SELECT 'tunnel' AS name, {_SORTED.format('window_names')} AS domain_names, {_SORTED.format('ids')} AS logline_ids,
  CAST(len(ids) AS BIGINT) AS request_count
FROM window_scores WHERE 1 - jaro > 0.5""",
)
def compact_warning(spark, sf):
    w = tunnel_warned(spark, sf).select(A.compact_warning().alias("w"))
    return w.select(
        "w.name",
        F.array_join("w.domain_names", ",").alias("domain_names"),
        F.array_join("w.logline_ids", ",").alias("logline_ids"),
        "w.request_count",
    )


@query(
    "f20_flat_messages",
    DGA + " SELECT suspicious_batch_id, count(*) AS n_messages, min(CAST(logline_id AS VARCHAR)) AS first_id FROM warned GROUP BY suspicious_batch_id",
)
def flat_messages(spark, sf):
    """Nested windows of an alert as one list."""
    nested = dga_warned(spark, sf).groupBy("suspicious_batch_id").agg(F.collect_list("request").alias("nested"))
    flat = nested.withColumn("m", A.flat_messages(F.col("nested")))
    return flat.select(
        "suspicious_batch_id",
        F.size("m").cast("bigint").alias("n_messages"),
        F.array_min(F.transform("m", lambda x: x["logline_id"])).alias("first_id"),
    )


DETECTORS = [
    {"name": "dga", "inspector_name": "dga_inspector", "consume_from": "inspector", "next_detectors": "", "produce_topics": ""},
    {"name": "tunnel", "inspector_name": "tunnel_inspector", "consume_from": "inspector",
     "next_detectors": ["behaviour", "tool"], "produce_topics": "siem, mail"},
    {"name": "behaviour", "consume_from": "detector", "next_detectors": "", "send_to_alerter": False},
    {"name": "tool", "consume_from": "detector", "produce_detector_topics": "behaviour", "produce_topics": ["siem"]},
]


@query(
    "f21_downstream_messages",
    WINDOWS + """
SELECT 'tunnel' AS upstream, d.name AS downstream, array_to_string(ids, ',') AS window_ids
FROM window_scores, (VALUES ('behaviour'), ('tool')) d(name) WHERE 1 - jaro > 0.5""",
)
def downstream(spark, sf):
    edges = routing.route_table(spark, routing.detector_edges(DETECTORS))
    sent = routing.downstream_messages(tunnel_warned(spark, sf), edges)
    ids = F.array_join(F.transform("request", lambda m: m["logline_id"]), ",")
    return sent.select("upstream", "downstream", ids.alias("window_ids"))


@query(
    "f22_alerter_routes",
    WINDOWS + """,
w AS (SELECT 'tunnel' AS name FROM window_scores WHERE 1 - jaro > 0.5
  UNION ALL SELECT CASE l_linenumber % 4 WHEN 0 THEN 'dga' WHEN 1 THEN 'tunnel' WHEN 2 THEN 'behaviour' ELSE 'tool' END FROM lineitem)
SELECT w.name, r.alerter, count(*) AS n FROM w JOIN (VALUES ('dga', 'generic'), ('tunnel', 'siem'), ('tunnel', 'mail'), ('tool', 'siem')) r(name, alerter)
  ON w.name = r.name GROUP BY 1, 2""",
)
def alerter_routes(spark, sf):
    routes = routing.route_table(spark, routing.alerter_routes(DETECTORS))
    place = F.col("l_linenumber") % 4
    other = tb.table(spark, sf, "lineitem").select(
        F.when(place == 0, "dga").when(place == 1, "tunnel").when(place == 2, "behaviour").otherwise("tool").alias("name")
    )
    warned = tunnel_warned(spark, sf).select("name").unionByName(other)
    return routing.fan_out(warned, routes, "name", "alerter").groupBy("name", "alerter").agg(F.count(F.lit(1)).alias("n"))


_EVENTS = DGA + """, hit AS (SELECT DISTINCT suspicious_batch_id FROM warned),
marked AS (SELECT s.*, h.suspicious_batch_id IS NOT NULL AS hit FROM suspicious s LEFT JOIN hit h ON s.suspicious_batch_id = h.suspicious_batch_id)"""


@query(
    "f23_line_events",
    _EVENTS + """
SELECT logline_id, 'data_analysis.detector' AS stage, CASE WHEN hit THEN 'detected' ELSE 'filtered_out' END AS status, FALSE AS is_active
FROM (SELECT DISTINCT suspicious_batch_id, CAST(logline_id AS VARCHAR) AS logline_id, hit FROM marked)""",
)
def line_events(spark, sf):
    lines = dga_lines(spark, sf)
    warned = flow.detect(lines, "DGADetector", name="dga", threshold=0.8)
    return X.detector_events(lines, warned, "dga")[0]


@query(
    "f23_batch_events",
    _EVENTS + """
SELECT suspicious_batch_id, src_ip, 'dga' AS instance_name, 'data_analysis.detector' AS stage,
  CASE WHEN hit THEN 'finished' ELSE 'filtered_out' END AS status, count(*) AS message_count, FALSE AS is_active
FROM marked GROUP BY suspicious_batch_id, src_ip, hit""",
)
def batch_events(spark, sf):
    lines = dga_lines(spark, sf)
    warned = flow.detect(lines, "DGADetector", name="dga", threshold=0.8)
    return X.detector_events(lines, warned, "dga")[1]


@query("f24_model_scores")
def model_scores(spark, sf):
    """Lines scored by a forest fitted on the labelled domains."""
    from siltwatch.plans import models

    model = models.fit_domain_model(tb.labelled_domains(spark, sf))
    scored = models.score_lines(tb.valid_log(spark, sf), model)
    return scored.select("logline_id", "domain_name", F.round("probability", 6).alias("probability"))


@query(
    "f25_repeated_scoring",
    DGA + """
SELECT CAST(logline_id AS VARCHAR) AS logline_id, count(*) AS n_scored, count(*) FILTER (WHERE NOT is_buffer) AS n_new
FROM rated WHERE least(1.0, raw_p) > 0.8 GROUP BY 1""",
)
def repeated_scoring(spark, sf):
    """Warnings per line with carried-over rows scored again, and without."""
    lines = dga_lines(spark, sf)
    both = []
    for flag, label in ((True, "n_scored"), (False, "n_new")):
        warned = flow.detect(lines, "DGADetector", flag, name="dga", threshold=0.8)
        both.append(warned.select(F.col("request")[0]["logline_id"].alias("logline_id"), F.lit(label).alias("kind")))
    return both[0].unionByName(both[1]).groupBy("logline_id").agg(
        F.count_if(F.col("kind") == "n_scored").alias("n_scored"), F.count_if(F.col("kind") == "n_new").alias("n_new")
    )


@query(
    "g2_originating_ids",
    DGA + """
SELECT suspicious_batch_id, coalesce(array_to_string(list_sort(list(DISTINCT server_message_id) FILTER (WHERE server_message_id NOT LIKE 'line-%')), ','), '') AS ids
FROM warned GROUP BY suspicious_batch_id""",
)
def originating(spark, sf):
    out = A.originating_ids(dga_alerts(spark, sf))
    return out.select("suspicious_batch_id", F.array_join(F.array_sort("originating_ids"), ",").alias("ids"))


@query(
    "g3_processed_events",
    DGA + f"""
SELECT server_message_id AS message_id, 'alerting.alerter' AS stage, 'processed' AS status, {AT_SQL} AS timestamp
FROM (SELECT DISTINCT suspicious_batch_id, server_message_id FROM warned WHERE server_message_id NOT LIKE 'line-%')""",
)
def processed(spark, sf):
    return A.processed_events(dga_alerts(spark, sf), F.lit(AT))


@query(
    "tunnel_end_to_end",
    WINDOWS + """
SELECT subnet_id, src_ip, count(*) AS n_windows, round(median(1 - jaro), 8) AS overall_score
FROM window_scores WHERE 1 - jaro > 0.5 GROUP BY 1, 2""",
)
def tunnel_end_to_end(spark, sf):
    """Lines to per-client tunnel alerts."""
    found = A.build_alerts(tunnel_warned(spark, sf), "tunnel", F.lit(AT), A.compact_warning())
    return found.select(
        F.col("suspicious_batch_id").alias("subnet_id"),
        "src_ip",
        F.col("n_warnings").alias("n_windows"),
        F.round("overall_score", 8).alias("overall_score"),
    )
