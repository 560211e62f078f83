from __future__ import annotations

import math
from itertools import combinations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltwatch.functions import domains as D
from siltwatch.functions import similarity as S


def features(spark, names, variant="serve"):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, domain_name string")
    rows = D.with_domain_parts(df).select("i", *D.feature_columns(variant=variant)).orderBy("i").collect()
    return [r.asDict() for r in rows]


@pytest.mark.parametrize(
    "name,stats", [("google.com", (2, 6, 10)), ("", (1, 0, 0)), ("a", (1, 1, 1)), ("sub1.sub2.example.com", (4, 4, 21)), (".a.b.", (2, 1, 3))]
)
def test_label_statistics(spark, name, stats):
    row = features(spark, [name])[0]
    assert (row["label_length"], row["label_max"], row["label_average"]) == stats


def entropy(text):
    return -sum(text.count(c) / len(text) * math.log2(text.count(c) / len(text)) for c in set(text)) if text else 0.0


def test_features_by_hand(spark):
    name = "Ab_1.x-y.Example.com"
    row = features(spark, [name])[0]
    assert len(D.FEATURES) == 44 == len(row) - 1
    levels = {"fqdn": name, "thirdleveldomain": "Ab_1.x-y", "secondleveldomain": "Example"}
    for c in D.LETTERS:
        assert row[f"freq_{c}"] == pytest.approx(name.lower().count(c) / len(name))
    for level, text in levels.items():
        assert row[f"{level}_full_count"] == 1.0
        assert row[f"{level}_alpha_count"] == pytest.approx(sum(x.isalpha() for x in text) / len(text))
        assert row[f"{level}_numeric_count"] == pytest.approx(sum(x.isdigit() for x in text) / len(text))
        special = sum(not x.isalnum() and not x.isspace() for x in text)
        assert row[f"{level}_special_count"] == pytest.approx(special / len(text))
        assert row[f"{level}_entropy"] == pytest.approx(entropy(text))
    train = features(spark, [name], "train")[0]
    assert train["thirdleveldomain_special_count"] == pytest.approx(2 / 8)
    assert row["thirdleveldomain_special_count"] == pytest.approx(3 / 8)


def test_short_names(spark):
    rows = features(spark, ["", "localhost", "a.b"])
    assert all(v == 0.0 for k, v in rows[0].items() if k not in ("i", "label_length"))
    assert rows[1]["secondleveldomain_full_count"] == 0.0
    assert rows[2]["thirdleveldomain_entropy"] == 0.0


def test_four_empty_subdomains():
    assert S.window_metrics(("",) * 4) == (1, 1, 1, 1, 1, 0, 0)


def slow_jaro(a, b):
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = set(), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in used and b[j] == c:
                used.add(j)
                left.append(c)
                break
    if not left:
        return 0.0
    right = [b[j] for j in sorted(used)]
    m = len(left)
    t = sum(x != y for x, y in zip(left, right)) // 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    best, run = 0, [0] * (len(b) + 1)
    for x in a:
        new, fresh = [0], [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            fresh.append(run[j] + 1 if x == y else 0)
        row, run = new, fresh
        best = max(best, *fresh)
    return row[-1], best


WORDS = st.text("abcd", max_size=24)


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_pair_metrics_match_brute_force(a, b):
    sequence, string = slow_lcs(a, b)
    assert S.lcs_sequence(a, b) == sequence
    assert S.lcs_string(a, b) == string
    assert S.jaro(a, b) == pytest.approx(slow_jaro(a, b))
    got = S.pair_metrics(a, b)
    assert got[0] == pytest.approx(2 * sequence / (len(a) + len(b)) if a or b else 1.0)
    assert got[3] >= got[1] and got[3] <= 1.0


def test_prefix_boost_needs_similar_strings():
    base = S.jaro("martha", "marhta")
    assert S.jaro_winkler("martha", "marhta", base) == pytest.approx(base + 3 * 0.2 * (1 - base))
    assert S.jaro_winkler("abxx", "abyyzz", 0.7) == 0.7


def test_window_similarity_column(spark):
    words = ["abc", "abd", "", "xabc"]
    df = spark.createDataFrame([(words,), (["a"],), (None,)], "w array<string>")
    rows = [r[0] for r in df.select(S.window_similarity(F.col("w"))).collect()]
    pairs = [S.pair_metrics(a, b) for a, b in combinations(words, 2)]
    assert list(rows[0]) == pytest.approx([sum(c) / 6 for c in zip(*pairs)])
    assert rows[1]["jaro"] is None and rows[2]["jaro"] is None


def test_window_metrics_run_once_and_in_pieces(spark, monkeypatch):
    """A filter on a metric leaves one Python step, and pieces of a batch give the values of the whole."""
    from siltwatch.functions import similarity

    rows = [(i, [f"h{i % 7}", f"x{i % 5}y", "", f"h{i}"][: i % 5]) for i in range(40)]
    scored = spark.createDataFrame(rows, "id long, w array<string>").withColumn("m", similarity.window_similarity(F.col("w")))
    warned = scored.select("id", F.col("m.jaro").alias("jaro"), F.col("m.lcs_string").alias("run")).where("jaro < 0.9").select("id", "jaro", "run")
    assert warned._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    whole = [tuple(r) for r in scored.orderBy("id").collect()]
    windows = pa.array([w for _, w in rows])
    monkeypatch.setattr(similarity, "PAIRS_AT_ONCE", 7)
    assert len(similarity._pieces(windows)) > 5
    assert [None if m["jaro"] is None else tuple(m.values()) for m in similarity._metrics_of_windows(windows).to_pylist()] == [
        None if m["jaro"] is None else tuple(m) for _, _, m in whole
    ]
    assert len(similarity._metrics_of_windows(windows[:0])) == 0
