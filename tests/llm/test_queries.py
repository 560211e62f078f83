"""Registered queries run, and the pipeline's stages do what they say."""

from __future__ import annotations

import random

import corpus_pipeline
from siltwatch.llm.queries import OPERATORS, llm_queries, llm_sql
from tests.llm.cases import prose
from tests.llm.test_dedup import brute_components

SF = "/root/testdata/sf0.001"


def test_names():
    assert set(llm_sql()) <= set(llm_queries())
    assert [int(f.__name__[2:].split("_")[0]) for f in OPERATORS] == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept.append({r.doc_id: r for r in docs.collect()})
        assert set(kept[-1]) < set(kept[-2]) or name == "decontamination" and set(kept[-1]) <= set(kept[-2]), name
    first = {}
    for i, r in sorted(kept[1].items()):
        first.setdefault(" ".join((r.text or "").split()), i)
    assert set(kept[2]) == set(first.values())
    near = brute_components([(i, r.text) for i, r in kept[2].items()], 5)
    assert set(kept[3]) == {i for i, (_, _, keep) in near.items() if keep}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert set(columns) <= set(mixed.columns)
    assert all(0 < r.taken <= 3 * r.n_words for r in mixed.collect())


def odd_documents(spark, tmp_path):
    """Missing and repeated ids among documents, and a benchmark and labels that know nothing of them."""
    rng = random.Random(9)
    texts = [prose(rng, 40) for _ in range(12)]
    data = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[2]), (7, texts[3]), (8, texts[4])]
    data += [(9, texts[5]), (None, texts[5]), (10, None), (10, None), (None, ""), (11, texts[6]), (12, texts[6] + " more")]
    data += [(20 + i, t) for i, t in enumerate(texts[7:])]
    docs = [(i, t, "en", f"s{k % 2}", k) for k, (i, t) in enumerate(data)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing that any of these documents says at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return docs, frame


def test_stages_decide_on_rows(spark, tmp_path):
    docs, frame = odd_documents(spark, tmp_path)
    stages, key = dict(corpus_pipeline.STAGES), lambda r: (r[0] is None, r[0] or 0)
    run = lambda name, rows: stages[name](spark, rows, str(tmp_path))
    assert sorted(map(repr, run("quality", frame).collect())) == sorted(map(repr, frame.collect()))
    groups = {}
    for r in docs:
        groups.setdefault(" ".join((r[1] or "").split()), []).append(r)
    out = run("exact_dedup", frame)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == frame.columns and len(got) == len(groups)
    for r in got:
        own = groups.pop(" ".join((r[1] or "").split()))
        assert r in own and key(r) == min(map(key, own))
    rest = spark.createDataFrame(got, frame.schema)
    near = [tuple(r) for r in run("near_dedup", rest).collect()]
    assert set(got) - set(near) == {next(r for r in got if r[0] == 12)}
    twice = spark.createDataFrame([*got, *got], frame.schema)
    again = [tuple(r) for r in run("near_dedup", twice).collect()]
    assert sorted(map(repr, (r for r in again if r[1]))) == sorted(map(repr, (r for r in near if r[1])))
    rest = spark.createDataFrame(near, frame.schema)
    clean = run("decontamination", rest)
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, rest.collect()))
    mixed = run("mixing", frame).collect()
    assert len(mixed) == len({r.n_chars for r in mixed}) and all(0 < r.taken <= 3 * r.n_words for r in mixed)
    assert {r.doc_id for r in mixed} == {r[0] for r in docs if (r[1] or "").split()}
    for name in stages:
        assert stages[name](spark, frame.limit(0), str(tmp_path)).count() == 0, name
