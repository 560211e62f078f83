"""Removal of lines that spread over many sites.

A HyperLogLog sketch of sites per line is merged by aggregation, so a line in a third of
all documents costs one small sketch per task. Lines whose estimate is near the threshold
get an exact distinct count; the others are decided by the estimate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import nonnull_text, staged


@dataclass(frozen=True)
class SpreadSpec:
    sites: int = 10
    """A line on this many distinct sites is boilerplate."""
    band: float = 0.25
    """Estimates within this part of the threshold are counted exactly; over six standard errors of the sketch."""
    sketch_bits: int = 11


LINE = ("h1", "h2")
TEXT = ("t1", "t2")


def _pair(value: Column, names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(value, F.lit(8)).alias(names[1])]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def spread_lines(docs: DataFrame, site: str, spec: SpreadSpec) -> tuple[DataFrame, DataFrame]:
    """All lines with text and place, and the keys of those that spread over enough sites."""
    own = docs.select(nonnull_text().alias("text"), F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"))
    lines = own.select(*_pair(F.col("text"), TEXT), "site", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(*TEXT, "site", "place", *_pair(F.col("line"), LINE))
    lines = staged(lines, "lines")
    pairs = lines.select(*LINE, "site").groupBy(*LINE)
    sketched = pairs.agg(F.hll_sketch_agg("site", F.lit(spec.sketch_bits)).alias("sketch"))
    sketched = sketched.select(*LINE, F.hll_sketch_estimate("sketch").alias("about"))
    likely = staged(sketched.where(F.col("about") >= spec.sites * (1 - spec.band)), "spread")
    sure = likely.where(F.col("about") > spec.sites * (1 + spec.band)).select(*LINE)
    near = likely.where(F.col("about") <= spec.sites * (1 + spec.band)).select(*LINE)
    exact = lines.select(*LINE, "site").join(near, list(LINE), "left_semi").distinct().groupBy(*LINE).agg(F.count(F.lit(1)).alias("n"))
    return lines, staged(sure.union(exact.where(F.col("n") >= spec.sites).select(*LINE)), "boilerplate")


def without_spread_lines(docs: DataFrame, site: str = "source", spec: SpreadSpec = SpreadSpec()) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` and ``n_removed``.

    Lines end at \\n; two are the same if identical. A line without any word never counts
    and stays. A null site is a site of its own. A null text is empty: one line, none
    removed. Repeated rows get the same result; other columns stay as they are, but
    columns named like the new ones are replaced. An empty table gives no rows.
    """
    lines, spread = spread_lines(docs, site, spec)
    cut = lines.select(*TEXT, "place", *LINE).join(spread, list(LINE), "left_semi")
    cut = cut.groupBy(*TEXT).agg(F.collect_set("place").alias("_cut"))
    keep = [c for c in docs.columns if c not in ("clean_text", "n_lines", "n_removed", *TEXT, "_cut")]
    keyed = docs.select(*keep, *_pair(nonnull_text(), TEXT)).join(cut, list(TEXT), "left")
    all_lines = _lines(nonnull_text())
    rest = F.filter(all_lines, lambda x, i: ~F.array_contains("_cut", i))
    clean = F.when(F.col("_cut").isNull(), nonnull_text()).otherwise(F.array_join(rest, "\n"))
    removed = F.coalesce(F.size("_cut"), F.lit(0))
    return keyed.select(*keep, clean.alias("clean_text"), F.size(all_lines).cast("long").alias("n_lines"), F.greatest(removed, F.lit(0)).cast("long").alias("n_removed"))


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("clean_sha256"))


SQL = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM t),
b AS (SELECT line FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line
      HAVING count(DISTINCT coalesce('=' || source, '')) >= 10)
SELECT l.doc_id, count(*) AS n_lines, count(b.line) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY place) FILTER (WHERE b.line IS NULL), '')) AS clean_sha256
FROM l LEFT JOIN b ON l.line = b.line GROUP BY l.r, l.doc_id
"""
