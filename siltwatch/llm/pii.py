"""Personal data by candidate gradient boosting.

Base spans follow fixed rules (email, ip, card, phone). Beyond them, generators of high
recall propose overlapping spans; boosted trees judge each by its format and context; a
threshold per kind, calibrated on candidates kept from the fit, selects those to add.

The trees do not learn the base rules. Positives are confirmed spans together with
disguised copies of them in the same place (``(at)`` for ``@``, no leading plus, other
separators); negatives are candidates that cannot be personal data: a failed check
digit, a part over 255, too few digits, a host whose last label no confirmed address
has, or a part of a confirmed span of another kind. All other candidates have no label:
they are what is judged. Trees and thresholds come from every labelled candidate of the
table. All of it is column expressions and JVM learning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import nonnull_text, staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# Possessive forms of the base rules: same matches, but linear on long runs.
BASE = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    r"\+[0-9](?:[\x20().-]*+[0-9])++",
)
_NUMBER = r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,40}+"
CANDIDATES = (
    (0, rf"[{_LOCAL}]{{1,64}}+\x20?(?:@|\(at\)|\[at\]|\bat\b)\x20?[{_HOST}]{{1,63}}+(?:(?:\.|\x20dot\x20|\[dot\])[{_HOST}]{{1,63}}+){{1,8}}+"),
    (1, r"(?<![0-9.])[0-9]{1,3}(?:[.:,-][0-9]{1,3}){3}(?![0-9])"),
    (2, _NUMBER),
    (3, _NUMBER),
)
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
HINTS = (r"(?i)mail|contact|write", r"(?i)\bip\b|host|server|address", r"(?i)card|visa|credit|karte|carte|tarjeta", r"(?i)tel|phone|call|fon|mobil|fax")


@dataclass(frozen=True)
class PiiSpec:
    precision: float = 0.95
    least_chance: float = 0.5
    fewest: int = 20
    """Labelled candidates kept from the fit that a threshold needs, of either label."""
    trees: int = 10
    depth: int = 4


def found_at(text: Column, pattern: str, kind: int) -> Column:
    """Matches as (start, kind, end, value), in code points, end exclusive.

    The text between matches gives their places: a match begins after all pieces and
    matches before it.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    lengths = F.transform(matches, lambda m: F.length(m))
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), lengths, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    walk = F.aggregate(steps, start, lambda a, s: F.struct((a["at"] + s["g"] + s["m"]).alias("at"), F.array_append(a["starts"], a["at"] + s["g"]).alias("starts")))
    return F.zip_with(
        walk["starts"], matches,
        lambda s, m: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(m)).alias("end"), m.alias("value")),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: int, value: Column) -> Column:
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == 2:
        return luhn(_digits(value))
    return F.length(_digits(value)).between(10, 15)


def _some(text: Column, kind: int, pattern: str) -> Column:
    """Matches, asked for only where the text can have any."""
    cheap = F.contains(text, F.lit("@")) if pattern == BASE[0] else text.rlike(r"\b(?:at|dot)\b|@|\(at\)|\[at\]") if kind == 0 else text.rlike("[0-9]")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(cheap, found_at(text, pattern, kind)).otherwise(none)


def _confirmed(text: Column, kind: int, pattern: str) -> Column:
    return F.filter(_some(text, kind, pattern), lambda s: _valid(kind, s["value"]))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def proposals(docs: DataFrame) -> DataFrame:
    """Per row: a row number, doc_id, base spans, and candidates with what surrounds them."""
    text = F.col("text")
    base = F.concat(*[_confirmed(text, k, p) for k, p in enumerate(BASE)])
    wide = F.concat(*[_some(text, k, p) for k, p in CANDIDATES])
    sizes = lambda s: F.length(_digits(s["value"]))
    wide = F.filter(wide, lambda s: F.when(s["kind"] == 2, sizes(s).between(13, 19)).when(s["kind"] == 3, sizes(s).between(7, 15)).otherwise(True))
    seen = F.transform(
        wide,
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
            F.substring(text, F.greatest(F.lit(1), s["start"] - 23), F.least(F.lit(24), s["start"])).alias("before"),
            F.substring(text, s["end"] + 1, F.lit(12)).alias("after"),
        ),
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), nonnull_text().alias("text"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array_sort(_bare(base)).alias("base"), seen.alias("wide"))


def features(rows: DataFrame) -> tuple[DataFrame, Sequence[str]]:
    """Format and context of each candidate as numbers."""
    value, digits = F.col("value"), _digits(F.col("value"))
    count = lambda p: F.regexp_count(value, F.lit(p))
    last, next_ = F.substring("before", -1, 1), F.substring("after", 1, 1)
    facts = {
        "f_digits": F.length(digits), "f_chars": F.length(value), "f_groups": count("[0-9]+"), "f_dots": count("[.]"),
        "f_hyphens": count("-"), "f_spaces": count(" "), "f_parens": count("[()]"), "f_letters": count("[A-Za-z]"),
        "f_first": F.coalesce(F.try_to_number(F.substring(digits, 1, 1), F.lit("9")), F.lit(-1)),
        "f_kinds": F.size(F.array_distinct(F.split(digits, ""))), "f_glued": last.rlike("[A-Za-z0-9_./-]"),
        "f_goes_on": next_.rlike("[A-Za-z0-9_/-]"), "f_opens": F.length("before") == 0, "f_closes": F.length("after") == 0,
        "f_quoted": last.rlike("[\"'=:]"),
    }
    facts |= {f"f_kind_{k}": F.col("kind") == i for i, k in enumerate(KINDS)}
    facts |= {f"f_hint_{k}": F.col("before").rlike(h) for k, h in zip(KINDS, HINTS, strict=True)}
    return rows.withColumns({k: v.cast("double") for k, v in facts.items()}), list(facts)


def disguises(kind: Column, value: Column) -> Column:
    """Other ways to write a confirmed span, as people do to hide it from a strict rule."""
    r = lambda v, old, new: F.replace(v, F.lit(old), F.lit(new))
    bare = F.regexp_replace(value, "[^0-9]", "")
    groups = lambda joint: F.rtrim(F.regexp_replace(bare, "([0-9]{4})(?=[0-9])", f"$1{joint}"))
    email = F.array(r(value, "@", " (at) "), r(value, "@", "(at)"), r(value, "@", " [at] "), r(r(value, "@", " at "), ".", " dot "))
    ip = F.array(r(value, ".", ","), r(value, ".", ":"), r(value, ".", "-"))
    card = F.array(bare, groups("."), groups("/"), groups(" "))
    plain = F.regexp_replace(value, r"^\+", "")
    phone = F.array(plain, F.concat(F.lit("00"), plain), F.regexp_replace(plain, "[() -]+", "."), F.regexp_replace(plain, "[()]", ""), bare)
    return F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).otherwise(phone)


def labelled(rows: DataFrame) -> DataFrame:
    """Candidates with ``label``: 1 for confirmed spans, 0 for what cannot be one, null for the rest.

    ``free`` tells candidates that no confirmed span overlaps.
    """
    own = F.struct("start", "kind", "end")
    touches = lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"])
    rows = rows.withColumns(
        {
            "known": F.array_contains("base", own),
            "free": ~F.exists("base", touches),
            "inside_other": F.exists("base", lambda s: touches(s) & (s["kind"] != F.col("kind"))),
            "last_label": F.lower(F.regexp_extract("value", r"([^.\x20\]]*)$", 1)),
        }
    ).drop("base")
    labels = rows.where("known AND kind = 0").select("last_label").distinct().withColumn("seen", F.lit(True))
    rows = rows.join(labels, "last_label", "left")
    value, digits, kind = F.col("value"), _digits(F.col("value")), F.col("kind")
    parts = F.transform(F.split(value, "[.:,-]"), lambda p: p.try_cast("int"))
    cannot = (
        F.when(kind == 0, F.col("seen").isNull())
        .when(kind == 1, F.exists(parts, lambda p: p > 255))
        .when(kind == 2, ~luhn(digits))
        .otherwise(~F.length(digits).between(10, 15))
    )
    label = F.when(F.col("known"), F.lit(1.0)).when(F.col("inside_other") | cannot, F.lit(0.0))
    return rows.withColumn("label", label).drop("known", "inside_other", "last_label", "seen")


def added_spans(rows: DataFrame, spec: PiiSpec) -> DataFrame | None:
    """(row, start, kind, end) of candidates that the trees select; None if there is nothing to learn from."""
    rows = staged(labelled(rows).withColumn("mark", F.xxhash64("row", "start", "kind", "end")), "pii-candidates")
    known = rows.where("label IS NOT NULL")
    # A confirmed span and its disguises stay on one side of the fit.
    copies = known.where("label = 1").withColumn("value", F.explode(disguises(F.col("kind"), F.col("value"))))
    placed = known.unionByName(copies).repartition("mark").sortWithinPartitions("mark", "row", "value")  # reruns agree
    shown, names = features(placed)
    shown = VectorAssembler(inputCols=list(names), outputCol="features").transform(shown).select("mark", "kind", "label", "features")
    shown = staged(shown, "pii-features")
    fold = F.pmod("mark", F.lit(3)) == 0
    fitting, kept = shown.where(~fold), shown.where(fold)
    if fitting.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    model = GBTClassifier(maxIter=spec.trees, maxDepth=spec.depth, seed=2, maxMemoryInMB=64).fit(fitting)
    chance = lambda df: model.transform(df).withColumn("chance", vector_to_array("probability")[1])
    steps = [x / 20 for x in range(1, 20) if x / 20 >= spec.least_chance]
    right = lambda x: F.coalesce(F.avg(F.when(F.col("chance") >= x, F.col("label"))), F.lit(0.0))
    judged = chance(kept).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), *[right(x).alias(f"p{i}") for i, x in enumerate(steps)])
    good = F.array(*[F.when(F.col(f"p{i}") >= spec.precision, F.lit(x)) for i, x in enumerate(steps)])
    enough = judged.where(F.col("n") >= spec.fewest)
    cut = F.lit(None).cast("double")
    for r in enough.select("kind", F.array_min(good).alias("cut")).where("cut IS NOT NULL").collect():  # four kinds at most
        cut = F.when(F.col("kind") == r["kind"], F.lit(r["cut"])).otherwise(cut)
    asked, names = features(rows.where("label IS NULL AND free"))
    asked = VectorAssembler(inputCols=list(names), outputCol="features").transform(asked)
    chosen = chance(asked.select("row", "start", "kind", "end", "features")).where(F.col("chance") >= cut)
    best = chosen.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("chance", "kind")).alias("kind"))
    return best.select("row", "start", "kind", "end")


def personal_data(docs: DataFrame, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (array of start, kind, end) and spans (base and added).

    Kinds are numbers in ``KINDS``. A null text is empty and has no spans; repeated rows
    are handled each; a null doc_id stays null. Without confirmed spans and candidates
    that cannot be any, or with too few of a kind for a threshold, nothing is added. An
    added span overlaps no base span; of two kinds for one span the likelier is added.
    Other columns are ignored.
    """
    rows = staged(proposals(docs), "pii-proposals")
    seen = rows.select("row", "base", F.explode("wide").alias("c")).select("row", "base", "c.*")
    own = F.struct("start", "kind", "end")
    more = added_spans(seen, spec)
    if more is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    more = more.groupBy("row").agg(F.collect_set(own).alias("more"))
    both = rows.join(more, "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("more", none)))
    return both.select("doc_id", "base", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
