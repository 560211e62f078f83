"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets become whole blocks of equal token count: first the blocks of the mix are dealt
to sources, then those of a source to its shards, each time to the highest quotients
votes / (2k + 1). A shard is a seeded share of a source's documents, laid end to end in
a seeded order; its quota gives full rounds over the shard plus a run of blocks from a
seeded place on that line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.llm.common import staged, word_count


@dataclass(frozen=True)
class MixSpec:
    weights: Sequence[float] = (5, 2, 1)
    share: float = 1.0
    """Words of the mix, as a part of all words."""
    most_repeats: int = 3
    block_tokens: int = 16
    shard_tokens: int = 1 << 21
    """Expected words of a shard; a shard is one task's share, so this bounds its size."""
    seed: str = "mix"


def seeded(spec: MixSpec, *parts: Column) -> Column:
    """Non-negative 60-bit value of the seed and the parts."""
    text = F.concat_ws("|", F.lit(spec.seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """(source, source_no, source_size, target): one row per source, null last.

    Sources in order of size per weight reach their cap first, so the level at which
    the rest is shared follows from running sums. The windows without a key run over
    one row per source, never over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weights = F.array(*[F.lit(float(w)) for w in spec.weights])
    rows = totals.withColumn("source_no", number)
    rows = rows.withColumn("weight", F.element_at(weights, ((F.col("source_no") - 1) % len(spec.weights) + 1).cast("int")))
    rows = rows.withColumn("cap", (F.col("source_size") * spec.most_repeats).cast("double"))
    whole = Window.partitionBy(F.lit(0))
    line = whole.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    words = F.sum("source_size").over(whole) * F.lit(float(spec.share))
    left = words - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    stays = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))
    rows = rows.withColumn("final", F.first(stays, True).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("final", F.lit(float("inf"))))
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def sainte_lague(rows: DataFrame, group: str, party: str, votes: str, seats: str) -> DataFrame:
    """``rows`` with ``quota``: ``seats`` of each group dealt to its parties by highest quotients.

    Quotients far above the last one that wins are sure and only counted, those far
    below are left out; about two to four a party are ranked. Ties go to the lower party.
    """
    sums = rows.groupBy(group).agg(F.sum(votes).cast("double").alias("_all"), F.count_if(F.col(votes) > 0).alias("_n"))
    own = rows.join(sums, group)
    part = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(0.0)
    at = lambda slack: F.floor(part * (F.col(seats) + F.col("_n") * slack) + 0.5)
    own = own.withColumn("_sure", F.greatest(F.lit(0), at(-0.5) - 1))
    own = own.withColumn("_most", F.when(part > 0, F.greatest("_sure", at(0.5) + 1)).otherwise(F.col("_sure")))
    own = own.withColumn("_left", F.col(seats) - F.sum("_sure").over(Window.partitionBy(group)))
    tries = own.where("_most > _sure").withColumn("_k", F.explode(F.sequence("_sure", F.col("_most") - 1)))
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    place = F.row_number().over(Window.partitionBy(group).orderBy(quotient.desc(), party))
    won = tries.withColumn("_place", place).where("_place <= _left").groupBy(group, party).agg(F.count(F.lit(1)).alias("_won"))
    out = own.join(won, [group, party], "left").withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
    return out.select(*rows.columns, "quota")


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    ``size`` is the number of words (0 for null or blank texts), ``taken`` the words the
    mix takes from the document, repeats counted, at most ``most_repeats`` times its size.
    A null source is a source of its own and comes last. Rows that repeat a doc_id or
    have none are documents of their own. Other columns are ignored; an empty table
    gives no rows. The same table always gives the same mix.
    """
    sizes = staged(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    targets = source_targets(sizes, spec).withColumn("shards", F.ceil(F.col("source_size") / spec.shard_tokens))
    targets = targets.withColumn("mix", F.lit(0)).withColumn(
        "blocks", F.round(F.sum("target").over(Window.partitionBy("mix")) / spec.block_tokens).cast("long")
    )
    targets = sainte_lague(targets, "mix", "source_no", "target", "blocks").withColumnRenamed("quota", "source_blocks")
    targets = staged(targets.drop("blocks", "mix"), "targets")
    placed = sizes.join(targets.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
    placed = placed.withColumn("place", seeded(spec, F.col("doc_id"))).withColumn(
        "shard", F.col("place") % F.greatest(F.col("shards"), F.lit(1))
    )
    placed = staged(placed.drop("source", "named", "shards"), "placed")
    shards = placed.groupBy("source_no", "shard", "source_blocks").agg(F.sum("size").alias("shard_size"))
    shards = sainte_lague(shards, "source_no", "shard", "shard_size", "source_blocks")
    size, b = F.col("shard_size"), spec.block_tokens
    asked = F.col("quota") * b
    rounds = F.when(size > 0, F.least(F.lit(spec.most_repeats), F.floor(asked / size))).otherwise(0)
    shards = shards.withColumn("rounds", rounds).withColumn("whole", F.floor(size / b))
    extra = F.least(F.col("whole"), F.round((asked - F.col("rounds") * size) / b).cast("long"))
    shards = shards.withColumn("extra", F.when(F.col("rounds") < spec.most_repeats, extra).otherwise(0))
    begin = seeded(spec, F.col("source_no"), F.col("shard")) % F.greatest(F.col("whole"), F.lit(1)) * b
    shards = shards.select("source_no", "shard", "rounds", (F.col("whole") * b).alias("line"), begin.alias("begin"), (F.col("extra") * b).alias("length"))
    order = Window.partitionBy("source_no", "shard").orderBy("place", "doc_id", "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = placed.withColumn("upto", upto).join(shards, ["source_no", "shard"])
    end = F.col("begin") + F.col("length")
    within = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("upto"), hi) - F.greatest(F.col("upto") - F.col("size"), lo))
    taken = F.col("rounds") * F.col("size") + within(F.col("begin"), F.least(end, F.col("line"))) + within(F.lit(0), end - F.col("line"))
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
