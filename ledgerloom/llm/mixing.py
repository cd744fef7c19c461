"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target: its share by weight of all words, never above
``MOST`` times what it holds; what a full source cannot take is shared again
by weight. The targets are dealt in blocks of ``block_words`` words, or of a
hundredth of the smallest target where that is less (at least one word), so
that small sources get their share too: blocks go
to sources by highest quotients target / (2 * blocks + 1), and the blocks of a
source go to its shards in the same way by the shards' sizes. A shard holds
about ``shard_words`` words, so a source of any size splits into many tasks.
Within a shard the words lie end to end in an order drawn from the seed; a
quota takes whole rounds of the shard and then its first blocks.

The quotients are never listed one by one: rounding at the exact divisor of
the mean share gives each party all but a few of its blocks, and only the last
ones are dealt (or taken back) by rank.

Defined results: null text has size 0 and takes 0; a null source is a source
of its own, last in order; an empty table gives an empty result; rows that
repeat an id are documents of their own; a shard never gives more than
``MOST`` rounds, what rounding to blocks would add beyond that is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import seeded_hash, store

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SHARD_WORDS = 200_000
#: A block is no larger than this part of the smallest target.
PARTS = 100
SEED = 7


def word_count(text: Column) -> Column:
    """Words are maximal runs without blanks; counted by where a word starts."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.length(F.regexp_replace(plain, r"[^ ]+ *", "w")).cast("long") - F.when(
        F.startswith(plain, F.lit(" ")), F.length(plain) - F.length(F.ltrim(plain))).otherwise(0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources fill up in the order of cap / weight. Before each source the rest
    of the words over the rest of the weights is the level that all remaining
    sources would get; the first source whose cap reaches that level fixes it.
    One row per source goes through the windows here, none per document.
    """
    listed = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = listed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    found = capped.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
    fixed = F.min_by("open", F.struct(F.col("open").isNull(), F.col("cap") / F.col("weight"), F.col("rank"))).over(every)
    return found.select("source", "source_size", F.least(
        F.col("cap").cast("double"), F.coalesce(fixed * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def apportion(parties: DataFrame, within: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Add ``won``: the seats of each party by highest quotients votes / (2 * seats + 1).

    ``seats`` is the same for all rows of one ``within``. Ties go to the
    smaller ``key``. Rounding every mean share leaves at most half a seat per
    party to deal or take back; per party only the quotients that the divisor
    can still move past are listed.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    p = parties.withColumn("_all", F.sum(F.col(votes).cast("double")).over(group)).withColumn(
        "_base", F.when(F.col("_all") > 0, F.floor(F.col(votes) * F.col(seats) / F.col("_all") + F.lit(0.5))).otherwise(0))
    p = p.withColumn("_n", F.count("*").over(group)).withColumn("_left", F.col(seats) - F.sum("_base").over(group))
    reach = F.when(F.col("_all") > 0, F.ceil(F.col(votes) / F.col("_all") * (F.abs("_left") + F.col("_n"))) + 1).otherwise(0)
    p = p.withColumn("_reach", F.when(F.col("_left") < 0, F.least(reach, F.col("_base"))).when(
        F.col("_left") > 0, reach).otherwise(0))
    step = F.explode(F.expr("sequence(0L, _reach - 1)"))
    tried = p.where("_reach > 0").select(*within, key, "_left", votes, "_base", step.alias("_k"))
    quotient = F.col(votes) / (F.lit(2) * F.when(F.col("_left") > 0, F.col("_base") + F.col("_k")).otherwise(
        F.col("_base") - 1 - F.col("_k")) + 1)
    ranked = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    deal = tried.withColumn("_q", quotient).withColumn("_rank", F.row_number().over(ranked.orderBy(
        F.when(F.col("_left") > 0, -F.col("_q")).otherwise(F.col("_q")),
        F.when(F.col("_left") > 0, F.col(key)).asc(), F.col(key).desc(), "_k")))
    moved = deal.where(F.col("_rank") <= F.abs("_left")).groupBy(*within, key).agg(
        F.sum(F.signum("_left")).cast("long").alias("_moved"))
    cond = F.lit(True)
    for c in [*within, key]:
        cond = cond & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return p.alias("a").join(moved.alias("b"), cond, "left").select(
        *[F.col(f"a.{c}") for c in parties.columns],
        (F.col("a._base") + F.coalesce("b._moved", F.lit(0))).cast("long").alias("won"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    sized = store(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size")), "mix-sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    every = Window.partitionBy(F.lit(0))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / PARTS))).cast("long")
    blocks = F.round(F.sum("source_size").over(every) / F.col("block")).cast("long")
    quotas = apportion(sources.withColumn("block", block).withColumn("seats", blocks), [], "source", "target", "seats").select(
        "source", "source_size", "target", "block", F.col("won").alias("quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"))
    quotas = store(quotas.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))),
                   "mix-quotas")

    placed = sized.alias("d").join(quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source"))).select(
        "d.doc_id", "d.source", "d.size", "q.source_size", "q.target", "q.source_no", "q.quota", "q.block",
        F.pmod(seeded_hash(seed, F.col("d.doc_id")), F.col("q.shards")).alias("shard"))
    shards = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.max("quota").alias("quota"), F.max("block").alias("block"))
    shares = store(apportion(shards, ["source_no"], "shard", "shard_size", "quota").select(
        "source_no", "shard", "shard_size",
        F.least(F.col("won") * F.col("block"), F.col("shard_size") * most).alias("words")), "mix-shards")

    lined = Window.partitionBy("source_no", "shard").orderBy(
        seeded_hash(seed + 1, F.col("doc_id"), F.col("size")), "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    laid = placed.join(shares, ["source_no", "shard"]).withColumn("end", F.sum("size").over(lined))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    rest = F.when(F.col("shard_size") > 0, F.col("words") % F.col("shard_size")).otherwise(0)
    part = F.greatest(F.lit(0), F.least(F.col("end"), rest) - (F.col("end") - F.col("size")))
    return laid.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
                       (F.col("size") * rounds + part).cast("long").alias("taken"))


def drawn(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each repeated as often as its words are taken.

    A document of which only a part is taken goes out whole when that part is
    at least half of it; one without words is not drawn. Rows that repeat an
    id are told apart by source and size. Columns as in ``docs``.
    """
    id_col, text_col, source_col = (options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    taken = mix(docs, **options).where("size > 0").groupBy("doc_id", "source", "size").agg(
        F.max(F.round(F.col("taken") / F.col("size"))).cast("int").alias("_copies"))
    sized = docs.withColumn("_size", word_count(F.col(text_col)))
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("t.doc_id")) & F.col(f"d.{source_col}").eqNullSafe(F.col("t.source")) & (F.col("d._size") == F.col("t.size"))
    return sized.alias("d").join(taken.hint("merge").alias("t"), same).where("_copies > 0").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.explode(F.expr("sequence(1, _copies)")).alias("_copy")).drop("_copy")
