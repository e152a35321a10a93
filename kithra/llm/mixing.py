"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import keyed_uniform
from ..operators.ordinal import with_ordinal
from ..session import materialize

WEIGHTS = (5.0, 2.0, 1.0)  # by the source's place in code point order, repeating
UNITS = 1_000_000  # parts of one expected copy
WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 3  # a source's target stops at so many times its size


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(_key, _source, size): words of each text; a null text has none."""
    return docs.select(F.col(key).alias("_key"), F.col(source).cast("string").alias("_source"), word_count(text).alias("size"))


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: float = MAX_COPIES) -> DataFrame:
    """(_source, source_size, target): shares of all words by weight, with a ceiling.

    A target above ``max_copies`` times its source's size is cut to that, and
    the excess goes to the other sources by weight, until none is above.  Only
    sums travel to the driver, so any number of sources will do.
    """
    totals = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    numbered = with_ordinal(totals, [F.col("_source").isNull(), "_source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = materialize(numbered.select(
        "_source", "source_size", weight.alias("weight"), (F.col("source_size") * float(max_copies)).alias("ceiling")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight among sources below their ceiling
    while total:
        above = F.col("ceiling") <= F.lit(level) * F.col("weight")
        kept, open_weight = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("ceiling"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if not open_weight:
            break
        raised = (total - kept) / open_weight
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return table.select("_source", "source_size", F.least("ceiling", F.lit(level) * F.col("weight")).alias("target"))


def systematic_copies(docs: DataFrame, group: str, order: list[str], expected: str, seed: int = 0) -> DataFrame:
    """Adds ``copies``: how often a row is emitted when each group is sampled systematically.

    Rows of a group stand in ``order``; ``expected`` is summed along it, one
    random offset per group is added, and a row is emitted once for every whole
    number that its own stretch of the sum crosses.  Sums are kept in
    millionths, so they do not depend on how rows are grouped.  A group is cut
    into the pieces that a range partitioning by (group, order) gives, so a hot
    one is spread over tasks; only one sum per piece is joined.
    """
    keys = [F.col(group).asc_nulls_first()] + [F.col(c) for c in order]
    units = docs.withColumn("_units", F.round(F.col(expected) * UNITS).cast("long"))
    ranged = materialize(units.repartitionByRange(*keys).withColumn("_piece", F.spark_partition_id()), "mixing")
    pieces = ranged.groupBy(group, "_piece").agg(F.sum("_units").alias("_sum"))
    # one row per group and piece: at most as many as groups and partitions together
    before = pieces.withColumn("_before", F.coalesce(F.sum("_sum").over(
        Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col(group).alias("_g"), F.col("_piece").alias("_p"), "_before")
    joined = ranged.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_piece") == F.col("_p")))
    upto = F.col("_before") + F.sum("_units").over(
        Window.partitionBy(group, "_piece").orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0))
    offset = F.floor(keyed_uniform(F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("null")), seed=seed) * UNITS).cast("long")
    out = joined.withColumn("_end", upto + offset)
    whole = F.expr(f"(_end div {UNITS}) - ((_end - _units) div {UNITS})")
    return out.withColumn("copies", whole).drop("_units", "_piece", "_g", "_p", "_before", "_end")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS,
        max_copies: float = MAX_COPIES, seed: int = 0) -> DataFrame:
    """(key, _source, size, source_size, target, copies, taken) per row of ``docs``.

    Rows of a source are taken in order of size, so every stretch of the sum
    holds like sizes and the words taken keep near the target.  Equal rows of
    one key share the copies in any order; a text without words counts 0 and
    is given copies like any other of its source.  An empty table gives none.
    """
    sizes = materialize(sized(docs, key, source, text), "sizes")
    targets = source_targets(sizes, weights, max_copies)
    rate = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = sizes.join(_by_source(rate, sizes), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    drawn = systematic_copies(rows, "_source", ["size", "_key"], "rate", seed)
    return drawn.withColumn("taken", F.col("copies") * F.col("size")).withColumnRenamed("_key", key).drop("rate")


SMALL_SOURCES = 10_000


def _by_source(table: DataFrame, sizes: DataFrame) -> DataFrame:
    """The table of sources, broadcast while it is of checked size; beyond it, an ordinary join."""
    table = table.withColumnRenamed("_source", "_s")
    return F.broadcast(table) if table.limit(SMALL_SOURCES + 1).count() <= SMALL_SOURCES else table


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents of the mix, each repeated as often as it was drawn; same columns as ``docs``, whatever their names."""
    same = ["_key", "_source", "size"]
    drawn = mix(docs, key, source, text, **options).select(F.col(key).alias("_key"), "_source", "size", "copies")
    drawn = drawn.withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("copies"))))
    drawn = drawn.filter("copies > 0").select(*[F.col(c).alias(f"{c}_d") for c in [*same, "_nth"]], "copies")
    # rows of one key, source and size are told apart by their order only
    told = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.col(source).cast("string").alias("_source"),
                       word_count(text).alias("_size"), F.xxhash64(text).alias("_told"))
    told = told.withColumn("_nth", F.row_number().over(Window.partitionBy("_key", "_source", "_size").orderBy("_told")))
    on = [F.col(a).eqNullSafe(F.col(b)) for a, b in
          (("_key", "_key_d"), ("_source", "_source_d"), ("_size", "size_d"), ("_nth", "_nth_d"))]
    taken = told.join(drawn, on).select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
