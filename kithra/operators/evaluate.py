"""How good a result is: recall, ranking, verification and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays, distances
from .knn import knn_join
from .linear import vector_stats
from .ordinal import with_ordinal


def ground_truth(base: DataFrame, queries: DataFrame, k: int = 50, metric="l2", first: int | None = None, **options) -> DataFrame:
    """Exact neighbours of all queries, or of the first ones by id."""
    if first:
        queries = queries.orderBy("query_id").limit(first)
    return knn_join(queries, base, k, metric, **options)


def recall_curve(ranked: DataFrame, truth: DataFrame, k: int, ts: list[int]) -> DataFrame:
    """``(t, recall, precision)`` for each t: recall = mean |truth ∩ first t| / k, precision = recall·k/t.

    ``truth`` is ``(query_id, id)`` with k rows per query, ``ranked`` has a rank.
    """
    places = truth.select("query_id", "id").join(ranked.select("query_id", "id", "rank"), ["query_id", "id"], "left")
    sums = places.agg(
        F.countDistinct("query_id").alias("nq"),
        *[F.sum((F.col("rank") <= t).cast("long")).alias(f"h{t}") for t in ts])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.coalesce(f"h{t}", F.lit(0)).alias("h")) for t in ts]))
    recall = F.col("r.h") / (F.col("nq") * F.lit(k))
    return sums.select("nq", rows.alias("r")).select(
        F.col("r.t").alias("t"), recall.alias("recall"), (recall * k / F.col("r.t")).alias("precision"))


def ranking_metrics(results: DataFrame, k: int, by: str | None = None, digits: int = 4) -> DataFrame:
    """MRR, MAP, precision@i and recall-1@i for i ≤ k over ``eval`` arrays of 0/1; overall (and per group).

    Recall-1 asks for one relevant result.  Average precision is over the
    relevant results that were returned, 0 if there are none.
    """
    rel = F.slice("eval", 1, k)
    first = F.array_position(rel, 1)
    hits = F.transform(rel, lambda r, i: F.aggregate(F.slice(rel, F.lit(1), i + 1), F.lit(0), lambda s, x: s + x))
    precisions = F.zip_with(rel, F.transform(hits, lambda h, i: h / (i + 1)), lambda r, p: r * p)
    total = F.aggregate(rel, F.lit(0), lambda s, x: s + x)
    measured = {
        "mrr": F.when(first > 0, 1.0 / first).otherwise(0.0),
        "map": F.when(total > 0, arrays.array_total(precisions) / F.when(total > 0, total)).otherwise(0.0),
    }
    for i in range(1, k + 1):
        some = F.aggregate(F.slice(rel, 1, i), F.lit(0), lambda s, x: s + x)
        measured[f"precision_{i}"] = some / F.lit(float(i))
        measured[f"recall_1_{i}"] = (some > 0).cast("double")
    rows = results.select(*([by] if by else []), *[c.alias(n) for n, c in measured.items()])
    means = [F.round(F.avg(n), digits).alias(n) for n in measured]
    overall = rows.agg(*means)
    if not by:
        return overall
    return overall.select(F.lit("all").alias(by), *measured).unionByName(rows.groupBy(by).agg(*means))


def compare_systems(rows: DataFrame) -> DataFrame:
    """Counts and shares where system a helps: it hits and b misses; it ranks better than a hit of b.

    ``rows`` has ``a_correct, a_rank, b_correct, b_rank`` (rank −1 for no hit).
    """
    recall = (F.col("a_correct") > 0) & (F.col("b_correct") == 0)
    rank = (F.col("a_rank") > 0) & (F.col("b_rank") > F.col("a_rank"))
    n = F.count("*")

    def counted(c):
        return F.sum(c.cast("long"))

    return rows.agg(
        counted(recall).alias("recall_improved"), (counted(recall) / n).alias("recall_share"),
        counted(rank).alias("rank_improved"), (counted(rank) / n).alias("rank_share"))


def rank_of_first_hit(eval_column: str) -> Column:
    place = F.array_position(eval_column, 1)
    return F.when(place > 0, place).otherwise(F.lit(-1)).cast("int")


# --------------------------------------------------------------- verification

def _folds(pairs: DataFrame, folds: int) -> DataFrame:
    """Adds the contiguous fold of each pair by ``pair_id``; the first folds get the extra rows."""
    n = pairs.count()
    size, extra = divmod(n, folds)
    numbered = with_ordinal(pairs, ["pair_id"], "_i")
    edge = extra * (size + 1)
    i = F.col("_i")
    fold = F.when(i < edge, F.floor(i / (size + 1))).otherwise(extra + F.floor((i - edge) / max(size, 1)))
    return numbered.withColumn("fold", fold.cast("int")).drop("_i")


def _fold_counts(pairs: DataFrame, thresholds: list[float], folds: int, metric: str, subtract_mean: bool):
    """Per (model fold, part, threshold number): same and different pairs first accepted there.

    A pair is accepted (distance < t) from one threshold on, so it is counted
    once and summed up afterwards; nothing is multiplied by the thresholds.
    Returns the counts and the pairs with their distances per model fold.
    """
    rows = _folds(pairs, folds)
    dist = distances.DISTANCES[metric]
    if subtract_mean:
        cells = rows.select("fold", F.explode(F.array("a", "b")).alias("v")).select("fold", F.posexplode(arrays.doubles("v")).alias("dim", "x"))
        parts = cells.groupBy("fold", "dim").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
        totals = parts.groupBy("dim").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
        # folds × d rows: the mean of everything outside the fold
        means = (
            parts.join(totals, "dim").groupBy("fold")
            .agg(F.array_sort(F.collect_list(F.struct("dim", ((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n"))).alias("m")))).alias("c"))
            .select(F.col("fold").alias("model"), F.col("c.m").alias("mean"))
        )
        every = rows.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        every = every.join(F.broadcast(means), "model")
        every = every.withColumn("dist", dist(arrays.subtract("a", "mean"), arrays.subtract("b", "mean")))
        every = every.select("pair_id", "model", "fold", "issame", "dist")
    else:
        every = rows.select("pair_id", "fold", "issame", dist(F.col("a"), F.col("b")).alias("dist"))
    table = arrays.constant_vector(thresholds)
    slot = arrays.bind(F.col("dist"), lambda d: F.size(F.filter(table, lambda t: t <= d))).alias("slot")
    keys = (["model"] if subtract_mean else []) + ["fold", slot]
    counts = every.groupBy(*keys).agg(
        F.sum(F.col("issame").cast("long")).alias("same"), F.sum((~F.col("issame")).cast("long")).alias("diff"))
    if not subtract_mean:
        counts = counts.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    counts = counts.groupBy("model", (F.col("fold") == F.col("model")).alias("test"), "slot").agg(
        F.sum("same").alias("same"), F.sum("diff").alias("diff"))
    return counts, every


def _curves(counts: DataFrame, thresholds: list[float], folds: int) -> DataFrame:
    """Accepted pairs below every threshold per (model, part): folds × 2 × thresholds rows."""
    n = len(thresholds)
    cells = [
        (m, test, i, float(thresholds[i]) if i < n else None)
        for m in range(folds) for test in (True, False) for i in range(n + 1)
    ]
    table = counts.sparkSession.createDataFrame(cells, "model int, test boolean, slot int, threshold double")
    full = table.join(counts, ["model", "test", "slot"], "left").fillna(0, ["same", "diff"])
    run = Window.partitionBy("model", "test").orderBy("slot")
    every = Window.partitionBy("model", "test")
    return full.select(
        "model", "test", "slot", "threshold",
        F.sum("same").over(run).alias("tp"), F.sum("diff").over(run).alias("fp"),
        F.sum("same").over(every).alias("same"), F.sum("diff").over(every).alias("diff"),
    ).filter(F.col("slot") < n)


def _rate(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.when(F.col(b) > 0, F.col(b))).otherwise(0.0)


def _accuracy() -> Column:
    return (F.col("tp") + F.col("diff") - F.col("fp")) / (F.col("same") + F.col("diff"))


def roc_kfold(pairs: DataFrame, thresholds: list[float], folds: int = 10, metric="l2", subtract_mean=False) -> DataFrame:
    """``(fold, threshold, tpr, fpr, accuracy)``: the most accurate threshold of the other folds, judged on the fold.

    ``pairs`` is ``(pair_id, a, b, issame)``; a pair is called same when its distance is below the threshold.
    """
    counts, _ = _fold_counts(pairs, thresholds, folds, metric, subtract_mean)
    curves = _curves(counts, thresholds, folds).withColumn("accuracy", _accuracy())
    best = curves.filter(~F.col("test")).groupBy("model").agg(
        F.max_by("slot", F.struct("accuracy", -F.col("slot"))).alias("slot"))
    return curves.filter("test").join(best, ["model", "slot"]).select(
        F.col("model").alias("fold"), "threshold", _rate("tp", "same").alias("tpr"), _rate("fp", "diff").alias("fpr"), "accuracy")


def roc_curve(pairs: DataFrame, thresholds: list[float], folds: int = 10, metric="l2", subtract_mean=False) -> DataFrame:
    """``(threshold, tpr, fpr)``: means over the folds."""
    counts, _ = _fold_counts(pairs, thresholds, folds, metric, subtract_mean)
    curves = _curves(counts, thresholds, folds).filter("test")
    return curves.groupBy("threshold").agg(F.avg(_rate("tp", "same")).alias("tpr"), F.avg(_rate("fp", "diff")).alias("fpr"))


def val_at_far(pairs: DataFrame, far_target: float, thresholds: list[float], folds: int = 10, metric="l2", subtract_mean=False) -> DataFrame:
    """One row ``(val, val_std, far)``: acceptance at the threshold where the other folds' false accepts meet the target.

    The threshold is interpolated between the last step not above the target
    and the next one; 0 if the target is never reached.
    """
    counts, every = _fold_counts(pairs, thresholds, folds, metric, subtract_mean)
    train = _curves(counts, thresholds, folds).filter(~F.col("test")).withColumn("far", _rate("fp", "diff"))
    run = Window.partitionBy("model").orderBy("slot")
    steps = train.withColumn("next_far", F.lead("far").over(run)).withColumn("next_t", F.lead("threshold").over(run))
    low = F.col("far") <= far_target
    meet = F.col("threshold") + (F.lit(far_target) - F.col("far")) / F.when(F.col("next_far") > F.col("far"), F.col("next_far") - F.col("far")) * (
        F.col("next_t") - F.col("threshold"))
    chosen = steps.groupBy("model").agg(
        F.max("far").alias("top"),
        F.max_by(F.coalesce(meet, F.col("threshold")), F.when(low, F.col("slot"))).alias("t"))
    chosen = chosen.select("model", F.when(F.col("top") >= far_target, F.coalesce("t", F.lit(0.0))).otherwise(0.0).alias("t"))
    if not subtract_mean:
        every = every.withColumn("model", F.col("fold"))
    judged = every.filter(F.col("model") == F.col("fold")).join(F.broadcast(chosen), "model")
    accept = F.col("dist") < F.col("t")
    per_fold = judged.groupBy("model").agg(
        F.sum((accept & F.col("issame")).cast("long")).alias("ta"), F.sum((accept & ~F.col("issame")).cast("long")).alias("fa"),
        F.sum(F.col("issame").cast("long")).alias("same"), F.sum((~F.col("issame")).cast("long")).alias("diff"))
    rates = per_fold.select(_rate("ta", "same").alias("val"), _rate("fa", "diff").alias("far"))
    return rates.agg(F.avg("val").alias("val"), F.stddev_pop("val").alias("val_std"), F.avg("far").alias("far"))


# --------------------------------------------------------------------- losses

def contrastive_loss(pairs: DataFrame, margin: float) -> DataFrame:
    """½·mean(y·d² + (1−y)·max(margin−d, 0)²) + 1e-9 over ``(a, b, issame)``, as one row ``(loss)``."""
    d = distances.euclid(F.col("a"), F.col("b"))
    apart = F.greatest(F.lit(margin) - d, F.lit(0.0))
    loss = F.when(F.col("issame"), d * d).otherwise(apart * apart)
    return pairs.agg((F.avg(loss) / 2 + F.lit(1e-9)).alias("loss"))


def triplet_loss(triplets: DataFrame, alpha: float) -> DataFrame:
    """mean(max(d²(anchor, positive) − d²(anchor, negative) + α, 0)), as one row ``(loss)``."""
    gap = distances.l2(F.col("anchor"), F.col("positive")) - distances.l2(F.col("anchor"), F.col("negative")) + alpha
    return triplets.agg(F.avg(F.greatest(gap, F.lit(0.0))).alias("loss"))


def group_centroid_spread(df: DataFrame, label: str = "label", vector: str = "vector") -> DataFrame:
    """``(label, n, spread)``: mean squared distance of vectors to their label's centre.

    Σ‖x − c‖²/n equals the summed per-dimension variances, so no row meets its
    centre in a join.
    """
    stats = vector_stats(df, vector, [label])
    return stats.groupBy(label).agg(F.max("n").alias("n"), F.sum("var").alias("spread"))
