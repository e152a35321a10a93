"""Detection boxes as rows: (image_id, box_id, x1, y1, x2, y2, score)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CORNERS = ["x1", "y1", "x2", "y2"]
# fixed values: step and size of a heat map's cells, in pixels
STRIDE, CELL = 2, 12
BLOCK = 2048  # undecided boxes that one tile holds at a time
STEP = 128  # boxes compared with each other at once
FAR = 1e15  # corners at or beyond it count as missing
MOST_CROWDED = 1 << 20  # crowded images listed with the side of their tiles: 16 bytes each
DROP, WAIT, KEEP = 0, 1, 2  # a tile's vote on a box


def _overlap(a, b, method: str):
    """Shared area over the union, or over the smaller box; sides count both end pixels."""
    if method not in ("Union", "Min"):
        raise ValueError("method must be 'Union' or 'Min'")
    area_a = (a["x2"] - a["x1"] + 1) * (a["y2"] - a["y1"] + 1)
    area_b = (b["x2"] - b["x1"] + 1) * (b["y2"] - b["y1"] + 1)
    least, most, zero = (F.least, F.greatest, F.lit(0.0)) if isinstance(area_b, Column) else (np.minimum, np.maximum, 0.0)
    w = most(least(a["x2"], b["x2"]) - most(a["x1"], b["x1"]) + 1, zero)
    h = most(least(a["y2"], b["y2"]) - most(a["y1"], b["y1"]) + 1, zero)
    shared = w * h
    return shared / (least(area_a, area_b) if method == "Min" else area_a + area_b - shared)


def _clash(a: np.ndarray, b: np.ndarray, threshold: float, method: str) -> np.ndarray:
    """Which of the boxes ``a`` (rows) and ``b`` (columns) overlap by more than ``threshold``."""
    with np.errstate(all="ignore"):
        share = _overlap(dict(zip(CORNERS, a.T[:, :, None])), dict(zip(CORNERS, b.T[:, None, :])), method)
        # a box without corners or area shares nothing
        return np.nan_to_num(share, nan=0.0, posinf=0.0, neginf=0.0) > threshold


class _Ballot:
    """Votes on rows that come tile by tile, kept ones first, then best first.

    Of the tile being read it holds the boxes kept for certain and those that
    other tiles may still drop; nothing of the tiles before it.
    """

    def __init__(self, threshold: float, method: str, block: int):
        self.threshold, self.method, self.block = threshold, method, block
        self.tile = -1
        self._clear()

    def _clear(self):
        self.sure, self.open, self.taken = np.empty((0, 4)), np.empty((0, 4)), 0

    def _met(self, held: np.ndarray, corners: np.ndarray) -> np.ndarray:
        return _clash(held, corners, self.threshold, self.method).any(0) if len(held) else np.zeros(len(corners), bool)

    def votes(self, corners: np.ndarray, tile: np.ndarray, fixed: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """One vote per row; ``tile`` numbers the tiles, one number for each."""
        if tile[0] != self.tile:
            self.tile = tile[0]
            self._clear()
        dropped, unsure = np.zeros((2, len(tile)), bool)
        went_on = np.flatnonzero(tile == self.tile)
        dropped[went_on], unsure[went_on] = self._met(self.sure, corners[went_on]), self._met(self.open, corners[went_on])
        clash = np.triu(_clash(corners, corners, self.threshold, self.method), 1) & (tile[:, None] == tile)
        hits = clash.any(1)
        vote = np.full(len(tile), WAIT)
        certain, held = np.zeros((2, len(tile)), bool)
        for i, number in enumerate(tile):
            if number != self.tile:
                self.tile = number
                self._clear()
            # behind a full tile a box may miss what stands before it: it waits for the next round
            if not fixed[i] and (dropped[i] or self.taken >= self.block):
                continue
            vote[i] = WAIT if unsure[i] and not fixed[i] else KEEP
            certain[i] = fixed[i] or alone[i] and not unsure[i]
            held[i] = True
            self.taken += not fixed[i]
            if hits[i]:
                (dropped if certain[i] else unsure)[clash[i]] = True
        vote[dropped & ~fixed] = DROP
        held &= tile == self.tile
        self.sure = np.vstack([self.sure, corners[held & certain]])
        self.open = np.vstack([self.open, corners[held & ~certain]])
        return vote


def _vote(batches, threshold: float, method: str, block: int):
    """Adds a vote to every undecided row; a tile may go on in the next batch."""
    ballot, last, number = _Ballot(threshold, method, block), None, 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        n, keys = table.num_rows, table.select(["image_id", "tx", "ty"])
        if not n:
            continue
        other = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy() for c in keys.columns]
        first, final = keys.slice(0, 1).to_pylist(), keys.slice(n - 1).to_pylist()
        tile = number + (first != last) + np.r_[0, np.cumsum(np.any(other, 0))]
        last, number = final, int(tile[-1])
        corners = np.stack([table[c].cast(pa.float64()).to_numpy() for c in CORNERS], 1)
        corners[~(np.abs(corners) < FAR).all(1)] = np.nan
        fixed, alone = table["fixed"].to_numpy(), table["tiles"].to_numpy() == 1
        vote = np.concatenate([
            ballot.votes(corners[i:i + STEP], tile[i:i + STEP], fixed[i:i + STEP], alone[i:i + STEP]) for i in range(0, n, STEP)])
        out = table.append_column("vote", pa.array(vote.astype(np.int32))).filter(pa.array(~fixed))
        yield from out.drop_columns(["fixed", "tx", "ty", "tiles"]).to_batches()


def _placed(rows: DataFrame) -> DataFrame:
    """One row per tile that a box touches; images of no ``side``, and boxes without finite corners, have one tile."""
    finite = F.lit(True)
    for c in CORNERS:
        finite = finite & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(c) < FAR)
    tiled = F.col("side").isNotNull() & finite

    def stretch(low, high):
        # two pixels more than the box: both end pixels count, and sums are rounded
        first = F.floor(F.col(low) / F.col("side"))
        last = F.greatest(F.floor((F.col(high) + 2) / F.col("side")), first)
        return F.when(tiled, F.sequence(first, last)).otherwise(F.array(F.lit(0).cast("long")))

    rows = rows.withColumns({"_x": stretch("x1", "x2"), "_y": stretch("y1", "y2")})
    rows = rows.withColumn("tiles", F.size("_x") * F.size("_y"))
    return rows.withColumn("tx", F.explode("_x")).withColumn("ty", F.explode("_y")).drop("_x", "_y")


def crowded_images(boxes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(image_id, side)`` of the images with more than ``block`` boxes: the side of their tiles.

    A tile is four times as wide as a box is on average, so that a box lies in
    less than two tiles on average, whatever the sizes.  At most ``MOST_CROWDED``
    images are listed, the largest; the others are read as one tile each.
    """
    wide, high = (F.greatest(F.col(b) - F.col(a) + 1, F.lit(0.0)) for a, b in (("x1", "x2"), ("y1", "y2")))
    usual = [F.avg(F.when(F.abs(x) < FAR, x)) for x in (wide, high, wide * high)]
    side = 4 * F.greatest(usual[0], usual[1], F.sqrt(usual[2]), F.lit(1.0))
    stats = boxes.groupBy("image_id").agg(F.count("*").alias("n"), side.alias("side")).filter(F.col("n") > block)
    return stats.orderBy(F.col("n").desc(), "image_id").limit(MOST_CROWDED).select("image_id", "side")


def nms(boxes: DataFrame, threshold: float, method: str = "Union", block: int = BLOCK) -> DataFrame:
    """Non-maximum suppression per image: best score first (ties by box id), drop overlap > threshold.

    Images of at most ``block`` boxes are decided whole.  Others are cut into
    tiles, and a box goes to every tile that it touches, so that two boxes that
    overlap share one.  A tile reads its boxes best first and votes: drop (a kept
    box is in the way), wait (an undecided one may be) or keep.  A box is dropped
    by one vote and kept if all its tiles say so; what is left goes into the next
    round, where at least the best box of every image is decided.  A tile holds
    ``block`` undecided boxes at most.

    ``(image_id, box_id)`` names a box: rows that repeat one stay or go together,
    rows where either is null are left out.  Boxes with a null or non-finite
    corner overlap with nothing and stay.
    """
    names = boxes.columns
    if not 0 <= threshold:
        raise ValueError("threshold must be 0 or more")
    best = ["image_id", "tx", "ty", F.col("fixed").desc(), F.col("score").desc(), "box_id"]
    shape = boxes.select("image_id", "box_id", *CORNERS, "score").filter("image_id is not null and box_id is not null")
    crowded = materialize(crowded_images(shape, block), "nms-images")
    none = crowded.isEmpty()
    if none:
        left = shape.withColumn("side", F.lit(None).cast("double"))
    else:
        left = shape.dropDuplicates(["image_id", "box_id"]).join(F.broadcast(crowded), "image_id", "left")
    left = left.select(*shape.columns, "side", F.lit(False).alias("fixed"))
    schema = left.drop("fixed").withColumn("vote", F.lit(0)).schema
    kept = None
    while True:
        dealt = _placed(left).repartition("image_id", "tx", "ty").sortWithinPartitions(*best)
        voted = dealt.mapInArrow(lambda batches: _vote(batches, threshold, method, block), schema)
        if none:
            kept = voted.filter(F.col("vote") == KEEP)
            break
        row = F.struct(*CORNERS, "score", "side")
        ballot = voted.groupBy("image_id", "box_id").agg(F.min("vote").alias("vote"), F.any_value(row).alias("row"), F.count("*").alias("n"))
        ballot = materialize(ballot.filter(F.col("vote") > DROP).select("image_id", "box_id", "row.*", "vote", "n"), "nms")
        chosen = ballot.filter(F.col("vote") == KEEP)
        kept = chosen.select("image_id", "box_id") if kept is None else kept.unionByName(chosen.select("image_id", "box_id"))
        if ballot.filter(F.col("vote") == WAIT).isEmpty():
            break
        # a box of one tile has been held against all of it; one of several is shown to them once more
        left = ballot.filter((F.col("vote") == WAIT) | (F.col("n") > 1)).select(
            *shape.columns, "side", (F.col("vote") == KEEP).alias("fixed"))
    return boxes.join(kept.select("image_id", "box_id"), ["image_id", "box_id"], "left_semi").select(*names)


def box_regress(boxes: DataFrame, regression: list[str] = ("dx1", "dy1", "dx2", "dy2")) -> DataFrame:
    """Move each corner by its regression times the box's width or height."""
    w, h = F.col("x2") - F.col("x1") + 1, F.col("y2") - F.col("y1") + 1
    sizes = (w, h, w, h)
    moved = {c: F.col(c) + F.col(r) * s for c, r, s in zip(CORNERS, regression, sizes)}
    return boxes.withColumns(moved)


def box_to_square(boxes: DataFrame) -> DataFrame:
    """Grow the shorter side about the centre."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    side = F.greatest(w, h)
    left, top = F.col("x1") + w * 0.5 - side * 0.5, F.col("y1") + h * 0.5 - side * 0.5
    return boxes.withColumns({"x1": left, "y1": top, "x2": left + side, "y2": top + side})


def box_margin(boxes: DataFrame, margin: float, width, height) -> DataFrame:
    """Half the margin on every side, cut to the image, whole pixels."""
    half = margin / 2
    width, height = (F.col(x) if isinstance(x, str) else F.lit(x) for x in (width, height))
    return boxes.withColumns({
        "x1": F.greatest(F.col("x1") - half, F.lit(0.0)).cast("int"),
        "y1": F.greatest(F.col("y1") - half, F.lit(0.0)).cast("int"),
        "x2": F.least(F.col("x2") + half, width).cast("int"),
        "y2": F.least(F.col("y2") + half, height).cast("int"),
    })


def box_clip(boxes: DataFrame, width, height) -> DataFrame:
    """Cut boxes to the image."""
    return box_margin(boxes, 0.0, width, height)


def box_pad(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """Where a box leaves the image (1-based pixels): the part of the patch that is filled.

    Adds ``dx, edx, x, ex`` and the same for y, and the patch size ``tmpw, tmph``.
    """
    out = boxes
    for axis, low, high, limit, size in (("x", "x1", "x2", width, "tmpw"), ("y", "y1", "y2", height, "tmph")):
        lo, hi = F.col(low).cast("int"), F.col(high).cast("int")
        span = (F.col(high) - F.col(low) + 1).cast("int")
        out = out.withColumns({
            size: span,
            f"d{axis}": F.when(lo < 1, 2 - lo).otherwise(F.lit(1)),
            f"ed{axis}": F.when(hi > limit, limit - hi + span).otherwise(span),
            axis: F.greatest(lo, F.lit(1)),
            f"e{axis}": F.least(hi, F.lit(limit)),
        })
    return out


def boxes_from_heatmap(maps: DataFrame, threshold: float, scale: float) -> DataFrame:
    """Cells of ``(image_id, heat: array<array<double>>)`` at or above the threshold, as boxes."""
    rows = maps.select("image_id", F.posexplode("heat").alias("_row", "_cells"))
    cells = rows.select("image_id", "_row", F.posexplode("_cells").alias("_col", "score")).filter(F.col("score") >= threshold)

    def corner(position, offset):
        return ((F.lit(STRIDE) * F.col(position) + offset) / scale).cast("int").cast("double")

    return cells.select(
        "image_id", corner("_col", 1).alias("x1"), corner("_row", 1).alias("y1"),
        corner("_col", CELL).alias("x2"), corner("_row", CELL).alias("y2"), "score")


def confident(boxes: DataFrame, threshold: float = 0.5) -> DataFrame:
    return boxes.filter(F.col("score") > threshold)


def format_box(boxes: DataFrame) -> Column:
    return F.format_string("(%d, %d, %d, %d)", *[F.col(c).cast("int") for c in CORNERS])
