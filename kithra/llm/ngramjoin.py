"""Jaccard join of word shingles by parity sketches.

Every shingle flips one bit of a sketch, so the sketches of two sets differ in
at most as many bits as the sets do.  Sets that may link differ in at most d
elements, d given by their size band; of a sketch cut into more than d parts,
some are therefore equal in both.  Equal parts propose pairs; those whose sketches
differ in more bits than linked sets of their sizes can are dropped; of what is
left the shingle sets decide.  A part is far wider than its few shingles, so it is kept as the XOR of
a hash of each flipped bit.  Shingles that many texts of a sample share flip
nothing: leaving the same shingles out everywhere never adds a difference.
The sketches that are compared whole are narrow, some bits for each difference
that is allowed, and every shingle flips one of theirs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import running_counts, with_ordinal
from ..session import materialize, ship_package
from . import bytewords
from .components import components
from .hotjoin import hot_join, keep_ids
from .workers import lean

WIDTH = 3  # words of a shingle
PERCENT = 90  # links at 100 * shared >= PERCENT * together
PART_BITS = 1 << 24
BAND_GROWTH = 1.3  # upper edge of a size band over its lower one, unless linked sets can be further apart
HOT_SAMPLE, HOT_TEXTS = 4096, 4  # a shingle in more than so many of so many sampled texts is left out of the sketches
HOT_BYTES, HOT_LEFT_OUT = 1 << 16, 1 << 18  # longest text of the sample, and the shingles left out at most
BITS_APART = 4  # bits of a compared sketch for each difference that linked sets can have
ROUNDS, ROUND_SHARE = 3, 100  # rounds of stars; another one follows while one id in so many gets a link
PAIR_UP = 32  # members of a group that are paired with each other at once
NEAR_ROWS, NEAR_WORDS = 4096, 1 << 17  # bounds of a block of members whose sketches are compared
NEAR_PAIRS = 1 << 18  # pairs of them that are compared at once
CELL_ROWS, CELL_ELEMENTS, CELL_COLUMNS = 256, 200_000, 8192  # bounds of a block of members whose sets are compared


# ------------------------------------------------------------------ sketches

def bands(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Lower edges of the size bands up to ``largest``; each holds at least one size.

    Linked sets lie in one band or in two neighbours: n elements link to
    100 n / percent at most, and a band grows by that much at least.
    """
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH), int(100 * edges[-1] // percent)))
    return np.array(edges, np.int64)


def differing(top: int, percent: int) -> int:
    """How many elements two linked sets of at most ``top`` elements can differ in.

    With s shared elements, d others and similarity s / (s + d) at least p, the
    sizes add up to 2 s + d, so d is at most (1 - p) / (1 + p) of their sum.
    """
    return 2 * top * (100 - percent) // (100 + percent)


def part_values(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the parts that are not empty, and 32 bits for each; ``hashes`` is sorted."""
    # the part grows with the hash, so a part's shingles are neighbours
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cut = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
    if not len(cut):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    # equal bits cancel, as they do in the sketch itself
    value = np.bitwise_xor.reduceat(bytewords.mix(hashes & np.uint64(PART_BITS - 1)), cut)
    return part[cut].astype(np.int64), (value ^ (value >> np.uint64(32))).astype(np.uint32)


def spare(d: int, percent: int) -> int:
    """Parts beyond d + 1: rather more than are empty by chance in the smallest set of a band."""
    filled = percent / 100 / (max(BAND_GROWTH, 100 / percent) * 2 * (100 - percent) / (100 + percent))  # its shingles per part
    return 2 + int(d * min(0.5, 0.03 + 2 * math.exp(-filled / 1.1)))


def named_parts(cold: np.ndarray, hashes: np.ndarray, d: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values by which the set proposes pairs among sets that differ in at most ``d`` elements.

    Linked sets agree in more than ``spare`` parts.  If one of the two has no
    more empty parts than that, they agree in a part that is not empty; so
    parts that are not empty will do, but for sets with many empty ones.  Those
    name the parts of a second sketch too, from which no shingle is left out,
    and if many of these are empty as well, the empty ones with them.
    """
    more = spare(d, percent)
    parts = d + 1 + more
    places, values = part_values(cold, parts)
    if parts - len(places) <= more:
        return places, values
    second = np.zeros(parts, np.uint32)
    at, whole = part_values(hashes, parts)
    second[at] = whole
    if parts - len(at) > more:
        at = np.arange(parts)
    return np.concatenate([places, at + parts]), np.concatenate([values, second[at]])


def bit_sketch(hashes: np.ndarray, top: int, percent: int) -> np.ndarray:
    """64-bit words in which every shingle flips one bit; as wide for all sets of a band, of at most ``top`` elements."""
    width = 64 * max(1, -(-BITS_APART * differing(top, percent) // 64))
    at = ((bytewords.mix(hashes) >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)
    flips = np.bincount(at.astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<i8")


def band_sketches(hashes: np.ndarray, edges: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The set's sketch as sets of its band have it, and as those of the next band, if a set there may link to it."""
    n = len(hashes)
    band = int(np.searchsorted(edges, n, side="right")) - 1
    own, after = (bit_sketch(hashes, int(edges[k + 1]) - 1, percent) if k == band or 100 * n >= percent * int(edges[k])
                  else np.zeros(0, np.int64) for k in (band, band + 1))
    return own, after


def sketch_parts(hashes: np.ndarray, edges: np.ndarray, percent: int, hot: np.ndarray):
    """The set's size band, then places and part values there, and in the next band if a set there may link to it."""
    n = len(hashes)
    band = int(np.searchsorted(edges, n, side="right")) - 1
    cold = hashes
    if len(hot):
        at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
        cold = hashes[hot[at] != hashes]
    none = np.zeros(0, np.int64), np.zeros(0, np.uint32)
    # a band is joined by its own sets and by smaller ones that reach percent of its lower edge
    found = [named_parts(cold, hashes, differing(int(edges[k + 1]) - 1, percent), percent)
             if k == band or 100 * n >= percent * int(edges[k]) else none for k in (band, band + 1)]
    return band, *found[0], *found[1]


def hot_shingles(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Shingles of more than ``HOT_TEXTS`` of about ``HOT_SAMPLE`` texts chosen by hash; any answer is right, a good one is fast."""
    share = max(1, -(-docs.count() // HOT_SAMPLE))
    sample = docs.filter((F.octet_length(text) <= HOT_BYTES) & (F.pmod(F.xxhash64(text), F.lit(share)) == 0)).select(text).distinct()
    found = shingle_rows(sample, text, [], width).select(F.explode("shingles").alias("s")).groupBy("s").count()
    rows = found.filter(F.col("count") > HOT_TEXTS).orderBy(F.desc("count"), "s").limit(HOT_LEFT_OUT).select("s").collect()
    return np.sort(np.array([r["s"] for r in rows], np.int64).view(np.uint64))


def shingle_rows(docs: DataFrame, text: str, columns: list[str], width: int) -> DataFrame:
    """``columns`` plus ``shingles``, the sorted distinct 64-bit shingle hashes."""
    ship_package(docs.sparkSession)
    rows = docs.select(*columns, F.col(text).alias("_text"))
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns), "shingles array<long>"])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                sets = list(bytewords.shingle_sets(part.column(len(columns)), width))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _lists(sets)], [*columns, "shingles"])

    return rows.mapInArrow(lean(run), schema)


def _lists(arrays: list[np.ndarray], kind=np.uint64) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, kind)]).view(np.int64 if kind == np.uint64 else np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def sketched(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(key, n_shingles, print, band, own_at, own, next_at, next, own_bits, next_bits).

    The set's size, 128 bits that stand for it, and its sketches' parts and bits, in its own band and the next.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("_text"))
    nothing = 0, *[np.zeros(0, np.int64), np.zeros(0, np.uint32)] * 2
    no_bits = np.zeros(0, np.int64), np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(hot_shingles(docs, text, width))

    def run(batches):
        edges = bands(1 << 10, percent)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                sizes, prints, parts, bits = [], [], [], []
                for found in bytewords.shingle_sets(part.column(1), width):
                    if len(found) * 2 > edges[-2]:
                        edges = bands(int(400 * len(found) // percent), percent)
                    sizes.append(len(found))
                    # sums over the set in two independent mixes: order and batches do not matter
                    prints.append(np.array([found.sum(), bytewords.mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64).tobytes())
                    parts.append(sketch_parts(found, edges, percent, shared.value) if len(found) else nothing)
                    bits.append(band_sketches(found, edges, percent) if len(found) else no_bits)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array([x[0] for x in parts], pa.int32()),
                     *[_lists([x[k].astype(np.uint32) for x in parts], np.uint32) for k in (1, 2, 3, 4)],
                     *[_lists([x[k].view(np.uint64) for x in bits]) for k in (0, 1)]],
                    ["key", "n_shingles", "print", "band", "own_at", "own", "next_at", "next", "own_bits", "next_bits"])

    return rows.mapInArrow(lean(run), f"key {docs.schema[key].dataType.simpleString()}, n_shingles long, print binary, "
                                "band int, own_at array<int>, own array<int>, next_at array<int>, next array<int>, own_bits array<long>, next_bits array<long>")


def part_keys(rows: DataFrame) -> DataFrame:
    """(id, value): one row per sketch part; the value tells band, place and content of the part."""
    def keyed(places, parts, band):
        return F.zip_with(places, parts, lambda i, v: F.xxhash64(v, i, band))

    both = F.concat(keyed(F.col("own_at"), F.col("own"), F.col("band")), keyed(F.col("next_at"), F.col("next"), F.col("band") + 1))
    return rows.select("id", F.explode(both).alias("value"))


def shared_parts(parts: DataFrame) -> DataFrame:
    """The rows (value, id) of values that several ids have; most values stand once and are dropped here."""
    spread = parts.repartition(F.col("value"))
    # the ids are asked for on both sides, so that both read one exchange
    often = spread.groupBy("value").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("value")
    return spread.join(often, "value").select("value", "id").distinct()


# ------------------------------------------------------------------ join

def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link; ``sets`` is (id, shingles).

    The sets of one side are put beside their pairs before the shuffle by the
    other, so an id with many pairs meets its own set there once.
    """
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    sized = pairs.join(b, "b").join(a, "a")
    # sizes that cannot reach the ratio are never intersected
    fits = (100 * F.least(F.size("sa"), F.size("sb")) >= percent * F.greatest(F.size("sa"), F.size("sb")))
    shared = F.size(F.array_intersect("sa", "sb"))
    return sized.filter(fits).filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by their sizes and by the bits in which their sketches differ.

    ``sketches`` is (id, n_shingles, band, own_bits, next_bits).  Two sets differ in at least as many
    elements as their sketches in bits, and linked ones in a bounded share of their sizes.
    """
    def side(name):
        return sketches.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n_shingles", "band", "own_bits", "next_bits")])

    rows = pairs.join(side("b"), "b").join(side("a"), "a")
    up, down = F.col("band_a") + 1 == F.col("band_b"), F.col("band_a") == F.col("band_b") + 1
    left = F.when(up, F.col("next_bits_a")).otherwise(F.col("own_bits_a"))
    right = F.when(down, F.col("next_bits_b")).otherwise(F.col("own_bits_b"))
    differ = F.aggregate(F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    least, most = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    rows = rows.filter(F.abs(F.col("band_a") - F.col("band_b")) <= 1).filter(100 * least >= percent * most)
    return rows.filter(differ * (100 + percent) <= (100 - percent) * (least + most)).select("a", "b").distinct()


def decided(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link: sketches first, and sets are made of the texts that are left."""
    close = materialize(near(pairs, sketches, percent), "close")
    ids = materialize(close.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "close-ids")
    sets = materialize(shingle_rows(keep_ids(texts, ids, "id"), "text", ["id"], width), "shingles")
    return verified(close, sets, percent)


def linked(parts: DataFrame, sketches: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(a, b): links whose components are those of all links; ``parts`` is (id, value), ``texts`` (id, text).

    Candidate pairs are the members of equal sketch parts.  Members already in
    one component need no comparison, so each group is first compared with one
    of its members: its smallest id, then the one with the most links, then any,
    as long as that links many.  Of groups that are still in several components,
    the small ones are paired up; large ones are joined to families, whose
    members are compared block by block (see ``_compared``).
    """
    groups = materialize(shared_parts(parts), "parts")
    concerned = groups.select("id").distinct().count()
    if not concerned:
        return groups.select(F.col("id").alias("a"), F.col("id").alias("b"))
    groups = groups.withColumn("component", F.col("id")).withColumn("links", F.lit(0).cast("long"))
    links, known = None, 0
    for turn in range(ROUNDS):
        pairs = _stars(groups, turn).filter("component != head_component").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b"))
        found = decided(pairs.distinct(), sketches, texts, width, percent)
        links = materialize(found if links is None else links.unionByName(found).distinct(), "links")
        before, known = known, links.count()
        joined = _labels(links)
        groups = groups.select("value", "id").join(joined, "id", "left").select(
            "value", "id", F.coalesce("component", "id").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
        groups = materialize(groups, "groups")
        # groups whose members all have one label are done
        unlike = materialize(groups.groupBy("value").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("value", "n"), "unlike")
        groups = materialize(hot_join(groups, unlike, "value"), "groups")
        if turn and (known - before) * ROUND_SHARE < concerned:
            break
    small, large = groups.filter(f"n <= {PAIR_UP}"), groups.filter(f"n > {PAIR_UP}")
    pairs = _pairs(small).distinct()
    links = links.unionByName(decided(pairs, sketches, texts, width, percent))
    return links if large.isEmpty() else links.unionByName(_compared(large, sketches, texts, width, percent))


def _pairs(groups: DataFrame) -> DataFrame:
    """(a, b): members of one group and of different components."""
    a = groups.select("value", F.col("id").alias("a"), F.col("component").alias("ca"))
    b = groups.select("value", F.col("id").alias("b"), F.col("component").alias("cb"))
    return a.join(b, "value").filter("a < b and ca != cb").select("a", "b")


def _labels(links: DataFrame) -> DataFrame:
    """(id, component, links): the smallest id linked to it or itself, and the number of its links.

    Ids of one label are in one component; some of a component may have others,
    and are only compared more often than need be.
    """
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionAll(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    return ends.groupBy("id").agg(F.least(F.min("other"), F.first("id")).alias("component"), F.count(F.lit(1)).alias("links"))


def _stars(groups: DataFrame, turn: int = 1) -> DataFrame:
    """Adds each group's head: its smallest id, in turn 1 the member with the most links, later any, by hash."""
    first = {0: F.lit(0), 1: -F.col("links")}.get(turn, F.xxhash64("id", F.lit(turn)))
    best = groups.groupBy("value").agg(F.min(F.struct(first.alias("l"), "id", "component")).alias("h"), F.count("*").alias("m"))
    heads = materialize(best.select("value", F.col("h.id").alias("head"), F.col("h.component").alias("head_component"), "m"), "heads")
    return hot_join(groups.select("value", "id", "component"), heads, "value", "m").drop("m")


def _blocks(members: DataFrame, size, limit: int) -> DataFrame:
    """Members with their ``block``: in order of family and component, up to ``limit`` of the summed ``size`` in each."""
    ordered = materialize(with_ordinal(members, ["family", "component", "id"], "place").withColumn("size", size), "ordered")
    # sums over stretches of the order, then over the stretches: no task sums up a whole family
    stretch = F.floor(F.col("place") / F.lit(CELL_ROWS))
    sums = ordered.groupBy(stretch.alias("stretch")).agg(F.sum("size").alias("s"))
    block = materialize(running_counts(sums.select(F.col("stretch").alias("x"), F.col("s").alias("n"))).select(
        F.col("x").alias("stretch"), F.floor(F.col("before") / F.lit(limit)).alias("block")), "stretches")
    return ordered.withColumn("stretch", stretch).join(block, "stretch").drop("stretch", "place", "size")


def _cells(placed: DataFrame) -> DataFrame:
    """(family, i, j, block): the pairs of blocks of a family that meet, once for each of the two.

    Blocks of one and the same component do not meet.
    """
    blocks = placed.groupBy("family", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    one = blocks.select("family", F.col("block").alias("i"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"))
    two = blocks.select("family", F.col("block").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"))
    cells = one.join(two, "family").filter("i <= j and not (lo_i = hi_i and lo_j = hi_j and lo_i = lo_j)").select("family", "i", "j")
    return cells.select("family", F.col("i").alias("block"), "i", "j").unionByName(
        cells.filter("i < j").select("family", F.col("j").alias("block"), "i", "j"))


def _compared(groups: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links between members of different components that share a group, a spanning forest of each cell's.

    A family is a component of the groups' stars, so it holds all candidate
    pairs of its members.  Its members' sketches are compared in large blocks;
    those that are near no member of another component go.  The rest is cut
    into blocks of bounded size, in the order of the members' components; each
    pair of blocks is one task's cell, which returns fewer links than it has
    members.
    """
    stars = _stars(groups)
    family = components(stars.select(F.col("id").alias("a"), F.col("head").alias("b")))
    members = groups.select("id", "component").distinct().join(family.withColumnRenamed("component", "family"), "id")
    drawn = members.join(sketches.select("id", "n_shingles", "band", "own_bits", "next_bits"), "id")
    words = F.size("own_bits") + F.size("next_bits") + F.lit(max(1, NEAR_WORDS // NEAR_ROWS))
    placed = materialize(_blocks(drawn, words, NEAR_WORDS), "families")
    rows = placed.join(_cells(placed), ["family", "block"])

    def close(table: pa.Table) -> pa.Table:
        return near_members(table, percent)

    left = rows.groupBy("family", "i", "j").applyInArrow(close, "id long")
    left = materialize(left.distinct(), "near-members")
    sets = materialize(shingle_rows(keep_ids(texts, left, "id"), "text", ["id"], width), "shingles")
    sized = members.join(left, "id").join(sets.groupBy("id").agg(F.sum(F.size("shingles")).alias("n")), "id")
    placed = materialize(_blocks(sized, F.greatest("n", F.lit(CELL_ELEMENTS // CELL_ROWS)), CELL_ELEMENTS), "families")
    rows = placed.join(_cells(placed), ["family", "block"]).join(sets, "id").select("family", "i", "j", "block", "id", "component", "shingles")

    def cell(table: pa.Table) -> pa.Table:
        return cell_links(table, percent)

    return rows.groupBy("family", "i", "j").applyInArrow(cell, "a long, b long")


def near_members(table: pa.Table, percent: int) -> pa.Table:
    """Ids of the cell's members whose sketch is near that of a member of another component."""
    ids, component, sizes, bands_ = (table[c].to_numpy() for c in ("id", "component", "n_shingles", "band"))
    kept = np.zeros(len(ids), bool)
    for band in np.unique(bands_):
        here, under = np.flatnonzero(bands_ == band), np.flatnonzero(bands_ == band - 1)
        own = _bit_matrix(table["own_bits"], here)
        # smaller sets that cannot reach this band have no sketch for it
        under = under[pc.list_value_length(table["next_bits"]).to_numpy()[under] > 0]
        for who, bits in ((here, own), (under, _bit_matrix(table["next_bits"], under))):
            step = max(1, NEAR_PAIRS // len(here))
            for low in range(0, len(who), step):
                mine = who[low:low + step]
                differ = np.zeros((len(mine), len(here)), np.int64)
                for w in range(own.shape[1]):
                    differ += np.bitwise_count(bits[low:low + step, w][:, None] ^ own[:, w][None, :])
                a, b = sizes[mine][:, None], sizes[here][None, :]
                close = (differ * (100 + percent) <= (100 - percent) * (a + b)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
                close &= component[mine][:, None] != component[here][None, :]
                kept[mine[close.any(axis=1)]] = True
                kept[here[close.any(axis=0)]] = True
    return pa.table({"id": pa.array(np.unique(ids[kept]), pa.int64())})


def _bit_matrix(column: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    taken = column.take(pa.array(rows)).combine_chunks()
    return taken.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), np.int64)


def cell_links(table: pa.Table, percent: int) -> pa.Table:
    """Links of one cell's members that join different components, as a spanning forest."""
    ids, component = table["id"].to_numpy(), table["component"].to_numpy()
    lists = table["shingles"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    hashes = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(ids)), size)
    # only shingles of several members can be shared
    _, word, times = np.unique(hashes, return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    kept = often[word]
    owner, word = owner[kept], number[word[kept]]
    shared = np.zeros((len(ids), len(ids)), np.int64)
    for start in range(0, int(often.sum()), CELL_COLUMNS):
        here = (word >= start) & (word < start + CELL_COLUMNS)
        held = np.zeros((len(ids), CELL_COLUMNS), np.float32)
        held[owner[here], word[here] - start] = 1
        shared += np.rint(held @ held.T).astype(np.int64)
    linked = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
    root = {c: c for c in component.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for p, q in zip(*(x.tolist() for x in np.nonzero(np.triu(linked & (component[:, None] != component[None, :]), 1)))):
        a, b = find(int(component[p])), find(int(component[q]))
        if a != b:
            root[a] = b
            found.append((int(ids[p]), int(ids[q])))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})


def ngram_jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                          percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id (smallest key reachable by links).

    Texts with equal sets are one class, represented by its smallest key, so
    copies cost one row.  Empty and null texts have no shingles and are linked
    with nothing; a null key forms no links and has a null component; rows that
    repeat a key are one document that holds the links of all its texts.
    ``key`` must be an integer column.  Shingles are compared by 64-bit hashes.
    """
    ship_package(docs.sparkSession)
    rows = materialize(sketched(docs, key, text, width, percent), "sketches")
    known = rows.filter("key is not null and n_shingles > 0").withColumn("id", F.col("key").cast("long"))
    classes = materialize(known.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    # texts that repeat a smaller key's set are left out by a lookup, so that no sketch is shuffled
    copies = hot_join(known.select("id", "print"), classes, "print").filter("id != rep").select("id", "print").distinct()
    parts = part_keys(keep_ids(known, materialize(copies, "copies"), ["id", "print"], "left_anti"))
    texts = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = known.select("id", "n_shingles", "band", "own_bits", "next_bits")
    links = linked(parts, sketches, texts, width, percent)
    # a key with several texts stands for several classes, which it links
    several = known.groupBy("id").agg(F.count_distinct("print").alias("texts")).filter("texts > 1").select("id")
    joint = known.select("id", "print").join(several, "id").join(classes, "print").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(joint))
    named = classes.join(found, classes["rep"] == found["id"], "left")
    named = materialize(named.select("print", F.coalesce("component", "rep").alias("component_id"), "n"), "named")
    inside = hot_join(known.select("key", "n_shingles", "print"), named, "print").select("key", "n_shingles", "component_id")
    outside = rows.filter("key is null or n_shingles = 0").select("key", "n_shingles", F.col("key").cast("long").alias("component_id"))
    return inside.unionByName(outside).withColumnRenamed("key", key)
