"""Recommendation, voting and detection boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import boxes as bx
from ..operators import recommend, votes
from .q_cells import NLIST, centres
from .q_search import SCALED, UNITS, scaled
from .registry import Tables, query
from .snippets import VECTORS, ip, knn as knn_sql, l2, norm

RATINGS = (
    "rat AS (SELECT o_custkey AS usr, l_partkey AS item, 1.0::DOUBLE + l_quantity % 5 AS rating FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
)


@query("label_encode", f"WITH {RATINGS} SELECT usr AS \"user\", row_number() OVER (ORDER BY usr) - 1 AS code, count(*) AS rows FROM rat GROUP BY usr")
def _(t: Tables):
    return recommend.label_encode(t.ratings, "user")


@query("label_encode_text", "SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code, count(*) AS rows FROM part GROUP BY p_name")
def _(t: Tables):
    return recommend.label_encode(t("part"), "p_name")


@query("id_map_join", "WITH v AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM part GROUP BY p_name) SELECT p_partkey AS id, code FROM part JOIN v USING (p_name)")
def _(t: Tables):
    ids = recommend.label_encode(t("part"), "p_name")
    return recommend.id_map_join(t("part").select("p_partkey", "p_name"), ids, "p_name").select(F.col("p_partkey").alias("id"), "code")


@query("ratings_to_sparse", f"""WITH {RATINGS}, u AS (SELECT usr, row_number() OVER (ORDER BY usr) - 1 AS r FROM rat GROUP BY usr),
  i AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS c FROM rat GROUP BY item)
  SELECT r AS "row", c AS col, sum(rating) AS value FROM rat JOIN u USING (usr) JOIN i USING (item) GROUP BY r, c""")
def _(t: Tables):
    return recommend.to_sparse(t.ratings)


@query("matrix_factorization_items")
def _(t: Tables):
    """Non-negative item factors of the observed ratings."""
    return recommend.matrix_factorization(t.ratings, rank=20, iterations=3)[1]


@query("matrix_factorization_zero_filled")
def _(t: Tables):
    return recommend.matrix_factorization(t.ratings, rank=20, iterations=3, fill_zero=True)[0]


@query("cosine_factor_neighbours")
def _(t: Tables):
    users, items = recommend.cosine_factors(t.ratings)
    return recommend.u2i(users, items, 10)


@query("u2i", knn_sql(ip("a.v", "b.v"), 10, "distance DESC",
       f"{SCALED}, {UNITS}, nvec AS (SELECT id, list_transform(v, lambda x: x / n) AS v FROM (SELECT id, v, {norm('v')} AS n FROM vec))", q="nvec", b="uvec"))
def _(t: Tables):
    return recommend.u2i(t.vectors, scaled(t.vectors, "id"), 10)


@query("i2i", knn_sql(ip("a.v", "b.v"), 10, "distance DESC", f"{SCALED}, {UNITS}", q="uvec", b="uvec"))
def _(t: Tables):
    return recommend.i2i(scaled(t.vectors, "id"), 10)


@query("recommend_user", f"WITH {VECTORS}, {SCALED} SELECT b.id, {ip('a.v', 'b.v')} AS score FROM vec a, svec b WHERE a.id = 7 ORDER BY score DESC, b.id LIMIT 12")
def _(t: Tables):
    return recommend.recommend_user(t.vectors, scaled(t.vectors, "id"), 7, 12)


@query("history_neighbours", knn_sql(ip("a.v", "b.v"), 20, "distance DESC", f"{SCALED}, {UNITS}", q="uvec", b="uvec"))
def _(t: Tables):
    rows = scaled(t.vectors, "id")
    return recommend.history_neighbours(rows, centres(t), k=20, nprobe=NLIST)


@query("auc", f"""WITH {RATINGS}, s AS (SELECT l_extendedprice AS x, (1.0 + l_quantity % 5) / 5 >= 0.75 AS pos FROM lineitem),
  g AS (SELECT x, count(*) AS n, count(*) FILTER (WHERE pos) AS p FROM s GROUP BY x), r AS (SELECT *, sum(n) OVER (ORDER BY x) - n + (n + 1) / 2.0::DOUBLE AS rk FROM g)
  SELECT round((sum(p * rk) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p)::DOUBLE * (sum(n) - sum(p))), 9) AS auc FROM r""")
def _(t: Tables):
    liked = (F.lit(1.0) + F.col("l_quantity") % 5) / 5 >= recommend.LIKED
    return recommend.auc(t("lineitem"), liked, "l_extendedprice").withColumn("auc", F.round("auc", 9))


@query("mae", "SELECT round(avg(abs(1.0 + l_quantity % 5 - (1 + l_tax * 50))), 6) AS mae FROM lineitem")
def _(t: Tables):
    rows = t("lineitem").select((F.lit(1.0) + F.col("l_quantity") % 5).alias("actual"), (1 + F.col("l_tax") * 50).alias("predicted"))
    return recommend.mae(rows, "actual", "predicted").withColumn("mae", F.round("mae", 6))


# ------------------------------------------------------------------- votes

VOTES = f"""d AS (SELECT id AS query_id, id // 10 AS image, v FROM vec), near AS (SELECT query_id, q, img FROM (SELECT a.query_id, a.image AS q, b.image AS img,
   row_number() OVER (PARTITION BY a.query_id ORDER BY {l2('a.v', 'b.v')}, b.image) AS r FROM d a, d b) WHERE r <= 8),
  vt AS (SELECT q AS image_id, img AS id, count(DISTINCT query_id) AS votes FROM near GROUP BY q, img),
  vm AS (SELECT * FROM (SELECT image_id, id, votes, row_number() OVER (PARTITION BY image_id ORDER BY votes DESC, id)::INTEGER AS "rank" FROM vt WHERE votes >= 2) WHERE "rank" <= 8),
  conf AS (SELECT image_id, "rank", id, votes, 100.0::DOUBLE * votes / n AS confidence FROM vm JOIN (SELECT image AS image_id, count(*) AS n FROM d GROUP BY image) USING (image_id))"""


def _descriptors(t: Tables):
    image = F.floor(F.col("id") / 10)
    asked = t.vectors.select(image.alias("image_id"), F.col("id").alias("query_id"), "vector")
    return asked, t.vectors.select(image.alias("id"), "vector")


@query("vote_match", f"WITH {VECTORS}, {VOTES} SELECT image_id, \"rank\", id, votes, confidence FROM conf")
def _(t: Tables):
    asked, base = _descriptors(t)
    return votes.vote_match(asked, base, 8, min_votes=2)


@query("best_and_similar", f"""WITH {VECTORS}, {VOTES}, o AS (SELECT image_id, list(id ORDER BY confidence DESC, id) AS ids, max(confidence) AS confidence FROM conf GROUP BY image_id)
  SELECT image_id, ids[1] AS best, confidence, ids[2:] AS similar FROM o""")
def _(t: Tables):
    asked, base = _descriptors(t)
    return votes.best_and_similar(votes.vote_match(asked, base, 8, min_votes=2))


# ------------------------------------------------------------------- boxes

BOX = (
    "box AS (SELECT l_orderkey AS image_id, 100 * (l_linenumber + 100 * l_suppkey + 100000 * l_partkey) + l_quantity::BIGINT AS box_id, (l_partkey % 40)::DOUBLE - 5 AS x1, (l_suppkey % 30)::DOUBLE - 4 AS y1,"
    " (l_partkey % 40)::DOUBLE + 5 + l_quantity AS x2, (l_suppkey % 30)::DOUBLE + 8 + l_quantity / 2 AS y2, l_discount * 10 AS score,"
    " l_tax AS dx1, l_discount AS dy1, l_tax * 2 AS dx2, l_discount * 2 AS dy2 FROM lineitem)"
)


def boxes(t: Tables):
    c = F.col
    x, y = (c("l_partkey") % 40).cast("double"), (c("l_suppkey") % 30).cast("double")
    return t("lineitem").select(
        c("l_orderkey").alias("image_id"), (100 * (c("l_linenumber") + 100 * c("l_suppkey") + 100000 * c("l_partkey")) + c("l_quantity").cast("long")).alias("box_id"),
        (x - 5).alias("x1"), (y - 4).alias("y1"), (x + 5 + c("l_quantity")).alias("x2"), (y + 8 + c("l_quantity") / 2).alias("y2"),
        (c("l_discount") * 10).alias("score"), c("l_tax").alias("dx1"), c("l_discount").alias("dy1"),
        (c("l_tax") * 2).alias("dx2"), (c("l_discount") * 2).alias("dy2"))


CORNERS = ["x1", "y1", "x2", "y2"]


def _nms_sql(limit, over, box=BOX):
    """Greedy by recursion over the rank of a box in its image, carrying the boxes kept so far."""
    shared = ("(greatest(least(k.x2, b.x2) - greatest(k.x1, b.x1) + 1, 0.0) * greatest(least(k.y2, b.y2) - greatest(k.y1, b.y1) + 1, 0.0))")
    area = "(({0}.x2 - {0}.x1 + 1) * ({0}.y2 - {0}.y1 + 1))"
    both = f"least({area.format('k')}, {area.format('b')})" if over == "Min" else f"({area.format('k')} + {area.format('b')} - {shared})"
    clash = shared.replace("k.", "z.") + " / " + both.replace("k.", "z.")
    return f"""WITH RECURSIVE {box}, o AS (SELECT image_id, box_id, score, {{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} AS b, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, box_id) AS r FROM box),
  run(image_id, r, kept, ids) AS (SELECT image_id, 1::BIGINT, [b], [box_id] FROM o WHERE r = 1
   UNION ALL SELECT run.image_id, o.r, CASE WHEN len(list_filter(run.kept, lambda z: {clash.replace('b.', 'o.b.')} > {limit})) = 0 THEN list_append(run.kept, o.b) ELSE run.kept END,
    CASE WHEN len(list_filter(run.kept, lambda z: {clash.replace('b.', 'o.b.')} > {limit})) = 0 THEN list_append(run.ids, o.box_id) ELSE run.ids END
   FROM run JOIN o ON o.image_id = run.image_id AND o.r = run.r + 1),
  last AS (SELECT image_id, unnest(ids) AS box_id FROM (SELECT image_id, ids, row_number() OVER (PARTITION BY image_id ORDER BY r DESC) AS z FROM run) WHERE z = 1)
  SELECT box.image_id, box.box_id, x1, y1, x2, y2, score FROM box JOIN last ON box.image_id = last.image_id AND box.box_id = last.box_id"""


@query("nms_union", _nms_sql(0.5, "Union"))
def _(t: Tables):
    return bx.nms(boxes(t), 0.5).select("image_id", "box_id", *CORNERS, "score")


CROWD = (
    "box AS (SELECT 10 * l_suppkey + l_linenumber AS image_id, 100 * (l_partkey + 100000 * l_orderkey) + l_quantity::BIGINT AS box_id, (l_partkey % 200)::DOUBLE AS x1, (l_orderkey % 150)::DOUBLE AS y1,"
    " (l_partkey % 200)::DOUBLE + 5 + l_quantity AS x2, (l_orderkey % 150)::DOUBLE + 8 + l_quantity / 2 AS y2, l_extendedprice AS score FROM lineitem)"
)


@query("nms_crowded", _nms_sql(0.3, "Union", CROWD))
def _(t: Tables):
    """Images of many boxes, cut into tiles."""
    c = F.col
    x, y = (c("l_partkey") % 200).cast("double"), (c("l_orderkey") % 150).cast("double")
    crowd = t("lineitem").select(
        (10 * c("l_suppkey") + c("l_linenumber")).alias("image_id"),
        (100 * (c("l_partkey") + 100000 * c("l_orderkey")) + c("l_quantity").cast("long")).alias("box_id"), x.alias("x1"), y.alias("y1"),
        (x + 5 + c("l_quantity")).alias("x2"), (y + 8 + c("l_quantity") / 2).alias("y2"), c("l_extendedprice").alias("score"))
    return bx.nms(crowd, 0.3, block=16).select("image_id", "box_id", *CORNERS, "score")


@query("nms_min", _nms_sql(0.6, "Min"))
def _(t: Tables):
    return bx.nms(boxes(t), 0.6, "Min").select("image_id", "box_id", *CORNERS, "score")


@query("box_regress", f"""WITH {BOX} SELECT box_id, image_id, round(x1 + dx1 * (x2 - x1 + 1), 6) AS x1, round(y1 + dy1 * (y2 - y1 + 1), 6) AS y1,
  round(x2 + dx2 * (x2 - x1 + 1), 6) AS x2, round(y2 + dy2 * (y2 - y1 + 1), 6) AS y2 FROM box""")
def _(t: Tables):
    out = bx.box_regress(boxes(t))
    return out.select("box_id", "image_id", *[F.round(c, 6).alias(c) for c in CORNERS])


@query("box_to_square", f"""WITH {BOX}, s AS (SELECT box_id, image_id, x1, y1, x2 - x1 AS w, y2 - y1 AS h, greatest(x2 - x1, y2 - y1) AS l FROM box)
  SELECT box_id, image_id, x1 + w*0.5 - l*0.5 AS x1, y1 + h*0.5 - l*0.5 AS y1, x1 + w*0.5 - l*0.5 + l AS x2, y1 + h*0.5 - l*0.5 + l AS y2 FROM s""")
def _(t: Tables):
    return bx.box_to_square(boxes(t)).select("box_id", "image_id", *CORNERS)


@query("box_margin", f"""WITH {BOX} SELECT box_id, image_id, trunc(greatest(x1 - 16.0, 0))::INTEGER AS x1, trunc(greatest(y1 - 16.0, 0))::INTEGER AS y1,
  trunc(least(x2 + 16.0, 64))::INTEGER AS x2, trunc(least(y2 + 16.0, 48))::INTEGER AS y2 FROM box""")
def _(t: Tables):
    return bx.box_margin(boxes(t), 32.0, 64, 48).select("box_id", "image_id", *CORNERS)


@query("box_clip", f"""WITH {BOX} SELECT box_id, image_id, trunc(greatest(x1, 0))::INTEGER AS x1, trunc(greatest(y1, 0))::INTEGER AS y1,
  trunc(least(x2, 64))::INTEGER AS x2, trunc(least(y2, 48))::INTEGER AS y2 FROM box""")
def _(t: Tables):
    return bx.box_clip(boxes(t), 64, 48).select("box_id", "image_id", *CORNERS)


@query("box_pad", f"""WITH {BOX}, i AS (SELECT box_id, image_id, trunc(x1)::INTEGER AS x1, trunc(y1)::INTEGER AS y1, trunc(x2)::INTEGER AS x2, trunc(y2)::INTEGER AS y2,
    trunc(x2 - x1 + 1)::INTEGER AS tmpw, trunc(y2 - y1 + 1)::INTEGER AS tmph FROM box)
  SELECT box_id, image_id, tmpw, tmph, CASE WHEN x1 < 1 THEN 2 - x1 ELSE 1 END AS dx, CASE WHEN y1 < 1 THEN 2 - y1 ELSE 1 END AS dy,
   CASE WHEN x2 > 60 THEN 60 - x2 + tmpw ELSE tmpw END AS edx, CASE WHEN y2 > 40 THEN 40 - y2 + tmph ELSE tmph END AS edy,
   greatest(x1, 1) AS x, greatest(y1, 1) AS y, least(x2, 60) AS ex, least(y2, 40) AS ey FROM i""")
def _(t: Tables):
    names = ["tmpw", "tmph", "dx", "dy", "edx", "edy", "x", "y", "ex", "ey"]
    return bx.box_pad(boxes(t), 60, 40).select("box_id", "image_id", *names)


@query("boxes_from_heatmap", f"""WITH {VECTORS}, g AS (SELECT id, generate_subscripts(v, 1) - 1 AS i, unnest(v) AS s FROM vec)
  SELECT id AS image_id, trunc((2 * (i % 8) + 1) / 0.6)::DOUBLE AS x1, trunc((2 * (i // 8) + 1) / 0.6)::DOUBLE AS y1,
   trunc((2 * (i % 8) + 12) / 0.6)::DOUBLE AS x2, trunc((2 * (i // 8) + 12) / 0.6)::DOUBLE AS y2, s AS score FROM g WHERE s >= 0.15""")
def _(t: Tables):
    heat = t.vectors.select(F.col("id").alias("image_id"), arrays.reshape(arrays.doubles("vector"), 8).alias("heat"))
    return bx.boxes_from_heatmap(heat, 0.15, 0.6)


@query("confident_boxes", f"WITH {BOX} SELECT box_id, image_id, score FROM box WHERE score > 0.5")
def _(t: Tables):
    return bx.confident(boxes(t)).select("box_id", "image_id", "score")
