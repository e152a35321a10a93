"""SQL fragments shared by the checking queries (list sums run in index order)."""

V = "embedding::DOUBLE[]"
VECTORS = "vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"


def each(a, b, term):
    """Σ over components of ``term`` with z[1], z[2] the two values."""
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: {term}))"


def l2(a, b):
    return each(a, b, "(z[1]-z[2])*(z[1]-z[2])")


def ip(a, b):
    return each(a, b, "z[1]*z[2]")


def norm(a):
    return f"sqrt({ip(a, a)})"


def unit(a):
    return f"list_transform({a}, lambda x: x / {a}_n)"


def h(*parts, seed=0):
    """keyed_hash"""
    return f"('0x'||substr(md5(concat_ws(':', {', '.join(f'{p}::VARCHAR' for p in parts)}, '{seed}')),1,8))::BIGINT"


def u(*parts, seed=0):
    """keyed_uniform"""
    return f"({h(*parts, seed=seed)} / 4294967296.0::DOUBLE)"


def top(pairs, k, order="distance ASC", select="query_id, \"rank\", id, distance"):
    """Top-k per query of a FROM-able pair query."""
    return (
        f"SELECT {select} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, id)::INTEGER"
        f" AS \"rank\" FROM ({pairs})) WHERE \"rank\" <= {k}"
    )


def knn(dist, k, order="distance ASC", ctes="", q="vec", b="vec", select="query_id, \"rank\", id, distance", where=""):
    """Exact kNN of CTE ``q`` against CTE ``b`` (both (id, v))."""
    extra = f", {ctes}" if ctes else ""
    pairs = f"SELECT a.id AS query_id, b.id AS id, {dist} AS distance FROM {q} a, {b} b {where}"
    return f"WITH {VECTORS}{extra} {top(pairs, k, order, select)}"
