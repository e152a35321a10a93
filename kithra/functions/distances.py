"""Scalar distance expressions ``dist(a, b)`` on vectors, bits and sets.

``l2`` is the squared Euclidean distance.  ``ip`` and ``cosine`` are
similarities: larger is nearer.  Vectors of different length give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import array_total, col, dot, doubles, l2_normalize

# distances where a larger value means nearer
SIMILARITIES = ("ip", "cosine")


def _sum_over(a, b, term) -> Column:
    return array_total(F.zip_with(doubles(a), doubles(b), term))


def l2(a, b) -> Column:
    return _sum_over(a, b, lambda x, y: (x - y) * (x - y))


def ip(a, b) -> Column:
    return dot(a, b)


def cosine(a, b) -> Column:
    return dot(l2_normalize(a), l2_normalize(b))


def angular(a, b) -> Column:
    return angle_of(cosine(a, b))


def angle_of(cos) -> Column:
    """arccos(cos)/π of a clamped cosine."""
    return F.acos(F.least(F.greatest(cos, F.lit(-1.0)), F.lit(1.0))) / F.pi()


def euclid(a, b) -> Column:
    return F.sqrt(l2(a, b))


def l1(a, b) -> Column:
    return _sum_over(a, b, lambda x, y: F.abs(x - y))


def linf(a, b) -> Column:
    return F.array_max(F.zip_with(doubles(a), doubles(b), lambda x, y: F.abs(x - y)))


def lp(a, b, p: float) -> Column:
    """Σ|x−y|^p; the root is left out, the order is the same."""
    return _sum_over(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p))))


def canberra(a, b) -> Column:
    """Σ|x−y| / (|x|+|y|) with 0/0 = 0."""
    def term(x, y):
        total = F.abs(x) + F.abs(y)
        return F.when(total == 0, F.lit(0.0)).otherwise(F.abs(x - y) / F.when(total != 0, total))

    return _sum_over(a, b, term)


def braycurtis(a, b) -> Column:
    """Σ|x−y| / Σ|x+y|; two zero vectors are at distance 0."""
    total = _sum_over(a, b, lambda x, y: F.abs(x + y))
    return F.when(total == 0, F.lit(0.0)).otherwise(l1(a, b) / F.when(total != 0, total))


def jensenshannon(a, b) -> Column:
    """½KL(a‖m)+½KL(b‖m), m the midpoint, 0·log 0 = 0."""
    def part(p, m):
        return F.when(p > 0, F.lit(0.5) * p * F.ln(p / m)).otherwise(F.lit(0.0))

    return _sum_over(a, b, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))


def mahalanobis(a, b, whitening) -> Column:
    """l2 after the whitening matrix (rows are input dimensions)."""
    from .arrays import affine

    return l2(affine(a, whitening), affine(b, whitening))


def hamming(a, b) -> Column:
    """Differing bits of two arrays of packed words."""
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )


def hamming_weight(a) -> Column:
    return F.aggregate(
        F.transform(col(a), lambda x: F.bit_count(x).cast("long")),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )


def hamming_text(a, b) -> Column:
    """Differing characters of two equally long strings, null otherwise."""
    a, b = col(a), col(b)
    letters = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    count = F.aggregate(letters, F.lit(0), lambda s, x: s + x)
    return F.when(F.length(a) == F.length(b), F.when(F.length(a) == 0, 0).otherwise(count))


def sign_mismatch(a, b) -> Column:
    """Components whose positivity differs."""
    return F.aggregate(
        F.zip_with(doubles(a), doubles(b), lambda x, y: ((x > 0) != (y > 0)).cast("long")),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )


def code_mismatch(a, b) -> Column:
    """Differing positions of two codes."""
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: (x != y).cast("long")),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )


def jaccard(a, b) -> Column:
    """|∩| / |∪| of two word sets."""
    a, b = col(a), col(b)
    union = F.size(F.array_union(a, b))
    return F.size(F.array_intersect(a, b)).cast("double") / F.when(union > 0, union)


DISTANCES = {
    "l2": l2, "ip": ip, "cosine": cosine, "angular": angular, "euclid": euclid,
    "l1": l1, "linf": linf, "canberra": canberra, "braycurtis": braycurtis,
    "jensenshannon": jensenshannon, "hamming": hamming,
    "sign_mismatch": sign_mismatch, "code_mismatch": code_mismatch, "jaccard": jaccard,
}
