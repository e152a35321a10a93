"""Per-row vector expressions.

All sums run over ``array<double>`` in index order, so the value does not
depend on the engine's evaluation strategy.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 0.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v) -> Column:
    return col(v).cast("array<double>")


def bind(value, use) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A lambda body is evaluated per element, so a row-level value used inside
    one would be computed again for every component.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def array_total(v) -> Column:
    """Σ v, left to right."""
    return F.aggregate(doubles(v), F.lit(ZERO), lambda s, x: s + x)


def dot(a, b) -> Column:
    return array_total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def squared_norm(v) -> Column:
    return dot(v, v)


def vector_norm(v) -> Column:
    return F.sqrt(squared_norm(v))


def scale(v, factor) -> Column:
    return F.transform(doubles(v), lambda x: x * factor)


def divide(v, divisor) -> Column:
    return F.transform(doubles(v), lambda x: x / divisor)


def l2_normalize(v) -> Column:
    """v / ‖v‖; the zero vector stays zero."""
    norm = vector_norm(v)
    return bind(F.when(norm == 0, F.lit(1.0)).otherwise(norm), lambda n: divide(v, n))


def subtract(a, b) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x - y)


def add(a, b) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x + y)


def constant_vector(values) -> Column:
    """A literal array<double> for a model-sized vector."""
    return F.array(*[F.lit(float(x)) for x in values])


def zeros(n) -> Column:
    return F.array_repeat(F.lit(ZERO), n)


def pad(v, dim: int) -> Column:
    """Zero-pad to ``dim`` components."""
    v = doubles(v)
    return F.concat(v, F.array_repeat(F.lit(ZERO), F.greatest(F.lit(dim) - F.size(v), F.lit(0))))


def remap(v, positions) -> Column:
    """Pick components by position; a position below 0 gives 0."""
    return bind(doubles(v), lambda w: F.array(
        *[F.lit(ZERO) if p < 0 else F.element_at(w, int(p) + 1) for p in positions]))


def affine(v, matrix, bias=None) -> Column:
    """v·A + b as literal rows; for small models (use linear.apply_linear for large ones)."""
    columns = list(zip(*matrix))
    bias = [0.0] * len(columns) if bias is None else bias
    return F.array(*[dot(v, constant_vector(c)) + F.lit(float(b)) for c, b in zip(columns, bias)])


def prewhiten(v) -> Column:
    """(x − mean) / max(std, 1/√n) with the population standard deviation."""
    v = doubles(v)
    n = F.size(v).cast("double")

    def spread(centred):
        std = F.sqrt(array_total(F.transform(centred, lambda x: x * x)) / n)
        return bind(F.greatest(std, F.lit(1.0) / F.sqrt(n)), lambda s: F.transform(centred, lambda x: x / s))

    return bind(bind(array_total(v) / n, lambda m: F.transform(v, lambda x: x - m)), spread)


def binarize(v, thresholds=None) -> Column:
    """1 where a component exceeds its threshold (0 without thresholds), else 0."""
    if thresholds is None:
        return F.transform(doubles(v), lambda x: (x > 0).cast("int"))
    return F.zip_with(doubles(v), doubles(thresholds), lambda x, t: (x > t).cast("int"))


def pack_words(bits, word: int = 32) -> Column:
    """0/1 array → array<long> of ``word``-bit words, first bit lowest."""

    def packed(held):
        words = F.ceil(F.size(held) / F.lit(word)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), words - 1),
            lambda w: F.aggregate(
                F.transform(
                    F.slice(held, w * word + 1, F.lit(word)),
                    lambda b, i: F.call_function("shiftleft", b.cast("long"), i),
                ),
                F.lit(0).cast("long"),
                lambda s, x: s + x,
            ),
        )

    return bind(col(bits), packed)


def pack_bits(bits) -> Column:
    """0/1 array → bytes, big-endian inside each byte, zero-filled at the end."""

    def packed(text):
        return F.transform(
            F.sequence(F.lit(0), F.ceil(F.length(text) / 8).cast("int") - 1),
            lambda i: F.lpad(F.conv(F.rpad(F.substring(text, i * 8 + 1, F.lit(8)), 8, "0"), 2, 16), 2, "0"),
        )

    return F.unhex(F.array_join(bind(F.array_join(col(bits).cast("array<string>"), ""), packed), ""))


def sign_code(v) -> Column:
    return pack_words(binarize(v))


def slices(v, m: int, dim: int) -> list[Column]:
    """Cut into ``m`` consecutive sub-vectors; the first ``dim mod m`` get one more."""
    v = doubles(v)
    return [F.slice(v, start + 1, size) for start, size in slice_bounds(dim, m)]


def slice_bounds(dim: int, m: int) -> list[tuple[int, int]]:
    """(start, size) of each of the ``m`` sub-spaces of a ``dim``-space."""
    small, extra = divmod(dim, m)
    bounds, start = [], 0
    for i in range(m):
        size = small + (i < extra)
        bounds.append((start, size))
        start += size
    return bounds


def reshape(values, dim: int) -> Column:
    """Flat array → array of consecutive ``dim``-vectors."""

    def cut(held):
        rows = F.floor(F.size(held) / F.lit(dim)).cast("int")
        pieces = F.transform(F.sequence(F.lit(1), F.greatest(rows, F.lit(1))), lambda i: F.slice(held, (i - 1) * dim + 1, F.lit(dim)))
        return F.slice(pieces, F.lit(1), rows)

    return bind(col(values), cut)


def rounded(v, digits: int = 6) -> Column:
    return F.transform(doubles(v), lambda x: F.round(x, digits))
