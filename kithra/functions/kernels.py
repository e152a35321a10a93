"""NumPy block kernels: small helpers called inside Arrow stages.

A kernel compares one block of queries with one block of base vectors.  The
value it reports for a pair is summed in index order in double precision, so it
equals the Catalyst expression of ``distances`` bit for bit.  Where a matrix
product is used to find the candidates, its rounding error is bounded and every
pair within that bound of the k-th value is re-computed exactly: copies and
ties are resolved by id, never lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 1 << 21  # distance cells held at once by one task
TILE_ROWS, TILE_COLUMNS = 16, 2048  # of a block, for metrics taken component by component
EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)


def matrix(column, dtype=np.float64) -> np.ndarray:
    """List column → n × d matrix; all rows must have one dimension."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, 0), dtype)
    sizes = pc.list_value_length(column)
    low, high = pc.min_max(sizes).values()
    if column.null_count or low.as_py() != high.as_py():
        raise ValueError("vectors of one set must share one dimension and be non-null")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.astype(dtype, copy=False)).reshape(n, -1)


def longs(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def list_array(rows: np.ndarray, value_type=None) -> pa.Array:
    """n × d matrix → list column."""
    n, d = rows.shape
    flat = pa.array(np.ascontiguousarray(rows).reshape(-1), type=value_type)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d if d else 1, dtype=np.int32)[: n + 1]), flat)


class Metric:
    """How to compare blocks.  Keys are ordered: lower is nearer."""

    dtype = np.float64
    similarity = False

    def check(self, q, b):
        """Both sides must have one dimension."""
        if q.shape[1] != b.shape[1]:
            raise ValueError(f"queries and base must share one dimension, got {q.shape[1]} and {b.shape[1]}")

    def block(self, q, b):
        """Key matrix of a block and the bound of its rounding error."""
        raise NotImplementedError

    def pairs(self, q, b, qi, bj):
        """Exact keys of the pairs (qi, bj); only needed when the bound is not 0."""
        raise NotImplementedError

    def value(self, key):
        """Key → reported distance or similarity."""
        return -key if self.similarity else key


class SquaredL2(Metric):
    def block(self, q, b):
        qn, bn = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", b, b)
        size = (qn.max(initial=0.0) + bn.max(initial=0.0)) * 2
        return qn[:, None] + bn[None, :] - 2.0 * (q @ b.T), 16 * (q.shape[1] + 2) * EPS * size

    def pairs(self, q, b, qi, bj):
        key = np.zeros(len(qi))
        for j in range(q.shape[1]):
            diff = q[qi, j] - b[bj, j]
            key += diff * diff
        return key


class Euclid(SquaredL2):
    def value(self, key):
        return np.sqrt(key)


class InnerProduct(Metric):
    similarity = True

    def block(self, q, b):
        qn, bn = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", b, b)
        size = np.sqrt(qn.max(initial=0.0) * bn.max(initial=0.0))
        return -(q @ b.T), 16 * (q.shape[1] + 2) * EPS * size

    def pairs(self, q, b, qi, bj):
        total = np.zeros(len(qi))
        for j in range(q.shape[1]):
            total += q[qi, j] * b[bj, j]
        return -total


def _tiles(rows: int, columns: int):
    """Cuts of a block whose working arrays stay in a core's cache."""
    for lo in range(0, rows, TILE_ROWS):
        for left in range(0, columns, TILE_COLUMNS):
            yield slice(lo, min(lo + TILE_ROWS, rows)), slice(left, min(left + TILE_COLUMNS, columns))


def _by_component(q, b, step, sums: int = 1):
    """``sums`` arrays of all pairs: ``step(x, y, *sums, spare)`` adds one component to a tile of them."""
    out = [np.zeros((len(q), len(b))) for _ in range(sums)]
    qt, bt = np.ascontiguousarray(q.T), np.ascontiguousarray(b.T)
    for rows, columns in _tiles(len(q), len(b)):
        tile = [np.zeros((rows.stop - rows.start, columns.stop - columns.start)) for _ in range(sums)]
        spare = [np.empty_like(tile[0]) for _ in range(2)]
        for x, y in zip(qt[:, rows, None], bt[:, None, columns]):
            step(x, y, *tile, spare)
        for whole, part in zip(out, tile):
            whole[rows, columns] = part
    return out


def _add_l1(x, y, key, spare):
    key += np.abs(np.subtract(x, y, out=spare[0]), out=spare[0])


def _max_l1(x, y, key, spare):
    np.maximum(key, np.abs(np.subtract(x, y, out=spare[0]), out=spare[0]), out=key)


def _add_canberra(x, y, key, spare):
    gap, total = spare
    np.abs(np.subtract(x, y, out=gap), out=gap)
    np.add(np.abs(x), np.abs(y), out=total)
    # two zeros: nothing over the least number is nothing
    np.copyto(total, TINY, where=total == 0) if not (x.all() or y.all()) else None
    key += np.divide(gap, total, out=gap)


def _add_braycurtis(x, y, num, den, spare):
    num += np.abs(np.subtract(x, y, out=spare[0]), out=spare[0])
    den += np.abs(np.add(x, y, out=spare[0]), out=spare[0])


class TermSum(Metric):
    """Metrics that are a sum (or, by its step, a maximum) of one term per component, exact as computed."""

    def __init__(self, step):
        self.step = step

    def block(self, q, b):
        return _by_component(q, b, self.step)[0], 0.0


class BrayCurtis(Metric):
    def block(self, q, b):
        num, den = _by_component(q, b, _add_braycurtis, 2)
        return np.divide(num, den, out=np.zeros_like(num), where=den != 0), 0.0


class Lp(Metric):
    """Sum of the p-th powers.  A whole small power is found by products, and near pairs by the power itself."""

    def __init__(self, p: float):
        self.p = p

    def block(self, q, b):
        # products, powers and sums are off by units of their last place
        with np.errstate(over="ignore", invalid="ignore"):
            largest = (np.abs(q).max(initial=0.0) + np.abs(b).max(initial=0.0)) ** self.p * q.shape[1]
        p = int(self.p) if self.p in (2, 3, 4) and np.isfinite(largest) else 0

        def step(x, y, key, spare):
            gap, power = spare
            np.abs(np.subtract(x, y, out=gap), out=gap)
            if not p:
                key += np.power(gap, self.p, out=gap)
                return
            np.multiply(gap, gap, out=power)
            for _ in range(p - 2):
                np.multiply(power, gap, out=power)
            key += power

        key, = _by_component(q, b, step)
        return key, 16 * (q.shape[1] + 8) * EPS * largest + TINY if p else 0.0

    def pairs(self, q, b, qi, bj):
        key = np.zeros(len(qi))
        for j in range(q.shape[1]):
            key += np.power(np.abs(q[qi, j] - b[bj, j]), self.p)
        return key


class JensenShannon(Metric):
    """Half the entropies' sum taken from the middle's: one logarithm a component finds the near pairs."""

    def block(self, q, b):
        if not all(np.isfinite(x).all() and (x >= 0).all() for x in (q, b)):
            return self._terms(q, b), 0.0
        (qe, be), size = ((x * np.log(np.maximum(x, TINY))).sum(axis=1) for x in (q, b)), 0.0
        for x in (q, b):
            size += np.abs(x * np.log(np.maximum(x, TINY))).sum(axis=1).max(initial=0.0) + x.sum(axis=1).max(initial=0.0)

        def step(x, y, key, spare):
            middle, log = spare
            np.multiply(np.add(x, y, out=middle), 0.5, out=middle)
            np.log(np.maximum(middle, TINY, out=log), out=log)
            key += np.multiply(middle, log, out=log)

        key, = _by_component(q, b, step)
        return 0.5 * (qe[:, None] + be[None, :]) - key, 32 * (q.shape[1] + 8) * EPS * size + TINY

    def pairs(self, q, b, qi, bj):
        key = np.zeros(len(qi))
        for j in range(q.shape[1]):
            key += _jensenshannon(q[qi, j], b[bj, j])
        return key

    def _terms(self, q, b):
        key = np.zeros((len(q), len(b)))
        for j in range(q.shape[1]):
            key += _jensenshannon(q[:, j][:, None], b[:, j][None, :])
        return key


class SignMismatch(Metric):
    def block(self, q, b):
        """Whole numbers that single precision holds exactly, from a matrix product of the signs."""
        if q.shape[1] >= 1 << 22:
            raise ValueError("too many components to count their signs")
        x, y = (q > 0).astype(np.float32), (b > 0).astype(np.float32)
        return x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :] - 2 * (x @ y.T), 0.0


class Hamming(Metric):
    dtype = np.int64

    def block(self, q, b):
        key = np.zeros((len(q), len(b)), np.int64)
        for j in range(q.shape[1]):
            key += np.bitwise_count(q[:, j][:, None] ^ b[:, j][None, :])
        return key.astype(np.float64), 0.0


class CodeMismatch(Metric):
    dtype = np.int64

    def block(self, q, b):
        key = np.zeros((len(q), len(b)))
        for j in range(q.shape[1]):
            key += q[:, j][:, None] != b[:, j][None, :]
        return key, 0.0


class AsymmetricCode(Metric):
    """Query vector against product codes: Σ_m table[m][code_m].

    ``codebooks`` is a list of (start, codewords) with codewords Ks × ds.
    """

    def __init__(self, codebooks):
        self.codebooks = codebooks

    def check(self, q, codes):
        if codes.shape[1] != len(self.codebooks):
            raise ValueError(f"codes of {codes.shape[1]} parts for {len(self.codebooks)} codebooks")

    def tables(self, q):
        out = []
        for start, words in self.codebooks:
            table = np.zeros((len(q), len(words)))
            for j in range(words.shape[1]):
                diff = q[:, start + j][:, None] - words[:, j][None, :]
                table += diff * diff
            out.append(table)
        return out

    def block(self, q, codes):
        codes = codes.astype(np.int64)
        key = np.zeros((len(q), len(codes)))
        for m, table in enumerate(self.tables(q)):
            key += table[:, codes[:, m]]
        return key, 0.0


class PolysemousCode(AsymmetricCode):
    """Asymmetric distance of the base rows whose code is within ``limit`` bits
    of the query's own code; the others are out of reach."""

    def __init__(self, codebooks, limit: int):
        super().__init__(codebooks)
        self.limit = limit

    def block(self, q, codes):
        codes = codes.astype(np.int64)
        key, _ = super().block(q, codes)
        own = assign_codes(q, self.codebooks)
        bits = np.zeros(key.shape, np.int64)
        for m in range(codes.shape[1]):
            bits += np.bitwise_count(own[:, m][:, None] ^ codes[:, m][None, :])
        key[bits > self.limit] = np.inf
        return key, 0.0


def _jensenshannon(x, y):
    mid = (x + y) / 2
    out = np.zeros(np.broadcast(x, y).shape)
    for p in (x, y):
        p = np.broadcast_to(p, out.shape)
        live = p > 0
        out[live] += 0.5 * p[live] * np.log(p[live] / mid[live])
    return out


def metric_of(metric) -> Metric:
    if isinstance(metric, Metric):
        return metric
    if metric in _METRICS:
        return _METRICS[metric]()
    if isinstance(metric, tuple) and metric[0] == "lp":
        return Lp(float(metric[1]))
    raise ValueError(f"unknown metric {metric!r}")


_METRICS = {
    "l2": SquaredL2,
    "euclid": Euclid,
    "ip": InnerProduct,
    "l1": lambda: TermSum(_add_l1),
    "linf": lambda: TermSum(_max_l1),
    "canberra": lambda: TermSum(_add_canberra),
    "braycurtis": BrayCurtis,
    "jensenshannon": JensenShannon,
    "hamming": Hamming,
    "code_mismatch": CodeMismatch,
    "sign_mismatch": SignMismatch,
}


class TopK:
    """Best k (key, id) per query row over any number of base blocks.

    Kept as rows × k tables filled from the left; free slots have an infinite key.
    """

    def __init__(self, rows: int, k: int):
        self.k = k
        self.keys = np.full((rows, k), np.inf)
        self.slots = np.zeros((rows, k), np.int64)

    def scan(self, metric: Metric, q, b, ids):
        metric.check(q, b)
        step = max(1, CELLS // max(1, len(b)))
        for lo in range(0, len(q), step):
            part = q[lo:lo + step]
            key, slack = metric.block(part, b)
            bound = self.keys[lo:lo + step, -1]
            if len(b) > self.k and not np.isfinite(bound).all():
                bound = np.minimum(bound, np.partition(key, self.k - 1, axis=1)[:, self.k - 1])
            qi, bj = np.nonzero((key <= (bound + slack)[:, None]) & (key < np.inf))
            if len(qi):
                exact = metric.pairs(part, b, qi, bj) if slack else key[qi, bj]
                self._merge(lo, len(part), qi, ids[bj], exact)

    def _merge(self, lo, rows, qi, ids, key):
        """Fold candidates into the rows lo … lo + rows; ties go to the lower id."""
        held_row, held_slot = np.nonzero(np.isfinite(self.keys[lo:lo + rows]))
        qi = np.concatenate([held_row, qi])
        ids = np.concatenate([self.slots[lo:lo + rows][held_row, held_slot], ids])
        key = np.concatenate([self.keys[lo:lo + rows][held_row, held_slot], key])
        order = np.lexsort((ids, key, qi))
        qi, ids, key = qi[order], ids[order], key[order]
        starts = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
        place = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
        keep = place < self.k
        qi, place = qi[keep] + lo, place[keep]
        self.keys[qi, place] = key[keep]
        self.slots[qi, place] = ids[keep]

    def flat(self):
        """(query rows, ids, keys) of the filled slots, in order."""
        qi, slot = np.nonzero(np.isfinite(self.keys))
        return qi, self.slots[qi, slot], self.keys[qi, slot]


def within(metric: Metric, q, b, radius: float):
    """Yield (query rows, base rows, keys) of the pairs nearer than ``radius``.

    Strictly below for distances, strictly above for similarities.
    """
    metric.check(q, b)
    limit = -radius if metric.similarity else radius
    step = max(1, CELLS // max(1, len(b)))
    for lo in range(0, len(q), step):
        part = q[lo:lo + step]
        key, slack = metric.block(part, b)
        qi, bj = np.nonzero(key < limit + slack) if slack else np.nonzero(key < limit)
        exact = metric.pairs(part, b, qi, bj) if slack else key[qi, bj]
        hit = exact < limit
        yield qi[hit] + lo, bj[hit], exact[hit]


def nearest(x, centroids, k: int = 1):
    """Row numbers and squared distances of the k nearest centroids per row."""
    best = TopK(len(x), min(k, len(centroids)))
    best.scan(SquaredL2(), x, centroids, np.arange(len(centroids)))
    return best.slots, best.keys


def assign_codes(x, codebooks):
    """n × M nearest codeword numbers of a product codebook."""
    codes = np.empty((len(x), len(codebooks)), np.int64)
    for m, (start, words) in enumerate(codebooks):
        codes[:, m] = nearest(x[:, start:start + words.shape[1]], words)[0][:, 0]
    return codes
