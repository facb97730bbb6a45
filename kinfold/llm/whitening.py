"""Embedding whitening by spectrum slicing.

Every entry becomes an integer (64 steps a unit, shifted), so sums are exact and do not depend on the order of tasks. One
pass gives the number of vectors and their sum, a second the products of the deviations from the
rounded mean; what reaches the driver is the sum and one dimension x dimension matrix, whatever the number of rows.
There the covariance is sliced: the inertia of ``V - shift`` (negative pivots of a pivoted LDL' factorisation) counts the
eigenvalues below a shift, so bisection finds an interval for each leading eigenvalue that holds it alone. Rayleigh quotient
iteration then converges cubically inside the interval; a step that leaves it is thrown away and the interval
is halved. The counts at its ends certify the eigenvalue's number. Eigenvalues that cannot be told apart are taken
together, with an orthonormal basis of their space. A third pass measures the covariance of the whitened
rows, the last one emits them.

Defined cases: a null vector, an empty one, and one with a null, a non-finite entry or one too large for a long is dropped; of the
rest, vectors of any but the commonest length (ties: the longer) are dropped too, as they lie in no common space. Null
ids stay, repeated rows count and are returned as often as they occur. Components without variance are left out, so equal vectors, a single
one or an empty table give an empty result. ``deviation`` is null where its exact value exceeds a long. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.registry import query, table
from kinfold.llm.store import written
from kinfold.llm.text import within


@dataclass
class WhiteningParams:
    components: int = 32
    steps: int = 64  # integers per unit
    shift: int = 1_000_000
    least_share: float = 1e-13  # of the trace; smaller eigenvalues are no components
    tie: float = 1e-10  # of the largest eigenvalue; nearer ones share a space


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
_LARGEST = float(1 << 62)


def integers(column: pa.Array, p: WhiteningParams) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (rows, matrix of longs) of the usable vectors of a batch."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()  # leaves out what null lists may cover
    null = values.is_null().to_numpy(zero_copy_only=False)
    numbers = pc.fill_null(values.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(numbers * p.steps)
    bad = null | ~np.isfinite(scaled) | (np.abs(scaled) >= _LARGEST)
    begin = np.cumsum(size) - size
    wrong = np.add.reduceat(np.append(bad, False), np.minimum(begin, len(bad))) if len(size) else np.zeros(0, int)
    whole = np.where(bad, 0.0, scaled).astype(np.int64) + p.shift
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero((size == d) & (wrong == 0))
        if len(rows):
            out[d] = rows, whole[begin[rows][:, None] + np.arange(d)]
    return out


def moments(vectors: DataFrame, p: WhiteningParams) -> tuple[int, int, list[int]]:
    """Commonest length, number of its vectors and their sum; length 0 where there is none."""

    def run(batches):
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, (rows, x) in integers(b.column(0), p).items():
                n[d] = n.get(d, 0) + len(rows)
                total[d] = total.get(d, 0) + x.sum(axis=0, dtype=np.int64)
        yield pa.table({"d": pa.array(list(n), pa.int32()), "n": pa.array(list(n.values()), pa.int64()),
                        "total": pa.array([t.tolist() for t in total.values()], pa.list_(pa.int64()))})

    parts = written(within(vectors.select("embedding"), run, "d int, n long, total array<long>"), "vector-sums")
    top = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return 0, 0, []
    sums = parts.filter(F.col("d") == top["d"]).select(F.posexplode("total")).groupBy("pos").agg(F.sum("col").alias("s"))
    return top["d"], top["n"], [r["s"] for r in sums.orderBy("pos").collect()]


def summed(parts: DataFrame) -> np.ndarray:
    """Sums of equally long lists over all tasks."""
    rows = parts.select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    return np.array([r["s"] for r in rows])


def symmetric(flat: np.ndarray, d: int) -> np.ndarray:
    full = np.zeros((d, d), flat.dtype)
    full[np.triu_indices(d)] = flat
    return np.where(np.tri(d, k=-1, dtype=bool), full.T, full)


def covariance(vectors: DataFrame, d: int, n: int, total: list[int], p: WhiteningParams) -> np.ndarray:
    """Covariance of the integer vectors. Rows are centred at the rounded mean, so products are small whole numbers that
    doubles add exactly; the rest of the mean, less than one step, is taken off in whole numbers too."""
    middle = np.array([t // n for t in total], np.int64)
    upper = np.triu_indices(d)

    def run(batches):
        products = np.zeros((d, d))
        for b in batches:
            got = integers(b.column(0), p).get(d)
            if got is not None:
                y = (got[1] - middle).astype(float)
                products += y.T @ y
        yield pa.table({"v": pa.array([products[upper].tolist()], pa.list_(pa.float64()))})

    products = symmetric(summed(within(vectors.select("embedding"), run, "v array<double>")), d)
    rest = np.array([t - n * int(m) for t, m in zip(total, middle, strict=True)], object)
    exact = np.array([[int(v) for v in row] for row in products], object) * n - np.outer(rest, rest)
    return (exact / (n * n)).astype(float)


def below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues below a shift: negative pivots of LDL' with complete pivoting over 1 x 1 and 2 x 2 blocks."""
    a = v - shift * np.eye(len(v))
    negative = 0
    while len(a):
        size = np.abs(a)
        one = int(np.argmax(np.diagonal(size)))
        i, j = divmod(int(np.argmax(size)), len(a))
        if size[i, j] == 0:
            break
        if size[one, one] >= 0.64 * size[i, j]:
            pivot, rest = [one], np.delete(np.arange(len(a)), one)
            negative += int(a[one, one] < 0)
        else:  # a block with one eigenvalue of each sign
            pivot, rest = [i, j], np.delete(np.arange(len(a)), [i, j])
            negative += 1
        beside = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - beside @ np.linalg.solve(a[np.ix_(pivot, pivot)], beside.T)
        a = (a + a.T) / 2
    return negative


def slices(v: np.ndarray, p: WhiteningParams) -> list[tuple[float, float, int, int]]:
    """(low, high, eigenvalues above high, above low) of intervals that hold one leading eigenvalue or one tie."""
    d = len(v)
    high = float(np.max(np.sum(np.abs(v), axis=1))) * (1 + 1e-12)
    floor = p.least_share * float(np.trace(v))
    if not high > 0 or not floor > 0:
        return []
    count = {floor: d - below(v, floor), high: 0}
    wanted = min(p.components, count[floor])
    stack, out = [(floor, high)], []
    while stack:
        lo, hi = stack.pop()
        if count[hi] >= wanted or count[lo] == count[hi]:
            continue
        if count[lo] - count[hi] == 1 or hi - lo <= p.tie * high:
            out.append((lo, hi, count[hi], count[lo]))
            continue
        mid = (lo + hi) / 2
        count[mid] = d - below(v, mid)
        stack += [(lo, mid), (mid, hi)]
    return sorted(out, key=lambda s: s[2])


def solved(v: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    """(V - shift)^-1 x; a shift that is an eigenvalue to the last bit is moved by one unit of rounding."""
    for nudge in (0.0, 4e-16, 4e-15, 4e-14):
        try:
            y = np.linalg.solve(v - (shift + nudge * scale) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.all(np.isfinite(y)) and np.any(y):
            return y
    raise ArithmeticError("a shifted covariance could not be solved")


def rayleigh(v: np.ndarray, lo: float, hi: float, number: int, scale: float) -> tuple[float, np.ndarray]:
    """The one eigenpair inside (lo, hi): the eigenvalue of that number."""
    d = len(v)
    for _ in range(200):
        shift = (lo + hi) / 2
        x = np.random.default_rng(number).standard_normal(d)
        for _ in range(2):
            x = solved(v, shift, x, scale)
            x /= np.linalg.norm(x)
        for _ in range(30):
            value = float(x @ v @ x)
            rest = float(np.linalg.norm(v @ x - value * x))
            if not lo < value < hi:
                break
            if rest <= 64 * np.finfo(float).eps * scale:
                # Some eigenvalue lies within ``rest`` of the quotient, and the interval holds only this one.
                if lo < value - rest and value + rest < hi:
                    x = solved(v, value, x, scale)  # one step more: the vector to full precision
                    x /= np.linalg.norm(x)
                    return float(x @ v @ x), x
                break
            x = solved(v, value, x, scale)
            x /= np.linalg.norm(x)
        mid = (lo + hi) / 2
        if d - below(v, mid) == number:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 256 * np.finfo(float).eps * scale:
            break
    return tied(v, lo, hi, 1, scale)[0]


def tied(v: np.ndarray, lo: float, hi: float, m: int, scale: float) -> list[tuple[float, np.ndarray]]:
    """m eigenvalues that lie together: inverse iteration on m vectors, then a rotation inside their space."""
    x = np.linalg.qr(np.random.default_rng(m).standard_normal((len(v), m)))[0]
    for _ in range(6):
        x = np.linalg.qr(solved(v, (lo + hi) / 2, x, scale))[0]
    small, turn = np.linalg.eigh(x.T @ v @ x)
    x = x @ turn
    return [(float(small[i]), x[:, i]) for i in range(m - 1, -1, -1)]


def leading(v: np.ndarray, p: WhiteningParams) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues, falling, and their unit vectors as rows; the largest entry of each is positive."""
    pairs: list[tuple[float, np.ndarray]] = []
    scale = float(np.max(np.sum(np.abs(v), axis=1))) if len(v) else 0.0
    for lo, hi, above_high, above_low in slices(v, p):
        m = above_low - above_high
        pairs += [rayleigh(v, lo, hi, above_low, scale)] if m == 1 else tied(v, lo, hi, m, scale)
    pairs = pairs[: p.components]
    vectors: list[np.ndarray] = []
    for _, x in pairs:
        for y in vectors:  # rounding only: eigenvectors of a symmetric matrix are orthogonal
            x = x - (x @ y) * y
        x = x / np.linalg.norm(x)
        vectors.append(x * np.sign(x[np.argmax(np.abs(x))]))
    return np.array([e for e, _ in pairs]), np.array(vectors).reshape(len(pairs), len(v))


def deviations(z: np.ndarray) -> pa.Array:
    """Row sums of squares of whole numbers; null where a long cannot hold them."""
    rough = np.einsum("ij,ij->i", z.astype(float), z.astype(float))
    exact = np.einsum("ij,ij->i", z, z)
    if np.all(rough < 9.2e18):
        return pa.array(exact)
    whole = [sum(int(x) ** 2 for x in row) if r >= 9.2e18 else int(e) for row, r, e in zip(z, rough, exact, strict=True)]
    return pa.array([x if x < 1 << 63 else None for x in whole], pa.int64())


def whitened(vectors: DataFrame, p: WhiteningParams) -> DataFrame:
    """Whitened coordinates of the frame (vec_id, embedding), one row per vector and component."""
    spark = vectors.sparkSession
    d, n, total = moments(vectors, p)
    values, components = np.zeros(0), np.zeros((0, 0))
    if n:
        v = covariance(vectors, d, n, total, p)
        values, components = leading(v, p)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    trace = float(np.trace(v))
    project = (components / np.sqrt(values)[:, None]).T
    sums, k = np.array(total, np.int64), len(values)
    upper = np.triu_indices(k)

    def spread(x: np.ndarray) -> np.ndarray:
        """n x - S; exact as long as n times an entry fits a long."""
        if n * max(abs(int(x.max())), abs(int(x.min()))) < 1 << 62:
            return n * x - sums
        return np.array([[n * int(a) - s for a, s in zip(row, total, strict=True)] for row in x], object)

    def coordinates(z: np.ndarray) -> np.ndarray:
        return (z.astype(float) / n) @ project

    def measured(batches):
        plain, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            got = integers(b.column(0), p).get(d)
            if got is not None:
                w = coordinates(spread(got[1]))
                plain += w.sum(axis=0)
                products += w.T @ w
        yield pa.table({"v": pa.array([[*plain, *products[upper]]], pa.list_(pa.float64()))})

    got = summed(within(vectors.select("embedding"), measured, "v array<double>")) / n
    off = symmetric(got[k:], k) - np.outer(got[:k], got[:k]) - np.eye(k)
    error = float(np.max(np.abs(off)))

    def run(batches):
        for b in batches:
            found = integers(b.column(1), p).get(d)
            if found is None:
                continue
            rows, x = found
            z = spread(x)
            m = len(rows)
            each = np.repeat(np.arange(m), k)
            columns = [
                b.column(0).take(pa.array(rows)).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), deviations(z).take(pa.array(each)), pa.array(coordinates(z).ravel()),
                pa.array(np.tile(values / trace, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return within(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), run, SCHEMA)


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, folder):
    return whitened(table(spark, folder, "embeddings"), WhiteningParams())
