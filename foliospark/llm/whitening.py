"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, ``floor(scale * entry) + offset``. The fit list is each distinct vector once. Its sums, and its products
after every entry has been centred on the whole number below its mean, are added up exactly, as whole numbers, so neither the order of tasks nor
a lost executor changes a bit of the covariance; the fraction that centring left is taken out exactly too.

The covariance V has as many rows as a vector has entries, whatever the number of vectors, and is solved on the driver. An inertia
count, the signs of the pivots of V - sI = LDL', says how many eigenvalues lie above s. Bisection by counts isolates each leading eigenvalue;
Rayleigh quotient iteration from inside its interval converges cubically and is taken only if it ends within; counts on both
sides of the result certify its number. Eigenvalues that counts cannot part are one cluster, whose vectors are made orthogonal.

Rows whose vector is null or holds null, non-finite or too large entries (beyond 2**50 once scaled) are dropped, as are those with another number of entries
than most vectors have (ties: the larger number). Components without variance (up to rounding) cannot be whitened and are left out, so
a table of equal vectors gives no rows; nor do empty tables or vectors without entries. Repeated rows and null ids each get their rows. A deviation that no long holds is null. Only the id and the vector
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from foliospark.llm.common import checkpointed, schema_of

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
LARGEST = 2**50
ROWS = 4096  # of a batch whose products are added up at once
LIMB = 20  # bits: sums of products of ROWS such parts are exact as doubles
PIVOT = (1 + 17**0.5) / 8  # of Bunch and Kaufman

SUMS = "i int, j int, total decimal(38,0)"
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The vector as whole numbers; null if it is null or holds what is no finite number in range."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < LARGEST))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + offset))


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Vectors of one length, a few thousand at a time."""
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            rows = batch.column(0).slice(start, ROWS)
            yield rows.flatten().to_numpy().reshape(len(rows), -1)


def decimals(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
    values = [columns[0], columns[1], [Decimal(v) for v in columns[2]]]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["i", "j", "total"])


def column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums: of entry j in row (0, j), the number of vectors in (1, 0)."""
    count, sums = 0, None
    for x in matrices(batches):
        own = [int(high) * 2**32 + int(low) for high, low in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
        sums = [a + b for a, b in zip(sums, own)] if sums else own
        count += len(x)
    yield decimals([(0, j, v) for j, v in enumerate(sums or [])] + [(1, 0, count)])


class Products:
    """Sums of z'z in whole numbers of any size: parts of LIMB bits are multiplied as doubles, which holds them exactly."""

    def __init__(self, length: int):
        self.length, self.batches = length, 0
        self.total = np.zeros((length, length), object)
        self.open: dict[int, np.ndarray] = {}  # by power of the parts, below 2**63

    def add(self, z: np.ndarray) -> None:
        parts = []
        while z.any():
            high = (z + (1 << (LIMB - 1))) >> LIMB
            parts.append((z - (high << LIMB)).astype(np.float64))
            z = high
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                power = LIMB * (a + b)
                self.open.setdefault(power, np.zeros((self.length,) * 2, np.int64))
                self.open[power] += (left.T @ right).astype(np.int64)
        self.batches += 1
        if self.batches % 1000 == 0:
            self.close()

    def close(self) -> np.ndarray:
        for power, own in self.open.items():
            self.total += own.astype(object) << power
        self.open = {}
        return self.total


def centred_products(means: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    centre = np.array(means, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Products(len(centre))
        for x in matrices(batches):
            sums.add(x - centre)
        total = sums.close()
        yield decimals([(i, j, total[i, j]) for i in range(len(centre)) for j in range(i + 1)])

    return run


def summed(rows: DataFrame, function: Callable) -> dict[tuple[int, int], int]:
    """As many numbers as the result has, whatever the rows."""
    totals = rows.mapInArrow(function, SUMS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(row["i"], row["j"]): int(row["total"]) for row in totals.collect()}


def pivots(matrix: np.ndarray) -> tuple[int, int]:
    """Positive and zero pivots of LDL', with blocks of one or two rows as Bunch and Kaufman choose them."""
    a = matrix.copy()
    n, k, positive, zero = len(a), 0, 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j], k:] = a[[j, i], k:]
        a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        most, own = (column.max() if len(column) else 0.0), abs(a[k, k])
        size = 1
        if max(most, own) > 0 and own < PIVOT * most:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if own * row.max() < PIVOT * most * most:
                if abs(a[r, r]) >= PIVOT * row.max():
                    swap(k, r)
                else:
                    size = 2
                    swap(k + 1, r)
        block = a[k : k + size, k : k + size]
        signs = np.linalg.eigvalsh(block) if size == 2 else block[0]
        positive += int((signs > 0).sum())
        zero += int((signs == 0).sum())
        if signs.all():
            below = a[k + size :, k : k + size]
            a[k + size :, k + size :] -= below @ np.linalg.solve(block, below.T)
        k += size
    return positive, zero


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than the shift."""
    return pivots(matrix - shift * np.eye(len(matrix)))[0]


def eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues of a matrix without negative ones, falling, and a row for each unit eigenvector.

    Those that rounding cannot tell from zero are left out.
    """
    n = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0  # no eigenvalue is larger
    blur = 4 * n * np.finfo(float).eps * size  # what rounding does to a count
    count = min(count, count_above(matrix, 4 * blur)) if size else 0
    known: dict[float, int] = {0.0: n, size + 2 * blur: 0}
    values, vectors = [], np.zeros((0, n))

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(matrix, shift)
        return known[shift]

    def interval(k: int) -> tuple[float, float]:
        """The closest counted shifts with eigenvalue k, counted from 0, between them."""
        return max(s for s, c in known.items() if c > k), min(s for s, c in known.items() if c <= k)

    while len(values) < count:
        k = len(values)
        low, high = interval(k)
        while above(low) - above(high) > 1 and high - low > blur:
            above((low + high) / 2)
            low, high = interval(k)
        for _ in range(above(low) - above(high)):  # one, or a cluster
            while True:
                value, vector = quotient_iteration(matrix, (low + high) / 2, vectors, k)
                inside = low - blur <= value <= high + blur
                if inside and above(value - blur) > k >= above(value + blur):
                    break
                if high - low <= blur:
                    raise ArithmeticError(f"eigenvalue {k + 1} was not certified")
                above((low + high) / 2)
                low, high = interval(k)
            values.append(value)
            vectors = np.vstack([vectors, vector])
            k += 1
            if k == count:
                break
    return np.array(values), vectors


def quotient_iteration(matrix: np.ndarray, shift: float, found: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """An eigenpair orthogonal to those found: two steps with the shift as it is, then with the Rayleigh quotient."""
    n = len(matrix)
    vector = np.random.default_rng(seed).standard_normal(n)
    best, least, worse = (shift, vector), np.inf, 0
    for step in range(30):
        for _ in range(2):
            vector = vector - found.T @ (found @ vector)
        vector = vector / np.linalg.norm(vector)
        value = float(vector @ matrix @ vector)
        left = float(np.linalg.norm(matrix @ vector - value * vector))
        worse = worse + 1 if left >= least else 0
        if worse > 1:  # rounding is all that is left
            break
        if left < least:
            best, least = (value, vector), left
        shift = shift if step < 2 else value
        try:
            vector = np.linalg.solve(matrix - shift * np.eye(n), vector)
        except np.linalg.LinAlgError:
            vector = np.linalg.solve(matrix - (shift + np.spacing(abs(shift) + np.abs(matrix).max())) * np.eye(n), vector)
        vector = vector / np.abs(vector).max()
    return best


@dataclass(frozen=True)
class Model:
    """The fit: ``components`` has a row for each unit eigenvector; ``error``: how far whitened fit rows are from unit covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        whole, rest = np.array([divmod(s, self.n) for s in self.sums], np.int64).reshape(-1, 2).T
        return ((x - whole) - rest / self.n) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S) squared, exact."""
        whole, rest = np.array([divmod(s, self.n) for s in self.sums], np.int64).reshape(-1, 2).T
        z = x - whole
        if len(z) and (float(np.abs(z).max()) + 1) * self.n < 2**31 / max(1, x.shape[1]) ** 0.5:
            return ((self.n * z - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * z.astype(object) - rest.astype(object)) ** 2).sum(axis=1).tolist()
        return [value if value < 2**63 else None for value in exact]


def usable(rows: DataFrame, vector: str, scale: int, offset: int, carried: list[Column]) -> DataFrame:
    return rows.select(whole_numbers(F.col(vector), scale, offset).alias("x"), *carried).filter("size(x) > 0")


def fit(
    rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> Model:
    numbers = usable(rows, vector, scale, offset, [])
    lengths = numbers.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    length = first["length"] if first else 0
    distinct = checkpointed(numbers.filter(F.size("x") == length).distinct())
    totals = summed(distinct, column_sums)
    n, sums = totals.get((1, 0), 0), tuple(totals.get((0, j), 0) for j in range(length))
    if not n:
        return Model(0, sums, np.zeros((0, length)), np.zeros(0), 0.0)
    split = [divmod(s, n) for s in sums]
    found = summed(distinct, centred_products([whole for whole, _ in split]))
    covariance = np.zeros((length, length))
    for (i, j), total in found.items():
        covariance[i, j] = covariance[j, i] = float(Fraction(n * total - split[i][1] * split[j][1], n * n))
    values, vectors = eigenpairs(covariance, components)
    model = Model(n, sums, vectors, values, float(np.trace(covariance)))
    return Model(n, sums, vectors, values, model.trace, identity_error(distinct, model))


def identity_error(distinct: DataFrame, model: Model) -> float:
    """The largest difference between the covariance of the whitened fit list and the identity."""
    size = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for x in matrices(batches):
            own = model.whitened(x)
            total += np.vstack([own.sum(axis=0), own.T @ own])
        i, j = np.divmod(np.arange(total.size), max(1, size))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "total"])

    parts = distinct.mapInArrow(moments, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    total = np.zeros((size + 1, size))
    for row in parts.collect():
        total[row["i"], row["j"]] = row["total"] / model.n
    covariance = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(covariance - np.eye(size)).max()) if size else 0.0


def whiten(
    rows: DataFrame,
    model: Model,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """``key, deviation, whitened`` (an array with a number for each component) of each usable row."""
    kind = schema_of("deviation long, whitened array<double>")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], to_arrow_type(kind))]
            for start in range(0, len(batch), ROWS):
                own = batch.slice(start, ROWS)
                x = own.flatten().to_numpy().reshape(len(own), -1)
                values = zip(model.deviations(x), model.whitened(x).tolist())
                parts.append(pa.array([{"deviation": d, "whitened": w} for d, w in values], to_arrow_type(kind)))
            yield pa.concat_arrays(parts)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    same = usable(rows, vector, scale, offset, [F.col(key)]).filter(F.size("x") == len(model.sums))
    return same.select(key, F.arrow_udf(run, returnType=kind)("x").alias("scan")).select(key, "scan.*")


def components(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component, with the figures of the fit."""
    model = fit(rows, vector, count)
    shares = F.array(*(F.lit(float(value / model.trace)) for value in model.values)).cast("array<double>")
    each = whiten(rows, model, key, vector).select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        key,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(model.error).alias("identity_error"),
    )
