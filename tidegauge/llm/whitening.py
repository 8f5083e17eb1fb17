"""Whitening of embeddings: leading principal components, scaled to unit variance.

Entries become whole numbers, x = floor(64 c) + 1,000,000, so that sums are exact.
1. One pass counts the vectors and sums each dimension.
2. One pass takes the mean from each vector and adds up the products of its entries: the partial
   matrices of tasks are added up in two steps. The matrix has a row for each dimension, so its
   size is bound by the vectors' length, not by their number; it comes to the driver.
3. There Householder reflections make it tridiagonal, bisection by Sturm counts finds the leading
   eigenvalues, inverse iteration their vectors, those of close eigenvalues made orthogonal.
4. The components are broadcast (dimensions x components numbers) and each vector is projected.
5. The covariance of the result, centred once more, is held against the identity.

Nulls: a null vector and one with null or non-finite entries are dropped, and so is one with an
entry beyond 2**46, of which x is no exact whole number. A null id is kept. Vectors must be of one
length: the most frequent length counts (of equals the shorter) and others are dropped. Repeated
rows count as often as they come. Components whose eigenvalue is zero to rounding are left out, so
equal vectors, a single one or an empty table give an empty result. Other columns are ignored.
"""

import functools

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from tidegauge.llm.common import keep, ready

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
LARGEST = float(1 << 46)
EPS = np.finfo(float).eps
CHUNK = 4096  # vectors multiplied together


def whole_numbers(vectors):
    """(mask of good vectors, {length: (places, x as a matrix)}) of a list of arrays."""
    good, by_length = np.zeros(len(vectors), bool), {}
    for i, v in enumerate(vectors):
        if v is not None and len(v):
            by_length.setdefault(len(v), []).append(i)
    found = {}
    for length, places in by_length.items():
        places = np.array(places)
        c = np.array([np.asarray(vectors[i], float) for i in places])
        fine = (np.abs(c) <= LARGEST).all(axis=1)  # false for NaN too
        good[places[fine]] = True
        x = np.floor(c[fine] * SCALE).astype(np.int64) + SHIFT
        found[length] = (places[fine], x)
    return good, found


def _length_sums(frames):
    total = {}
    for frame in frames:
        for length, (_, x) in whole_numbers(list(frame["v"]))[1].items():
            n, s = total.get(length, (0, 0))
            total[length] = (n + len(x), s + x.sum(axis=0))
    for length, (n, s) in total.items():
        if n:
            yield pd.DataFrame({"length": length, "i": np.arange(length), "n": n, "s": s})


def exact_sums(rows):
    """(n, sums of each dimension as integers) of the vectors of the most frequent length."""
    partial = rows.mapInPandas(_length_sums, "length int, i int, n long, s long")
    summed = partial.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    one = keep(summed, "whiten-sums")
    first = one.filter("i = 0").orderBy(F.col("n").desc(), "length").first()
    if first is None:
        return 0, []
    sums = one.filter(F.col("length") == first["length"]).orderBy("i").collect()
    return first["n"], [r["s"] for r in sums]


def centred(x, n, sums):
    """x less the mean, each entry rounded once."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], float) / n
    return (x - whole) - rest


def deviations(x, n, sums):
    """Sum over dimensions of (n x - S)**2, exact; None where it exceeds a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    near = x - whole
    rough = float(np.abs(near).max(initial=0) + 1) * n
    if rough * rough * max(1, x.shape[1]) < 2.0 ** 62:
        return ((n * near - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(r)) ** 2 for a, r in zip(row, rest, strict=True))
             for row in near]
    return [v if v < 1 << 63 else None for v in exact]


def _products(read, frames):
    """This task's sum of products, a row (part, i, row) for each dimension."""
    total = None
    for frame in frames:
        y = read(frame)
        for at in range(0, len(y), CHUNK):
            part = y[at:at + CHUNK]
            total = part.T @ part if total is None else total + part.T @ part
    if total is not None:
        yield pd.DataFrame({"part": TaskContext.get().partitionId(), "i": np.arange(len(total)),
                            "row": list(total)})


def _added_up(rows):
    """Sum of the arrays in ``rows``, structs (part, row), in order of the part."""
    ordered = F.transform(F.array_sort(rows), lambda r: r["row"])
    return F.reduce(F.slice(ordered, 2, F.size(ordered)), F.element_at(ordered, 1),
                    lambda a, b: F.zip_with(a, b, lambda x, y: x + y))


def covariance(rows, read, n, dims):
    """Sum of products of centred vectors over ``n``, as a matrix on the driver.

    ``read`` makes centred vectors of a pandas frame. Tasks' matrices are added up some dozens at
    a time, then the sums of those.
    """
    partial = rows.mapInPandas(functools.partial(_products, read),
                               "part int, i int, row array<double>")
    some = partial.groupBy("i", F.pmod("part", F.lit(64)).alias("part")).agg(
        _added_up(F.collect_list(F.struct("part", "row"))).alias("row"))
    whole = some.groupBy("i").agg(_added_up(F.collect_list(F.struct("part", "row"))).alias("row"))
    matrix = np.zeros((dims, dims))
    for r in whole.collect():
        matrix[r["i"]] = r["row"]
    return (matrix + matrix.T) / (2 * n)


def tridiagonal(matrix):
    """(diagonal, subdiagonal, reflection vectors) by Householder's reflections."""
    a = np.array(matrix, float)
    n = len(a)
    mirrors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        length = np.linalg.norm(v)
        if not length or not np.any(x[1:]):
            mirrors.append(None)  # the column is as it should be
            continue
        v /= length
        head = -np.copysign(size, x[0])
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = head
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def reflected_back(vectors, mirrors):
    """Vectors of the tridiagonal matrix as vectors of the whole one."""
    out = np.array(vectors)
    for k in range(len(mirrors) - 1, -1, -1):
        if mirrors[k] is not None:
            v = mirrors[k]
            out[k + 1:] -= 2 * np.outer(v, v @ out[k + 1:])
    return out


def sturm_counts(diagonal, squares, shifts):
    """How many eigenvalues are below each shift."""
    tiny = np.finfo(float).tiny * max(1.0, squares.max(initial=0.0))
    count = np.zeros(len(shifts), np.int64)
    q = diagonal[0] - shifts
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - shifts - squares[i - 1] / q
        q = np.where(np.abs(q) <= tiny, -tiny, q)
        count += q < 0
    return count


def leading_eigenvalues(diagonal, below, most):
    """The ``most`` largest eigenvalues, falling, each by bisection to the last digits."""
    n = len(diagonal)
    most = min(most, n)
    radius = np.zeros(n)
    radius[:-1] += np.abs(below)
    radius[1:] += np.abs(below)
    low, high = (diagonal - radius).min(), (diagonal + radius).max()
    margin = 2 * EPS * max(abs(low), abs(high)) * n + np.finfo(float).tiny
    low, high = np.full(most, low - margin), np.full(most, high + margin)
    wanted = n - 1 - np.arange(most)  # as many eigenvalues are smaller
    for _ in range(200):
        middle = (low + high) / 2
        if not ((low < middle) & (middle < high)).any():
            break
        above = sturm_counts(diagonal, below * below, middle) > wanted
        high = np.where(above, middle, high)
        low = np.where(above, low, middle)
    return (low + high) / 2


def _solve_shifted(diagonal, below, shift, b):
    """Solves (T - shift) z = b by elimination with row exchanges; zero pivots become tiny."""
    n = len(diagonal)
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0), 1e-300)
    one = (diagonal - shift).tolist()  # the row's first, second and third entry
    two, three = [*below.tolist(), 0.0], [0.0] * n
    under, z = below.tolist(), b.tolist()
    for i in range(n - 1):
        low = under[i]
        if abs(low) > abs(one[i]):
            swap = (one[i], two[i])
            one[i], two[i], three[i] = low, one[i + 1], two[i + 1]
            factor = swap[0] / low
            one[i + 1] = swap[1] - factor * two[i]
            two[i + 1] = -factor * three[i]
            z[i], z[i + 1] = z[i + 1], z[i] - factor * z[i + 1]
        else:
            if abs(one[i]) < tiny:
                one[i] = tiny
            factor = low / one[i]
            one[i + 1] -= factor * two[i]
            z[i + 1] -= factor * z[i]
    if abs(one[-1]) < tiny:
        one[-1] = tiny
    for i in range(n - 1, -1, -1):
        left = z[i]
        if i + 1 < n:
            left -= two[i] * z[i + 1]
        if i + 2 < n:
            left -= three[i] * z[i + 2]
        z[i] = left / one[i]
        if abs(z[i]) > 1e150:
            z[i:] = [v * 1e-150 for v in z[i:]]
            z[:i] = [v * 1e-150 for v in z[:i]]
    return np.array(z)


def inverse_iteration(diagonal, below, values):
    """Unit vectors of the falling eigenvalues ``values``, as columns.

    Vectors of eigenvalues closer than a thousandth of the matrix's size form a cluster; each new
    one is made orthogonal to those before it in its cluster, twice a step.
    """
    n = len(diagonal)
    size = max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0))
    rng = np.random.default_rng(13)  # a start without structure, the same each time
    found = np.zeros((n, len(values)))
    head = 0
    shift = None
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            head = k
        # Equal shifts would lead to one direction only.
        step = 4 * EPS * size
        shift = value if shift is None or shift - value > step else shift - step
        z = rng.standard_normal(n)
        for _ in range(6):
            z = _solve_shifted(diagonal, below, shift, z / np.linalg.norm(z))
            z /= np.abs(z).max()
            for _ in range(2):
                z -= found[:, head:k] @ (found[:, head:k].T @ z)
        found[:, k] = z / np.linalg.norm(z)
    return found


def leading_components(matrix, most=COMPONENTS):
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix.

    Eigenvalues that are zero to rounding, or below, are left out.
    """
    matrix = np.asarray(matrix, float)
    size = np.abs(matrix).max(initial=0.0)
    if not size:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, below, mirrors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, below, most)
    values = values[values > 4 * EPS * len(matrix) * values.max(initial=0.0)]
    vectors = reflected_back(inverse_iteration(diagonal, below, values), mirrors)
    vectors /= np.linalg.norm(vectors, axis=0)
    return values * size, vectors


def whiten(df, key="vec_id", vector="embedding", most=COMPONENTS):
    """(table, eigenvalues, trace, identity error): the whitened vectors and how they came.

    The table (``key``, n, deviation, whitened array<double>) has a row for each vector that
    counts. The identity error is the largest absolute entry of its covariance less the identity.
    """
    spark = df.sparkSession
    ready(spark)
    rows = df.select(F.col(key), F.col(vector).cast("array<double>").alias("v"))
    schema = rows.select(key, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias(
        "deviation"), F.col("v").alias("whitened")).schema
    n, sums = exact_sums(rows.select("v"))
    dims = len(sums)

    def matrix_of(frame):
        _, x = whole_numbers(list(frame["v"]))[1].get(dims, (None, None))
        return np.zeros((0, dims)) if x is None else centred(x, n, sums)

    total = covariance(rows.select("v"), matrix_of, n, dims) if n else np.zeros((0, 0))
    values, vectors = leading_components(total, most)
    trace = float(np.trace(total))
    shared = spark.sparkContext.broadcast(vectors / np.sqrt(values))

    def project(frames):
        for frame in frames:
            at, x = whole_numbers(list(frame["v"]))[1].get(dims, (None, None))
            if x is None or not len(x):
                continue
            out = centred(x, n, sums) @ shared.value
            yield pd.DataFrame({key: frame[key].iloc[at].to_numpy(), "n": n,
                                "deviation": pd.array(deviations(x, n, sums), "Int64"),
                                "whitened": list(out)})

    if not len(values):
        return spark.createDataFrame([], schema), values, trace, 0.0
    # Ids travel as they are: whole numbers beside nulls must not become floating ones.
    text = rows.withColumn(key, F.col(key).cast("string"))
    made = text.mapInPandas(project, text.select(
        key, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
        F.col("v").alias("whitened")).schema)
    table = keep(made.withColumn(key, F.col(key).cast(df.schema[key].dataType)), "whitened")

    mean_of = table.mapInPandas(_sums_of_whitened, "i int, s double").groupBy("i").agg(
        F.sum("s").alias("s"))
    mean = np.zeros(len(values))
    for r in mean_of.collect():  # a row for each component
        mean[r["i"]] = r["s"] / n

    def again(frame):
        return np.stack(frame["whitened"].to_list()) - mean

    unit = covariance(table.select("whitened"), again, n, len(values))
    error = float(np.abs(unit - np.eye(len(values))).max())
    return table, values, trace, error


def _sums_of_whitened(frames):
    total = None
    for frame in frames:
        part = np.stack(frame["whitened"].to_list()).sum(axis=0) if len(frame) else 0
        total = part if total is None else total + part
    if total is not None and np.ndim(total):
        yield pd.DataFrame({"i": np.arange(len(total)), "s": total})


def long_form(df, key="vec_id", vector="embedding", most=COMPONENTS):
    """A row for each vector and component, with what the component explains."""
    table, values, trace, error = whiten(df, key, vector, most)
    shares = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    rows = table.select(key, "n", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return rows.select(
        key, (F.col("_i") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.element_at(shares, F.col("_i") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
