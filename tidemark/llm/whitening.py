"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers, so the scatter matrix ``n^2 V`` is known exactly. Spark sums it, reduces it to Hessenberg form
modulo many primes, one task per few primes, and reads the characteristic polynomial off each; Chinese remaindering
joins them. All its roots are real, so the sign changes of a shifted polynomial count the roots above a point exactly:
that isolates the largest ones, and bisection by the sign of the polynomial refines them far beyond double precision.
Components span the null space of ``V - e``, found by inverse iteration in decimal arithmetic.

Everything that leaves the tasks depends on the dimension alone: sums, one polynomial per prime, a few vectors.
"""

from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.repeats import column

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries from this size on count as non-finite: sums of squares then fit 38 digits for any number of rows.
LARGEST = float(1 << 32)
ROOT_BITS = 140
DIGITS = 110
OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def integer_rows(frame, id_col="vec_id", vec_col="embedding"):
    """(id, x): usable vectors as integers floor(1024 c) + 100000."""
    vec = F.col(f"`{vec_col}`")
    usable = vec.isNotNull() & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LARGEST))
    x = F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    return frame.filter(F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").alias(id_col), x.alias("x"))


def _matrix(batch, dim):
    return column(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _decimals(values):
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def fit_sums(rows):
    """(n, sums per dimension) of the most frequent length, of equally frequent ones the larger; (0, []) without rows."""

    def run(batches):
        total = {}
        for b in batches:
            x = column(b, "x")
            lens = x.value_lengths().to_numpy()
            for dim in np.unique(lens):
                part = x.filter(pa.array(lens == dim)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else np.zeros((int((lens == 0).sum()), 0), np.int64)
                n, s = total.get(int(dim), (0, 0))
                total[int(dim)] = n + len(part), s + part.sum(axis=0).astype(object)  # entries are below 2^43
        for dim, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * (dim + 1), pa.int32()), pa.array(range(-1, dim), pa.int32()), _decimals([n, *s])], ["dim", "i", "part"])

    sums = rows.select("x").mapInArrow(run, "dim int, i int, part decimal(38,0)").groupBy("dim", "i").agg(F.sum("part").alias("v"))
    sums = stored(rows.sparkSession, sums, "vector-sums")
    most = sums.filter("i = -1").orderBy(F.desc("v"), F.desc("dim")).first()
    if most is None:
        return 0, []
    return int(most["v"]), [int(r["v"]) for r in sums.filter((F.col("dim") == most["dim"]) & (F.col("i") >= 0)).orderBy("i").collect()]


def _products(y):
    """Exact sum of outer products of integer rows, as an object matrix."""
    most = int(np.abs(y).max(initial=1)) or 1
    some = (1 << 53) // (most * most)
    if not some:
        y = y.astype(object)
        return y.T @ y
    out = np.zeros((y.shape[1],) * 2, dtype=object)
    for at in range(0, len(y), some):
        part = y[at : at + some].astype(np.float64)  # every partial sum is an integer below 2^53
        out += (part.T @ part).astype(np.int64)
    return out


def scatter(rows, n, sums):
    """The integer matrix ``n^2 V``: rows are centred at the rounded mean, then corrected exactly for the rest."""
    dim = len(sums)
    center = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def run(batches):
        total = np.zeros((dim, dim), dtype=object)
        for b in batches:
            if b.num_rows:
                total += _products(_matrix(b, dim) - center)
        i, k = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i * dim + k, pa.int64()), _decimals(total[i, k])], ["at", "part"])

    found = rows.filter(F.size("x") == dim).select("x").mapInArrow(run, "at long, part decimal(38,0)")
    found = found.groupBy("at").agg(F.sum("part").alias("v")).collect()  # dim * (dim + 1) / 2 numbers
    left = [int(s) - n * int(c) for s, c in zip(sums, center)]
    out = np.zeros((dim, dim), dtype=object)
    for r in found:
        i, k = divmod(r["at"], dim)
        out[i, k] = out[k, i] = n * int(r["v"]) - left[i] * left[k]
    return out


def is_prime(p):
    """Miller and Rabin with bases that decide every number below 3.2e9."""
    if p < 9:
        return p in (2, 3, 5, 7)
    d, s = p - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(s - 1)):
            return p == a
    return p % 2 == 1


def primes(bits):
    """Primes below 2^31, largest first, whose product has more than ``bits`` bits."""
    out, p, product = [], (1 << 31) - 1, 1
    while product.bit_length() <= bits:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def hessenberg(a, p):
    """A matrix similar to ``a`` modulo ``p`` with zeros below the first subdiagonal."""
    a = a.copy()
    for k in range(len(a) - 2):
        held = np.flatnonzero(a[k + 1 :, k])
        if not len(held):
            continue
        i = k + 1 + held[0]
        if i != k + 1:
            a[[i, k + 1]] = a[[k + 1, i]]
            a[:, [i, k + 1]] = a[:, [k + 1, i]]
        u = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - u[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * u % p).sum(axis=1)) % p
    return a


def polynomial_mod(a, p):
    """Coefficients of det(x - a) modulo ``p``, constant first."""
    h, dim = hessenberg(a, p), len(a)
    known = np.zeros((dim + 1, dim + 1), dtype=np.int64)
    known[0, 0] = 1
    for k in range(1, dim + 1):
        row = np.zeros(dim + 1, dtype=np.int64)
        row[1:] = known[k - 1, :-1]
        t, factors = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):  # product of the subdiagonal between i and k
            factors[i] = h[i, k - 1] * t % p
            t = t * int(h[i, i - 1]) % p if i else t
        known[k] = (row - (factors[:, None] * known[:k] % p).sum(axis=0)) % p
    return known[dim]


def characteristic_polynomial(spark, m):
    """Integer coefficients of det(x - m), constant first, for a positive semidefinite integer matrix."""
    dim, trace = len(m), int(sum(m.diagonal()))
    # By Maclaurin's inequality no coefficient exceeds the largest term of (1 + trace / dim)^dim.
    terms, choose = [1], 1
    for k in range(1, dim + 1):
        choose = choose * (dim - k + 1) // k
        terms.append(choose * trace**k // dim**k + 1)
    wanted = primes(max(terms).bit_length() + 2)

    def run(batches):
        for b in batches:
            ps = column(b, "p").to_pylist()
            coefs = [polynomial_mod((m % p).astype(np.int64), p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([column(b, "p"), pa.array(coefs, pa.list_(pa.int64()))], ["p", "coefs"])

    some = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(min(len(wanted), 64), "p")
    product, value = 1, [0] * (dim + 1)
    for r in some.mapInArrow(run, "p long, coefs array<long>").collect():
        inverse = pow(product, -1, r["p"])
        value = [v + product * ((c - v) * inverse % r["p"]) for v, c in zip(value, r["coefs"])]
        product *= r["p"]
    return [v - product if 2 * v > product else v for v in value]


def roots_above(coefs, at, bits):
    """How many roots exceed ``at / 2^bits``, with multiplicity: sign changes of the shifted polynomial."""
    dim = len(coefs) - 1
    c = [v << bits * (dim - k) for k, v in enumerate(coefs)]
    for k in range(dim):
        for i in range(dim - 1, k - 1, -1):
            c[i] += at * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefs, at, bits):
    out = 0
    for k, v in enumerate(reversed(coefs)):
        out = out * at + (v << bits * k)
    return out


def largest_roots(coefs, count):
    """[(numerator, bits, multiplicity)] of the largest positive roots, at least ``count`` or all; all roots are real and >= 0.

    Roots that agree in ROOT_BITS bits are one of that multiplicity.
    """
    positive = roots_above(coefs, 0, 0)
    top = max(-coefs[-2], 0) + 1 if len(coefs) > 1 else 1
    out, found = [], 0
    # (low, high, bits, roots above high, roots in between), largest first.
    todo = [(0, top, 0, 0, positive)]
    while todo and found < count:
        low, high, bits, above, inside = todo.pop()
        if not inside:
            continue
        while inside == 1 and (high - low) << ROOT_BITS > low:
            if high - low < 2:
                low, high, bits = low * 2, high * 2, bits + 1
            mid = (low + high) // 2
            # Left of the largest root the sign alternates with every root passed.
            v = _value(coefs, mid, bits)
            right = above if v == 0 else above + (v > 0 if above % 2 else v < 0)
            if v == 0:
                low, high = mid * (2 << ROOT_BITS), mid * (2 << ROOT_BITS) + 1
                bits += ROOT_BITS + 1
            elif right > above:
                low = mid
            else:
                high = mid
        if (high - low) << ROOT_BITS <= low:
            out.append((low + high, bits + 1, inside))
            found += inside
            continue
        if high - low < 2:
            low, high, bits = low * 2, high * 2, bits + 1
        mid = (low + high) // 2
        right = roots_above(coefs, mid, bits)
        todo.append((low, mid, bits, right, above + inside - right))
        todo.append((mid, high, bits, above, right - above))
    return out


def null_vectors(m, root, bits, count):
    """``count`` orthonormal vectors that ``m - root / 2^bits`` all but annuls, by inverse iteration in decimals."""
    dim = len(m)
    with localcontext() as context:
        context.prec = DIGITS
        e = Decimal(root) / Decimal(1 << bits)
        a = np.array([[Decimal(int(v)) for v in row] for row in m], dtype=object)
        size = max(abs(v) for v in a.ravel()) or Decimal(1)
        a[np.arange(dim), np.arange(dim)] -= e
        order = np.arange(dim)
        for k in range(dim):
            i = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, i]], order[[k, i]] = a[[i, k]], order[[i, k]]
            if not a[k, k]:
                a[k, k] = size * Decimal(10) ** -(DIGITS - 10)
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solved(v):
            v = v[order]
            for k in range(dim):
                v[k + 1 :] -= a[k + 1 :, k] * v[k]
            for k in range(dim - 1, -1, -1):
                v[k] /= a[k, k]
                v[:k] -= a[:k, k] * v[k]
            return v

        out = []
        for j in range(count):
            v = np.array([Decimal((i * 7919 + j * 104729 + 12345) * 2654435761 % 4294967296 - 2147483648) for i in range(dim)], dtype=object)
            for _ in range(3):
                v = solved(v)
                for w in out:
                    v = v - w * (v @ w)
                v = v / (v @ v).sqrt()
            out.append(v)
        return [[float(c) for c in v] for v in out]


def components(spark, m, count=COMPONENTS):
    """[(eigenvalue of m, as Decimal, unit vector)], largest first: at most ``count``, only positive ones."""
    if not len(m):
        return []
    roots = largest_roots(characteristic_polynomial(spark, m), count)

    def run(batches):
        for b in batches:
            at, root, bits, times = (column(b, c).to_pylist() for c in ("at", "root", "bits", "times"))
            for i in range(len(at)):
                for j, v in enumerate(null_vectors(m, int(root[i]), bits[i], times[i])):
                    yield pa.RecordBatch.from_arrays([pa.array([at[i]], pa.int32()), pa.array([j], pa.int32()), pa.array([v], pa.list_(pa.float64()))], ["at", "j", "v"])

    given = spark.createDataFrame([(i, str(r), b, min(k, count)) for i, (r, b, k) in enumerate(roots)], "at int, root string, bits int, times int")
    found = given.repartition(max(1, len(roots)), "at").mapInArrow(run, "at int, j int, v array<double>")
    with localcontext() as context:
        context.prec = DIGITS
        values = [Decimal(r) / Decimal(1 << b) for r, b, _ in roots]
    return [(values[r["at"]], r["v"]) for r in sorted(found.collect(), key=lambda r: (r["at"], r["j"]))][:count]


def whiten(frame, id_col="vec_id", vec_col="embedding", count=COMPONENTS):
    """One row per usable vector and component: id, component from 1, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are left out, so are those of another length than the
    most frequent one (of equally frequent ones the larger) and those with an entry of 2^32 or more in size.
    Components without variance don't exist: a table of equal vectors, of one, of empty ones or without usable
    ones has no rows. Repeated and null ids keep their rows. Other columns are ignored. ``deviation``
    is exact; an error is raised where it takes more than 38 digits.
    """
    spark = frame.sparkSession
    rows = integer_rows(frame, id_col, vec_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    n, sums = fit_sums(rows)
    m = scatter(rows, n, sums) if sums else np.zeros((0, 0), dtype=object)
    found = components(spark, m, count) if sum(m.diagonal()) else []
    if not found:
        return spark.createDataFrame([], f"`{id_col}` {id_type}, {OUT}")
    dim, trace = len(sums), int(sum(m.diagonal()))
    center = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    left = np.array([s - n * int(c) for s, c in zip(sums, center)], dtype=object)
    rest = (left / n).astype(np.float64)
    squared = int(left @ left)
    if n < 1 << 31:
        left = left.astype(np.int64)
    with localcontext() as context:
        context.prec = DIGITS
        project = np.array([v for _, v in found]).T / np.array([float(e.sqrt() / n) for e, _ in found])
        explained = [float(e / trace) for e, _ in found]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b, dim) - center
            most = int(np.abs(y).max(initial=0)) + n
            y_ = y if most * most * dim < 1 << 62 else y.astype(object)
            # Squares of n x - S = n y - left, summed.
            squares = n * n * (y_ * y_).sum(axis=1).astype(object) - 2 * n * (y_ @ left).astype(object) + squared
            w = (y - rest) @ project
            yield pa.RecordBatch.from_arrays(
                [column(b, id_col), _decimals(squares), pa.array(w.tolist(), pa.list_(pa.float64()))], [id_col, "deviation", "w"])

    done = rows.filter(F.size("x") == dim).mapInArrow(run, f"`{id_col}` {id_type}, deviation decimal(38,0), w array<double>")
    done = stored(spark, done, "whitened")
    k = len(found)
    means = done.agg(*[F.avg(F.col("w")[i]) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = done.agg(*[F.avg((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])) for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(cov, pairs))
    each = F.posexplode("w").alias("_i", "whitened")
    return done.select(f"`{id_col}`", "deviation", each).select(
        f"`{id_col}`", (F.col("_i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("_i") + 1).alias("explained"), F.lit(error).alias("identity_error"))
