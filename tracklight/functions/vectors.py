"""Vector arithmetic on ``array<double>`` columns, evaluated in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNROLLED = 32


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def dot(a, b) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def dot_of(a, b, width: int) -> Column:
    """Dot product of vectors of known width; short ones are written out, which compiles to plain arithmetic."""
    if width > UNROLLED:
        return dot(a, b)
    return reduce(Column.__add__, [_col(a)[i] * _col(b)[i] for i in range(width)])


def map_of(width: int, function, *vectors) -> Column:
    """``function`` of the elements at each place of vectors of known width."""
    if width > UNROLLED:
        if len(vectors) == 1:
            return F.transform(_col(vectors[0]), function)
        return F.zip_with(_col(vectors[0]), _col(vectors[1]), function)
    return F.array(*[function(*[_col(v)[i] for v in vectors]) for i in range(width)])


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a, b) -> Column:
    """Cosine of the angle; 0 when either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), length))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def euclidean(a, b) -> Column:
    gaps = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x))


def mean_squared_gap(a, b) -> Column:
    gaps = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x) / F.size(_col(a))


def unit(a) -> Column:
    """The vector scaled to length 1; a zero vector stays zero."""
    length = norm(a)
    return F.transform(_col(a), lambda x: F.coalesce(F.try_divide(x.cast("double"), length), F.lit(0.0)))


def sum_of(column, width: int) -> Column:
    """Element-wise sum over a group, combined map-side: a plain sum per element of short vectors, one typed aggregate
    (ML's summary of a vector column) for longer ones, whose cost does not grow with the number of expressions."""
    c = _col(column)
    if width > UNROLLED:
        from pyspark.ml.functions import array_to_vector, vector_to_array
        from pyspark.ml.stat import Summarizer

        return vector_to_array(Summarizer.sum(array_to_vector(c.cast("array<double>"))))
    return F.array(*[F.sum(c[i]) for i in range(width)])


def random_vector(width: int, scale: float, shift: float, *parts) -> Column:
    """Seeded start vector with elements ``(uniform + shift) * scale``."""
    from tracklight.functions.hashing import uniform

    if width > UNROLLED:
        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda f: (uniform(*parts, f.cast("string")) + F.lit(shift)) * F.lit(scale))
    return F.array(*[(uniform(*parts, f) + F.lit(shift)) * F.lit(scale) for f in range(width)])
