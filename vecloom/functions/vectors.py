"""Vector and text column functions, built from Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DISTANCE_DIGITS = 6  # ranking compares distances rounded to this many digits, then keys


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _let(value: Column, body) -> Column:
    """Bind `value` once for use inside a lambda.

    An outer expression used in a lambda is evaluated once per element; going through a
    one-element array evaluates it once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def array_distance(a, b) -> Column:
    """Euclidean distance in double precision. NULL if either side is NULL.

    Unequal widths and NULL elements are errors, not NULL results.
    """
    a, b = _col(a).cast("array<double>"), _col(b).cast("array<double>")
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    width_error = F.raise_error(
        F.concat(
            F.lit("array_distance: widths differ, "),
            F.array_size(a).cast("string"),
            F.lit(" and "),
            F.array_size(b).cast("string"),
        )
    ).cast("double")
    element_error = F.raise_error(F.lit("array_distance: a vector has a NULL element")).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(F.array_size(a) != F.array_size(b), width_error)
        .otherwise(F.coalesce(F.sqrt(_sum(squares)), element_error))
    )


def vector_width(v) -> Column:
    """Number of elements; NULL for a NULL vector."""
    return F.array_size(_col(v))


def to_vector(v, width: int) -> Column:
    """Cast to `array<float>` and check the width. NULL stays NULL, another width is an error."""
    v = _col(v).cast("array<float>")
    error = F.raise_error(
        F.concat(
            F.lit("to_vector: cannot cast a list with length "),
            F.array_size(v).cast("string"),
            F.lit(f" to a vector with width {int(width)}"),
        )
    ).cast("array<float>")
    return F.when(F.array_size(v) != width, error).otherwise(v)


def l2_normalize(v) -> Column:
    """Divide by the Euclidean norm. There is no epsilon: a zero vector gives NaN elements."""
    v = _col(v).cast("array<double>")
    norm = F.sqrt(_sum(F.transform(v, lambda x: x * x)))
    unit = _let(norm, lambda n: F.transform(v, lambda x: F.when(n == 0, F.lit(float("nan"))).otherwise(x / n)))
    return unit.cast("array<float>")


def mean_pool(vectors, mask) -> Column:
    """Masked mean of a row's token vectors: sum(v * m) / max(sum(m), 1e-8)."""
    vectors, mask = _col(vectors).cast("array<array<double>>"), _col(mask).cast("array<double>")
    weighted = F.zip_with(vectors, mask, lambda v, m: F.transform(v, lambda x: x * m))
    zeros = F.transform(F.get(vectors, F.lit(0)), lambda x: F.lit(0.0))
    sums = F.aggregate(weighted, zeros, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))
    count = F.greatest(_sum(mask), F.lit(1e-8))
    pooled = _let(count, lambda n: F.transform(sums, lambda x: x / n))
    return pooled.cast("array<float>")


def valid_text(text) -> Column:
    """Decode lossily: invalid UTF-8 becomes U+FFFD. Takes strings and binary."""
    return F.make_valid_utf8(_col(text).cast("string"))


def rank_distance(distance) -> Column:
    """The rounded distance that every ranking here orders by."""
    return F.round(_col(distance), DISTANCE_DIGITS)
