"""Vector expressions on array columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    """Inner product in double precision."""
    pairs = F.zip_with(
        a, b, lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v) -> Column:
    """Unit length as array<double>; a zero vector stays zero."""
    norm = F.sqrt(dot(v, v))
    # the one-element array evaluates the norm once, not once per entry
    return F.element_at(
        F.transform(
            F.array(norm),
            lambda n: F.transform(
                v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))
            ),
        ),
        1,
    )
