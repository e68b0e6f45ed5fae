"""Vectors as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fuse(a: Column, b: Column) -> Column:
    """Mean by element; an empty side gives way to the other, unequal lengths to the first."""
    none_a, none_b = (F.coalesce(F.size(v) <= 0, F.lit(True)) for v in (a, b))
    mean = F.zip_with(a, b, lambda x, y: ((x.cast("double") + y.cast("double")) / 2).cast("float"))
    return F.when(none_a, b).when(none_b, a).when(F.size(a) != F.size(b), a).otherwise(mean)


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles, summed in order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def sign_bits(v: Column, bits: int = 64) -> Column:
    """Bit i is set if element i is positive."""
    own = F.transform(F.slice(v, 1, bits), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def seeded_vector(text: Column, dims: int = 8) -> Column:
    """A vector that depends on the text alone, for runs without a model: four elements
    to a digest. Empty for an empty text."""
    part = lambda digest, k: (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") % 2001 / 1000.0 - 1.0).cast("float")
    digests = F.array(*(F.md5(F.concat_ws(":", text, F.lit(str(i)))) for i in range(-(-dims // 4))))
    one = F.slice(F.flatten(F.transform(digests, lambda d: F.array(*(part(d, k) for k in range(4))))), 1, dims)
    return F.when(F.length(F.coalesce(text, F.lit(""))) > 0, one).otherwise(F.array().cast("array<float>"))
