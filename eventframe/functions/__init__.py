"""Column functions over jagged columns, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(items: Column) -> Column:
    """Sum of an entry's items; 0 for none."""
    return F.aggregate(items, F.lit(0).cast("double"), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0).cast("double"), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def where(items: Column, mask: Column) -> Column:
    """The items whose place in mask is true."""
    return F.transform(F.filter(F.arrays_zip(items.alias("x"), mask.alias("m")), lambda s: s["m"]), lambda s: s["x"])


def pairs(items: Column) -> Column:
    """All unordered pairs of an entry's items as structs a, b."""
    n = F.size(items)
    left = lambda i: F.transform(F.slice(items, i + 2, n - i), lambda y: F.struct(F.element_at(items, i + 1).alias("a"), y.alias("b")))
    return F.when(n > 1, F.flatten(F.transform(F.sequence(F.lit(0), n - 2), left))).otherwise(F.array().cast("array<struct<a:double,b:double>>"))


def bin_of(x: Column, low: float, width: float, bins: int) -> Column:
    """Histogram bin from 0, with -1 for underflow and bins for overflow."""
    k = F.floor((x - low) / width)
    return F.greatest(F.lit(-1), F.least(F.lit(bins), k)).cast("int")


def delta_phi(a: Column, b: Column) -> Column:
    """Difference of angles in [-pi, pi)."""
    return F.pmod(a - b + F.pi(), 2 * F.pi()) - F.pi()


def invariant_mass(pt1: Column, eta1: Column, phi1: Column, pt2: Column, eta2: Column, phi2: Column) -> Column:
    """Mass of two massless particles."""
    return F.sqrt(2 * pt1 * pt2 * (F.cosh(eta1 - eta2) - F.cos(phi1 - phi2)))
