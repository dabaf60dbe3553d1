"""Scalar expressions: power transforms, temperature estimates, labels, hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exponent and zero point of the approximate temperature display.
APPROX_LAMBDA = 0.24
KELVIN_ZERO = 273.15

NEAR_ZERO = 1e-10


def boxcox(x: Column, lmbda: float) -> Column:
    if abs(lmbda) < NEAR_ZERO:
        return F.ln(x)
    return (F.pow(x, F.lit(lmbda)) - 1.0) / F.lit(lmbda)


def boxcox_inverse(v: Column, lmbda: float) -> Column:
    """Back to the raw scale; values below the transform's range become 0."""
    if abs(lmbda) < NEAR_ZERO:
        return F.exp(v)
    inner = F.greatest(v * F.lit(lmbda) + 1.0, F.lit(0.0))
    return F.when(v.isNotNull(), F.pow(inner, F.lit(1.0 / lmbda)))


def approximate_kelvin(raw: Column) -> Column:
    return F.when(raw > 0, F.pow(raw, F.lit(1.0 / APPROX_LAMBDA))).otherwise(F.lit(0.0))


def approximate_celsius(raw: Column) -> Column:
    return approximate_kelvin(raw) - F.lit(KELVIN_ZERO)


def feature_label(feature: Column) -> Column:
    """Readable label of a feature name."""
    spaced = F.replace(feature, F.lit("_"), F.lit(" "))
    return F.initcap(F.replace(spaced, F.lit("wtd"), F.lit("weighted")))


def key_digest(seed: int, *keys: Column) -> Column:
    """A stable digest of a row key: the same on every run, cluster and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def digest_number(digest: Column) -> Column:
    """The first 60 bits of a digest as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def below_fraction(digest: Column, fraction: float) -> Column:
    """True for `fraction` of all digests, compared as hex text of 8 digits."""
    if fraction >= 1.0:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(f"{int(fraction * 2**32):08x}")


def safe_ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)
