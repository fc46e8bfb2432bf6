"""Column functions on reflectances and band vectors. All stay inside whole-stage code generation or array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The twelve bands in order, and each band's mean and standard deviation over the training imagery.
BANDS = ("coastal-aerosol", "blue", "green", "red", "red-edge", "red-edge-2", "red-edge-3", "nir", "red-edge-4", "water-vapor", "swir1", "swir2")
BAND_MEAN = (1367.8407, 1104.4116, 1026.8099, 856.1295, 1072.1476, 1880.3287, 2288.875, 2104.5999, 2508.7764, 305.3795, 1686.0194, 946.1319)
BAND_STD = (249.14418, 317.69983, 340.8048, 467.8019, 390.11594, 529.972, 699.90826, 680.56006, 798.34937, 108.10846, 651.8683, 568.5347)


def _literals(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def normalize(x: Column, scale: float = 3000.0) -> Column:
    """Reflectance to about 0..1."""
    return x / F.lit(float(scale))


def unit_norm(bands: Column, mean: Sequence[float] = BAND_MEAN, std: Sequence[float] = BAND_STD) -> Column:
    """Per-band standard scores of a band vector; a missing band stays missing."""
    centred = F.zip_with(bands, _literals(mean), lambda x, m: x - m)
    return F.zip_with(centred, _literals(std), lambda x, s: x / s)


def inverse_unit_norm(scores: Column, mean: Sequence[float] = BAND_MEAN, std: Sequence[float] = BAND_STD, scale: float = 3000.0) -> Column:
    """Back from standard scores to normalised reflectance."""
    spread = F.zip_with(scores, _literals(std), lambda x, s: x * s)
    return F.zip_with(spread, _literals(mean), lambda x, m: (x + m) / F.lit(float(scale)))


def normalized_difference(a: Column, b: Column, empty: float | None = None) -> Column:
    """(a - b) / (a + b); a zero sum gives empty (NULL by default). NDVI: nir and red; the moisture index: nir and swir1."""
    ratio = F.try_divide(a - b, a + b)
    return ratio if empty is None else F.coalesce(ratio, F.lit(float(empty)))


def array_mean(values: Column) -> Column:
    """Mean of an array's elements that are not NULL; NULL for none."""
    present = F.filter(values, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(present, F.lit(0.0), lambda s, x: s + x), F.size(present))


def contrast(bands: Column) -> Column:
    """Mean of bands 7 to 10 less the mean of the first four."""
    return array_mean(F.slice(bands, 7, 4)) - array_mean(F.slice(bands, 1, 4))


def stretch(x: Column, low: float = 0.1, high: float = 0.75, gamma: float = 1.2, clip: bool = False) -> Column:
    """(clip(x, low, high) - low) / (high - low) ** gamma: the exponent belongs to the denominator. clip: the result to 0..1 too."""
    out = (F.greatest(F.least(x, F.lit(high)), F.lit(low)) - F.lit(low)) / F.lit((high - low) ** gamma)
    return F.greatest(F.least(out, F.lit(1.0)), F.lit(0.0)) if clip else out


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(float(high))), F.lit(float(low)))


def min_max(x: Column, *partition: str) -> Column:
    """(x - min) / (max - min) over the partition (all rows without one); NULL where all are equal."""
    w = W.partitionBy(*(partition or (F.lit(0),)))
    return F.try_divide(x - F.min(x).over(w), F.max(x).over(w) - F.min(x).over(w))


def fire(coastal: Column, nir: Column, swir1: Column, swir2: Column) -> Column:
    """Active fire test on reflectances; a missing ratio counts as not above."""
    hot = F.coalesce(F.try_divide(swir2, nir) > 2.5, F.lit(False)) & (swir2 - nir > 0.3) & (swir2 > 0.5)
    flare = (swir1 > 0.8) & (coastal < 0.2) & ((nir > 0.4) | (swir2 < 0.1))
    return hot | flare


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def sliding_dot(bands: Column, kernel: Sequence[float]) -> Column:
    """Dot products of a short kernel at every place of the band vector."""
    k = len(kernel)
    return F.transform(F.sequence(F.lit(0), F.size(bands) - k), lambda i: dot(F.slice(bands, i + 1, k), _literals(kernel)))


def all_within(values: Column, low: float, high: float) -> Column:
    """Every element strictly between low and high."""
    return F.forall(values, lambda x: (x > low) & (x < high))


def color_match(values: Column, reference: Sequence[float], width: float) -> Column:
    """Every channel nearer to the reference than width."""
    return F.forall(F.zip_with(values, _literals(reference), lambda x, r: F.abs(x - r) < F.lit(width)), lambda x: x)


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def argmax(values: Column) -> Column:
    """Place (from 0) of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def bayes_update(prior: Column, positive: Column, sensitivity: float, specificity: float) -> Column:
    """Posterior of the positive class after one test with that outcome."""
    p1 = F.when(positive, F.lit(sensitivity)).otherwise(F.lit(1 - sensitivity)) * prior
    p0 = F.when(positive, F.lit(1 - specificity)).otherwise(F.lit(specificity)) * (1 - prior)
    return F.try_divide(p1, p1 + p0)


def vote_prior(vote: Column, disagreement: Column) -> Column:
    """Soft label of an ensemble: its vote, drawn to the middle by the members' disagreement (standard deviation)."""
    return vote * (1 - 2 * disagreement)


def soft_label(weights: Sequence[float], *labels: Column) -> Column:
    """Weighted sum of soft labels, divided by the weights' sum."""
    total = sum(weights)
    return sum((F.lit(w / total) * x for w, x in zip(weights, labels)), F.lit(0.0))
