"""Effect sizes, their verbal size, and the test verdict, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conventional cut points (small, medium, large) per kind of effect.
EFFECT_CUTS = {
    "r": (0.1, 0.3, 0.5),
    "v": (0.1, 0.3, 0.5),
    "eta2": (0.01, 0.06, 0.14),
}
EFFECT_NAMES = ("negligible", "small", "medium", "large", "undefined")


def cramers_v(chi2: Column, n: Column, rows: Column, cols: Column) -> Column:
    freedom = F.least(rows, cols) - F.lit(1)
    return F.when((freedom > 0) & (n > 0) & chi2.isNotNull(),
                  F.sqrt(F.greatest(F.lit(0.0), chi2) / F.nullif(n * freedom, F.lit(0))))


def kruskal_eta2(h: Column, groups: Column, n: Column) -> Column:
    spare = n - groups
    return F.when((spare > 0) & h.isNotNull(), F.greatest(F.lit(0.0),
                                        (h - groups + F.lit(1)) / F.nullif(spare, F.lit(0))))


def rank_biserial(u: Column, n1: Column, n2: Column) -> Column:
    pairs = n1.cast("double") * n2.cast("double")
    return F.when((n1 > 0) & (n2 > 0),
                  F.lit(1.0) - F.lit(2.0) * u / F.nullif(pairs, F.lit(0.0)))


def effect_label(value: Column, kind: str = "r", names=EFFECT_NAMES) -> Column:
    """Name the size of an effect; unknown kinds use the correlation scale."""
    small, medium, large = EFFECT_CUTS.get(kind, EFFECT_CUTS["r"])
    size = F.abs(value)
    return (F.when(size.isNull() | F.isnan(size), F.lit(names[4]))
            .when(size < small, F.lit(names[0]))
            .when(size < medium, F.lit(names[1]))
            .when(size < large, F.lit(names[2]))
            .otherwise(F.lit(names[3])))


def verdict(p: Column, alpha: float = 0.05) -> Column:
    return (F.when(p.isNull() | F.isnan(p), F.lit("not testable"))
            .when(p < alpha, F.lit("reject H0"))
            .otherwise(F.lit("do not reject H0")))


def stars(p: Column) -> Column:
    """Significance marks: three below 0.001, two below 0.01, one below 0.05."""
    return (F.when(p.isNull() | F.isnan(p), F.lit(""))
            .when(p < 0.001, F.lit("***"))
            .when(p < 0.01, F.lit("**"))
            .when(p < 0.05, F.lit("*"))
            .otherwise(F.lit(" ns")))
