"""Column helpers shared by the native operators (JVM expressions only)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 64-bit unsigned uniforms are cut into two halves of 32 bits.
TWO32 = float(1 << 32)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable.

    Spark may inline a projected column into a lambda, which then evaluates it once per element; a lambda
    variable is never inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def indices(n: Column) -> Column:
    """0 .. n-1, and no element for n = 0 (``sequence`` alone would count downwards)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(empty("int"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the fast way for texts without other letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, letters, letters.lower())
    )


def words(text: Column, separators: str) -> Column:
    """The pieces of ``text`` between runs of the character class ``separators``; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def window_hashes(w: Column, n: int, seed: int = 0) -> Column:
    """xxhash64 of each run of ``n`` elements of array ``w``; shorter arrays give one hash of all, empty ones none."""
    return F.when(
        F.size(w) > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))),
            lambda i: F.xxhash64(F.lit(seed), *[F.get(w, i + j) for j in range(n)]),
        ),
    ).otherwise(empty("bigint"))


def long_array(values: Sequence[int]) -> Column:
    """A constant array, folded once by the optimizer."""
    if not values:
        return empty("bigint")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def uniform(h: Column, low: bool) -> Column:
    """A double in (0, 1) from one half of a 64-bit hash."""
    half = h.bitwiseAND(F.lit(0xFFFFFFFF)) if low else F.shiftrightunsigned(h, 32)
    return (half.cast("double") + 0.5) / TWO32


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending approximate quantiles of a long column that cut it into at most ``parts`` ranges.

    One scan of that column; the sketch and the result are bounded by ``parts``, not by the data.
    """
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, at, F.lit(20 * parts)).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_of(key: Column, bounds: Sequence[int]) -> Column:
    """Number of ``bounds`` that are <= key, by a search of two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    every, coarse = long_array(bounds), long_array(bounds[step - 1 :: step])
    below = lambda a: F.size(F.filter(a, lambda b: b <= key))
    return let(below(coarse) * step, lambda c: c + below(F.slice(every, c + 1, step)))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
