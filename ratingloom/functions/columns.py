"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2_147_483_647  # a prime, 2^31 - 1; products of two values below it fit a long
TIE_DIGITS = 9


def mix(user: str | Column, item: str | Column, seed: int | Column = 0) -> Column:
    """Arithmetic hash of a pair in [0, HASH_RANGE), the same in every SQL engine.

    Any 64-bit ids fit: an id is first folded from its upper and lower 31 bits, so ids below the range differ from
    each other and larger ones do not repeat with the range. A linear sum alone would keep the order of the pairs
    when the seed changes. Its fifth power modulo the prime is a permutation of the range that does not.
    """
    size = F.lit(HASH_RANGE).cast("long")

    def folded(part: Column) -> Column:
        part = part.cast("long")
        return F.pmod(F.pmod(part, size) + F.pmod(F.shiftright(part, 31), size) * 48271, size)

    user = folded(F.col(user) if isinstance(user, str) else user)
    item = folded(F.col(item) if isinstance(item, str) else item)
    seed = folded(F.lit(seed) if isinstance(seed, int) else seed)
    # the three products together stay below 2^63
    base = F.pmod(user * 1103515245 + item * 998244353 + seed * 715225739, size)
    square = F.pmod(base * base, size)
    return F.pmod(F.pmod(square * square, size) * base, size)


def mix_unit(user: str | Column, item: str | Column, seed: int | Column = 0) -> Column:
    """The same hash as a number in [0, 1)."""
    return mix(user, item, seed) / F.lit(float(HASH_RANGE))


def tie_safe(value: Column) -> Column:
    """Score used for ranking: equal to nine digits counts as a tie, so sum order cannot flip ranks."""
    return F.round(value, TIE_DIGITS)


def rounded(value: str | Column, digits: int = 6) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two array<double> columns."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def combine(a: str | Column, b: str | Column, fn: Callable[[Column, Column], Column]) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.zip_with(a, b, fn)


def vector_agg(fn: Callable[[Column], Column], element: Callable[[int], Column], k: int) -> Column:
    """Element-wise aggregate of vectors as k scalar aggregates, which combine map-side in codegen."""
    return F.array(*[fn(element(f)) for f in range(k)])


def initial_vector(id_col: str | Column, k: int, seed: int, scale: float = 0.2, low: float = -0.5) -> Column:
    """Reproducible starting factors: scale * (hash(id, factor, seed) + low)."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    places = F.sequence(F.lit(0), F.lit(k - 1))
    return F.transform(places, lambda f: F.lit(scale) * (mix_unit(id_col, f, seed) + F.lit(low)))
