"""Guarded ratios, and exact sums of doubles that do not depend on the order of the rows.

A sum of doubles rounds at every addition, so its last digits change with the partitioning.
Here each value is cut into seven limbs of 21 bits (2^42, 2^21, 1, 2^-21, .., 2^-84; the top
one takes what is above), which is free of error for all values from 1e-9 to 2^63, and each
limb is summed as a whole number: up to 2^42 rows cannot overflow. The limbs are put together
and rounded to a double once, at the end (``money_value``).

``money_sum`` gives the limbs as a struct, ``money_total`` adds up such structs (sums of sums
stay exact). Values beyond 2^63, infinities and NaN are summed apart, as doubles, and added
at the end: an infinity gives an infinite sum, opposite ones NaN. NULLs are left out, and a sum
of no values is NULL. Bits of a value below 2^-84 (5e-26) are cut off, and a sum below 0.002 is
rounded at 2^-63 (1e-19).
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, Row
from pyspark.sql import functions as F

_BITS = 21
_MASK = (1 << _BITS) - 1
#: Exponent of each limb's unit.
_UNITS = tuple(42 - _BITS * k for k in range(7))
_LIMBS = tuple(f"l{k}" for k in range(7))
_WIDEST = 2.0 ** 63


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(num, den)


def pct(num: Column, den: Column) -> Column:
    """Percentage ``num / den * 100``; NULL when ``den`` is 0 or NULL."""
    return safe_ratio(num, den) * F.lit(100.0)


def _cut(x: Column) -> list[Column]:
    """The limbs of a double below 2^63, with its sign."""
    size = F.abs(x)
    whole = F.floor(size)
    below = (size - whole) * _WIDEST             # the next 63 bits
    fraction = F.floor(below)
    rest = F.floor((below - fraction) * 2.0 ** _BITS)
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
    parts = [F.shiftright(whole, 2 * _BITS), F.shiftright(whole, _BITS).bitwiseAND(_MASK),
             whole.bitwiseAND(_MASK), F.shiftright(fraction, 2 * _BITS),
             F.shiftright(fraction, _BITS).bitwiseAND(_MASK), fraction.bitwiseAND(_MASK), rest]
    return [p.cast("long") * sign for p in parts]


def money_sum(value: str | Column, times: Column | None = None) -> Column:
    """Exact sum of doubles (each ``times`` over, where given), as a struct of limbs."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    plain = F.when(F.abs(x) < _WIDEST, x)
    wild = F.when(~(F.abs(x) < _WIDEST), x)
    if times is not None:
        wild = F.when(times > 0, wild * times)
    limbs = [c * times if times is not None else c for c in _cut(plain)]
    return F.struct(*[F.sum(c).alias(n) for n, c in zip(_LIMBS, limbs)],
                    F.sum(wild).alias("wild"))


def money_total(sums: str | Column) -> Column:
    """Sum of the sums that ``money_sum`` gave."""
    c = F.col(sums) if isinstance(sums, str) else sums
    return F.struct(*[F.sum(c[n]).alias(n) for n in (*_LIMBS, "wild")])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _carried(parts: list[Column]) -> Column:
    """Whole part and limbs below 1, these within 0 .. 2^21 - 1."""
    parts = list(parts)
    for k in range(len(parts) - 1, 2, -1):
        parts[k - 1] = parts[k - 1] + F.shiftright(parts[k], _BITS)
        parts[k] = parts[k].bitwiseAND(_MASK)
    whole = (_number(parts[0]) * _power(42) + _number(parts[1]) * _power(21) + _number(parts[2]))
    return F.struct(_number(whole).alias("whole"), (
        F.shiftleft(parts[3], 42) + F.shiftleft(parts[4], 21) + parts[5]).alias("below"),
        parts[6].alias("rest"))


def _number(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def _power(n: int) -> Column:
    return _number(F.lit(Decimal(2 ** n)))


def _decimal_text(c: Column) -> Column:
    """All digits of a carried sum that is not negative: 63 bits below 1 have 63 decimals; a
    last digit stands for what is below them, so the text is read as the nearest double."""
    unit, rest = _number(F.lit(Decimal(10 ** 18))), _number(c["below"])
    text = [c["whole"].cast("string"), F.lit(".")]
    for _ in range(4):
        scaled = _number(rest * unit)
        digits = F.call_function("div", scaled, _power(63))
        text.append(F.lpad(digits.cast("string"), 18, "0"))
        rest = _number(scaled % _power(63))
    return F.concat(*text, F.when(c["rest"] > 0, "1").otherwise("0"))


def money_value(limbs: str | Column) -> Column:
    """The double nearest to a sum of ``money_sum`` or ``money_total``."""
    c = F.col(limbs) if isinstance(limbs, str) else limbs

    def nearest(s: Column) -> Column:
        parts = [s[n] for n in _LIMBS]
        number = _let(_carried(parts), lambda up: F.when(up["whole"] >= 0, _decimal_text(up))
                      .otherwise(F.concat(F.lit("-"), _let(_carried([-p for p in parts]),
                                                           _decimal_text)))).cast("double")
        return F.when(s["wild"].isNotNull(), s["wild"] + F.coalesce(number, F.lit(0.0))
                      ).otherwise(number)

    return _let(c, nearest)


def money_fraction(limbs: Row | None) -> Fraction | float:
    """The exact value of a collected sum (none: 0); a double where it has wild values."""
    if limbs is None or (limbs["l0"] is None and limbs["wild"] is None):
        return Fraction(0)
    exact = sum((Fraction(limbs[n] or 0) * Fraction(2) ** u for n, u in zip(_LIMBS, _UNITS)),
                Fraction(0))
    return exact if limbs["wild"] is None else float(exact) + limbs["wild"]


def round_money(c: Column, digits: int = 2) -> Column:
    """Round to ``digits`` half-up."""
    return F.round(c, digits).cast("double")
