"""Seeded draws as column expressions.

Every value is a function of (seed, dataset, field, row id), so it does not depend on the
partitioning, on retries or on the order of execution. One md5 gives four 32-bit draws;
a whole number from a range of more than 2^32 members takes 52 bits instead.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE, IS_NULL, SECOND, THIRD = range(4)
DAY = 86_400
#: Rounds of a shuffle; each moves one half of a position.
ROUNDS = 6


@dataclass(frozen=True)
class Draws:
    """The draws of one field of one row."""

    seed: int
    dataset: str
    field: str
    row_id: Column

    def digest(self) -> Column:
        return F.md5(F.concat(F.lit(f"{self.seed}|{self.dataset}|{self.field}|"), self.row_id.cast("string")))

    def unit(self, slot: int = VALUE, digits: int = 8) -> Column:
        """Uniform double in [0, 1), of that many hex digits."""
        number = F.conv(F.substring(self.digest(), 1 + 8 * slot, digits), 16, 10)
        return number.cast("double") / F.lit(float(1 << 4 * digits))

    def below(self, n: int, slot: int = VALUE) -> Column:
        """Uniform whole number in 0 … n-1; every one can be drawn, for n up to 2^52."""
        if n > 1 << 52:
            raise ValueError(f"a range of {n} members is beyond the resolution of a draw")
        wide = n > 1 << 32
        if wide and slot == THIRD:
            raise ValueError("the last draw of a field cannot be wide")
        return F.floor(self.unit(slot, 13 if wide else 8) * F.lit(n))

    def integer(self, low: int, high: int) -> Column:
        return self.below(high - low + 1) + F.lit(low)

    def real(self, low: float, high: float, digits: int = 2) -> Column:
        return F.round(F.lit(low) + self.unit() * F.lit(high - low), digits)

    def pick(self, values: Sequence, slot: int = VALUE) -> Column:
        """Uniform member of a list, which may hold None."""
        return F.element_at(F.array(*[F.lit(v) for v in values]), (self.below(len(values), slot) + 1).cast("int"))

    def coin(self) -> Column:
        return self.unit() < F.lit(0.5)

    def uuid(self) -> Column:
        """The md5 in the 8-4-4-4-12 form, with the version-4 and variant digits set."""
        d = self.digest()
        variant = F.substring(F.lit("89ab"), (F.conv(F.substring(d, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
        return F.concat(
            F.substring(d, 1, 8),
            F.lit("-"),
            F.substring(d, 9, 4),
            F.lit("-4"),
            F.substring(d, 14, 3),
            F.lit("-"),
            variant,
            F.substring(d, 18, 3),
            F.lit("-"),
            F.substring(d, 21, 12),
        )

    def instant(self, low: dt.datetime, high: dt.datetime) -> Column:
        """ISO text of a whole number of seconds after ``low``, not past ``high``."""
        seconds = int((high - low).total_seconds())
        return iso_text(low, self.below(seconds + 1))

    def shuffled(self, n: int) -> Column:
        """A seeded bijection of the row ids 0 … n-1, as an expression: no sort, no join, and no other row is looked at.

        A position is a pair (left, right) of a rectangle of about √n times √n cells, and each round moves one of the two by a draw
        from the other, which can be undone. A cell beyond n is moved on until it isn't. There are fewer of those than the
        rectangle has rows, so that up to 4096 members no walk is cut; beyond, the chance that one needs more than 64 steps is
        below n * n^-32.
        """
        if not 0 < n <= 1 << 52:
            raise ValueError(f"{n} members are beyond the resolution of a draw")
        rows = math.isqrt(n - 1) + 1
        width = -(-n // rows)
        prefix = F.lit(f"{self.seed}|{self.dataset}|{self.field}|")

        def step(at: Column, turn: Column) -> Column:
            right = F.pmod(at, F.lit(width))
            left = ((at - right) / F.lit(width)).cast("long")
            even = turn % 2 == 0
            other = F.when(even, right).otherwise(left)
            digest = F.md5(F.concat(prefix, turn.cast("string"), F.lit("|"), other.cast("string")))
            drawn = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
            moved_left, moved_right = F.pmod(left + drawn, F.lit(rows)) * width + right, left * width + F.pmod(right + drawn, F.lit(width))
            return F.when(even, moved_left).otherwise(moved_right).cast("long")

        def moved(at: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), at, step)

        first = moved(self.row_id.cast("long"))
        walk = F.sequence(F.lit(1), F.lit(min(rows, 64)))
        return F.aggregate(walk, first, lambda at, _: F.when(at < n, at).otherwise(moved(at)))

    def days_back(self, now: dt.datetime, most: int = 30) -> Column:
        """ISO text of ``now`` minus 0 … ``most`` whole days."""
        return iso_text(now, -self.below(most + 1) * F.lit(DAY))


def iso_text(start: dt.datetime, seconds: Column) -> Column:
    """ISO text of ``start`` moved by whole seconds, however many; fraction and offset of ``start`` are kept as they are.

    Computed on a timestamp without zone, so the session zone cannot shift it.
    """
    whole = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    days, rest = F.floor(seconds / F.lit(DAY)).cast("int"), F.pmod(seconds, F.lit(DAY)).cast("decimal(18,6)")
    moved = whole + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)
    fraction = f".{start.microsecond:06d}" if start.microsecond else ""
    offset = start.isoformat()[len(start.replace(tzinfo=None).isoformat()):]
    return F.concat(F.translate(moved.cast("string"), " ", "T"), F.lit(fraction + offset))
