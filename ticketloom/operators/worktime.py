"""Working time: due times and elapsed time that count business hours only.

Working time up to an instant is a sum in closed form: whole weeks, the days of the week before, the part of
the day, less what holidays before it took. The way back is a binary search in the working time before each holiday
and then in the week. No row is made for a day, and a column of instants is mapped within its row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.functions import text as X

MINUTE = 60_000_000
DAY = 1440 * MINUTE
#: A Monday; days are counted from it.
BASE = date(1970, 1, 5)


def numbers(values: Sequence[int]) -> Column:
    """A constant list as one literal, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def count_below(ordered: Column, n: int, x: Column) -> Column:
    """How many of n ascending numbers are below x, by binary search."""
    if not n:
        return F.lit(0)
    steps = F.array(*(F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda pos, s: F.when((pos + s <= n) & (F.element_at(ordered, F.least(pos + s, F.lit(n))) < x), pos + s).otherwise(pos))


def at(values: Column, place: Column) -> Column:
    """The number at a place from 0 on."""
    return F.element_at(values, place + 1)


@dataclass(frozen=True)
class WorkCalendar:
    """Working hours by day of the week, Monday first, as (begin, end) or None, and days off. Times are those of the columns, without a zone."""

    hours: tuple[tuple[time, time] | None, ...] = ((time(9), time(17)),) * 5 + (None, None)
    holidays: tuple[date, ...] = ()

    def __post_init__(self) -> None:
        if len(self.hours) != 7 or not any(self.hours) or any(h and h[0] >= h[1] for h in self.hours):
            raise ValueError("a calendar needs seven days, one of them with hours that end after they begin")

    @cached_property
    def begins(self) -> list[int]:
        return [(h[0].hour * 60 + h[0].minute) * MINUTE if h else 0 for h in self.hours]

    @cached_property
    def lengths(self) -> list[int]:
        return [(h[1].hour * 60 + h[1].minute) * MINUTE - b if h else 0 for h, b in zip(self.hours, self.begins, strict=True)]

    @cached_property
    def upto(self) -> list[int]:
        """Working time of a week before each day, and of the whole week."""
        out = [0]
        for n in self.lengths:
            out.append(out[-1] + n)
        return out

    @property
    def day_minutes(self) -> int:
        """A business day: the longest one."""
        return max(self.lengths) // MINUTE

    @cached_property
    def days_off(self) -> list[int]:
        """Days off that would be working days, counted from BASE."""
        days = sorted({(h - BASE).days for h in self.holidays})
        return [d for d in days if self.lengths[d % 7]]

    @cached_property
    def lost(self) -> list[int]:
        """What the days off before each of them took, and all of them."""
        out = [0]
        for d in self.days_off:
            out.append(out[-1] + self.lengths[d % 7])
        return out

    @cached_property
    def before_off(self) -> list[int]:
        """Working time before each day off."""
        return [d // 7 * self.upto[7] + self.upto[d % 7] - n for d, n in zip(self.days_off, self.lost, strict=False)]

    def _with_tables(self, value: Column, body) -> Column:
        """Evaluate `value` once and hand it on with the calendar's lists, which are constants only outside of lambdas."""
        lists = {"begins": self.begins, "lengths": self.lengths, "upto": self.upto, "off": self.days_off, "lost": self.lost, "before": self.before_off}
        return X.let(F.struct(value.alias("value"), *(numbers(v).alias(k) for k, v in lists.items())), body)

    def worked(self, instant: Column) -> Column:
        """Microseconds of working time from BASE up to an instant; null stays null."""
        micros = F.timestamp_diff("MICROSECOND", F.lit(datetime.combine(BASE, time())).cast("timestamp_ntz"), instant.cast("timestamp_ntz"))
        n = len(self.days_off)

        def upto(t: Column) -> Column:
            u = t["value"]

            def on_day(day: Column) -> Column:
                of_week = F.pmod(day, F.lit(7)).cast("int")
                part = F.greatest(F.least(u - day * DAY - at(t["begins"], of_week), at(t["lengths"], of_week)), F.lit(0))
                whole = F.floor(day / 7) * self.upto[7] + at(t["upto"], of_week)
                off = X.let(count_below(t["off"], n, day), lambda k: F.struct(at(t["lost"], k).alias("lost"), (F.get(t["off"], k) == day).alias("today")))
                return X.let(off, lambda o: whole - o["lost"] + F.when(o["today"], 0).otherwise(part))

            return X.let(F.floor(u / DAY), on_day)

        return self._with_tables(micros, upto)

    def instant(self, worked: Column) -> Column:
        """The first instant at which so much working time has passed; null stays null."""

        def back(t: Column) -> Column:
            w = t["value"]

            def in_week(g: Column) -> Column:
                week = -F.floor(-g / self.upto[7]) - 1
                rest = F.struct(week.alias("week"), (g - week * self.upto[7]).alias("rest"))
                place = lambda r: X.let(count_below(t["upto"], 8, r["rest"]) - 1, lambda d: (r["week"] * 7 + d) * DAY + at(t["begins"], d) + r["rest"] - at(t["upto"], d))
                return X.let(rest, place)

            return X.let(w + at(t["lost"], count_below(t["before"], len(self.before_off), w)), in_week)

        base = F.lit(datetime.combine(BASE, time())).cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", self._with_tables(worked, back), base)

    def add(self, start: Column, minutes: Column) -> Column:
        """The instant at which so many working minutes have passed since start; start itself for none."""
        return F.when(minutes > 0, self.instant(self.worked(start) + minutes.cast("bigint") * MINUTE)).otherwise(F.when(minutes.isNotNull(), start.cast("timestamp_ntz")))

    def elapsed(self, start: Column, end: Column) -> Column:
        """Working minutes between two instants, negative if they are the other way round."""
        return (self.worked(end) - self.worked(start)) / MINUTE


def yearly(years: range, *days: tuple[int, int]) -> tuple[date, ...]:
    """The same days (month, day) of some years."""
    return tuple(date(y, m, d) for y in years for m, d in days)

