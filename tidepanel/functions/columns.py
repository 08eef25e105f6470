"""Column expressions: casts, calendar parts, encodings, labels.

All are built-in JVM expressions. Division goes through ``try_divide`` and casts through
``try_cast`` because Spark's ANSI mode raises where a null is meant.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- cleaning -------------------------------------------------------------------------


def point_number(c: Column | str) -> Column:
    """Text to double; anything but a plain number gives null."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def locale_number(c: Column | str) -> Column:
    """Text with a decimal comma or point to double; anything else gives null."""
    return point_number(F.replace(col(c).cast("string"), F.lit(","), F.lit(".")))


def missing_if_nan(c: Column | str) -> Column:
    return F.nullif(col(c).cast("double"), F.lit(float("nan")))


def joined_timestamp(date: Column | str, time: Column | str) -> Column:
    """``yyyy-MM-dd`` and ``HH:mm`` to a zone-less timestamp; bad text raises."""
    text = F.concat(col(date), F.lit(" "), col(time))
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))


def lenient_date(c: Column | str) -> Column:
    """Text to date; bad text gives null."""
    return F.try_to_date(col(c).cast("string"), "yyyy-MM-dd")


def floor_to(c: Column | str, minutes: int) -> Column:
    """Floor a zone-less timestamp to a divisor of the hour.

    Subtracts the excess instead of using ``date_trunc``, which would pass through the
    session's time zone and shift hours that a daylight-saving change skips.
    """
    ts = col(c)
    excess = F.minute(ts) % minutes
    seconds = F.date_part(F.lit("SECOND"), ts)
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, excess, seconds)


# --- calendar -------------------------------------------------------------------------

# Season of each month and its ordinal.
SEASONS = {
    "Winter": ((12, 1, 2), 1),
    "Spring": ((3, 4, 5), 2),
    "Summer": ((6, 7, 8), 3),
    "Autumn": ((9, 10, 11), 4),
}


def season(month: Column | str) -> Column:
    out = None
    for name, (months, _) in SEASONS.items():
        test = col(month).isin(*months)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def season_number(name: Column | str) -> Column:
    out = None
    for label, (_, number) in SEASONS.items():
        test = col(name) == label
        out = F.when(test, number) if out is None else out.when(test, number)
    return out


def calendar(ts: Column | str) -> dict[str, Column]:
    """Calendar columns of a timestamp; weekdays count from Monday = 0."""
    t = col(ts)
    weekday = F.weekday(t)
    return {
        "Year": F.year(t),
        "Month": F.month(t),
        "Day": F.dayofmonth(t),
        "Hour": F.hour(t),
        "DayOfWeek": weekday,
        "IsWeekend": (weekday >= 5).cast("int"),
        "Quarter": F.quarter(t),
        "Season": season(F.month(t)),
    }


# --- arithmetic -----------------------------------------------------------------------


def sum_present(columns: Sequence[str]) -> Column:
    """Row sum that skips nulls; a row of nulls gives 0."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total


def share(part: Column | str, total: Column | str) -> Column:
    """Percentage, 0 where the total is not positive."""
    p, t = col(part), col(total)
    return F.when(t > 0, F.try_divide(p, t) * 100).otherwise(0.0)


def ratio_to_next(a: Column | str, b: Column | str) -> Column:
    """``a / (b + 1)``; null where the denominator is 0."""
    return F.try_divide(col(a), col(b) + 1)


def cyclic(x: Column | str, period: int) -> tuple[Column, Column]:
    angle = col(x) * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def hash_normal(keys: Sequence[Column | str], seed: int) -> Column:
    """A standard normal number from a row's key: the same whatever the partitioning.

    Two uniform numbers from the key's MD5 become a normal one by Box and Muller.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))
    first, second = (
        (F.conv(F.substring(digest, at, 8), 16, 10).cast("double") + 0.5) / float(1 << 32) for at in (1, 9)
    )
    return F.sqrt(-2 * F.log(first)) * F.cos(2 * math.pi * second)


def harmonic_temperature(
    day_of_year: Column | str, hour: Column | str, noise_seed: int | None = None, keys: Sequence[Column | str] = ()
) -> Column:
    """Yearly and daily temperature wave, with normal noise (sd 3) by ``keys`` when a seed is given."""
    year_wave = F.sin(col(day_of_year) * (2 * math.pi) / 365 - math.pi / 2)
    day_wave = F.sin(col(hour) * (2 * math.pi) / 24 - math.pi / 3)
    value = F.lit(15.0) + 10 * year_wave + 5 * day_wave
    return value if noise_seed is None else value + 3 * hash_normal(keys, noise_seed)


# --- text -----------------------------------------------------------------------------


@cache
def _accent_table() -> tuple[str, str]:
    """Characters to replace by their base letter, then combining marks to delete."""
    accented, plain, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        base = [b for b in unicodedata.normalize("NFD", ch) if not unicodedata.combining(b)]
        if len(base) == 1 and base[0] != ch:
            accented.append(ch)
            plain.append(base[0])
    return "".join(accented + marks), "".join(plain)


def accent_key(c: Column | str) -> Column:
    """Key that ignores accents and case (Hangul syllables stay composed)."""
    return F.lower(F.translate(col(c), *_accent_table()))


def first_token(c: Column | str, sep: str = "_") -> Column:
    return F.split_part(col(c), F.lit(sep), F.lit(1))


def shortened(c: Column | str, width: int) -> Column:
    """Cut to ``width`` characters and mark the cut."""
    text = col(c)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("...")))\
        .otherwise(text)


def spaced(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("_"), F.lit(" "))


# Wichura's rational approximations of the normal quantile (AS 241, PPND16), from the
# constant term up: the middle, then the tails for r up to 5 and beyond. Error below 1e-15.
QUANTILE_MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
QUANTILE_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
QUANTILE_FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(x: Column, tables: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    parts = []
    for coefficients in tables:
        value = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            value = value * x + c
        parts.append(value)
    return parts[0] / parts[1]


def normal_quantile(p: Column | str) -> Column:
    """Where the standard normal distribution reaches ``p``; null outside of (0, 1)."""
    p = col(p)
    d = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.signum(d) * F.when(r <= 5, _ratio(r - 1.6, QUANTILE_TAIL)).otherwise(_ratio(r - 5.0, QUANTILE_FAR))
    inside = (p > 0) & (p < 1)
    return F.when(inside & (F.abs(d) <= 0.425), d * _ratio(0.180625 - d * d, QUANTILE_MIDDLE)).when(inside, tail)


# --- labels of test results -----------------------------------------------------------


def stars(p: Column | str, otherwise: str = "ns") -> Column:
    p = col(p)
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise(otherwise)


# Thresholds and labels of correlations and effects.
def strength(r: Column | str) -> Column:
    size = F.abs(col(r))
    return (
        F.when(size < 0.1, "Négligeable")
        .when(size < 0.3, "Faible")
        .when(size < 0.5, "Modérée")
        .when(size < 0.7, "Forte")
        .when(size.isNotNull(), "Très forte")
    )


def effect(eta_squared: Column | str) -> Column:
    e = col(eta_squared)
    return F.when(e > 0.14, "Large").when(e > 0.06, "Medium").when(e.isNotNull(), "Small")


def nonlinear(r: Column | str, rho: Column | str) -> Column:
    return F.abs(col(rho) - col(r)) > 0.1


def sign_name(c: Column | str) -> Column:
    return F.when(col(c) > 0, "positive").when(col(c) < 0, "negative").otherwise("zero")
