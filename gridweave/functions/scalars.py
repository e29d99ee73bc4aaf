"""Scalar kernels as column expressions; a missing input gives a missing result."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import at_least, at_most, clip, holds

# Vapour pressure of the two Magnus forms, (hPa or kPa, factor, offset in degrees C).
MAGNUS_KPA = (0.6108, 17.625, 243.04)
MAGNUS_HPA = (6.112, 17.67, 243.5)
# Equilibrium moisture content by relative humidity, coefficients of (1, RH, T, RH * T, RH * RH), T in degrees F.
EMC_DRY = (0.03229, 0.281073, 0.0, -0.000578, 0.0)
EMC_MIDDLE = (2.22749, 0.160107, -0.014784, 0.0, 0.0)
EMC_MOIST = (21.0606, -0.483199, 0.0, -0.00035, 0.005565)
# Heat load, coefficients of (1, cosL cosS, cosF sinS sinL, sinL sinS, sinF sinS).
HEAT_LOAD = (-1.467, 1.582, -1.5, -0.262, 0.607)
BASE_RATE = 1.276e-3
#: Risk tiers as multiples of the base rate.
TIERS = (("High", 100), ("Elevated", 28), ("Moderate", 7))
RAMP = (1.0, 19.0)
#: Hours (UTC) in which satellites pass; half-open.
PASS_WINDOWS = ((0.0, 2.5), (11.7, 14.5), (23.7, 24.0))


def wind_u(speed: Column, direction: Column) -> Column:
    """Eastward wind from speed and the direction it blows from."""
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def wind_direction(u: Column, v: Column) -> Column:
    """The direction (degrees) that a wind blows from."""
    return F.pmod(F.degrees(F.atan2(u, v)) - 180, F.lit(360.0))


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def kmh_to_ms(x: Column) -> Column:
    return x / 3.6


def vapour_pressure(t: Column, form: tuple[float, float, float] = MAGNUS_KPA) -> Column:
    """Saturation vapour pressure at t degrees C, in the unit of the form."""
    scale, factor, offset = form
    return scale * F.exp(factor * t / (t + offset))


def vapour_deficit(t: Column, rh: Column) -> Column:
    return at_least(vapour_pressure(t) * (1 - rh / 100), 0.0)


def moisture_content(t: Column, rh: Column) -> Column:
    """Equilibrium moisture content in per cent from degrees C and relative humidity."""
    f = t * 9 / 5 + 32

    def of(c: tuple[float, ...]) -> Column:
        return c[0] + c[1] * rh + c[2] * f + c[3] * rh * f + c[4] * rh * rh

    return at_least(F.when(rh < 10, of(EMC_DRY)).when(rh <= 50, of(EMC_MIDDLE)).otherwise(of(EMC_MOIST)), 0.0)


def fire_weather(emc: Column, wind_ms: Column) -> Column:
    """Fosberg index from moisture content and wind."""
    m = at_most(emc, 30.0) / 30
    damping = 1 - 2 * m + 1.5 * m * m - 0.5 * m * m * m
    mph = 2.236936 * wind_ms
    return damping * F.sqrt(1 + mph * mph) / 0.3002


def vegetation_cover(ndvi: Column, soil: float = 0.05, vegetation: float = 0.86) -> Column:
    return clip(F.pow((ndvi - soil) / (vegetation - soil), F.lit(2.0)), 0.0, 1.0)


def hot_dry_windy(deficit: Column, wind: Column) -> Column:
    return deficit * wind


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    angle = 2 * math.pi * x / period
    return F.sin(angle), F.cos(angle)


def year_cycle(day: Column, period: float = 365.25) -> tuple[Column, Column]:
    """(sin, cos) of the day of year; 1 January is angle 0."""
    return cyclic(F.dayofyear(day) - 1, period)


def week_cycle(day: Column) -> tuple[Column, Column]:
    """(sin, cos) of the weekday; Monday is angle 0."""
    return cyclic(F.weekday(day).cast("double"), 7.0)


def heat_load(slope: Column, aspect: Column, latitude: Column) -> Column:
    """Heat load index from degrees; warmest at aspect 225."""
    s, lat, folded = F.radians(slope), F.radians(latitude), F.radians(F.abs(180 - F.abs(aspect - 225)))
    a, b, c, d, e = HEAT_LOAD
    return F.exp(a + b * F.cos(lat) * F.cos(s) + c * F.cos(folded) * F.sin(s) * F.sin(lat) + d * F.sin(lat) * F.sin(s) + e * F.sin(folded) * F.sin(s))


def aspect_parts(sectors: list[Column]) -> tuple[Column, Column, Column]:
    """(eastness, southness, aspect in degrees) from the shares of 8 sectors, the first centred at 22.5 degrees; missing if the first is."""
    east = sum((F.coalesce(f, F.lit(0.0)) * math.sin(math.radians(22.5 + 45 * k)) for k, f in enumerate(sectors)), F.lit(0.0))
    north = sum((F.coalesce(f, F.lit(0.0)) * math.cos(math.radians(22.5 + 45 * k)) for k, f in enumerate(sectors)), F.lit(0.0))
    there = sectors[0].isNotNull()
    return F.when(there, east), F.when(there, -north), F.when(there, F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)))


def humidity_from_dewpoint(t: Column, dew: Column) -> Column:
    return clip(100 * vapour_pressure(dew, MAGNUS_HPA) / vapour_pressure(t, MAGNUS_HPA), 0.0, 100.0)


def humidity_from_specific(q: Column, pressure_hpa: Column, t: Column) -> Column:
    pressure = q * pressure_hpa / (0.622 + 0.378 * q)
    return clip(100 * pressure / vapour_pressure(t, MAGNUS_HPA), 0.0, 100.0)


def kelvin_to_celsius(x: Column) -> Column:
    return x - 273.15


def pascal_to_hectopascal(x: Column) -> Column:
    return x / 100


def metres_to_millimetres(x: Column) -> Column:
    return x * 1000


def wrapped_longitude(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def grid_index(x: Column, origin: float, step: float) -> Column:
    """Nearest cell, halves to even."""
    return F.rint((x - origin) / step).cast("int")


def risk_band(p: Column, base: float = BASE_RATE) -> Column:
    out = None
    for name, times in TIERS:
        out = F.when(p >= times * base, name) if out is None else out.when(p >= times * base, name)
    return out.otherwise("Low")


def ramp_position(p: Column, base: float = BASE_RATE) -> Column:
    """Place of a probability on a logarithmic colour ramp, 0..1."""
    low, high = (math.log(x * base) for x in RAMP)
    return clip((F.ln(F.greatest(p, F.lit(1e-12))) - low) / (high - low), 0.0, 1.0)


def blended(over: Column, under: Column, alpha: Column) -> Column:
    """One colour channel of a layer over another."""
    return over * alpha + under * (1 - alpha)


def fractional_year(day: Column) -> Column:
    return F.year(day) + F.dayofyear(day) / 365.25


def logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def adjusted(p: Column, prior: Column) -> Column:
    """A probability moved by a prior's log odds."""
    return sigmoid(logit(clip(p, 1e-8, 1 - 1e-8)) + prior)


def uniform(seed: int, *keys: Column) -> Column:
    """A number between 0 and 1 from a row's keys: the first 13 hexadecimal digits of the md5 of seed and keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52


def noisy(x: Column, scale: float, seed: int, *keys: Column) -> Column:
    """x with normal noise that a row's keys and the seed settle, wherever the row is (Box-Muller)."""
    return x + F.sqrt(-2 * F.ln(uniform(seed, *keys))) * F.cos(2 * F.pi() * uniform(seed + 1, *keys)) * scale


def outside_passes(ts: Column) -> Column:
    """Whether no satellite passes at that time of day."""
    hour = F.hour(ts) + F.minute(ts) / 60
    inside = F.lit(False)
    for a, b in PASS_WINDOWS:
        inside = inside | ((hour >= a) & (hour < b))
    return holds(~inside)


def age_text(seconds: Column, fine: bool = False) -> Column:
    """How long ago, in the largest fitting unit; ``fine`` tells seconds below a minute and a half."""
    whole = lambda n: F.floor(seconds / n).cast("string")
    first = F.when(seconds < 90, F.concat(whole(1), F.lit("s ago"))) if fine else F.when(seconds < 120, F.lit("just now"))
    return F.when(seconds.isNull(), F.lit("—")).otherwise(first.when(seconds < 5400, F.concat(whole(60), F.lit("m ago"))).when(seconds < 172800, F.concat(whole(3600), F.lit("h ago"))).otherwise(F.concat(whole(86400), F.lit("d ago"))))
