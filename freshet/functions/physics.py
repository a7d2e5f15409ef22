"""Column expressions of hydrology and map projection. Missing inputs give missing results."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CUBIC_FEET_AN_ACRE_FOOT = 43560.0
KELVIN = 273.15


def at_least(c: Column, least: float) -> Column:
    """Clips from below and keeps nulls (``greatest`` would replace them)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(least)))


def clipped(c: Column, least: float, most: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(least)), F.lit(most)))


def present_rate(c: Column) -> Column:
    """Negative rates mean no data."""
    return F.when(c >= 0, c)


def lon360(c: Column) -> Column:
    return F.pmod(c, F.lit(360.0))


def depth(rate: Column, minutes: float) -> Column:
    """A rate an hour as the depth that falls in so many minutes."""
    return rate * F.lit(minutes / 60.0)


def hourly_pet(temp: Column, humidity: Column, longwave: Column, shortwave: Column, pressure: Column, u: Column, v: Column) -> Column:
    """Hourly Penman-Monteith reference evapotranspiration in mm.

    Degrees Celsius; specific humidity in kg/kg (values over 0.02 are taken as g/kg); radiation in W/m2; pressure in Pa;
    wind components at 10 m in m/s. Constants are those of the published hourly standard equation for short grass.
    """
    q = F.when(humidity > 0.02, humidity / 1000.0).otherwise(humidity)
    kpa = pressure / 1000.0
    wind = F.sqrt(u * u + v * v) * F.lit(4.87 / math.log(67.8 * 10.0 - 5.42))
    gamma = kpa * 0.000665
    saturated = F.exp(temp * 17.27 / (temp + 237.3)) * 0.6108
    actual = q * kpa / (q * 0.378 + 0.622)
    slope = saturated * 4098.0 / F.pow(temp + 237.3, F.lit(2.0))
    outgoing = F.pow(temp + KELVIN, F.lit(4.0)) * (0.98 * 4.903e-9 / 24.0)
    net = shortwave * (0.77 * 0.0036) + (longwave * 0.0036 - outgoing)
    soil, drag = F.when(net > 0, net * 0.1).otherwise(net * 0.5), F.when(net > 0, 0.24).otherwise(0.96)
    top = slope * 0.408 * (net - soil) + gamma * (F.lit(37.0) / (temp + KELVIN)) * wind * (saturated - actual)
    return at_least(top / (slope + gamma * (drag * wind + 1.0)), 0.0)


# fixed values: the conterminous Albers equal-area projection on the GRS 80 ellipsoid
ALBERS = {"a": 6378137.0, "f": 1 / 298.257222101, "lat1": 29.5, "lat2": 45.5, "lat0": 23.0, "lon0": -96.0}


def _authalic(sin_lat, e: float, log, sin=None):
    return (1 - e * e) * (sin_lat / (1 - e * e * sin_lat * sin_lat) - log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e))


def albers_terms() -> dict[str, float]:
    """The projection's constants n, C, rho0, e."""
    e = math.sqrt(ALBERS["f"] * (2 - ALBERS["f"]))
    lat = {k: math.radians(ALBERS[k]) for k in ("lat0", "lat1", "lat2")}
    m = {k: math.cos(x) / math.sqrt(1 - (e * math.sin(x)) ** 2) for k, x in lat.items()}
    q = {k: _authalic(math.sin(x), e, math.log) for k, x in lat.items()}
    n = (m["lat1"] ** 2 - m["lat2"] ** 2) / (q["lat2"] - q["lat1"])
    c = m["lat1"] ** 2 + n * q["lat1"]
    return {"n": n, "C": c, "rho0": ALBERS["a"] * math.sqrt(c - n * q["lat0"]) / n, "e": e}


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres: x and y."""
    k = albers_terms()
    s = F.sin(F.radians(lat))
    rho = F.sqrt(F.lit(k["C"]) - _authalic(s, k["e"], F.log) * k["n"]) * (ALBERS["a"] / k["n"])
    theta = F.radians(lon - ALBERS["lon0"]) * k["n"]
    return rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres to degrees: longitude and latitude, the latter by the published series from the authalic latitude (to about 1e-8 degrees)."""
    k = albers_terms()
    e, below = k["e"], F.lit(k["rho0"]) - y
    rho = F.sqrt(x * x + below * below)
    q = (F.lit(k["C"]) - F.pow(rho * (k["n"] / ALBERS["a"]), F.lit(2.0))) / F.lit(k["n"])
    authalic = F.asin(q / F.lit(_authalic(1.0, e, math.log)))
    # fixed values: the series' coefficients
    series = ((2, e**2 / 3 + 31 * e**4 / 180 + 517 * e**6 / 5040), (4, 23 * e**4 / 360 + 251 * e**6 / 3780), (6, 761 * e**6 / 45360))
    lat = authalic
    for times, factor in series:
        lat = lat + F.sin(authalic * float(times)) * factor
    return F.degrees(F.atan2(x, below) / F.lit(k["n"])) + ALBERS["lon0"], F.degrees(lat)
