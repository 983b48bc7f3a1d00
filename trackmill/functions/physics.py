"""Airspeed, atmosphere and drag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit conversions and the standard atmosphere.
KT_TO_MPS = 0.514444
FTMIN_TO_MPS = 0.00508
M_TO_FT = 3.28084
SEA_LEVEL_PRESSURE = 101325.0
SEA_LEVEL_TEMPERATURE = 288.15
LAPSE_RATE = 0.0065
GAS_CONSTANT_AIR = 287.05
GRAVITY = 9.80665
GRAVITY_ROUNDED = 9.81
HEAT_RATIO = 1.4


def true_airspeed(groundspeed: Column, track: Column, wind_u: Column, wind_v: Column) -> Column:
    """True airspeed in kt from ground speed (kt), track (deg) and wind (m/s)."""
    ground = groundspeed * KT_TO_MPS
    east = ground * F.sin(F.radians(track)) - wind_u
    north = ground * F.cos(F.radians(track)) - wind_v
    return F.sqrt(east * east + north * north) / KT_TO_MPS


def path_angle(vertical_rate: Column, tas: Column) -> Column:
    """Climb gradient from vertical rate (ft/min) and airspeed (kt); NULL at zero airspeed."""
    return F.try_divide(vertical_rate * FTMIN_TO_MPS, tas * KT_TO_MPS)


def air_density(altitude_m: Column, temperature_k: Column) -> Column:
    """Ideal-gas density under the barometric pressure of the standard atmosphere (kg/m3)."""
    exponent = GRAVITY / (GAS_CONSTANT_AIR * LAPSE_RATE)
    base = 1.0 - altitude_m * LAPSE_RATE / SEA_LEVEL_TEMPERATURE
    return SEA_LEVEL_PRESSURE * F.pow(base, F.lit(exponent)) / (temperature_k * GAS_CONSTANT_AIR)


def drag_term(cd0: Column, tas_mps: Column) -> Column:
    return cd0 * tas_mps * tas_mps / 2.0


def mach(tas_kt: Column, temperature_k: Column) -> Column:
    return F.try_divide(tas_kt * KT_TO_MPS, F.sqrt(temperature_k * (HEAT_RATIO * GAS_CONSTANT_AIR)))


def thrust(c0: Column, c1: Column, c2: Column, c3: Column,
           tas: Column, altitude: Column, vertical_rate: Column) -> Column:
    """Thrust as a linear form in airspeed, altitude and vertical rate; the coefficients are data."""
    return c0 + c1 * tas + c2 * altitude + c3 * vertical_rate


def fuel_flow(f0: Column, f1: Column, f2: Column, f3: Column, force: Column, altitude: Column) -> Column:
    return f0 + f1 * force + f2 * force * force + f3 * altitude


def smooth_up(x: Column, low: float, high: float) -> Column:
    """0 below ``low``, 1 above ``high``, two parabolas in between."""
    width, middle = high - low, (low + high) / 2
    rising, settling = (x - low) / width, (x - high) / width
    return (
        F.when(x <= low, 0.0)
        .when(x >= high, 1.0)
        .when(x <= middle, rising * rising * 2.0)
        .when(x.isNotNull(), 1.0 - settling * settling * 2.0)
    )


def smooth_down(x: Column, low: float, high: float) -> Column:
    return 1.0 - smooth_up(x, low, high)


def bell(x: Column, centre: float, spread: float) -> Column:
    offset = x - centre
    return F.exp(offset * offset / (-2.0 * spread * spread))
