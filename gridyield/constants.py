"""Fixed values of the physical model and of the lattice.

These are model parameters: results are only right with exactly these numbers.
"""

from __future__ import annotations

# --- radiation ---------------------------------------------------------------
SOLAR_CONSTANT_KW = 1.367  # kW m-2
MIN_COS_ZENITH = 1e-4
MIN_EXTRATERRESTRIAL_KW = 1e-6

# --- photovoltaic module -----------------------------------------------------
SYSTEM_COEFFICIENT = 0.8056
REFERENCE_CELL_TEMPERATURE = 25.0  # degC
TEMPERATURE_GAMMA = 0.005  # per degC
CELL_TEMPERATURE_OFFSET = 4.3  # degC
CELL_TEMPERATURE_AIR = 0.943
CELL_TEMPERATURE_IRRADIANCE = 0.028  # degC m2 W-1
CELL_TEMPERATURE_WIND = 1.528  # degC s m-1

# --- Fourier series in the day angle 2*pi*(doy-1)/365 (Spencer 1971) ----------
# (constant, [(cos, sin) of the 1st, 2nd, ... multiple of the angle])
DECLINATION_SERIES = (0.006918, [(-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.001480)])
EQUATION_OF_TIME_SERIES = (0.000075, [(0.001868, -0.032077), (-0.014615, -0.040849)])
EQUATION_OF_TIME_SCALE = 229.18  # minutes
ECCENTRICITY_SERIES = (1.000110, [(0.034221, 0.001280), (0.000719, 0.000077)])

# --- diffuse fraction (Erbs et al. 1982), polynomial coefficients from degree 0 --
ERBS_LOW_LIMIT = 0.22
ERBS_LOW = (1.0, -0.09)
ERBS_HIGH_LIMIT = 0.80
ERBS_MIDDLE = (0.9511, -0.1604, 4.388, -16.638, 12.336)
ERBS_CLEAR = 0.165

# --- wind turbine --------------------------------------------------------------
HUB_HEIGHT = 100.0  # m
REFERENCE_HEIGHT = 10.0  # m
POWER_LAW_EXPONENT = 1.0 / 7.0
CUT_OUT_SPEED = 25.0  # m s-1
CUT_OUT_RAMP = 0.01  # m s-1 from the cut-out speed down to zero power
CURVE_EXTENSION_STEP = 0.5  # m s-1

# --- units ------------------------------------------------------------------------
KELVIN_OFFSET = 273.15
KMH_PER_MS = 3.6
KMH_SPELLINGS = ("km/h", "kmh-1", "kmhr-1")
IRRADIANCE_QUANTILE, IRRADIANCE_LIMIT = 0.99, 10.0
TEMPERATURE_QUANTILE, TEMPERATURE_LIMIT = 0.5, 100.0
JOULE_PER_KWH = 3_600_000.0
SECONDS_PER_HOUR = 3600.0
MM_PER_M = 1000.0
SUNSHINE_THRESHOLD = 120.0  # W m-2

# --- 0.1 degree lattice, latitude 90 .. -90, longitude 0 .. 359.9 ------------------
LATTICE_STEPS_PER_DEGREE = 10
LATTICE_NLAT = 1801
LATTICE_NLON = 3600
LATTICE_TOLERANCE = 1e-3
GRID_TOLERANCE = 1e-6

# --- mean year of 8760 hours: February always has 28 days -------------------------
DAYS_PER_MONTH = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)

# --- natural keys of the annual result tables ---------------------------------------
REGION_KEY = ("energy", "model", "scenario", "region", "year")
GLOBAL_KEY = ("energy", "model", "scenario", "year")
REANALYSIS_REGION_KEY = ("energy", "source", "region", "year")
REANALYSIS_GLOBAL_KEY = ("energy", "source", "year")
PREFERRED_PERIOD = "2015-2060"
