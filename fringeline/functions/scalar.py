"""Column expressions of radar interferometry: identifiers, dates, phases, look geometry, clips.

All run inside whole-stage code generation; none needs Python on the executors but ``strip_accents``.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sentinel-1 repeat cycle in days and orbits, C-band wavelength factors, ionosphere constant.
CYCLE_DAYS, CYCLE_ORBITS = 12, 175
SPEED_OF_LIGHT = 299_792_458.0
C_BAND_HZ = 5.405e9
IONO_K = 40.308193
EARTH_RADIUS_M = 6_378_137.0
EARTH_FLATTENING = 1 / 298.257223563
FRAME_ID = r"^\d{3}[AD]_\d{5}_\d{6}$"
PRODUCT_NAME = r"^(S1[A-D])_([A-Z0-9]{2})_[A-Z]{3}[A-Z_]_\d[A-Z]([A-Z]{2})_(\d{8}T\d{6})_(\d{8}T\d{6})"


def is_frame_id(frame: Column) -> Column:
    return frame.rlike(FRAME_ID)


def frame_track(frame: Column) -> Column:
    return F.substring(frame, 1, 3).cast("int")


def frame_pass(frame: Column) -> Column:
    return F.substring(frame, 4, 1)


def frame_burst_count(frame: Column) -> Column:
    """Sum of the three two-digit swath counts."""
    return sum((F.substring(frame, at, 2).cast("int") for at in (14, 16)), F.substring(frame, 12, 2).cast("int"))


def burst_parts(burst: Column) -> Column:
    """``relorb_IWn_tanx*10`` -> struct(relorb, iw, tanx)."""
    p = F.split(burst, "_")
    return F.struct(F.get(p, F.lit(0)).cast("int").alias("relorb"), F.substring(F.get(p, F.lit(1)), 3, 1).cast("int").alias("iw"), (F.get(p, F.lit(2)).cast("double") / 10).alias("tanx"))


def product_parts(name: Column) -> Column:
    """Scene name -> struct(sat, mode, pol, start, stop)."""
    part = [F.regexp_extract(name, PRODUCT_NAME, i) for i in range(1, 6)]
    stamp = "yyyyMMdd'T'HHmmss"
    return F.struct(part[0].alias("sat"), part[1].alias("mode"), part[2].alias("pol"), F.try_to_timestamp(part[3], F.lit(stamp)).alias("start"), F.try_to_timestamp(part[4], F.lit(stamp)).alias("stop"))


def relative_orbit(orbit: Column) -> Column:
    """Absolute to relative orbit of the first satellite, 1 to 175."""
    return F.pmod(orbit - 73, F.lit(CYCLE_ORBITS)) + 1


def archive_path(name: Column, date: Column, base: str) -> Column:
    """Archive folder of a scene; the processor's version folder changed on 2019-06-25."""
    version = F.when(date >= F.lit("2019-06-25").cast("date"), F.lit("IPF_v3")).otherwise(F.lit("IPF_v2"))
    return F.concat_ws("/", F.lit(base), version, F.date_format(date, "yyyy"), F.date_format(date, "MM"), F.date_format(date, "dd"), F.concat(name, F.lit(".zip")))


def lband_frame(product: Column) -> Column:
    """L-band product id -> track_direction_frame."""
    p = F.split(product, "_")
    return F.concat_ws("_", F.get(p, F.lit(5)), F.get(p, F.lit(6)), F.get(p, F.lit(7)))


def pair_dates(pair: Column) -> Column:
    """yyyymmdd_yyyymmdd -> struct(epoch1, epoch2, btemp)."""
    e1, e2 = (F.try_to_date(F.get(F.split(pair, "_"), F.lit(i)), "yyyyMMdd") for i in (0, 1))
    return F.struct(e1.alias("epoch1"), e2.alias("epoch2"), F.datediff(e2, e1).alias("btemp"))


def pair_name(epoch1: Column, epoch2: Column) -> Column:
    return F.concat_ws("_", F.date_format(epoch1, "yyyyMMdd"), F.date_format(epoch2, "yyyyMMdd"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between timestamps, rounded down."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.floor((micros(later) - micros(earlier)) / 86_400_000_000)


def wrap(phase: Column) -> Column:
    """Phase in (-pi, pi]."""
    return F.atan2(F.sin(phase), F.cos(phase))


def wrap_mod(phase: Column) -> Column:
    """Phase in [-pi, pi)."""
    two_pi = 2 * F.pi()
    return F.pmod(phase + F.pi(), two_pi) - F.pi()


def to_complex(mag: Column, phase: Column) -> Column:
    return F.struct((mag * F.cos(phase)).alias("re"), (mag * F.sin(phase)).alias("im"))


def conjugate_product(re1: Column, im1: Column, re2: Column, im2: Column) -> Column:
    """a * conj(b)"""
    return F.struct((re1 * re2 + im1 * im2).alias("re"), (im1 * re2 - re1 * im2).alias("im"))


def rad_to_mm(rad: Column, sign: int, wavelength_m: float) -> Column:
    """Line-of-sight mm; sign conventions differ between products, so both arguments are asked for."""
    return rad * F.lit(sign * wavelength_m * 1000 / (4 * 3.141592653589793))


def mm_to_rad(mm: Column, sign: int, wavelength_m: float) -> Column:
    return mm / F.lit(sign * wavelength_m * 1000 / (4 * 3.141592653589793))


def coherence_from_byte(byte: Column) -> Column:
    return byte / F.lit(255.0)


def coherence_to_byte(coh: Column) -> Column:
    return F.round(coh * 255).cast("short")


def phase_weight(coh: Column) -> Column:
    """2c^2 / (1 - c^2), null at c = 1."""
    return 2 * coh * coh / F.nullif(1 - coh * coh, F.lit(0.0))


def phase_std_deg(coh: Column, terms: int = 100) -> Column:
    """Single-look phase deviation in degrees from coherence, by the series of the dilogarithm."""
    c2 = coh * coh
    dilog = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda a, k: a + F.pow(c2, k) / (k * k))
    a = F.asin(coh)
    return F.degrees(F.sqrt(F.greatest(F.pi() * F.pi() / 3 - F.pi() * a + a * a - dilog / 2, F.lit(0.0))))


def point_phase_std_deg(coh: Column) -> Column:
    """Point-scatterer phase deviation in degrees."""
    return F.degrees(F.sqrt((1 - coh * coh) / (2 * coh * coh)))


def phase_pdf(phase: Column, coh: Column, mean: float = 0.0) -> Column:
    """Single-look probability density of the phase."""
    b = coh * F.cos(phase - F.lit(mean))
    return (1 - coh * coh) / (2 * F.pi()) / (1 - b * b) * (1 + b * F.acos(-b) / F.sqrt(1 - b * b))


def phase_pdf_looks(phase: Column, coh: Column, looks: int, terms: int = 100) -> Column:
    """Density for several looks, with the Gauss hypergeometric series 2F1(L, 1; 1/2; b^2)."""
    b = coh * F.cos(phase)
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    series = F.aggregate(
        F.sequence(F.lit(0), F.lit(terms - 1)), start, lambda a, k: F.struct((a["t"] * (k + looks) / (k + 0.5) * b * b).alias("t"), (a["s"] + a["t"] * (k + looks) / (k + 0.5) * b * b).alias("s"))
    )["s"]
    from math import gamma, pi

    lead = gamma(looks + 0.5) / (2 * gamma(looks) * pi**0.5)
    return F.pow(1 - coh * coh, F.lit(looks)) * (F.lit(lead) * b / F.pow(1 - b * b, F.lit(looks + 0.5)) + series / (2 * F.pi()))


def anx_burst_id(seconds: Column) -> Column:
    """Tenths of a second since the ascending node, within one orbit."""
    return F.round(F.pmod(seconds, F.lit(CYCLE_DAYS * 86400 / CYCLE_ORBITS)) * 10).cast("long")


def incidence_deg(east: Column, up: Column) -> Column:
    return F.degrees(F.acos(up))


def heading_deg(east: Column, north: Column, right_looking: bool = True) -> Column:
    """Heading from the horizontal part of the line of sight."""
    flip = 1 if right_looking else -1
    return F.degrees(F.atan2(north * flip, -east * flip))


def azimuth_enu(inc_deg: Column, heading: Column) -> Column:
    """East and north part of the along-track unit vector."""
    return F.struct(F.sin(F.radians(heading)).alias("e"), F.cos(F.radians(heading)).alias("n"))


def los_enu(inc_deg: Column, heading: Column) -> Column:
    """Line-of-sight unit vector (e, n, u) of a right-looking radar."""
    i, h = F.radians(inc_deg), F.radians(heading)
    return F.struct((-F.sin(i) * F.cos(h)).alias("e"), (F.sin(i) * F.sin(h)).alias("n"), F.cos(i).alias("u"))


def geodetic(x: Column, y: Column, z: Column) -> Column:
    """ECEF metres -> struct(lon, lat, height), closed form."""
    a, f = EARTH_RADIUS_M, EARTH_FLATTENING
    b, e2 = a * (1 - f), f * (2 - f)
    p = F.hypot(x, y)
    t = F.atan2(z * a, p * b)
    lat = F.atan2(z + e2 / (1 - e2) * b * F.pow(F.sin(t), 3), p - e2 * a * F.pow(F.cos(t), 3))
    n = a / F.sqrt(1 - e2 * F.sin(lat) * F.sin(lat))
    return F.struct(F.degrees(F.atan2(y, x)).alias("lon"), F.degrees(lat).alias("lat"), (p * F.cos(lat) + z * F.sin(lat) - a * a / n).alias("height"))


def height_of_ambiguity(bperp: Column, range_m: float, inc_deg: Column, wavelength_m: float) -> Column:
    return F.lit(wavelength_m * range_m / 2) * F.sin(F.radians(inc_deg)) / F.nullif(bperp, F.lit(0.0))


def fm_rate(tau: Column, tau0: Column, coefficients: list[float]) -> Column:
    """Polynomial in slant-range time, by Horner's rule."""
    out, x = F.lit(0.0), tau - tau0
    for c in reversed(coefficients):
        out = out * x + F.lit(c)
    return out


def iono_phase(vtec: Column, inc_deg: Column, hz: float = C_BAND_HZ, height_km: float = 450.0) -> Column:
    """Vertical electron content -> two-way phase screen of a single layer."""
    s = F.lit(EARTH_RADIUS_M / 1000 / (EARTH_RADIUS_M / 1000 + height_km)) * F.sin(F.radians(inc_deg))
    return F.lit(-4 * 3.141592653589793 * IONO_K * 1e16 / (SPEED_OF_LIGHT * hz)) * vtec / F.sqrt(1 - s * s)


def slant_delay_rad(zenith_m: Column, up: Column, wavelength_m: float) -> Column:
    return zenith_m / up * F.lit(4 * 3.141592653589793 / wavelength_m)


def offset_mm(azimuth_px: Column, range_px: Column) -> Column:
    return F.struct((azimuth_px * 14000).alias("azimuth_mm"), (range_px * 2300).alias("range_mm"))


def clip_parts(clip: Column) -> Column:
    """lon1/lon2/lat1/lat2 -> ordered box."""
    v = [F.get(F.split(clip, "/"), F.lit(i)).cast("double") for i in range(4)]
    return F.struct(F.least(v[0], v[1]).alias("lon1"), F.greatest(v[0], v[1]).alias("lon2"), F.least(v[2], v[3]).alias("lat1"), F.greatest(v[2], v[3]).alias("lat2"))


def clip_text(lon1: Column, lon2: Column, lat1: Column, lat2: Column) -> Column:
    return F.format_string("%.5f/%.5f/%.5f/%.5f", lon1, lon2, lat1, lat2)


def clip_box(lon: Column, lat: Column, half_km: float, km_per_degree: float) -> Column:
    """Square around a point, in degrees."""
    r = half_km / km_per_degree
    return F.struct((lon - r).alias("lon1"), (lon + r).alias("lon2"), (lat - r).alias("lat1"), (lat + r).alias("lat2"))


def enlarge(lon1: Column, lon2: Column, lat1: Column, lat2: Column, sides: Column, by: float) -> Column:
    """Move the sides named in a string of L, R, U, D outwards."""
    add = lambda flag: F.when(F.contains(sides, F.lit(flag)), F.lit(by)).otherwise(F.lit(0.0))
    return F.struct((lon1 - add("L")).alias("lon1"), (lon2 + add("R")).alias("lon2"), (lat1 - add("D")).alias("lat1"), (lat2 + add("U")).alias("lat2"))


def colatitude(lat: Column) -> Column:
    """Hundredths of a degree from the north pole."""
    return F.round((90 - lat) * 100).cast("long")


def decimal_year_date(year: Column) -> Column:
    whole = F.floor(year).cast("int")
    first = F.make_date(whole, F.lit(1), F.lit(1))
    days = F.datediff(F.make_date(whole + 1, F.lit(1), F.lit(1)), first)
    return F.date_add(first, F.floor((year - whole) * days).cast("int"))


@F.pandas_udf(T.StringType())
def strip_accents(text: pd.Series) -> pd.Series:
    """Compatibility decomposition to ASCII, without quotes; Spark has no built-in decomposition."""
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().replace("'", "").replace('"', ""), na_action="ignore")
