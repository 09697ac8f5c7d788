"""Row-level derivations of the survey jobs (P1-P38) as Column expressions.

All are built-in Spark expressions (whole-stage codegen); none is a UDF.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions.nulls import col_of, r_ifelse, recode
from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH

# Unit conversion factors used by the surveys.
UNIT_FACTORS = {
    ("ft", "m"): 0.3048,
    ("m", "cm"): 100.0,
    ("cm", "m"): 0.01,
    ("acre_ft", "m3"): 1233.48,
    ("nmi", "m"): 1852.0,
    ("us_cm", "ms_cm"): 0.001,
}

# Tide codes shared by several surveys.
TIDE_CODES = {1: "High Slack", 2: "Ebb", 3: "Low Slack", 4: "Flood"}

# Bay Study tow codes.
VALID_TOW_CODES = [1, 2, 51, 54, 55, 56, 57]
INVALID_TOW_CODES = [0, 52, 53, 58]


# -- P1-P3: projections -------------------------------------------------------

def cast_cols(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """``{type: [columns]}`` -> try_cast each listed column (bad values null)."""
    target = {c: t for t, cols in types.items() for c in cols}
    return df.select(*[F.expr(f"try_cast(`{c}` AS {target[c]})").alias(c) if c in target
                       else F.col(f"`{c}`") for c in df.columns])


def canonical(df: DataFrame, cols: Sequence[str], fill_missing: bool = False) -> DataFrame:
    """Keep the known columns in contract order, tolerating absent ones."""
    present = [c for c in cols if c in df.columns]
    if not fill_missing:
        return df.select(*present)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (used before joins to avoid collisions)."""
    return df.withColumnsRenamed(dict(mapping))


# -- P4-P6: code decoding -----------------------------------------------------

def tide(code: str | Column) -> Column:
    """Numeric tide code -> label, unmatched null."""
    return recode(code, TIDE_CODES, default=None)


def tow_status(code: str | Column) -> Column:
    """P5: Bay Study tow code -> Valid / Invalid (else null)."""
    c = col_of(code)
    return (F.when(c.isin(VALID_TOW_CODES), F.lit("Valid"))
            .when(c.isin(INVALID_TOW_CODES), F.lit("Invalid")))


def classify(c: str | Column, rules: Sequence[tuple[str, str]]) -> Column:
    """First regex that matches gives the label; no match -> null."""
    c = col_of(c)
    expr = None
    for pattern, label in rules:
        cond = F.coalesce(c.rlike(pattern), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# -- P7-P9: coordinates and units --------------------------------------------

def dms_to_decimal(d: str | Column, m: str | Column, s: str | Column,
                   west: bool = False) -> Column:
    """degrees/minutes/seconds -> decimal degrees, west negative."""
    v = col_of(d) + col_of(m) / 60.0 + col_of(s) / 3600.0
    return -v if west else v


def degmin_text_to_decimal(c: str | Column, sep: str = "°",
                           subtract: bool = False) -> Column:
    """Text "deg<sep>min" -> decimal.  Longitudes stored negative use
    ``subtract=True`` (minutes are subtracted)."""
    parts = F.split(col_of(c), sep)
    deg = F.trim(F.try_element_at(parts, F.lit(1))).try_cast("double")
    mins = F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
    return deg - mins / 60.0 if subtract else deg + mins / 60.0


def convert(c: str | Column, unit_from: str, unit_to: str) -> Column:
    """Unit conversion (ft->m, m->cm, F->C, acre-ft->m3, nmi->m ...)."""
    c = col_of(c)
    if (unit_from, unit_to) == ("F", "C"):
        return (c - 32.0) * 5.0 / 9.0
    return c * F.lit(UNIT_FACTORS[(unit_from, unit_to)])


# -- P11-P17: measurements and effort ----------------------------------------

def null_if(c: str | Column, cond: Column) -> Column:
    """Null the value where ``cond`` holds (null cond keeps it)."""
    c = col_of(c)
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(None).cast("double")).otherwise(c)


def null_before(c: str | Column, date_col: str | Column, cutoff: str) -> Column:
    """Null a measurement taken before its standardisation date."""
    return null_if(c, col_of(date_col) < F.to_date(F.lit(cutoff)))


def meter_delta(start: str | Column, end: str | Column, rollover: float = 1_000_000) -> Column:
    """Flow-meter difference, adding the rollover when negative."""
    d = col_of(end) - col_of(start)
    return F.when(d < 0, d + F.lit(float(rollover))).otherwise(d)


def tow_volume(delta: str | Column, k: float | Column, area: float,
               zero_is_null: bool = False) -> Column:
    """volume = meter delta x k-factor x mouth area."""
    k = k if isinstance(k, Column) else F.lit(float(k))
    d = col_of(delta)
    v = d * k * F.lit(float(area))
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(v) if zero_is_null else v


def swept_area_distance(nmi: str | Column, width_m: float = 3.42) -> Column:
    """Otter trawl area = distance (nmi) x 1852 x net width."""
    return col_of(nmi) * 1852.0 * width_m


def swept_area_duration(minutes: str | Column, knots_m_per_h: float = 4.0 * 1000,
                        width: float = 4.3, efficiency: float = 0.7) -> Column:
    """Area from duration: min/60 x speed x width x efficiency."""
    return col_of(minutes) / 60.0 * knots_m_per_h * width * efficiency


def default_effort(c: str | Column, default: float, missing_when: Column | None = None,
                   suspect: Column | None = None) -> Column:
    """Default effort when the meter reading is missing or suspect."""
    v = col_of(c)
    if missing_when is not None:
        v = F.when(F.coalesce(missing_when, F.lit(False)), F.lit(float(default))).otherwise(v)
    v = F.coalesce(v, F.lit(float(default)))
    if suspect is not None:
        v = F.when(F.coalesce(suspect, F.lit(False)), F.lit(float(default))).otherwise(v)
    return v


def invalidate_effort(volume: str | Column, debris_flag: str | Column,
                      debris_values: Iterable[str] = ("Y", "Yes"),
                      zero_is_null: bool = False) -> Column:
    """Null the volume when the net had debris (null flag keeps it)."""
    v = r_ifelse(col_of(debris_flag).isin(list(debris_values)), F.lit(None).cast("double"),
                 col_of(volume), missing=col_of(volume))
    if zero_is_null:
        v = F.when(v == 0, F.lit(None).cast("double")).otherwise(v)
    return v


# -- P18-P22: time and identifiers -------------------------------------------


def compose_datetime(date: str | Column, time: str | Column,
                     midnight_is_null: bool = False, with_seconds: bool = False) -> Column:
    """Local timestamp (TIMESTAMP_NTZ) from a date and a time of day.

    ``time`` is a timestamp or text holding ``H:mm[:ss]`` (ISO, or the
    ``MM/dd/yyyy HH:mm`` export layout); only its clock part is used (hour
    and minute, plus seconds if ``with_seconds``).  Null or unparsable time
    gives null; with ``midnight_is_null`` a 00:00 time is treated as unknown.
    """
    text = col_of(time).cast("string")
    clock = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"
    part = lambda i: F.regexp_extract(text, clock, i)
    h, m, s = part(1).try_cast("int"), part(2).try_cast("int"), part(3).try_cast("int")
    s = F.coalesce(s, F.lit(0))
    secs = s if with_seconds else F.lit(0)
    d = col_of(date)
    ts = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), h, m, secs)
    out = F.when(h.isNull() | m.isNull() | d.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(ts)
    if midnight_is_null:
        zero = (h == 0) & (m == 0) & ((s == 0) if with_seconds else F.lit(True))
        out = F.when(F.coalesce(zero, F.lit(False)), F.lit(None).cast("timestamp_ntz")).otherwise(out)
    return out


def is_nonexistent_local(ts_ntz: str | Column, tz: str = "America/Los_Angeles") -> Column:
    """True for wall-clock times that do not exist in ``tz`` (spring-forward gap)."""
    ts = col_of(ts_ntz)
    round_trip = F.convert_timezone(F.lit("UTC"), F.lit(tz),
                                    F.convert_timezone(F.lit(tz), F.lit("UTC"), ts))
    return round_trip != ts


def fix_dst_gap(ts_ntz: str | Column, tz: str = "America/Los_Angeles",
                repair_hour: int = 2) -> Column:
    """A nonexistent local time becomes null, except exactly
    ``repair_hour``:00:00 which is moved to the next hour (N14)."""
    ts = col_of(ts_ntz)
    gap = is_nonexistent_local(ts, tz)
    exact = (F.hour(ts) == repair_hour) & (F.minute(ts) == 0) & (F.second(ts) == 0)
    return (F.when(gap & exact, ts + F.expr("INTERVAL 1 HOUR"))
            .when(gap, F.lit(None).cast("timestamp_ntz"))
            .otherwise(ts))


def force_tz(ts_ntz: str | Column, tz: str = "America/Los_Angeles") -> Column:
    """P20: read a wall-clock (NTZ) value as local time in ``tz`` without
    shifting the clock; returns the instant as UTC wall clock (NTZ)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col_of(ts_ntz))


def sample_id(source: str | Column, *cols: str | Column, sep: str = " ") -> Column:
    """``paste(source, ...)``: nulls spelled "NA" as R does (N10), a
    null first part too."""
    parts = [F.coalesce(col_of(source).cast("string"), F.lit("NA"))]
    parts += [F.coalesce(col_of(c).cast("string"), F.lit("NA")) for c in cols]
    return F.concat_ws(sep, *parts)


def braced(c: str | Column) -> Column:
    """Brace-wrap a key ("{...}") as the Suisun ids are written, unless it
    has a brace already."""
    key = col_of(c).cast("string")
    return F.when(key.rlike("[{}]"), key).otherwise(F.concat(F.lit("{"), key, F.lit("}")))


def hashed_id(*cols: str | Column) -> Column:
    """P22 alternative: a deterministic id from a natural key (no ordering)."""
    return F.xxhash64(*[col_of(c) for c in cols])


# -- P23-P26: taxa and flags ---------------------------------------------------

def strip_lifestage(c: str | Column) -> Column:
    """Drop everything from the first " (" (life stage) on."""
    return F.regexp_replace(col_of(c), r" \(.*$", "")


def taxa_label(name: str | Column, stage: str | Column) -> Column:
    """P24: "Name (Stage)" when a life stage is present, else the name."""
    n, s = col_of(name), col_of(stage)
    return F.when(s.isNotNull(), F.concat(n, F.lit(" ("), s, F.lit(")"))).otherwise(n)


def length_flag(length: str | Column, count: str | Column,
                no_catch: Column | None = None) -> Column:
    """P25: "No fish caught" (no catch), "Unknown length" (null length with
    a positive count), else null.  ``no_catch`` defaults to null length and
    null count, the rule most surveys use."""
    L, C = col_of(length), col_of(count)
    nc = (L.isNull() & C.isNull()) if no_catch is None else no_catch
    return (F.when(F.coalesce(nc, F.lit(False)), F.lit(NO_FISH))
            .when(L.isNull() & (C > 0), F.lit(UNKNOWN_LENGTH)))


def zero_no_catch(count: str | Column, flag: str | Column) -> Column:
    """Count 0 on "No fish caught" rows (null flag keeps the count)."""
    return r_ifelse(col_of(flag) == NO_FISH, F.lit(0.0), col_of(count), missing=col_of(count))


# -- P27-P31: codes and text ---------------------------------------------------

def pad_station(c: str | Column, width: int = 3) -> Column:
    """Left-pad station codes with zeros; longer codes stay as they are
    (``lpad`` alone would cut them)."""
    code = col_of(c).cast("string")
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def merge_notes(*cols: str | Column, sep: str = "; ") -> Column:
    """Join note columns, skipping nulls; null when all are null."""
    cs = [col_of(c) for c in cols]
    joined = F.concat_ws(sep, *cs)
    return F.when(F.coalesce(*cs).isNull(), F.lit(None).cast("string")).otherwise(joined)


def extract_facility(c: str | Column) -> Column:
    """The facility code (CVP or SWP) named in a label, else null."""
    v = F.regexp_extract(col_of(c), r"\b(CVP|SWP)\b", 1)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def facility_station(method: str | Column, location: str | Column,
                     fallback: str | Column) -> Column:
    """Facility from the sample method (1 SWP, 2 CVP, else the station
    lookup's label), then "facility location" with the CVP repair."""
    m = col_of(method)
    fac = (F.when(m == 1, F.lit("SWP")).when(m == 2, F.lit("CVP"))
           .when(m.isNull() & col_of(fallback).isNotNull(), col_of(fallback)))
    st = sample_id(fac, location)
    return F.when(st == "CVP NA", F.lit("CVP Federal Facility")).otherwise(st)


# Size-comment vocabulary (translated catch comments).
LIFESTAGE_WORDS = [("YOY", "YOY"), ("larva", "Larval"), ("uvenile", "Juvenile"), ("dult", "Adult")]
AGE_WORDS = [("age 0", "Age-0"), ("age 1", "Age-1"), ("age 2", "Age-2+")]
IGNORE_WORDS = ["egg", "ovi", "OVI"]


def parse_size_comment(c: str | Column) -> Column:
    """struct(min_flag, approx_flag, max_flag, number, lifestage, ignore)
    from a catch comment such as "<30mm", ">50", "~40", "YOY", "with eggs"."""
    c = col_of(c)
    has = lambda s: F.coalesce(F.instr(c, s) > 0, F.lit(False))
    stage = None
    for word, label in LIFESTAGE_WORDS:
        stage = F.when(has(word), F.lit(label)) if stage is None else stage.when(has(word), F.lit(label))
    age = None
    for word, label in AGE_WORDS:
        age = F.when(has(word), F.lit(label)) if age is None else age.when(has(word), F.lit(label))
    ignore = has(IGNORE_WORDS[0])
    for word in IGNORE_WORDS[1:]:
        ignore = ignore | has(word)
    number = F.regexp_extract(c, r"(\d+(\.\d+)?)", 1)
    return F.struct(
        has(">").alias("min_length"),
        (has("~") | has("about")).alias("approx_length"),
        has("<").alias("max_length"),
        F.when(number == "", F.lit(None).cast("double")).otherwise(number.try_cast("double")).alias("number"),
        F.coalesce(age, stage).alias("lifestage"),
        ignore.alias("ignore"),
    )


def harmonise_lifestage(stage: str | Column, taxa: str | Column,
                        adult_map: Mapping[str, Sequence[str]]) -> Column:
    """Recode stage words, then adult -> age class by taxon."""
    s = recode(stage, {"YOY": "Age-0", "Larval": "Age-0", "Yearling": "Age-1"})
    out = None
    for label, taxa_list in adult_map.items():
        cond = (s == "Adult") & col_of(taxa).isin(list(taxa_list))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return s if out is None else out.otherwise(s)


def diff_cols(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """(a - b, (a - b) / b) with x/0 -> null."""
    d = col_of(a) - col_of(b)
    return d, F.try_divide(d, col_of(b))
