"""Names, ids, sources and the predicates built on them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Source classes, name patterns and file suffixes.
CLASS_SOURCE = "peloton"
KNOWN_SOURCES = ("garmin", "peloton", "hevy")
RELAY_SOURCE = "strava"
UNKNOWN_SOURCE = "unknown"
TRAINER_LED = r"(?i)Trainer Session|Training Session"
WARM_UP = r"(?i)warm.?up"
COOL_DOWN = r"(?i)cool.?down"
FIT_SUFFIXES = (".fit", ".fit.gz")
TCX_SUFFIXES = (".tcx.gz", ".tcx")
SUPPORTED_SUFFIXES = FIT_SUFFIXES + TCX_SUFFIXES
UNSUPPORTED_SUFFIXES = (".gpx",)
ASSUMED_TRAINER_MINUTES = 60
HIGH_INTENSITY_HR = 128
HIGH_INTENSITY_WATTS = 150


def is_class(source: Column) -> Column:
    return source == CLASS_SOURCE


def is_outdoor(source: Column) -> Column:
    """Everything but the class source; a null source is neither."""
    return source != CLASS_SOURCE


def of_type(activity_type: Column, wanted: str) -> Column:
    return activity_type == wanted


def non_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def name_matches(name: Column, pattern: str) -> Column:
    """Regular-expression search; a null name does not match."""
    return F.coalesce(name.rlike(pattern), F.lit(False))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    """Case-insensitive test against any of ``suffixes``."""
    lowered = F.lower(name)
    hit = F.lit(False)
    for suffix in suffixes:
        hit = hit | lowered.endswith(suffix)
    return hit


def activity_id_from_entry(entry: Column) -> Column:
    """Drop ``.gz``, then ``.fit``, then ``.tcx``, once each; upper-case suffixes stay."""
    for pattern in (r"\.gz\z", r"\.fit\z", r"\.tcx\z"):
        entry = F.regexp_replace(entry, pattern, "")
    return entry


def source_from_manufacturer(manufacturer: Column) -> Column:
    """Known brand contained in the text, else the lower-cased text itself."""
    text = F.lower(F.coalesce(manufacturer, F.lit("")))
    result = F.when(F.lit(False), text)
    for brand in KNOWN_SOURCES:
        result = result.when(text.contains(brand), F.lit(brand))
    return result.when(text.isin("", RELAY_SOURCE), F.lit(UNKNOWN_SOURCE)).otherwise(text)


def device_name(garmin_product: Column, product: Column) -> Column:
    """First product field that is neither empty nor zero, as text.

    When neither qualifies, the second one's value is kept as it is.
    """
    first = F.when(garmin_product.isin("", "0"), F.lit(None)).otherwise(garmin_product)
    return F.coalesce(first, product).cast("string")


def map_enum(c: Column, mapping: dict[str, str], strict: bool = False) -> Column:
    """Look ``c`` up in a fixed map; unknown values give null, or fail the job when strict."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), F.coalesce(c, F.lit("")))
    if not strict:
        return found
    problem = F.concat(F.lit("unrecognized value: "), F.coalesce(c, F.lit("")))
    return F.coalesce(found, F.raise_error(problem).cast("string"))


def assumed_minutes(
    trainer_led: Column, logged: Column, assumed: float = ASSUMED_TRAINER_MINUTES
) -> Column:
    return F.when(trainer_led, F.lit(float(assumed))).otherwise(logged)


def high_intensity(
    hr: Column, watts: Column,
    min_hr: float = HIGH_INTENSITY_HR, min_watts: float = HIGH_INTENSITY_WATTS,
) -> Column:
    """Either signal suffices; a missing one counts as below the threshold."""
    return F.coalesce(hr >= min_hr, F.lit(False)) | F.coalesce(watts >= min_watts, F.lit(False))
