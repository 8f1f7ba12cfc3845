"""Keys and values that are written inside names: columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def well_name(image_name: Column) -> Column:
    """``C01`` of ``WellC01_PointC01_0000_Channel..._Seq0001``."""
    return F.regexp_extract(image_name, r"_Point([A-H]\d\d)_(\d+)_", 1)


def site_name(image_name: Column) -> Column:
    """``C01-0000``: the well and the number of the site in it."""
    return F.concat_ws("-", well_name(image_name), F.regexp_extract(image_name, r"_Point([A-H]\d\d)_(\d+)_", 2))


def file_stem(path: Column) -> Column:
    """The last part of a path, without its extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    """The folder that a file is in: the plate of an image file."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def channels(image_name: Column) -> Column:
    """The channels listed in an image's name, in order; null where the name has no list."""
    listed = F.regexp_extract(image_name, r"_Channel(.*)_[^_]*$", 1)
    return F.when(listed != "", F.split(listed, ","))


def well_row(well: Column) -> Column:
    """0 for A to 7 for H."""
    return F.ascii(F.substring(well, 1, 1)) - 65


def well_column(well: Column) -> Column:
    """0 for 01 to 11 for 12."""
    return F.substring(well, 2, 2).cast("int") - 1


#: Patterns that an id begins with and the letter that each gives; the first that matches holds. Fixed values.
COHORTS = (
    ("CMV.+", "E"),
    ("EBV.+", "E"),
    ("3-.+", "last"),
    ("2-.+", "last"),
    ("02-.+", "last?"),
    ("[A-Z]\\d+", "first"),
)
#: Letters of control cohorts, in lower case. Fixed values.
CONTROLS = ("b", "a", "x", "z", "e", "cmv", "ebv")


def cohort_letter(cohort_id: Column) -> Column:
    """The cohort of an id by the first matching pattern, null without one."""
    take = {"first": F.substring(cohort_id, 1, 1), "last": F.substring(cohort_id, -1, 1), "last?": F.concat(F.substring(cohort_id, -1, 1), F.lit("?"))}
    out = F.lit(None).cast("string")
    for pattern, letter in reversed(COHORTS):
        out = F.when(cohort_id.rlike(f"^(?:{pattern})"), take.get(letter, F.lit(letter))).otherwise(out)
    return out


def cohort_class(letter: Column) -> Column:
    """positive for C, control for the letters of controls, unknown for the rest, null for null; upper or lower case."""
    small = F.lower(letter)
    return F.when(letter.isNull(), F.lit(None).cast("string")).when(small == "c", "positive").when(small.isin(*CONTROLS), "control").otherwise("unknown")


def clean_cohort_id(cell: Column) -> Column:
    """A sheet's cell as an id, trimmed; ``unknown`` if it begins with none of the patterns as it stands in the sheet."""
    known = F.coalesce(cell.rlike("^(?:" + "|".join(p for p, _ in COHORTS) + ")"), F.lit(False))
    return F.when(known, F.trim(cell)).otherwise("unknown")


def lab_value(value: Column) -> Column:
    """A lab's number: what follows a ``>``, with a decimal comma, as double; null if it isn't one."""
    return F.regexp_replace(F.regexp_replace(value, r"^.*?>", ""), ",", ".").try_cast("double")


def plate_time(plate_name: Column) -> Column:
    """The time in a plate's name ``..._YYYYMMDD_HHMMSS_...``: of the first part that begins with 202 and the part after it;
    midnight if that is no time, null without a date."""
    parts = F.split(plate_name, "_")
    at = F.array_position(F.transform(parts, lambda x: x.startswith("202")), F.lit(True))
    day, hour = F.get(parts, (at - 1).cast("int")), F.get(parts, at.cast("int"))
    full = F.try_to_timestamp(F.concat_ws("_", day, hour), F.lit("yyyyMMdd_HHmmss"))
    return F.when(at > 0, F.coalesce(full, F.try_to_timestamp(day, F.lit("yyyyMMdd"))))


def empty_wells(plate_name: Column, overrides: Column | None = None) -> Column:
    """The wells that a plate leaves empty: those of a map ``overrides`` from plate name to wells if it has the plate, else by
    the rule of its name, two on series T, U and K from 22 on, else one."""
    form = r"^(?:p(?=late[TUK])|P(?=lateK))late([TUK])(\d+)"
    kind, number = F.regexp_extract(plate_name, form, 1), F.regexp_extract(plate_name, form, 2).try_cast("int")
    two = kind.isin("T", "U") | ((kind == "K") & (number >= 22))
    rule = F.when(F.coalesce(two, F.lit(False)), F.array(F.lit("H01"), F.lit("G01"))).otherwise(F.array(F.lit("H01")))
    return rule if overrides is None else F.coalesce(F.try_element_at(overrides, plate_name), rule)


def serum_type(channel: Column) -> Column:
    """``IgG`` of ``serum_IgG``."""
    return F.element_at(F.split(channel, "_"), -1)


def display_name(name: Column, channel: Column, fixed: Column) -> Column:
    """A merged column's name: without ``serum`` and ``of_cell_``, with its channel's type before it unless fixed."""
    plain = F.regexp_replace(F.replace(F.replace(name, F.lit("serum_"), F.lit("")), F.lit("of_cell_"), F.lit("")), "^_+", "")
    return F.when(fixed, plain).otherwise(F.concat_ws("_", serum_type(channel), plain))
