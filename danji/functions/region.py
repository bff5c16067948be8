"""Region codes, province names and selection labels."""

from pyspark.sql import Column, functions as F

from danji.constants import LEVEL_DISTRICT, LEVEL_PROVINCE, PROVINCE_FULL_NAMES


def is_full_code(code: Column) -> Column:
    return F.length(code) == 10


def is_province_code(code: Column) -> Column:
    return F.right(code, F.lit(8)) == "00000000"


def district_code(code: Column) -> Column:
    return F.left(code, F.lit(5))


def code_level(code: Column) -> Column:
    return F.when(
        is_full_code(code),
        F.when(is_province_code(code), F.lit(LEVEL_PROVINCE)).otherwise(F.lit(LEVEL_DISTRICT)),
    )


def _mapped(name: Column, pairs: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), name)


def province_full_name(name: Column) -> Column:
    return _mapped(name, PROVINCE_FULL_NAMES)


def province_short_name(name: Column) -> Column:
    return _mapped(name, {full: short for short, full in PROVINCE_FULL_NAMES.items()})


_LABEL = r"^(.*) \((.*)\)$"


def label_name(label: Column) -> Column:
    """'name (province)' -> name; a plain label is its own name."""
    return F.when(label.rlike(_LABEL), F.regexp_extract(label, _LABEL, 1)).otherwise(label)


def label_province(label: Column) -> Column:
    """'name (province)' -> province; NULL for a plain label."""
    return F.when(label.rlike(_LABEL), F.regexp_extract(label, _LABEL, 2))
