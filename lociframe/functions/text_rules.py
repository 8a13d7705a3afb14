"""Small rules on names, bounds and lists of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(text: str) -> int:
    """A bound of a filter: a count, or ``n%`` as -n. Raises on what is neither, or out of range."""
    digits = text.removesuffix("%")
    try:
        value = int(digits)
    except ValueError:
        raise ValueError(f"{digits!r} is not an integer") from None
    if value < 0:
        raise ValueError(f"{value} is negative")
    if digits != text and value > 100:
        raise ValueError(f"percentage {value} is above 100")
    return -value if digits != text else value


def bound_value(text: Column) -> Column:
    """The same for a column; null where the text is no bound."""
    value = F.regexp_extract(text, r"^([0-9]+)%?$", 1).try_cast("int")
    return F.when(F.endswith(text, F.lit("%")), F.when(value <= 100, -value)).otherwise(value)


def is_identifier(text: Column) -> Column:
    return text.rlike("^[0-9A-Z_a-z]+$")


def codes_of(text: Column) -> Column:
    """The codes of a list like ``code=name.code=name``."""
    return F.transform(F.split(text, r"\."), lambda x: F.substring_index(x, "=", 1))


def genes_of(text: Column) -> Column:
    """The single genes of a name like ``gene1.gene2``."""
    return F.split(text, r"\.")


def class_columns(text: str, columns: int) -> list[int]:
    """``c1,c3`` -> [0, 2]. Raises on another format or a column that is not there."""
    out = []
    for part in (x.strip() for x in text.split(",")):
        if part[:1].lower() != "c" or not part[1:].isdigit():
            raise ValueError(f"bad column format: {part}")
        if not 1 <= int(part[1:]) <= columns:
            raise ValueError(f"column out of range: {part}")
        out.append(int(part[1:]) - 1)
    return out


def underscored(name: Column) -> Column:
    return F.replace(F.trim(name), F.lit(" "), F.lit("_"))


def chromosome_key(chrom: Column) -> Column:
    """What chromosomes are ordered by: the name without the letters c, h and r before it."""
    return F.regexp_replace(chrom, "^[chr]+", "")
