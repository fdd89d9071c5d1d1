"""What column names and types suggest, as Catalyst expressions over metadata rows.

Rules are ordered CASE branches: the first that matches wins, and a column is classified
in the scan of the metadata itself, with no join, sort or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item fields and the column names that mean them, in order of priority.
FIELD_RULES = [
    ("title", ["^title$", "^name$", "^product_?name$", "^listing_?name$"]),
    ("price", ["^price$", "^cost$", "^amount$", "^sale_?price$"]),
    ("currency", ["^currency$", "^currency_?code$"]),
    ("category", ["^category$", "^type$", "^product_?type$"]),
    ("status", ["^status$", "^state$", "^listing_?status$"]),
    ("description", ["^description$", "^desc$", "^details$", "^body$"]),
]
# Attributes and the column names that mean them, in order of priority.
ATTRIBUTE_RULES = [
    ("make", ["make", "brand", "manufacturer"]),
    ("model", ["model"]),
    ("year", ["^year$", "^model_?year$", "^production_?year$"]),
    ("color", ["^color$", "^colour$"]),
    ("mileage", ["^mileage$", "^kilometers$", "^km$", "^odometer$"]),
    ("fuelType", ["fuel"]),
    ("transmission", ["transmission", "gearbox"]),
    ("enginePower", ["engine", "power", "horsepower", "hp$"]),
    ("drivetrain", ["drivetrain", "drive_?type", "^4wd$", "^awd$"]),
]
# Names with one meaning.
PUBLISHED = ["^published$", "^is_?active$", "^active$", "^is_?published$", "^visible$"]
SOFT_DELETED = ["^deleted_?at$", "^removed_?at$", "^archived_?at$"]
UPDATED_AT = ["^updated_?at$", "^modified_?at$", "^last_?updated$", "^changed_?at$"]
IMAGE = "url$|^image|^photo|^picture|^thumbnail|^src$"
SEARCHABLE = (
    "^(title|name|product_?name|listing_?name|description|desc|details|body)$"
    "|make|model|brand|manufacturer"
)
URL = "url$|^src$"
LABEL = "name|value|label"
# Names by their ending, case as written.
REFERENCE_LIKE = "(Id|_id)$"
TIME_LIKE = "(At|_at)$"
# Targets whose text is too free to filter by.
FREE_TEXT = ["title", "description", "desc", "details", "body"]
# Type names by class; the last few of each are Spark's own.
TEXT_TYPES = [
    "text", "character varying", "varchar", "char", "character", "name", "citext",
    "string",
]
LONG_TEXT_TYPES = ["text", "character varying", "varchar", "string"]
NUMERIC_TYPES = [
    "integer", "bigint", "smallint", "numeric", "decimal", "real", "double precision",
    "float", "int", "int4", "int8", "tinyint", "double",
]


def matches(name: Column, pattern: str | list[str]) -> Column:
    """Whether a name has a pattern, or one of several, in either case."""
    pattern = pattern if isinstance(pattern, str) else "|".join(pattern)
    return name.rlike(f"(?i)(?:{pattern})")


def base_type(data_type: Column) -> Column:
    """A type's name without its length or precision."""
    return F.trim(F.regexp_replace(F.lower(data_type), r"\(.*", ""))


def is_text(data_type: Column) -> Column:
    return base_type(data_type).isin(TEXT_TYPES)


def is_long_text(data_type: Column) -> Column:
    return base_type(data_type).isin(LONG_TEXT_TYPES)


def is_numeric(data_type: Column) -> Column:
    return base_type(data_type).isin(NUMERIC_TYPES)


def is_plumbing(name: Column) -> Column:
    """Named like a reference or a time."""
    return name.rlike(REFERENCE_LIKE) | name.rlike(TIME_LIKE)


def quoted(name: Column) -> Column:
    """In double quotes where the name has capitals."""
    return F.when(name.rlike("[A-Z]"), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(name)


def mapping(name: Column, is_primary_key: Column) -> Column:
    """What a column maps to: ``struct(target, kind, confidence, rule)``, null for nothing.

    Fields come before attributes; keys, references and times are no attributes.
    """
    branches = [
        (matches(name, pattern), target, "field", "high") for target, pattern in FIELD_RULES
    ]
    free = ~is_primary_key & ~is_plumbing(name)
    branches += [
        (free & matches(name, pattern), target, "attribute", "medium")
        for target, pattern in ATTRIBUTE_RULES
    ]
    ladder = None
    for rule, (test, target, kind, confidence) in enumerate(branches, start=1):
        value = F.struct(
            F.lit(target).alias("target"),
            F.lit(kind).alias("kind"),
            F.lit(confidence).alias("confidence"),
            F.lit(rule).alias("rule"),
        )
        ladder = F.when(test, value) if ladder is None else ladder.when(test, value)
    return ladder
