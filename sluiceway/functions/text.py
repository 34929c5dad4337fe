"""Column expressions for names, keys, casts and text masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "***REDACTED***"

# Type codes of the catalog and the type names shown to people.
TYPE_NAMES = {
    "I": "INTEGER",
    "I1": "BYTEINT",
    "I2": "SMALLINT",
    "I8": "BIGINT",
    "D": "DECIMAL",
    "F": "FLOAT",
    "CF": "CHAR",
    "CV": "VARCHAR",
    "CO": "CLOB",
    "DA": "DATE",
    "AT": "TIME",
    "TS": "TIMESTAMP",
    "TZ": "TIMESTAMP WITH TIME ZONE",
    "SZ": "TIMESTAMP WITH TIME ZONE",
    "YR": "INTERVAL YEAR",
    "YM": "INTERVAL YEAR TO MONTH",
    "MO": "INTERVAL MONTH",
    "DY": "INTERVAL DAY",
    "DH": "INTERVAL DAY TO HOUR",
    "DM": "INTERVAL DAY TO MINUTE",
    "DS": "INTERVAL DAY TO SECOND",
    "HR": "INTERVAL HOUR",
    "HM": "INTERVAL HOUR TO MINUTE",
    "HS": "INTERVAL HOUR TO SECOND",
    "MI": "INTERVAL MINUTE",
    "MS": "INTERVAL MINUTE TO SECOND",
    "SC": "INTERVAL SECOND",
    "BO": "BLOB",
    "BV": "VARBYTE",
    "BF": "BYTE",
}

# Fixed value: a credential word, a separator and the secret after it (letters of any script
# count as word characters).
CREDENTIAL_PATTERN = r"(?iU)\b(password|token|secret|key|credential)\b[=:\s]+\S+"


# Fixed value: what counts as blank at the ends of a text.
BLANKS = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Without blanks of any kind at the ends (plain ``trim`` takes spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


# Where the words of a column name part.
CAMEL_EDGE = r"([a-z])([A-Z])"
WORD_GAP = r"[_\s]+"


def normalize_name(name: Column) -> Column:
    """Lower-case identifier: runs of other characters become one underscore, none at the ends."""
    collapsed = F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "_")
    return F.btrim(collapsed, F.lit("_"))


def humanize_name(name: Column, type_code: Column) -> Column:
    """``cust_id`` / ``custId`` with code ``I`` becomes ``Cust Id (INTEGER)``."""
    spaced = F.regexp_replace(name, CAMEL_EDGE, "$1 $2")
    words = F.trim(F.regexp_replace(spaced, WORD_GAP, " "))
    lookup = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    friendly = F.coalesce(F.try_element_at(lookup, type_code), type_code)
    return F.concat(F.initcap(words), F.lit(" ("), friendly, F.lit(")"))


def request_id(name: Column, key: Column) -> Column:
    """Deterministic id: the first 16 hex digits of sha256 over ``name:key``."""
    return F.substring(F.sha2(F.concat_ws(":", name, key), 256), 1, 16)


def safe_cast_ts(value: Column, fmt: str | None = None) -> Column:
    """Timestamp from text, NULL where the text is not one."""
    return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds as a double, the same in every session time zone."""
    gap = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(20,6)").cast("double")


def redact_text(text: Column) -> Column:
    """Mask the value after a credential word; works on the whole text."""
    return F.regexp_replace(text, CREDENTIAL_PATTERN, "$1=" + MASK)
