"""Declared (source database) column type -> Spark type."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# The families of declared types and the Spark type each one maps to.
PREFIX_FAMILIES: list[tuple[tuple[str, ...], T.DataType]] = [
    (("VARCHAR", "NVARCHAR2", "CHAR", "NCHAR", "CLOB", "NCLOB", "LONG"), T.StringType()),
    (("BLOB", "RAW"), T.BinaryType()),
    (("TIMESTAMP",), T.TimestampType()),
]
EXACT_NAMES: dict[str, T.DataType] = {
    "DATE": T.DateType(),
    "BINARY_DOUBLE": T.DoubleType(),
    "BINARY_FLOAT": T.DoubleType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "SMALLINT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
}
DECIMAL_NAMES = ("NUMBER", "NUMERIC", "DECIMAL")
MAX_PRECISION = 38
BARE_DECIMAL_SCALE = 10

# A text key longer than this is compared by hash first (see operators.keys).
WIDE_TEXT_LENGTH = 64

class MappedType(NamedTuple):
    data_type: T.DataType
    known: bool  # False when the declared type is not in the table and fell back to string


class DeclaredType(NamedTuple):
    """A declared type taken apart: its name, and what its brackets hold, parted at commas."""

    name: str
    arguments: tuple[str, ...]


def take_apart(declared: str) -> DeclaredType | None:
    """None if the brackets do not close at the end or hold others."""
    text = " ".join(declared.upper().split())
    opening = text.find("(")
    if opening < 0:
        return None if ")" in text else DeclaredType(text, ())
    inner = text[opening + 1 : -1]
    if text[-1] != ")" or "(" in inner or ")" in inner:
        return None
    return DeclaredType(text[:opening].rstrip(), tuple(part.strip() for part in inner.split(",")))


def _whole(text: str) -> int | None:
    digits = text[1:] if text.startswith("-") else text
    return int(text) if digits.isascii() and digits.isdigit() else None


def _decimal(arguments: tuple[str, ...]) -> T.DecimalType | None:
    """The decimal of `(precision[, scale])`, clamped to Spark's range; None if they are no such."""
    if not arguments:
        return T.DecimalType(MAX_PRECISION, BARE_DECIMAL_SCALE)
    asked = MAX_PRECISION if arguments[0] == "*" else _whole(arguments[0])
    scale = _whole(arguments[1]) if len(arguments) == 2 else 0
    if asked is None or asked < 0 or scale is None or len(arguments) > 2:
        return None
    precision = min(max(asked, 1), MAX_PRECISION)
    return T.DecimalType(precision, min(max(scale, 0), precision))


def map_declared_type(declared: str) -> MappedType:
    """Map one declared type. Lengths of text are dropped, decimals are clamped to Spark's
    range, and a type outside the table becomes string with `known=False`."""
    text = " ".join(declared.upper().split())
    for prefixes, data_type in PREFIX_FAMILIES:
        if text.startswith(prefixes):
            return MappedType(data_type, True)
    found, parts = None, take_apart(declared)
    if parts and parts.name in DECIMAL_NAMES:
        found = _decimal(parts.arguments)
    elif parts and parts.name in EXACT_NAMES:
        # FLOAT may carry a binary precision, which does not change its Spark type.
        binary = parts.name == "FLOAT" and _decimal(parts.arguments) is not None
        if binary or not parts.arguments:
            found = EXACT_NAMES[parts.name]
    return MappedType(found or T.StringType(), found is not None)


def is_wide_text(declared: str) -> bool:
    """True for declared types whose values may be long enough to make a costly shuffle key."""
    mapped = map_declared_type(declared)
    if not isinstance(mapped.data_type, (T.StringType, T.BinaryType)) or not mapped.known:
        return False
    parts = take_apart(declared)
    stated = parts.arguments[0].split() if parts and parts.arguments else []
    length = _whole(stated[0]) if stated else None
    return length is None or length > WIDE_TEXT_LENGTH


def _fits(source: T.DataType, target: T.DataType) -> str | None:
    """Condition on `{x}` that is false only for numbers the target type cannot hold, or None
    where every number may fit. Bounds are exact in the source type."""
    if isinstance(target, T.DecimalType):
        digits = target.precision - target.scale
        low, high = -(10**digits), 10**digits  # both outside
    elif isinstance(target, (T.IntegerType, T.LongType)):
        bits = 31 if isinstance(target, T.IntegerType) else 63
        low, high = -(2**bits) - 1, 2**bits
    else:
        return None
    if isinstance(source, (T.FloatType, T.DoubleType)):
        if isinstance(target, T.LongType) or float(high) != high:
            return None  # the bound is no double
        return f"{{x}} > {float(low)!r}D AND {{x}} < {float(high)!r}D"
    if isinstance(source, T.IntegralType):
        if high >= 2**63:
            return None
        return f"{{x}} > {low}L AND {{x}} < {high}L"
    if isinstance(source, T.DecimalType):
        if len(str(high)) > source.precision - source.scale:
            return None
        return f"{{x}} > {low}BD AND {{x}} < {high}BD"
    return None


def fitting_cast(value: str, source: T.DataType, target: T.DataType) -> str:
    """SQL text casting `value` to `target`, NULL where it does not fit.

    Equal to `try_cast`, which raises and catches an exception for each number out of range;
    comparing with the range first keeps tables with many such numbers as fast as others.
    """
    cast = f"try_cast({value} AS {target.simpleString()})"
    fits = _fits(source, target)
    return f"CASE WHEN {fits.format(x=value)} THEN {cast} END" if fits else cast
