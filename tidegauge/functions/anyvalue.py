"""Column helpers for OTLP attribute values and key/value lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.numbers import all_of, strict


def _let(value: Column, body) -> Column:
    """Compute a value once and use it several times within one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def float_text(number: Column) -> Column:
    """Text of a double the way the lake stores it: ``1e-05``, ``12345678.0``, ``nan``.

    Spark switches to exponents outside [1e-3, 1e7), the stored text outside [1e-4, 1e16), so the
    digits are laid out again from Spark's own text.
    """

    def from_text(text: Column) -> Column:
        parts = F.struct(
            F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
            F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.0$", "").alias("mantissa"),
            F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int").alias("exponent"),
        )
        return (
            F.when(text == "NaN", F.lit("nan"))
            .when(text.endswith("Infinity"), F.regexp_replace(text, "Infinity", "inf"))
            .when(~text.contains("E"), text)
            .otherwise(_let(parts, laid_out))
        )

    def laid_out(parts: Column) -> Column:
        exponent = parts["exponent"]
        digits = F.replace(parts["mantissa"], F.lit("."), F.lit(""))
        whole = F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0"))
        rest = F.substring(digits, exponent + 2, F.length(digits))
        size = F.abs(exponent).cast("string")
        body = (
            F.when(
                exponent.between(7, 15),
                F.concat(whole, F.lit("."), F.when(rest == "", "0").otherwise(rest)),
            )
            .when(exponent == -4, F.concat(F.lit("0.000"), digits))
            .otherwise(
                F.concat(
                    parts["mantissa"],
                    F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
                    F.lpad(size, F.greatest(F.lit(2), F.length(size)), F.lit("0")),
                )
            )
        )
        return F.concat(parts["sign"], body)

    return _let(number.cast("string"), from_text)


def any_text(value: Column) -> Column:
    """Text of whichever alternative is set; NULL when none is."""
    number = value["doubleValue"]
    return F.coalesce(
        value["stringValue"],
        value["intValue"],
        F.when(number.isNotNull(), float_text(strict(number, "double", "doubleValue"))),
        F.when(value["boolValue"], F.lit("True")).when(~value["boolValue"], F.lit("False")),
        value["bytesValue"],
        value["arrayValue"],
        value["kvlistValue"],
    )


def any_truthy(value: Column) -> Column:
    """False for unset, '', 0, 0.0, false and empty bytes; true otherwise."""
    number = strict(value["doubleValue"], "double", "doubleValue")
    return F.coalesce(
        value["stringValue"] != "",
        strict(value["intValue"], "bigint", "intValue") != 0,
        F.isnan(number) | (number != 0.0),
        value["boolValue"],
        value["bytesValue"] != "",
        value["arrayValue"].isNotNull() | value["kvlistValue"].isNotNull(),
    )


def kv_texts(attributes: Column) -> Column:
    """Attribute list as (key, text) pairs, order and duplicates kept."""
    pairs = F.transform(
        attributes,
        lambda a: F.struct(F.coalesce(a["key"], F.lit("")).alias("key"), any_text(a["value"]).alias("value")),
    )
    return F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>"))


def kv_strings(attributes: Column) -> Column:
    """Attribute list as (key, string) pairs; anything but a string becomes ''."""
    pairs = F.transform(
        attributes,
        lambda a: F.struct(
            F.coalesce(a["key"], F.lit("")).alias("key"),
            F.coalesce(a["value"]["stringValue"], F.lit("")).alias("value"),
        ),
    )
    return F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>"))


def first_match(pairs: Column, key: str) -> Column:
    """Value of the first pair with this key, NULL when there is none."""
    return F.get(pairs["value"], (F.array_position(pairs["key"], key) - 1).cast("int"))


def last_match(pairs: Column, key: str) -> Column:
    """Value of the last pair with this key, NULL when there is none."""
    return first_match(F.reverse(pairs), key)


def kv_matches(pairs: Column, patterns: dict[str, str]) -> Column:
    """True when every (key, pattern) finds a pair with that key whose value contains the pattern."""

    def hit(key: str, pattern: str) -> Column:
        found = F.exists(pairs, lambda p: (p["key"] == key) & p["value"].rlike(pattern))
        return F.coalesce(found, F.lit(False))

    return all_of([hit(key, pattern) for key, pattern in patterns.items()])


def kv_map(pairs: Column) -> Column:
    """Key/value list as a map. Duplicate keys raise unless the session asks for LAST_WIN."""
    return F.map_from_entries(pairs)
