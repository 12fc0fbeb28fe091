"""The text of a JSON value in the one form a binary JSON column gives it.

Spaces stand after commas and colons only; an object's keys go by length, then by bytes, and of
a repeated key the last value stays; strings and numbers are written in one way. All of it is
made of column functions, for values of any depth.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TOKEN = r'"(?:[^"\\]|\\.)*+"|[\[\]{}:,]|[^\s\[\]{}:,"]++'
NUMBER = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?$"
FRAME = "struct<object:boolean,items:array<struct<key:string,value:string>>,key:string>"
STATE = f"struct<open:array<{FRAME}>,done:string>"


def plain_string(token: Column) -> Column:
    """The content of a string token."""
    decoded = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
    return F.when(token.contains("\\"), decoded).otherwise(F.substring(token, F.lit(2), F.length(token) - 2))


def string_text(token: Column) -> Column:
    """A string token with no escapes but the needed ones, those of control signs in lower case."""
    written = F.to_json(F.array(plain_string(token)))
    written = F.substring(written, F.lit(2), F.length(written) - 2)
    for digit in "ABCDEF":
        # An even number of backslashes before: this one opens the escape.
        written = F.regexp_replace(
            written, rf'(?<=[^\\])((?:\\\\)*)\\u00([01]){digit}', rf"$1\\u00$2{digit.lower()}"
        )
    return F.when(token.contains("\\"), written).otherwise(token)


def number_text(token: Column) -> Column:
    """A number token without exponent, with the digits after the point that it was given."""
    sign, whole, fraction, power = (F.regexp_extract(token, NUMBER, k) for k in range(1, 5))
    digits = F.concat(whole, fraction)
    scale = F.length(fraction) - F.coalesce(F.when(power != "", power.cast("int")), F.lit(0))
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), scale + 1 - F.length(digits)))
    padded = F.concat(zeros, digits, F.repeat(F.lit("0"), F.greatest(F.lit(0), -scale)))
    after = F.greatest(F.lit(0), scale)
    before = F.regexp_replace(F.substring(padded, F.lit(1), F.length(padded) - after), "^0+(?=[0-9])", "")
    point = F.when(after > 0, F.concat(F.lit("."), F.right(padded, after))).otherwise(F.lit(""))
    minus = F.when(digits.rlike("[1-9]"), sign).otherwise(F.lit(""))
    return F.when(token.rlike(NUMBER), F.concat(minus, before, point)).otherwise(token)


def scalar_text(token: Column) -> Column:
    return F.when(token.startswith('"'), string_text(token)).otherwise(number_text(token))


def frame_text(frame: Column) -> Column:
    """A finished array or object."""
    items = frame["items"]
    last_ones = F.filter(items, lambda item, place: ~F.exists(
        F.slice(items, place + 2, F.size(items)), lambda later: later["key"] == item["key"]
    ))
    sorted_items = F.array_sort(F.transform(last_ones, lambda item: F.struct(
        F.octet_length(plain_string(item["key"])).alias("size"), plain_string(item["key"]).alias("name"),
        item["key"].alias("key"), item["value"].alias("value"),
    )))
    members = F.transform(sorted_items, lambda item: F.concat_ws(": ", item["key"], item["value"]))
    values = F.transform(items, lambda item: item["value"])
    return F.when(
        frame["object"], F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
    ).otherwise(F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]")))


def _state(open_frames: Column, done: Column) -> Column:
    return F.struct(open_frames.alias("open"), done.alias("done")).cast(STATE)


def _frame(is_object: Column, items: Column, key: Column) -> Column:
    return F.struct(is_object.alias("object"), items.alias("items"), key.alias("key")).cast(FRAME)


def _with_value(open_frames: Column, value: Column) -> Column:
    """The state after a value is complete: it goes into the innermost frame, or is all."""
    top = F.element_at(open_frames, -1)
    below = F.slice(open_frames, 1, F.size(open_frames) - 1)
    item = F.struct(top["key"].alias("key"), value.alias("value"))
    grown = _frame(top["object"], F.concat(top["items"], F.array(item)), F.lit(None).cast("string"))
    return F.when(F.size(open_frames) == 0, _state(open_frames, value)).otherwise(
        _state(F.concat(below, F.array(grown)), F.lit(None).cast("string"))
    )


def _step(state: Column, token: Column) -> Column:
    frames = state["open"]
    top = F.try_element_at(frames, F.lit(-1))
    opened = F.concat(frames, F.array(_frame(
        token == "{", F.array().cast("array<struct<key:string,value:string>>"), F.lit(None).cast("string")
    )))
    below = F.slice(frames, 1, F.greatest(F.lit(0), F.size(frames) - 1))
    named = F.concat(below, F.array(_frame(top["object"], top["items"], scalar_text(token))))
    return (
        F.when(token.isin(",", ":"), state)
        .when(token.isin("{", "["), _state(opened, F.lit(None).cast("string")))
        .when(token.isin("}", "]"), _with_value(below, frame_text(top)))
        .when(top["object"] & top["key"].isNull(), _state(named, F.lit(None).cast("string")))
        .otherwise(_with_value(frames, scalar_text(token)))
    )


def json_text(document: Column) -> Column:
    """The text of a JSON array or object; any other text, NULL included, as it is."""
    start = F.struct(
        F.array().cast(f"array<{FRAME}>").alias("open"), F.lit(None).cast("string").alias("done")
    ).cast(STATE)
    folded = F.aggregate(F.regexp_extract_all(document, F.lit(TOKEN), F.lit(0)), start, _step)
    return F.when(document.rlike(r"^\s*[\[{]"), F.coalesce(folded["done"], document)).otherwise(document)
