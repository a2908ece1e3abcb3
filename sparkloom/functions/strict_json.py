"""Strict JSON: what a closed control file may hold, and one canonical form of it."""

from __future__ import annotations

import json
import math
import struct
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Refused(ValueError):
    """The text isn't JSON of the strict form, or a number of it is no double."""


class Number(str):
    """The text of a number as it stood."""


def _object(pairs):
    found = dict(pairs)
    if len(found) != len(pairs):
        raise Refused("a key comes twice")
    return found


def _depth(value, left: int = 128) -> None:
    if left < 0:
        raise Refused("too deep")
    for x in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        _depth(x, left - 1)


def _surrogates(value) -> None:
    texts = [value] if isinstance(value, str) else [*value, *value.values()] if isinstance(value, dict) else value if isinstance(value, list) else []
    for x in texts:
        if isinstance(x, str):
            if any(0xD800 <= ord(c) < 0xE000 for c in x):
                raise Refused("a lone surrogate")
        else:
            _surrogates(x)


def parse(text: str):
    """A JSON value; numbers keep their text. Refuses repeated keys, control characters, lone surrogates and more than 128 levels."""
    try:
        value = json.loads(text, object_pairs_hook=_object, parse_float=Number, parse_int=Number, parse_constant=Number)
    except RecursionError:
        raise Refused("too deep") from None
    except ValueError as e:
        raise Refused(str(e)) from None
    _depth(value)
    _surrogates(value)
    return value


def number(raw: str) -> str:
    """The shortest decimal form of a number as ECMAScript prints it; refuses what a double can't hold."""
    try:
        value = float(raw)
    except ValueError:
        raise Refused("no number") from None
    if not math.isfinite(value):
        raise Refused("not finite")
    if value == 0:
        if Decimal(raw) != 0:
            raise Refused("more digits than a double holds")
        return "0"
    sign, digits, exponent = Decimal(repr(value)).normalize().as_tuple()
    if Decimal(raw).normalize().as_tuple().digits != digits:
        raise Refused("more digits than a double holds")
    d, point = "".join(map(str, digits)), len(digits) + exponent
    if len(d) <= point <= 21:
        body = d + "0" * (point - len(d))
    elif 0 < point <= 21:
        body = f"{d[:point]}.{d[point:]}"
    elif -6 < point <= 0:
        body = "0." + "0" * -point + d
    else:
        body = d[0] + (f".{d[1:]}" if len(d) > 1 else "") + f"e{point - 1:+d}"
    return "-" * sign + body


def canonical(value) -> str:
    """One text per value: keys by UTF-16 units, least escapes, ECMAScript numbers."""
    if isinstance(value, Number):
        return number(value)
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be"))) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return {None: "null", True: "true", False: "false"}[value]


def canonical_or_none(text: str | None) -> str | None:
    try:
        return None if text is None else canonical(parse(text))
    except Refused:
        return None


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    """The canonical form of each text; null where it is refused."""
    return texts.map(canonical_or_none)


@F.pandas_udf(T.StringType())
def f64_le_hex(x: pd.Series) -> pd.Series:
    """Eight little-endian bytes of a double in hex."""
    return x.map(lambda v: None if v is None else struct.pack("<d", v).hex())


@F.pandas_udf(T.IntegerType())
def bf16_bits(x: pd.Series) -> pd.Series:
    """The upper half of a float's bits, rounded to nearest, ties to even."""
    bits = x.to_numpy("float32").view("uint32").astype("uint64")
    return pd.Series(((bits + 0x7FFF + ((bits >> 16) & 1)) & 0xFFFFFFFF) >> 16).astype("int32")
