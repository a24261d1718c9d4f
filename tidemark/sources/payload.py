"""Event payloads: the data map, else MessagePack, else JSON; what is none of them goes to the dead letters."""

from __future__ import annotations

import base64
import json
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpack(data: bytes):
    """A MessagePack value; raises ValueError on other bytes or bytes left over."""
    try:
        value, at = _read(data, 0)
    except (IndexError, struct.error, UnicodeDecodeError) as e:
        raise ValueError("not MessagePack") from e
    if at != len(data):
        raise ValueError("bytes left over")
    return value


# Fixed values of the format: marks of numbers with their struct codes, and of lengths with theirs.
NUMBERS = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}
SIZED = {0xC4: ("bin", ">B"), 0xC5: ("bin", ">H"), 0xC6: ("bin", ">I"), 0xD9: ("str", ">B"), 0xDA: ("str", ">H"), 0xDB: ("str", ">I"), 0xDC: ("array", ">H"), 0xDD: ("array", ">I"), 0xDE: ("map", ">H"), 0xDF: ("map", ">I")}
CONSTANTS = {0xC0: None, 0xC2: False, 0xC3: True}


def _read(d: bytes, at: int):
    mark = d[at]
    at += 1
    if mark < 0x80:
        return mark, at
    if mark >= 0xE0:
        return mark - 256, at
    if mark in CONSTANTS:
        return CONSTANTS[mark], at
    if mark in NUMBERS:
        code = NUMBERS[mark]
        return struct.unpack_from(code, d, at)[0], at + struct.calcsize(code)
    if mark in SIZED:
        kind, code = SIZED[mark]
        size, at = struct.unpack_from(code, d, at)[0], at + struct.calcsize(code)
    elif mark < 0x90:
        kind, size = "map", mark & 15
    elif mark < 0xA0:
        kind, size = "array", mark & 15
    elif mark < 0xC0:
        kind, size = "str", mark & 31
    else:
        raise ValueError("unknown mark")
    if kind in ("bin", "str"):
        raw = d[at : at + size]
        if len(raw) < size:
            raise ValueError("cut short")
        return (raw.decode("utf-8") if kind == "str" else raw), at + size
    if kind == "array":
        out = []
        for _ in range(size):
            x, at = _read(d, at)
            out.append(x)
        return out, at
    pairs = {}
    for _ in range(size):
        k, at = _read(d, at)
        pairs[k], at = _read(d, at)
    return pairs, at


def as_text(value) -> str | None:
    """A decoded value in the text form in which values travel."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, bytes):
        return base64.b64encode(value).decode()
    if isinstance(value, (dict, list)):
        return json.dumps(value, default=as_text, separators=(",", ":"))
    return str(value)


def decode_payloads(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with data filled from their payload where it is missing, and the ones that can't be decoded with their reason.

    Only events without data go through Python.
    """
    names = [f.name for f in events.schema.fields]

    def from_msgpack(frames):
        for d in frames:
            out = []
            for p in d["payload"]:
                try:
                    v = unpack(bytes(p)) if p is not None else None
                except ValueError:
                    v = None
                out.append({str(k): as_text(x) for k, x in v.items()} if isinstance(v, dict) else None)
            yield d.assign(data=out)[names]

    ready = events.filter(F.col("data").isNotNull())
    packed = events.filter(F.col("data").isNull())
    text = F.from_json(F.when(F.is_valid_utf8(F.col("payload").cast("string")), F.col("payload").cast("string")), "map<string,string>")
    decoded = packed.mapInPandas(from_msgpack, events.schema).withColumn("data", F.coalesce("data", text))
    good = ready.unionByName(decoded.filter(F.col("data").isNotNull()))
    return good, decoded.filter(F.col("data").isNull()).withColumn("reason", F.lit("deserialization_failed"))
