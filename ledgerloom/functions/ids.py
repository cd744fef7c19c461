"""Surrogate ids: md5 over bar-joined parts (NULL parts are skipped)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bar_md5(*parts: Column) -> Column:
    """md5(concat_ws('|', parts...)) with every part cast to text first."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


_HEX, _TEXT = bytearray(b"\x01"), bytearray(b"\x00")


def _is_hex(text: Column) -> Column:
    """Whether a text is pairs of lower-case hex digits: such a text alone comes back from its bytes (much cheaper than a pattern)."""
    return F.lower(F.hex(F.unhex(text))) == text


def packed(text: Column) -> Column:
    """A text as bytes that ``unpacked`` turns back into it; lower-case hex takes half its length."""
    return (F.when(_is_hex(text), F.concat(F.lit(_HEX), F.unhex(text)))
             .otherwise(F.concat(F.lit(_TEXT), text.cast("binary"))))


def packed_id(text: Column) -> Column:
    """An md5 id as bytes that ``unpacked`` turns back into it and that sort as the ids do; other texts as long as they
    are, sorted among themselves."""
    return (F.when((F.octet_length(text) == 32) & _is_hex(text), F.concat(F.lit(_HEX), F.unhex(text)))
             .otherwise(F.concat(F.lit(_TEXT), text.cast("binary"))))


def unpacked(value: Column) -> Column:
    body = F.substring(value, 2, 1 << 30)
    return F.when(F.substring(value, 1, 1) == F.lit(_HEX), F.lower(F.hex(body))).otherwise(body.cast("string"))
