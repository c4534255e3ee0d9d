"""Byte-string helpers: hex, padding, topic decoding, display forms."""

from pyspark.sql import Column, functions as F


def to_hex(c) -> Column:
    """Bytes as lower-case hex without prefix."""
    return F.lower(F.hex(c))


def to_hex0x(c) -> Column:
    """Bytes as lower-case hex with ``0x``; null stays null."""
    return F.concat(F.lit("0x"), to_hex(c))


def strip_0x(c) -> Column:
    return F.regexp_replace(c, "^0[xX]", "")


def from_hex(c) -> Column:
    """Hex text, prefixed or not, as bytes."""
    return F.unhex(strip_0x(c))


def pad_bytes(c, width: int) -> Column:
    """Left-pad bytes with zero bytes (big-endian widening)."""
    return F.lpad(c, F.lit(width), F.lit(b"\x00"))


def zeros(width: int) -> Column:
    return F.lit(bytes(width))


def literal(text: str, width: int | None = None) -> Column:
    """A bytes literal from hex text, left-padded to ``width``: foldable, so it is
    pushed down to the scan."""
    digits = text[2:] if text[:2] in ("0x", "0X") else text
    raw = bytes.fromhex(digits.zfill(len(digits) + len(digits) % 2))
    return F.lit(raw if width is None else raw.rjust(width, b"\x00"))


def topic_address(topic) -> Column:
    """The 20-byte address held by a 32-byte topic."""
    return F.substring(topic, 13, 20)


def topic(n: int, topics="topics") -> Column:
    """``topic1`` .. ``topic3``; the stored array starts at topic1.  Null if absent."""
    return F.try_element_at(F.col(topics) if isinstance(topics, str) else topics, F.lit(n))


def short_hash(text) -> Column:
    """``0x12345678...abcdef12``: the first ten and the last eight characters."""
    return F.concat(F.left(text, F.lit(10)), F.lit("..."), F.right(text, F.lit(8)))
