"""Conversions between token bytes, token ids and text.

A token stream is stored as BINARY. ``width=1`` holds one token per byte
(pre-tokenized shards, byte-level text); ``width=2`` holds little-endian
uint16 ids (what a BPE encoder writes). Spark has no unsigned types, so ids
are INT and range checks are explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col


def utf8_bytes(text) -> Column:
    """UTF-8 bytes of a string: byte-level tokens of text."""
    return F.encode(as_col(text), "UTF-8")


def _latin1(b: Column) -> Column:
    # ISO-8859-1 maps every byte 0..255 to the code point of the same value,
    # one to one, so string functions can address single bytes.
    return F.decode(b, "ISO-8859-1")


def bytes_to_ids(data, width: int = 1) -> Column:
    """BINARY token stream -> ARRAY<INT> of token ids; empty for an empty stream.

    With ``width=2`` a stream of an odd number of bytes is an error.
    """
    b = as_col(data)
    one = F.when(F.octet_length(b) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(_latin1(b), ""), lambda c: F.ascii(c)))
    if width == 1:
        return one
    if width != 2:
        raise ValueError("width must be 1 or 2")
    # two bytes are four hex digits, the low byte first
    pairs = F.transform(F.regexp_extract_all(F.hex(b), F.lit("[0-9A-F]{4}"), 0),
                        lambda x: F.conv(F.concat(F.substring(x, 3, 2), F.substring(x, 1, 2)), 16, 10).cast("int"))
    odd = F.raise_error(F.lit("a uint16 token stream has an odd number of bytes")).cast("array<int>")
    return (F.when(F.octet_length(b) == 0, F.array().cast("array<int>"))
            .when(F.octet_length(b) % 2 == 1, odd).otherwise(pairs).alias("ids"))


def ids_to_bytes(ids, width: int = 1) -> Column:
    """ARRAY<INT> of ids -> BINARY stream (ids are taken modulo 2**(8*width))."""
    a = as_col(ids)
    if width == 1:
        s = F.array_join(F.transform(a, lambda t: F.char(t)), "")
    elif width == 2:
        s = F.array_join(
            F.transform(a, lambda t: F.concat(F.char(t % 256), F.char(F.floor(t / 256) % 256))), "")
    else:
        raise ValueError("width must be 1 or 2")
    return F.encode(s, "ISO-8859-1")


def token_count(data, width: int = 1) -> Column:
    """Number of tokens in a BINARY stream without decoding it."""
    n = F.octet_length(as_col(data)).cast("long")
    return n if width == 1 else F.floor(n / width).cast("long")


def token_sum(data, width: int = 1) -> Column:
    """Sum of the token ids in a stream (a cheap content digest)."""
    return F.aggregate(bytes_to_ids(data, width), F.lit(0).cast("long"),
                       lambda acc, x: acc + x)


def ids_csv(ids) -> Column:
    """Comma-separated ids: a portable, comparable rendering of an array."""
    return F.array_join(as_col(ids), ",")


def bytes_csv(data, width: int = 1) -> Column:
    return ids_csv(bytes_to_ids(data, width))


def decode_utf8(data) -> Column:
    """Token bytes -> text; malformed sequences (a cut character) -> U+FFFD."""
    return F.make_valid_utf8(as_col(data).cast("string"))


def tail_context(ids, block_size: int) -> Column:
    """Last ``block_size`` ids of an array (all of them if shorter)."""
    a = as_col(ids)
    n = F.least(F.size(a), F.lit(block_size))
    return F.when(n == 0, a).otherwise(F.slice(a, -n, n))


def append_token(ids, tok) -> Column:
    """T4: append one sampled id to a sequence."""
    return F.concat(as_col(ids), F.array(as_col(tok).cast("int")))


def truncate_at_stop(ids, stop_id: int) -> Column:
    """Cut a sequence after its first stop id (inclusive); keep all if absent."""
    a = as_col(ids)
    p = F.array_position(a, F.lit(stop_id))
    return F.when(p > 0, F.slice(a, 1, p.cast("int"))).otherwise(a)


def out_of_range(ids, vocab_size: int) -> Column:
    """Number of ids outside ``[0, vocab_size)``."""
    return F.size(F.filter(as_col(ids), lambda t: (t < 0) | (t >= vocab_size)))
