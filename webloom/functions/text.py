"""Column functions on text: file names, tokens, FNV-1a and SimHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the C locale; the no-break space is not among it.
SPACES = r"[ \t\n\x0B\f\r]+"
FNV_START = -3750763034362895579
LOW32 = 4294967295


def content_hash(text: Column) -> Column:
    """MD5 of the UTF-8 text, in hex."""
    return F.md5(text)


def safe_filename(url: Column) -> Column:
    """The URL with ``:``, ``/`` and ``.`` as ``_``, cut to 100 characters, with ``.md``."""
    return F.concat(F.left(F.translate(url, ":/.", "___"), F.lit(100)), F.lit(".md"))


def legacy_filename(url: Column) -> Column:
    """Host and path of the URL with ``.`` and ``/`` as ``_``, ``index`` for no path, cut to 100 characters."""
    host = F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))
    path = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "^/+|/+$", "")
    path = F.replace(path, F.lit("/"), F.lit("_"))
    return F.left(F.concat(F.replace(host, F.lit("."), F.lit("_")), F.lit("_"), F.when(path == "", "index").otherwise(path)), F.lit(100))


def tokens(text: Column) -> Column:
    """Words between white space, with repeats; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def clean_word(word: Column) -> Column:
    """ASCII letters and digits of a word, in lower case."""
    return F.lower(F.regexp_replace(word, "[^A-Za-z0-9]", ""))


def count_of(text: Column, part: str) -> Column:
    """How often ``part`` occurs in ``text`` without overlap, from the left."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def escaped_content(line: Column, key: str = "content") -> Column:
    """The still escaped value of a key of a JSON line."""
    return F.regexp_extract(line, f'"{key}": ?"([^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+)"', 1)


def fnv1a(word: Column) -> Column:
    """FNV-1a of the UTF-8 bytes, as a signed 64-bit number, in built-in functions.

    The product wraps around at 64 bits, so it is put together from 32-bit halves.
    """

    def step(acc: Column, byte: Column) -> Column:
        x = acc.bitwiseXOR(byte)
        low = x.bitwiseAND(F.lit(LOW32)) * 435
        high = F.shiftrightunsigned(x, 32) * 435 + F.shiftrightunsigned(low, 32) + F.shiftleft(x.bitwiseAND(F.lit(LOW32)), 8)
        return F.shiftleft(high.bitwiseAND(F.lit(LOW32)), 32).bitwiseOR(low.bitwiseAND(F.lit(LOW32)))

    octets = F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.ascii(c).cast("long"))
    return F.when(word == "", F.lit(FNV_START)).otherwise(F.aggregate(octets, F.lit(FNV_START).cast("long"), step))


def fnv1a_bytes(data: bytes, h: int = 0xCBF29CE484222325) -> int:
    """FNV-1a as an unsigned number; ``h`` is that of the bytes before."""
    for b in data:
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h


#: Bytes of text that are hashed at once; arrays of numbers for each word take several times as much.
_SLICE_BYTES = 1 << 19
_BLANK = np.zeros(256, bool)
_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_PRIME = np.uint64(0x100000001B3)
#: One bit of each byte; sums of up to 255 of them stay within their bytes.
_LANES, _LANE_WORDS = np.uint64(0x0101010101010101), 255


@F.arrow_udf(T.LongType())
def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """SimHash of each text: the sign of the sum of its tokens' FNV-1a bits; 0 without tokens.

    Words are hashed where they stand in the batch's bytes, a slice of rows at a time,
    so a worker keeps nothing from one batch to the next.
    """
    for part in texts:
        data, at = _bytes_of(part)
        out, i = np.zeros(len(part), np.int64), 0
        while i < len(part):
            j = max(i + 1, int(np.searchsorted(at, at[i] + _SLICE_BYTES, "right")) - 1)
            out[i:j] = simhash_slice(data[at[i] : at[j]], at[i : j + 1] - at[i])
            i = j
        yield pa.array(out)


def _bytes_of(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and where its rows begin and end; null counts as empty."""
    part = part.cast(pa.large_string()).fill_null("")
    _, at, data = part.buffers()
    if not len(part):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64)[part.offset : part.offset + len(part) + 1]
    return np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8), offsets


def simhash_slice(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SimHash of rows that lie one behind the other in ``data``, from ``at[i]`` to ``at[i + 1]``."""
    out = np.zeros(len(at) - 1, np.int64)
    inside = ~_BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]
    first[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return out
    h = fnv1a_spans(data, starts, np.flatnonzero(last) + 1 - starts)
    row = np.searchsorted(starts, at)
    rows = np.flatnonzero(np.diff(row))
    begin, words = row[rows], np.diff(row)[rows]
    lots = -(-words // _LANE_WORDS)
    lot = np.cumsum(lots) - lots
    cut = np.repeat(begin, lots) + (np.arange(int(lots.sum())) - np.repeat(lot, lots)) * _LANE_WORDS
    ones = np.empty((len(rows), 8, 8), np.int64)
    for k in range(8):
        sums = np.add.reduceat(h >> np.uint64(k) & _LANES, cut).view(np.uint8).reshape(-1, 8)
        ones[:, :, k] = np.add.reduceat(sums, lot, axis=0, dtype=np.int64)
    out[rows] = np.packbits(2 * ones.reshape(-1, 64) > words[:, None], axis=1, bitorder="little").view(np.int64)[:, 0]
    return out


def fnv1a_spans(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """FNV-1a of stretches of ``data``, a byte of all of them at a time; the last few long ones singly."""
    order = np.argsort(np.minimum(length, 65535).astype(np.uint16), kind="stable")[::-1]
    s, n = starts[order], length[order]
    h = np.full(len(s), 0xCBF29CE484222325, np.uint64)
    left = len(s) - np.cumsum(np.bincount(np.minimum(length, 65535)))
    p, m = 0, len(s)
    while m >= 32 and p < 65535:
        h[:m] = (h[:m] ^ data[s[:m] + p]) * _PRIME
        p += 1
        m = int(left[p]) if p < len(left) else 0
    for i in range(m):
        h[i] = fnv1a_bytes(data[s[i] + p : s[i] + n[i]].tobytes(), int(h[i]))
    out = np.empty_like(h)
    out[order] = h
    return out


def hamming(a: Column, b: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_block(fp: Column, k: int) -> Column:
    """The k-th of the four 16-bit parts of a fingerprint."""
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(65535).cast("long"))


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")
