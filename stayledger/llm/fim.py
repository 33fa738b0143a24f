"""Fill-in-middle: texts cut at two token boundaries and written as prefix, suffix and middle.

A token is a run of ASCII white space and the word after it, or the white space at a text's end; its end
is a boundary. A text's boundaries are held as a compressed set in the manner of roaring bitmaps: offsets
are grouped by their high bits into containers of 2^16 offsets, and each container is the smallest of a
sorted array, a bitmap, and a list of runs. Running cardinalities over the containers find the container
of the k-th boundary by binary search, and a select within the container finds the offset.

Offsets are in UTF-8 bytes: white space is ASCII, so no character is cut, and the pieces are taken from
the bytes without decoding the text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, quoted, text_bytes

# The marks before prefix, suffix and middle, and the forms' names.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# end of fixed values

CHUNK = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class ArrayContainer:
    """Sorted low halves."""

    def __init__(self, low: np.ndarray) -> None:
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per offset, and how many are set before each word of 64."""

    def __init__(self, low: np.ndarray) -> None:
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        per_word = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate(([0], np.cumsum(per_word)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.bytes[word * 8 : word * 8 + 8], bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """First offsets of runs, and how many offsets stand before each run."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(lengths)))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form for a chunk's sorted offsets (not empty)."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    if 4 * (len(breaks) + 1) < min(2 * len(low), CHUNK // 8):
        first = np.concatenate(([0], breaks))
        return RunContainer(low[first], np.diff(np.concatenate((first, [len(low)]))))
    return ArrayContainer(low) if 2 * len(low) <= CHUNK // 8 else BitmapContainer(low)


class BoundarySet:
    """A set of offsets, added in ascending chunks, with select."""

    def __init__(self) -> None:
        self.high: list[int] = []
        self.parts: list[ArrayContainer | BitmapContainer | RunContainer] = []
        #: How many offsets stand before each container, and in all.
        self.before = [0]

    def add(self, high: int, low: np.ndarray) -> None:
        if len(low):
            self.high.append(high)
            self.parts.append(container(low))
            self.before.append(self.before[-1] + len(low))

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        i = bisect_right(self.before, k) - 1
        return self.high[i] * CHUNK + self.parts[i].select(k - self.before[i])


def boundaries(text: bytes) -> BoundarySet:
    """The ends of a text's tokens."""
    found, n = BoundarySet(), len(text)
    if not n:
        return found
    data = np.frombuffer(text, np.uint8)
    for start in range(0, n + 1, CHUNK):
        stop = min(start + CHUNK, n + 1)
        here, before = _SPACE[data[start:stop]], _SPACE[data[max(0, start - 1) : stop - 1]]
        if start == 0:
            before = np.append(True, before)
        if stop > n:  # the text's end
            here = np.append(here, True)
        ends = here & ~before
        if stop > n:
            ends[-1] = True
        found.add(start // CHUNK, np.flatnonzero(ends))
    return found


def cut(text: bytes, first: int, second: int) -> tuple[int, int, int]:
    """Number of tokens n, and the offsets after first % (n + 1) and second % (n + 1) tokens, in order."""
    ends = boundaries(text)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends.select(low - 1) if low else 0, ends.select(high - 1) if high else 0


def draws(seed: int, key: str) -> list[int]:
    """Four numbers below 2^32 that a seed and a key decide."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _chars(data: bytes) -> int:
    """Code points in UTF-8 bytes."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


ADDED = T.StructType(
    [
        T.StructField("n", T.LongType(), False),
        T.StructField("form", T.StringType(), False),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType(), False),
    ]
)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``docs`` with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    ``rate`` of 100 texts are cut, ``spm_rate`` of 100 of those are written suffix first. What is drawn
    depends on seed and key only, so repeated keys are cut by the same draws and a retry gives the same
    rows. A null text is an empty one, a null key an empty text. Empty texts and texts that hold one of
    the marks stay plain. A very long text costs memory for its bytes and its compressed boundaries.
    An empty table gives an empty table. Columns with the added names are replaced, others pass through.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    before, after, between = marks

    def step(keys: pa.Array, texts: pa.Array):
        rows = []
        for name, data in zip(keys.to_pylist(), texts.to_pylist()):
            first, second, chosen, kind = draws(seed, name)
            n, a, b = cut(data, first, second)
            if not data or chosen % 100 >= rate or any(m in data for m in marks):
                rows.append((n, PLAIN, None, None, data))
                continue
            prefix, middle, suffix = data[:a], data[a:b], data[b:]
            if kind % 100 < spm_rate:
                form, parts = SPM, (after, suffix, before, prefix, between, middle)
            else:
                form, parts = PSM, (before, prefix, after, suffix, between, middle)
            rows.append((n, form, _chars(prefix), _chars(middle), b"".join(parts)))
        n, form, p, m, out = zip(*rows)
        return [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(p, pa.int64()), pa.array(m, pa.int64()), pa.array(out, pa.binary()).view(pa.string())]

    name = F.coalesce(quoted(key).cast("string"), F.lit(""))
    return append(docs, [name, text_bytes(quoted(text))], ADDED, lambda: step)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made from. A cut text held no mark, and no mark can
    begin or end within another, so the three marks cut the output uniquely."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
