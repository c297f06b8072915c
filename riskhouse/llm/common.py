"""Helpers shared by the operators: shipping the code, text blocks, word and shingle hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Both the separators and
A-Z are ASCII, so words are cut and hashed on UTF-8 bytes without decoding.
All hashes are 64-bit and depend on content alone, so every executor (and
every retry of a task) gives the same values.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; bounds the scratch arrays.
PIECE = 1 << 20
#: Bytes of text that one block of rows holds (or a single longer row).
BLOCK = 4 << 20
SHINGLE = 5

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(0x5EED))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for workers whose path lacks it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(), "riskhouse_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(os.path.join(root, "riskhouse")):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(d, f), os.path.relpath(os.path.join(d, f), root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; executors may be lost afterwards."""
    from riskhouse.session import checkpointed

    return checkpointed(df)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_REST = "_other_columns"


def packed(df: DataFrame, used: list[str]) -> DataFrame:
    """The used columns, and all others as one struct, so that no name of theirs can clash with a working column."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*used, F.struct(*others or [F.lit(0).alias("none")]).alias(_REST))


def unpacked(df: DataFrame, like: DataFrame, *more) -> DataFrame:
    """The columns of ``like`` from a frame that packed() made of it, and more columns."""
    held = set(df.schema[_REST].dataType.names)
    own = lambda c: F.col(_REST).getField(c).alias(c) if c in held else F.col(f"`{c}`")
    return df.select(*[own(c) for c in like.columns], *more)


def held_out(doc_id):
    """crc32 of the id as text, mod 5, is 0 (null id: not held out, and not learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- Arrow strings as byte buffers ------------------------------------------------


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def row_blocks(off: np.ndarray, most: int = BLOCK):
    """Row ranges of at most ``most`` bytes each (a longer row is alone)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


# --- word and shingle hashes ------------------------------------------------------


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < n:
        for key, base in (("p", _BASE), ("i", _BASE_INV)):
            step = np.full(max(n, PIECE + 64), base, np.uint64)
            step[0] = 1
            _powers[key] = np.cumprod(step, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def finish(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of the rows that ``off`` bounds, and the rows' offsets into them.

    Works on pieces of about PIECE bytes cut between words, so a very long
    text needs no more scratch memory than a short one (only a single word
    longer than a piece widens its piece).
    """
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at, end = int(off[0]), int(off[-1])
    while at < end:
        cut = min(end, at + PIECE)
        if cut < end:
            seps = np.flatnonzero(_SEP[data[at:cut]])
            row = int(off[np.searchsorted(off, cut, "right") - 1])
            best = max(int(seps[-1]) + at + 1 if len(seps) else at, row)
            while best <= at and cut < end:  # one word fills the piece
                cut = min(end, cut + PIECE)
                seps = np.flatnonzero(_SEP[data[at:cut]])
                nxt = int(off[np.searchsorted(off, at, "right")])
                best = min(int(seps[0]) + at + 1 if len(seps) else end, nxt) if len(seps) or nxt <= cut else at
            cut = best if best > at else end
        piece = data[at:cut]
        word = ~_SEP[piece]
        rows = off[np.searchsorted(off, at) : np.searchsorted(off, cut)] - at
        rows = rows[rows < len(piece)]
        before = np.empty_like(word)
        before[0], before[1:] = False, word[:-1]
        before[rows] = False
        after = np.empty_like(word)
        after[-1], after[:-1] = False, word[1:]
        after[rows[rows > 0] - 1] = False
        s, e = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after)
        p, inv = _pow(len(piece))
        total = np.cumsum(_BYTE[_LOWER[piece]] * p[: len(piece)], dtype=np.uint64)
        h = total[e] - np.where(s > 0, total[s - 1], np.uint64(0))
        hashes.append(finish(h * inv[s]))
        starts.append(s + at)
        at = cut
    h, s = np.concatenate(hashes), np.concatenate(starts)
    return h, np.searchsorted(s, off)


def shingle_hashes(h: np.ndarray, wo: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words in order, and row offsets.  A row of 1 to k-1 words has one shingle, the whole row."""
    n = np.diff(wo)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    so = np.concatenate([[0], np.cumsum(count)])
    if not len(h):
        return np.zeros(0, np.uint64), so
    first = np.arange(so[-1]) - np.repeat(so[:-1], count) + np.repeat(wo[:-1], count)
    width = np.repeat(np.minimum(n, k), count)
    out = width.astype(np.uint64) * _MIX[63]
    for j in range(k):
        out += np.where(j < width, h[np.minimum(first + j, len(h) - 1)] * _MIX[j], np.uint64(0))
    return finish(out), so


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = SHINGLE):
    """The sorted set of shingle hashes of each row, one array after the other."""
    for lo, hi in row_blocks(off):
        h, wo = word_hashes(data, off[lo : hi + 1])
        sh, so = shingle_hashes(h, wo, k)
        for i in range(hi - lo):
            yield np.unique(sh[so[i] : so[i + 1]])
