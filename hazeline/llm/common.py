"""Shared helpers: row keys, scratch tables, and text batches as numpy arrays.

A row of documents is known by its id and a 64-bit hash of its text, so null and repeated ids need no
special case: rows alike in both are alike in every result.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.session import scratch_path

#: Bytes of text worked on at once in a Python task; a longer text is taken alone.
CHUNK_BYTES = 1 << 20

U64 = np.uint64
_MIX_A, _MIX_B = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9)
_BASE = U64(0x100000001B3 * 2 + 1)
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

# fixed values: which bytes belong to a word after A-Z are lowered (digits, a-z, and all of a
# multi-byte character)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
#: Bytes of words that only space, tab and line ends part.
SPACED = np.ones(256, dtype=bool)
SPACED[32] = SPACED[9:14] = False


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once per context; Spark serves the file to them."""
    context = spark.sparkContext
    name = "hazeline.zip"
    if any(f.rsplit("/", 1)[-1] == name for f in context.listFiles):
        return
    package = Path(__file__).resolve().parents[1]
    file = Path(tempfile.mkdtemp(prefix="hazeline-")) / name
    with zipfile.ZipFile(file, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(file))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written below ``spark.checkpoint.dir`` and read again: no lineage behind it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (hash of the text) and ``text``; a null text is empty, other columns go."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the row key; null ids match."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["th"] == right["th"])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        first, base = 0, 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(first, last - first)
            base, first = int(ends[last - 1]), last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts (one more entry for the end)."""
    size = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=size)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    values = (values ^ (values >> U64(31))) * _MIX_B
    return values ^ (values >> U64(29))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """``base`` to the powers 0 to n-1, modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(data: np.ndarray, bounds: np.ndarray, member: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, number of the first word of each row (and the end), and word byte lengths.

    Words are runs of digits, letters a-z (A-Z are lowered) and characters beyond ASCII, or of the bytes that are
    a ``member``; none spans rows.
    """
    low = _LOWER[data]
    inside = member[low]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    compact = low[inside]
    at = np.cumsum(inside)[starts] - 1
    lengths = np.diff(np.append(at, len(compact)))
    place = np.arange(len(compact)) - np.repeat(at, lengths)
    hashes = np.add.reduceat(_BYTE_CODES[compact] * powers(int(lengths.max()))[place], at)
    return mixed(hashes * _MIX_A + lengths.astype(np.uint64)), np.searchsorted(starts, bounds), lengths


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, rows not regarded; shorter than the input by n-1."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for j, p in enumerate(powers(n, _MIX_A)):
        total += hashes[j : j + m] * p
    return mixed(total)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges start, start+1, ... of the given counts, one after the other."""
    counts = np.asarray(counts, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open spans of one text joined where they overlap or touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]
