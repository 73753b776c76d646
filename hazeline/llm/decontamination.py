"""Benchmark decontamination by winnowing.

Of every window of six consecutive 5-word hashes the smallest is a fingerprint (of equals the rightmost), so
every span of ten words that a document shares with an item holds a fingerprint both have chosen. Documents'
fingerprints are joined with those of the items; each place that is hit is extended to the windows of ten words around it, and
a window that an item has too marks its words. A place is extended once, however often the items hold its fingerprint. An
item of fewer than ten words is one window, looked up whole.

The items' fingerprints travel to the documents in blocks of at most ``block_words`` words, so what a task
holds is bounded whatever the benchmark's size; documents are never shuffled. Windows are compared by 64-bit hashes.

A null or empty text has no words; an item without words occurs nowhere; rows alike in id and text give as
many result rows. Null item ids are left out of the list of items (their words still count). Items that
share an id count once. An empty benchmark finds nothing; an empty table gives an empty result. Columns
besides id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common

WINDOW_WORDS = 10
GRAM_WORDS = 5
#: Words of benchmark items sent to the tasks at once; 16 bytes each for windows, and a few more for fingerprints.
BLOCK_WORDS = 1 << 20


@dataclass
class Block:
    """Some items: their fingerprints, and by words in a window the windows and who has them."""

    prints: np.ndarray  # different fingerprints, sorted
    windows: dict[int, tuple[np.ndarray, np.ndarray]]  # words -> sorted hashes, item numbers; each pair once


def winnowed(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest value of every window of ``width``; of equals the rightmost."""
    if not len(values):
        return np.zeros(0, np.int64)
    if len(values) <= width:
        return np.array([len(values) - 1 - int(np.argmin(values[::-1]))])
    windows = np.lib.stride_tricks.sliding_window_view(values, width)
    return np.unique(np.arange(len(windows)) + width - 1 - np.argmin(windows[:, ::-1], axis=1))


def block_of(texts: list[str]) -> Block:
    data, bounds = common.text_bytes(pa.array(texts, pa.string()))
    hashes, starts, _ = common.words(data, bounds)
    prints, found = [np.zeros(0, np.uint64)], {}
    for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        n = min(int(b - a), WINDOW_WORDS)
        if n == WINDOW_WORDS:
            values = common.grams(hashes[a:b], GRAM_WORDS)
            prints.append(values[winnowed(values, WINDOW_WORDS - GRAM_WORDS + 1)])
        if n:
            values = np.unique(common.grams(hashes[a:b], n))
            found.setdefault(n, []).append((values, np.full(len(values), k)))
    windows = {}
    for n, parts in found.items():
        values, items = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.argsort(values, kind="stable")
        windows[n] = (values[by], items[by])
    return Block(np.unique(np.concatenate(prints)), windows)


def _pairs(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (place in values, place in the sorted table) with equal entries."""
    first, last = np.searchsorted(table, values, "left"), np.searchsorted(table, values, "right")
    found = np.flatnonzero(last > first)
    counts = (last - first)[found]
    return np.repeat(found, counts), common.spread(first[found], counts)


def _holds(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the sorted table has each value."""
    at = np.searchsorted(table, values)
    return (at < len(table)) & (table[np.minimum(at, len(table) - 1)] == values) if len(table) else np.zeros(len(values), bool)


def _suspects(hashes: np.ndarray, firsts: np.ndarray, row_of: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """First words of all windows around fingerprints that rows and items share."""
    values, width = common.grams(hashes, GRAM_WORDS), WINDOW_WORDS - GRAM_WORDS + 1
    # the items' fingerprints are looked up first; only rows that contain some need the window rule
    at = np.flatnonzero(_holds(prints, values))
    own = [np.zeros(0, np.int64)]
    for row in np.unique(row_of[at]):
        a, b = firsts[row], firsts[row + 1]
        if b - a >= WINDOW_WORDS:
            mine = at[np.searchsorted(at, a) : np.searchsorted(at, b)]
            mine = mine[np.isin(mine, winnowed(values[a : b - GRAM_WORDS + 1], width) + a)]
            starts = np.unique(mine[:, None] - np.arange(width))
            own.append(starts[(starts >= a) & (starts + WINDOW_WORDS <= b)])
    return np.concatenate(own)


def hits(hashes: np.ndarray, firsts: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last) of the rows' words that are windows of the block, and different (row, item) of them."""
    row_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    spans, told = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]
    for n, (table, items) in block.windows.items():
        if len(hashes) < n:
            continue
        values = common.grams(hashes, n)
        if n == WINDOW_WORDS:
            at = _suspects(hashes, firsts, row_of, block.prints)
        else:
            at = np.arange(len(values))
            at = at[row_of[at] == row_of[at + n - 1]]
        at = at[_holds(table, values[at])]
        spans.append(np.stack([at, at + n]))
        # a window that comes again in a row names the same items
        order = np.lexsort((values[at], row_of[at]))
        row, value = row_of[at][order], values[at][order]
        new = np.append(True, (row[1:] != row[:-1]) | (value[1:] != value[:-1]))[: len(row)]
        place, entry = _pairs(value[new], table)
        told.append(np.unique(np.stack([row[new][place], items[entry]]), axis=1))
    return *np.concatenate(spans, axis=1), *np.unique(np.concatenate(told, axis=1), axis=1)


def _scan(block: Block, items: list) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, th, n_words, first word and end of merged hits, items) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            hashes, firsts, _ = common.words(*common.text_bytes(batch.column("text")))
            start, end, holder, item = hits(hashes, firsts, block)
            rows = np.searchsorted(firsts, start, "right") - 1
            order = np.argsort(rows, kind="stable")
            cuts = np.searchsorted(rows[order], np.arange(batch.num_rows + 1))
            named = np.searchsorted(holder, np.arange(batch.num_rows + 1))
            starts, ends, found = [], [], []
            for row in range(batch.num_rows):
                mine = order[cuts[row] : cuts[row + 1]]
                s, e = common.merged(start[mine], end[mine]) if len(mine) else (mine, mine)
                starts.append((s - firsts[row]).tolist())
                ends.append((e - firsts[row]).tolist())
                found.append([items[k] for k in item[named[row] : named[row + 1]]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array(np.diff(firsts)),
                    pa.array(starts, pa.list_(pa.int64())),
                    pa.array(ends, pa.list_(pa.int64())),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["doc_id", "th", "n_words", "starts", "ends", "items"],
            )

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[tuple[Block, list]]:
    """The items in bounded blocks; one block's texts are in the driver at a time."""
    size = F.expr(f"length(coalesce(`{text_col}`, '')) div 2 + 1")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), size.alias("most"))
    total = items.agg(F.sum("most")).first()[0] or 0
    n = max(1, -(-total // block_words))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
        texts, names = [], []
        for row in part.select("item", "text").toLocalIterator():
            texts.append(row.text)
            names.append(row.item)
        yield block_of(texts), names


def contaminated_words(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row: ``doc_id, th, n_words``, word spans ``starts, ends`` inside windows, and ``items`` (ids as text).

    With one block a row is found in one pass; further blocks are united by row key.
    """
    source = common.keyed(docs, id_col, text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType),
            T.StructField("th", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("starts", T.ArrayType(T.LongType())),
            T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    parts = [source.mapInArrow(_scan(block, names), schema) for block, names in _blocks(benchmark, item_col, item_text_col, block_words)]
    found = parts[0]
    if len(parts) > 1:
        # rows alike in id and text have equal hits in a block; one of them is enough
        rest = [p.where("size(starts) > 0").withColumn("block", F.lit(k)) for k, p in enumerate(parts[1:])]
        more = rest[0]
        for p in rest[1:]:
            more = more.unionByName(p)
        more = more.groupBy("doc_id", "th", "block").agg(*(F.first(c).alias(c) for c in ("starts", "ends", "items")))
        more = more.groupBy("doc_id", "th").agg(F.collect_list(F.struct("starts", "ends", "items")).alias("all"))
        more = more.select("doc_id", "th", *(F.flatten(F.col("all")[x]).alias(x[0]) for x in ("starts", "ends", "items")))
        found = (
            found.alias("a")
            .join(more.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th")), "left")
            .select(
                "a.doc_id",
                "a.th",
                "n_words",
                *(
                    F.concat(F.col(x), F.coalesce(F.col(y), F.array().cast(t))).alias(x)
                    for x, y, t in (("starts", "s", "array<long>"), ("ends", "e", "array<long>"), ("items", "i", "array<string>"))
                ),
            )
        )
    return found


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, count, digest = [], [], []
        for starts, ends, items in zip(*(batch.column(c).to_pylist() for c in ("starts", "ends", "items")), strict=True):
            s, e = common.merged(np.array(starts, np.int64), np.array(ends, np.int64))
            names = sorted({i for i in items if i is not None})
            hit.append(int((e - s).sum()))
            count.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        hit = pa.array(hit, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                hit,
                pa.array(count, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array(hit.to_numpy() > 0),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def report(found: DataFrame) -> DataFrame:
    """Counts per row and a digest of its items."""
    kind = found.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )
    return found.mapInArrow(_digest, schema)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows no window of the benchmark occurs in, with all their columns."""
    bad = contaminated_words(docs, benchmark, id_col, text_col, **options).where("size(starts) > 0")
    bad = bad.select(F.col("doc_id").alias("_hz_id"), F.col("th").alias("_hz_th")).distinct()
    th = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_hz_id"]) & (th == bad["_hz_th"]), "left_anti")
