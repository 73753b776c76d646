"""Removal of long repeated strings with a run-length index.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else in the corpus, in the
same text or another; matches never cross texts, and strings are judged on the input.

1. *Pieces.* Every window of ``length`` bytes belongs to the smallest hash of the ``seed``-byte strings inside
   it. A maximal run of windows with one smallest hash (at most ``length - seed + 1`` of them) is a piece:
   each window is in exactly one piece, and equal windows are in pieces with equal hashes wherever they
   stand. Only (hash, digest of the piece, place) is shuffled.
2. Pieces whose hash occurs once hold no repeated window. Pieces that occur whole again are repeated from end
   to end; one of them stands for all from here on. Both are found by counts with partial sums.
3. *Run-length index.* What is left are different pieces with one hash: repetitive text by construction.
   Groups of them form an index of bounded size: a Burrows-Wheeler transform kept as runs, with the text
   places of the first and last suffix of each run. Matching statistics are streamed over the text: the
   longest match of a suffix is compared against its neighbours only at run ends, elsewhere it is one less
   than that of the suffix before it. Windows with a match of ``length`` or more are repeated.
4. A hash with more than ``most`` different pieces (a line in a third of all texts) is split: its pieces are cut
   again by a longer seed, and at last by the whole window, where a count decides. Nothing is dropped.

A null or empty text, or one below ``length`` bytes, has nothing to remove. Rows alike in id and text are
copies of each other like any two rows. Columns besides id and text are not read; an empty table gives an
empty result. A text of any size is read in blocks of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common
from hazeline.llm.common import U64

LENGTH = 200
#: Seed lengths of the first cut and of the cut of hot hashes; the last cut is the window itself.
SEED, LONG_SEED = 48, 160
#: Different pieces of one hash that go into an index together.
MOST = 200
MASK = (1 << 64) - 1
#: Bytes of text in one index.
INDEX_BYTES = 1 << 18


def window_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each place on, by doubling; shorter than ``data`` by n-1."""
    base = common._BASE
    if len(data) < n:
        return np.zeros(0, np.uint64)
    part, size = common._BYTE_CODES[data], 1
    total, done = None, 0
    power = base
    step = n
    while True:
        if step & 1:
            if total is None:
                total, done = part.copy(), size
            else:
                keep = len(part) - done
                total = total[:keep] * power + part[done : done + keep]
                done += size
        step >>= 1
        if not step:
            break
        part = part[:-size] * power + part[size:]
        size *= 2
        power = U64(int(power) ** 2 & MASK)
    return common.mixed(total[: len(data) - n + 1])


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of every window of ``width`` values."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size :][: len(values) - width + 1])


def pieces(data: np.ndarray, bounds: np.ndarray, length: int, seed: int):
    """(row, first byte in ``data``, windows, hash, digest, loops) of every piece of the rows.

    ``loops``: the smallest hash stands more than once in the piece, so its own windows may repeat.
    """
    n_windows = np.maximum(np.diff(bounds) - length + 1, 0)
    if not n_windows.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int32))
    hashes = window_hashes(data, seed)
    smallest = least_in(hashes, length - seed + 1)
    at = common.spread(bounds[:-1], n_windows)  # first byte of each window inside a row
    key = smallest[at]
    row_first = np.cumsum(n_windows) - n_windows
    new = np.empty(len(at), bool)
    new[0], new[1:] = True, key[1:] != key[:-1]
    new[row_first[n_windows > 0]] = True
    run = np.flatnonzero(new)
    counts = np.diff(np.append(run, len(at)))
    most = length - seed + 1
    if (counts > most).any():  # periodic text: long runs are cut
        parts = -(-counts // most)
        run = np.repeat(run, parts) + most * common.spread(np.zeros(len(parts), np.int64), parts)
        counts = np.diff(np.append(run, len(at)))
    first = at[run]
    row = np.searchsorted(bounds, first, "right") - 1
    inside = counts + length - seed
    equal = hashes[common.spread(first, inside)] == np.repeat(key[run], inside)
    loops = np.add.reduceat(equal, np.cumsum(inside) - inside, dtype=np.int32) > 1
    return row, first, counts, key[run], digests(data, first, counts + length - 1), loops.astype(np.int32)


def digests(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each string ``data[first : first + size]``, from running sums of windowed products."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common._BYTE_CODES[data] * common.powers(len(data), common._MIX_A))])
    back = common.powers(len(data), U64(pow(int(common._MIX_A), -1, MASK + 1)))
    value = (sums[first + sizes] - sums[first]) * back[first]  # the exponent of the first byte is taken out
    return common.mixed(value + sizes.astype(np.uint64) * common._MIX_B)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``text`` holds a different separator after every string."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, size = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-size] = rank[size:] + 1
        pair = rank * (n + 2) + after
        order = np.argsort(pair)  # equal pairs get equal ranks, in whatever order they come
        step = np.append(0, pair[order][1:] != pair[order][:-1])
        fresh = np.cumsum(step)
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        size *= 2


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a set of strings, with sampled run ends."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        """``data``: the strings one after the other; ``starts``: where each begins, and the end."""
        sizes = np.diff(starts)
        self.starts = starts[:-1] + np.arange(len(sizes))  # with a separator after every string
        self.text = np.empty(len(data) + len(sizes), np.int64)
        separator = np.cumsum(sizes + 1) - 1
        is_text = np.ones(len(self.text), bool)
        is_text[separator] = False
        self.text[is_text] = data.astype(np.int64) + len(sizes)
        self.text[separator] = np.arange(len(sizes))
        order = suffix_order(self.text)
        before = np.where(order > 0, self.text[order - 1], -1)
        head = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (before[1:] < len(sizes))))
        tail = np.append(head[1:] - 1, len(order) - 1)
        #: one entry per run: its symbol, its length, and the text places of its first and last suffix
        self.symbol, self.runs = before[head], tail - head + 1
        self.first_place, self.last_place = order[head], order[tail]
        # the neighbours outside the run of both run ends
        self.above = np.append(-1, self.last_place[:-1])
        self.below = np.append(self.first_place[1:], -1)

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b; 0 where a or b is -1."""
        size = np.zeros(len(a), np.int64)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        while len(live):
            x, y = a[live] + size[live], b[live] + size[live]
            inside = np.maximum(x, y) < len(self.text)
            live, x, y = live[inside], x[inside], y[inside]
            live = live[self.text[x] == self.text[y]]  # separators differ from each other
            size[live] += 1
        return size

    def matching_statistics(self) -> np.ndarray:
        """Longest match elsewhere of the suffix at every place of the text.

        At a run end the outer neighbour is compared, as is the inner one where the run is longer; a place
        inside a run has a match one shorter than the place before it.
        """
        best = np.zeros(len(self.text), np.int64)
        np.maximum.at(best, self.first_place, self.common_prefix(self.first_place, self.above))
        np.maximum.at(best, self.last_place, self.common_prefix(self.last_place, self.below))
        place = np.arange(len(best))
        return np.maximum(np.maximum.accumulate(best + place) - place, 0)


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every window of ``length`` bytes that stands elsewhere in the strings too."""
    index = RunIndex(data, starts)
    place = np.flatnonzero(index.matching_statistics() >= length)
    string = np.searchsorted(index.starts, place, "right") - 1
    return string, place - index.starts[string]


def _strings(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The strings ``data[first : first + size]`` as a binary column."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    joined = data[common.spread(first, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])


def _cut(length: int, seed: int, block: int = common.CHUNK_BYTES) -> Callable:
    """Pieces of documents. A text beyond ``block`` bytes is read in blocks of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            data, bounds = common.text_bytes(batch.column("text"))
            for low in range(0, max(len(data), 1), block) if batch.num_rows == 1 else (0,):
                part = data[low : low + block + length - 1] if batch.num_rows == 1 else data
                edges = np.array([0, len(part)]) if batch.num_rows == 1 else bounds
                row, first, counts, key, digest, loops = pieces(part, edges, length, seed)
                if len(row):
                    rows = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(rows),
                            batch.column("th").take(rows),
                            pa.array((first - edges[row] + low).astype(np.int64)),
                            pa.array(counts.astype(np.int32)),
                            pa.array(key.view(np.int64)),
                            pa.array(digest.view(np.int64)),
                            pa.array(loops),
                        ],
                        ["doc_id", "th", "start", "windows", "seed", "digest", "loops"],
                    )

    return run


def _recut(length: int, seed: int) -> Callable:
    """Pieces of pieces, by a longer seed; the bytes travel along unless each piece is a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "bytes"):
            data, bounds = common.text_bytes(batch.column("bytes"))
            row, first, counts, key, digest, loops = pieces(data, bounds, length, seed)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("th").take(rows),
                    pa.array(batch.column("start").to_numpy()[row] + first - bounds[row]),
                    pa.array(counts.astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(digest.view(np.int64)),
                    pa.array(loops),
                    batch.column("again").take(rows),
                    pa.nulls(len(row), pa.binary()) if seed == length else _strings(data, first, counts + length - 1),
                ],
                ["doc_id", "th", "start", "windows", "seed", "digest", "loops", "again", "bytes"],
            )

    return run


def _indexed(length: int, index_bytes: int) -> Callable:
    """Spans of repeated windows in pieces, which come sorted by seed; whole seeds go into one index."""

    def flush(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        data, starts = common.text_bytes(table.column("bytes"))
        string, offset = repeated_windows(data, starts, length)
        head = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1))[: len(string)])
        tail = np.append(head[1:], len(string))[: len(head)] - 1
        rows = pa.array(string[head])
        start = table.column("start").to_numpy()[string[head]]
        return pa.RecordBatch.from_arrays(
            [
                table.column("doc_id").take(rows),
                table.column("th").take(rows),
                pa.array(start + offset[head]),
                pa.array(start + offset[tail] + length),
            ],
            ["doc_id", "th", "first", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            seeds = batch.column("seed").to_numpy()
            ends = np.cumsum(np.diff(common.text_bytes(batch.column("bytes"))[1]))
            edge = np.append(np.flatnonzero(seeds[1:] != seeds[:-1]) + 1, len(seeds))
            if last is not None and seeds[0] != last and size >= index_bytes:
                yield flush(held)
                held, size = [], 0
            a, base = 0, 0
            for b in edge:
                if size + ends[b - 1] - base >= index_bytes and b < len(seeds):
                    held.append(batch.slice(a, b - a))
                    yield flush(held)
                    held, size, a, base = [], 0, int(b), int(ends[b - 1])
            held.append(batch.slice(a))
            size += int(ends[-1]) - base
            last = seeds[-1]
        if held:
            yield flush(held)

    return run


def _fetch(length: int) -> Callable:
    """Bytes of the pieces asked for, from the documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            data, bounds = common.text_bytes(batch.column("text"))
            asked = batch.column("asked")
            counts = np.diff(asked.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), counts)
            flat = asked.flatten()
            start, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
            low = bounds[row] + start
            for part in range(0, len(row), 20000):
                few = slice(part, part + 20000)
                rows = pa.array(row[few])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("th").take(rows),
                        pa.array(start[few].astype(np.int64)),
                        pa.array(windows[few].astype(np.int32)),
                        flat.field("seed")[few.start : few.stop],
                        flat.field("digest")[few.start : few.stop],
                        flat.field("loops")[few.start : few.stop],
                        flat.field("again")[few.start : few.stop],
                        _strings(data, low[few], windows[few] + length - 1),
                    ],
                    ["doc_id", "th", "start", "windows", "seed", "digest", "loops", "again", "bytes"],
                )

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most: int = MOST, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """``doc_id, th, first, end``: byte spans made of repeated windows, some of them touching or overlapping."""
    source = common.keyed(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType
    seed = min(SEED, length)
    piece = [
        T.StructField("doc_id", id_type),
        T.StructField("th", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("windows", T.IntegerType()),
        T.StructField("seed", T.LongType()),
        T.StructField("digest", T.LongType()),
        T.StructField("loops", T.IntegerType()),
    ]
    with_bytes = T.StructType([*piece, T.StructField("again", T.BooleanType()), T.StructField("bytes", T.BinaryType())])
    span = T.StructType([*piece[:2], T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])

    cut = source.where(F.octet_length("text") >= length).mapInArrow(_cut(length, seed), T.StructType(piece))
    times = F.count("*") + F.sum("loops")
    # counts are stored before they are joined: both sides of the join are then dealt out alike, and Spark can
    # split the share of a hot seed
    seeds = common.stored(cut.groupBy("seed").agg(times.alias("n")).where("n > 1").select("seed"), "seeds")
    shared = common.stored(cut.join(seeds, "seed", "left_semi"), "pieces")

    def covered(rows: DataFrame) -> DataFrame:
        end = F.col("start") + F.col("windows") + (length - 1)
        return rows.select("doc_id", "th", F.col("start").alias("first"), end.alias("end"))

    def one_of_each(rows: DataFrame, *carried: str) -> DataFrame:
        """One piece for all that are alike, and whether there are more."""
        place = F.struct("doc_id", "th", "start", "windows", "loops", *carried)
        one = rows.groupBy("seed", "digest").agg(F.min(place).alias("p"), F.count("*").alias("n"))
        return one.select("seed", "digest", "p.*", (F.col("n") > 1).alias("twice"))

    distinct = common.stored(one_of_each(shared).withColumnRenamed("twice", "again"), "distinct-pieces")
    copied = distinct.where("again").select("seed", "digest")
    spans = [covered(shared.join(copied, ["seed", "digest"], "left_semi"))]

    # different pieces with one seed: their bytes are asked of the documents
    kinds = common.stored(distinct.groupBy("seed").agg(times.alias("kinds")).where("kinds > 1"), "kinds")
    wanted = distinct.join(kinds.select("seed"), "seed", "left_semi")
    asked = wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("start", "windows", "seed", "digest", "loops", "again")).alias("asked")
    )
    holders = source.alias("s").join(asked.alias("a"), F.expr("s.doc_id <=> a.doc_id AND s.th = a.th"))
    level = common.stored(holders.select("s.doc_id", "s.th", "s.text", "a.asked").mapInArrow(_fetch(length), with_bytes), "piece-bytes")

    for next_seed in (max(seed, min(LONG_SEED, length)), length):
        fit = most if next_seed < length else 4 * most  # pieces of the second cut are shorter
        kinds = common.stored(level.groupBy("seed").agg(times.alias("kinds")).where("kinds > 1"), "kinds")
        cool = level.join(kinds.where(F.col("kinds") <= fit).select("seed"), "seed", "left_semi")
        spans.append(cool.repartition("seed").sortWithinPartitions("seed").mapInArrow(_indexed(length, index_bytes), span))
        # pieces of hot seeds lie in few partitions; they are dealt out evenly before they grow in number
        hot = level.join(kinds.where(F.col("kinds") > fit).select("seed"), "seed", "left_semi").hint("rebalance")
        again = hot.mapInArrow(_recut(length, next_seed), with_bytes)
        if next_seed < length:
            again = common.stored(again, "hot-pieces")
            ones = common.stored(one_of_each(again, "again", "bytes"), "hot-distinct")
            spans.append(covered(again.join(ones.where("twice").select("seed", "digest"), ["seed", "digest"], "left_semi")))
            level = ones.withColumn("again", F.col("again") | F.col("twice")).select(*(f.name for f in with_bytes))
        else:  # every piece is a window now
            windows = common.stored(again.drop("bytes"), "hot-windows")
            twice = windows.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
            spans.append(covered(windows.join(twice, "seed", "left_semi")))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged spans of each row."""
    for batch in batches:
        rows = []
        for spans in batch.column("spans").to_pylist():
            flat = np.array([(s["first"], s["end"]) for s in spans or ()], np.int64).reshape(-1, 2)
            a, b = common.merged(flat[:, 0], flat[:, 1])
            rows.append([{"first": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(rows, kind)], ["doc_id", "th", "spans"])


def merged_spans(spans: DataFrame) -> DataFrame:
    """``doc_id, th, spans``: maximal removed runs per row that loses bytes; a row's spans fit its own text."""
    kind = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([spans.schema["doc_id"], spans.schema["th"], T.StructField("spans", kind)])
    grouped = spans.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    return grouped.mapInArrow(_merge, schema)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        data, bounds = common.text_bytes(batch.column("text"))
        raw = memoryview(np.ascontiguousarray(data))
        gone, count, digest, kept = [], [], [], []
        for row, spans in enumerate(batch.column("spans").to_pylist()):
            low, high = int(bounds[row]), int(bounds[row + 1])
            parts, at = [], low
            for s in spans or ():
                parts.append(raw[at : low + s["first"]])
                at = low + s["end"]
            parts.append(raw[at:high])
            rest = b"".join(parts)
            kept.append(rest)
            gone.append(high - low - len(rest))
            count.append(len(spans or ()))
            digest.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(bounds)),
                pa.array(gone, pa.int64()),
                pa.array(count, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: counts, the bytes that stay (``kept``) and their digest."""
    source = common.keyed(docs, id_col, text_col)
    spans = merged_spans(common.stored(repeated_spans(docs, id_col, text_col, **options), "spans"))
    joined = source.alias("s").join(spans.alias("m"), F.expr("s.doc_id <=> m.doc_id AND s.th = m.th"), "left")
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return joined.select("s.doc_id", "s.text", "m.spans").mapInArrow(_removed, schema)
