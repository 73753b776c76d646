"""Packing of tokenized documents into sequences by multiway differencing.

Documents are tokenized with an end token each and cut: full sequences first, and what is left into pieces of
at most ``piece_tokens``. Pieces are dealt out in batches of bounded size. In each batch the Karmarkar-Karp
method differences pieces into windows: partial partitions, one sum per window each, are merged two at a time,
the largest sums of one with the smallest of the other, those with the widest spread first. The windows end up
near-equal; when one exceeds the capacity, the number of windows rises and the batch is differenced again.

A null text is an empty one: its end token still is a piece. Rows alike in id and text are packed one by one. A
text of any size is tokenized whole. Columns besides id and text are not read; an empty table gives an empty
result. Special-token strings inside a text are read as the tokenizer file reads them.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common

CAPACITY = 4096
END_ID = 2
PIECE_TOKENS = 1024
#: Pieces that are differenced together.
BATCH_PIECES = 1024
#: Bytes of units and their ids that a worker remembers between tasks.
CACHE_BYTES = 32 << 20
#: Bytes of units that ask the tokenizer for their ids together.
ASK_BYTES = 4096
#: Bytes of text whose units are looked up together.
STRETCH_BYTES = 8 << 20

# fixed values: kinds of bytes. Letters, digits and signs are those the tokenizer takes apart in any case; a word with
# any other byte is left to it whole: an apostrophe, "|" of its special strings, characters beyond Latin letters.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[9:14] = _KIND[32] = _SPACE
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[0xC3] = _LETTER
_KIND[[39, 124]] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Second bytes after 0xC3: which are letters, and their lower case.
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_SECOND_LOWER = np.arange(256, dtype=np.uint8)
_SECOND_LOWER[0x80:0x9F] += 32
_LETTERS_ONLY = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_KNOWN: dict[str, _Tokenizer] = {}


class _Tokenizer:
    """The tokenizer, its merges alone, which ids end a word, and the ids of units a worker has met so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.whole.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[k for token, k in vocab.items() if token.endswith("</w>")]] = True
        self.units = self.ids = pa.array([], pa.large_binary())

    def ids_of(self, units: pa.Array) -> pa.Array:
        """Ids of distinct units as little-endian bytes."""
        if self.units.nbytes + self.ids.nbytes > CACHE_BYTES:
            self.units = self.ids = pa.array([], pa.large_binary())
        at = np.array(pc.fill_null(pc.index_in(units, value_set=self.units), -1))
        new = at < 0
        if new.any():
            at[new] = len(self.units) + np.arange(new.sum())
            units = units.filter(pa.array(new))
            self.ids = pa.concat_arrays([self.ids, self._learned(units.to_pylist())])
            self.units = pa.concat_arrays([self.units, units])
        return self.ids.take(pa.array(at))

    def _learned(self, units: list[bytes]) -> pa.Array:
        """What is asked together is joined by spaces, which no token crosses; plain letters go to the merges directly."""
        plain = np.array([u.isalpha() or _LETTERS_ONLY.fullmatch(u) is not None for u in units], bool)
        found = []
        asked = list(_asked(list(compress(units, plain))))
        for low in range(0, len(asked), 32):
            texts = [charmap_decode(b" ".join(some), "strict", _LETTERS)[0] for some in asked[low : low + 32]]
            for encoding in self.merges.encode_batch_fast(texts, add_special_tokens=False):
                ids = np.array(encoding.ids, "<u4")
                found.append(_binary(ids.view(np.uint8), 4 * np.flatnonzero(self.last[ids]) + 4))
        for some in _asked(list(compress(units, ~plain))):
            texts = [u.decode() for u in some]
            encoding = self.whole.encode(" ".join(texts), add_special_tokens=False)
            begin = np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 0]
            ends = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
            found.append(_binary(np.array(encoding.ids, "<u4").view(np.uint8), 4 * ends))
        order = np.argsort(~plain, kind="stable")
        return pa.concat_arrays(found).take(pa.array(np.argsort(order)))


def _tokenizer(path: str) -> _Tokenizer:
    if path not in _KNOWN:
        _KNOWN[path] = _Tokenizer(path)
    return _KNOWN[path]


def _asked(units: list[bytes]) -> Iterator[list[bytes]]:
    """The units in runs of about ``ASK_BYTES``, one at least."""
    ends = np.cumsum([len(u) + 1 for u in units], dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // ASK_BYTES, append=-1)) + 1
    for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
        yield units[low:high]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values that lie one behind the other."""
    bounds = np.append(0, ends).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _byte_letters() -> str:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next one from 256 on.

    The space, which parts words here, stays.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return "".join(chr(b if b in plain or b == 32 else 256 + rest.index(b)) for b in range(256))


_LETTERS = _byte_letters()


def _units(data: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """What the tokenizer takes apart before any merge, and the number of the first unit of each of ``rows``.

    Runs of letters, lowered, single digits and runs of signs; words with odd bytes as they stand.
    """
    kind, low = _KIND[data], _LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[_SECOND[data[second]]]
    kind[second] = _LETTER
    low[second] = _SECOND_LOWER[data[second]]
    inside = kind != _SPACE
    word = np.ones(len(data), bool)
    word[1:] = ~inside[:-1]
    word[rows[rows < len(data)]] = True
    rows = np.append(0, np.cumsum(inside, dtype=np.int32))[rows]
    kind, low, word = kind[inside], low[inside], word[inside]
    start = kind == _DIGIT
    start[1:] |= kind[1:] != kind[:-1]
    start |= word
    odd = np.flatnonzero(kind == _ODD)
    if len(odd):
        begins = np.append(np.flatnonzero(word), len(kind))
        found = np.unique(np.searchsorted(begins, odd, side="right") - 1)
        at = common.spread(begins[found], begins[found + 1] - begins[found])
        start[at], low[at] = False, data[inside][at]
        start[begins[found]] = True
    at = np.flatnonzero(start)
    return _binary(low, np.append(at[1:], len(low))[: len(at)]), np.searchsorted(at, rows)


def _stretches(data: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``limit`` bytes that end with a row or before white space."""
    first = 0
    while first < len(data):
        at, last = first + limit, None
        while last is None:
            row = int(bounds[min(np.searchsorted(bounds, at), len(bounds) - 1)])
            spaces = np.flatnonzero(_KIND[data[at : at + limit]] == _SPACE)
            if len(spaces):
                last = min(row, at + int(spaces[0]))
            elif row <= at + limit:
                last = row
            at += limit
        yield first, last
        first = last


def token_ids(texts: pa.Array, path: str, limit: int = STRETCH_BYTES) -> Iterator[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit values; worked on in stretches of ``limit`` bytes."""
    tokenizer = _tokenizer(path)
    data, bounds = common.text_bytes(texts)
    places, found, total = np.zeros(len(bounds), np.int64), [], 0
    for first, last in _stretches(data, bounds, limit):
        low, high = np.searchsorted(bounds, [first, last])
        if last == len(data):
            high = len(bounds)
        units, rows = _units(data[first:last], bounds[low:high] - first)
        coded = units.dictionary_encode()
        ids = tokenizer.ids_of(coded.dictionary).take(coded.indices)
        held, starts = common.text_bytes(ids)
        places[low:high] = total + starts[rows]
        total += len(held)
        found.append(held.tobytes())
    whole = b"".join(found)
    for k in range(len(texts)):
        yield whole[places[k] : places[k + 1]]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text of a list."""
    return list(token_ids(pa.array(texts, pa.string()), path))


def _cut(path: str, capacity: int, piece_tokens: int, end_id: int, with_ids: bool) -> Callable:
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=STRETCH_BYTES):
            row, start, length, crc, total, kept = [], [], [], [], [], []
            for k, ids in enumerate(token_ids(batch.column("text"), path)):
                ids += end
                n, at = len(ids) // 4, 0
                while at < n:
                    size = capacity if n - at >= capacity else min(piece_tokens, n - at)
                    part = ids[4 * at : 4 * (at + size)]
                    row.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    kept.append(part if with_ids else None)
                    at += size
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return run


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Items of each of ``windows`` windows, by the Karmarkar-Karp method for many windows.

    A partial partition is its sums less the smallest, in falling order, with the items behind every sum.
    Zero sums at the end are left out.
    """
    heap = [(-s, k, [s], [[k]]) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        # the largest sums of a meet the smallest of b, which are zeros beyond its end
        gap = windows - len(b)
        pairs = [(s, x) for s, x in zip(a[:gap], a_items[:gap], strict=True)]
        rest, rest_items = a[gap:], a_items[gap:]
        free = gap - len(a)
        for k in range(len(b)):
            j = len(b) - 1 - k  # smallest of b first
            if free < 0 and k < -free:
                pairs.append((rest[k] + b[j], rest_items[k] + b_items[j]))
            else:
                pairs.append((b[j], b_items[j]))
        pairs.sort(key=lambda p: -p[0])
        if len(pairs) == windows:
            least = pairs[-1][0]
            # sums are kept as they are; only their spread orders the merging
            spread = pairs[0][0] - least
        else:
            least, spread = 0, pairs[0][0]
        number += 1
        heapq.heappush(heap, (-spread, number, [p[0] for p in pairs], [p[1] for p in pairs]))
    return heap[0][3] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of near-equal size, none above the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differenced(sizes, windows)
        worst = max((sum(sizes[k] for k in w) for w in found), default=0)
        if worst <= capacity:
            return found
        # near-equal windows: all have about the mean and the worst tells by how much it is missed
        windows += 1


def _pack(capacity: int, batch_pieces: int) -> Callable:
    """Sequence and offset of every piece; batches of pieces in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        held, count = [], 0

        def flush():
            nonlocal sequence, held, count
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table.column("length").to_pylist()
            ids, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for window in windows_of(lengths, capacity):
                at = 0
                for k in window:
                    ids[k], offsets[k] = sequence, at
                    at += lengths[k]
                sequence += 1
            held, count = [], 0
            table = table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))
            yield from table.to_batches()

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, batch_pieces - count)
                held.append(part)
                count += part.num_rows
                at += part.num_rows
                if count == batch_pieces:
                    yield from flush()
        if held:
            yield from flush()

    return run


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    piece_tokens: int = PIECE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, ids``: the cut documents; ``ids`` as bytes if asked for."""
    source = common.keyed(docs, id_col, text_col)
    schema = T.StructType(
        [source.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")), T.StructField("ids", T.BinaryType())]
    )
    return source.mapInArrow(_cut(tokenizer_path, capacity, piece_tokens, end_id, with_ids), schema)


def packed(cut: DataFrame, capacity: int = CAPACITY, batch_pieces: int = BATCH_PIECES) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``.

    The pieces are stored and dealt out evenly, whatever their ids, so a task holds one batch at a time. A
    full piece is a sequence of its own.
    """
    rows = common.stored(cut, "pieces")
    full = rows.where(F.col("length") == capacity)
    schema = T.StructType([*rows.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    rest = rows.where(F.col("length") < capacity)
    dealt = rest.repartition(max(1, -(-rest.count() // (batch_pieces * 16))))
    mixed = dealt.mapInArrow(_pack(capacity, batch_pieces), schema)
    own = full.withColumns({"sequence_id": F.monotonically_increasing_id() + F.lit(1 << 62), "offset": F.lit(0).cast("long")})
    return mixed.unionByName(own)


def sequences(placed: DataFrame, with_ids: bool = True) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the sequences themselves, at most ``capacity`` tokens each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), *([joined.alias("ids")] if with_ids else []))
