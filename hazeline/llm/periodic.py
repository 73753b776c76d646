"""Periodic runs of words by seeds and diagonals.

A run is a stretch of words with smallest period q (words q apart are identical), of ``least_words`` words or more and
two periods or more, that no neighbouring word extends. On the diagonal of lag q such a run is a stretch of
``max(least_words - q, q)`` equal places at least, so it holds a shared gram of half of ``least_words`` words.

Seeds are pairs of equal grams of one text whose distance lies in a class of lags. For lags below ``2 * k`` every gram of
k words is a seed; for lags from Q to 2Q - 1 the stretch has Q places or more, so grams of Q/2 words at every
Q/2-th word are enough, and the seeds of one stretch touch. That gives at most 2n pairs a class whatever the text,
n log n in all, even where one word fills it. Grams twice as long are named by pairs of names: equality is exact. A table
of the furthest place covered per lag joins seeds of one stretch, and only its two ends are extended, by less than a step
of the seeds, with one comparison for each shorter gram. Of stretches with one extent the smallest lag is the period.

Words are runs of characters other than space, tab and line ends. A null or empty text has no words and no runs; rows
alike in id and text give as many result rows; an empty table gives an empty result. Columns besides id and text are not
read. A text is worked on whole, in memory that is a multiple of its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common

LEAST_WORDS = 12

_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def words_of(text: bytes) -> list[bytes]:
    return text.split()  # of bytes: at space, tab, LF, VT, FF and CR


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal ones alike."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _agreeing(ids: np.ndarray, known: list[tuple[int, np.ndarray]], few: int, i: np.ndarray, j: np.ndarray, room: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words agree from places i and j on (or before them), ``room`` at most.

    They are fewer than twice the longest known gram, or than ``few`` if none is known. Names of grams are compared from the
    longest to the shortest, each once, and then words.
    """
    out, live = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for g, names in [*reversed(known), *[(1, ids)] * (known[0][0] if known else few)]:
        a, b = (i + out, j + out) if ahead else (i - out - g, j - out - g)
        fits = live & (out + g <= room)
        a, b = names[np.where(fits, a, 0)], names[np.where(fits, b, 0)]
        same = fits & (a >= 0) & (a == b)
        out += g * same
        if g == 1:
            live = same
    return out


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys, and whether a key is there more than once."""
    _, names, times = np.unique(keys, return_inverse=True, return_counts=True)
    return names, times[names] > 1


def _stretches(names: np.ndarray, g: int, low: int, high: int, step: int, ids: np.ndarray, shorter: list, first: np.ndarray, end: np.ndarray):
    """Start, end and lag of all equal stretches on diagonals of lags ``low`` to ``high - 1`` that hold a seed.

    ``shorter``: names of all grams shorter than g, for the ends.
    """
    n = len(ids)
    known = np.flatnonzero(names >= 0)
    index = np.sort(names[known] * n + known)
    seeds = known[(known - first[known]) % step == 0]
    till = np.minimum(seeds + high, end[seeds] - g + 1)
    seeds, till = seeds[seeds + low < till], till[seeds + low < till]
    a = np.searchsorted(index, names[seeds] * n + seeds + low)
    b = np.searchsorted(index, names[seeds] * n + till)
    at = np.repeat(seeds, b - a)
    lag = index[common.spread(a, b - a)] % n - at
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    # per lag: a seed no further than the place covered so far goes on with the stretch
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    new = np.append(True, (lag[1:] != lag[:-1]) | (first[at[1:]] != first[at[:-1]]) | (at[1:] > at[:-1] + g))
    start, covered, lag = at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + g, lag[new]
    begin, stop = first[start], end[start]
    ahead = _agreeing(ids, shorter, g, covered, covered + lag, stop - covered - lag, True)
    back = _agreeing(ids, shorter, g, start, start + lag, start - begin, False)
    return start - back, covered + ahead, lag


def find(rows: list[np.ndarray], least_words: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every row of numbered words, by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    k = max(1, -(-least_words // 2))
    sizes = np.array([len(r) for r in rows])
    if not (sizes >= max(2, least_words)).any():
        return out
    # only texts in which a gram of k words comes twice can hold a run
    ids, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    values = common.grams(common.mixed(ids.astype(np.uint64) + common.U64(1)), k)
    values = common.mixed(values ^ common.mixed(owner[: len(values)].astype(np.uint64) + common.U64(7)))
    order = np.argsort(values, kind="stable")
    twin = np.flatnonzero(values[order][1:] == values[order][:-1])
    whole = owner[: len(values)] == owner[k - 1 :]
    twin = twin[whole[order[twin]] & whole[order[twin + 1]]]
    chosen = np.unique(owner[order[twin]])
    if not len(chosen):
        return out
    ids, sizes = np.concatenate([rows[r] for r in chosen]), sizes[chosen]
    bounds = np.append(0, np.cumsum(sizes))
    n, first, end = len(ids), np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    at = np.arange(n)
    names = ids.copy()
    for more in range(1, k):  # names of grams of k words, word by word
        keep = at[: n - more][(names[: n - more] >= 0) & (at[: n - more] + more < end[: n - more])]
        fresh, again = _named(names[keep] * n + ids[keep + more])
        names = np.full(n, -1)
        names[keep[again]] = fresh[again]
    found = [_stretches(names, k, 1, 2 * k, 1, ids, [], first, end)]
    g, known = k, []
    while 4 * g <= sizes.max() and (names >= 0).any():  # lags from 2g on, 2g words or more on the diagonal
        found.append(_stretches(names, g, 2 * g, 4 * g, g, ids, known, first, end))
        known.append((g, names.astype(np.int32)))
        keep = np.flatnonzero(names[: n - g] >= 0)
        keep = keep[(keep + 2 * g <= end[keep]) & (names[keep + g] >= 0)]
        fresh, again = _named(names[keep] * n + names[keep + g])
        names = np.full(n, -1)
        names[keep[again]] = fresh[again]
        g *= 2
    start, stop, lag = (np.concatenate(x) for x in zip(*found, strict=True))
    stop = stop + lag
    long = stop - start >= np.maximum(least_words, 2 * lag)
    start, stop, lag = start[long], stop[long], lag[long]
    order = np.lexsort((lag, stop, start))
    start, stop, lag = start[order], stop[order], lag[order]
    one = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))[: len(start)]
    start, stop, lag = start[one], stop[one], lag[one]
    order = np.lexsort((lag, start))
    for s, e, q in zip(start[order].tolist(), stop[order].tolist(), lag[order].tolist(), strict=True):
        row = int(np.searchsorted(bounds, s, "right")) - 1
        out[chosen[row]].append((s - int(bounds[row]), e - s, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _scan(least_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            words = [words_of(t.as_buffer().to_pybytes()) for t in batch.column("text").cast(pa.large_binary())]
            runs = find([numbered(w) for w in words], least_words)
            kept = [b" ".join(collapsed(w, r)).decode() for w, r in zip(words, runs, strict=True)]
            told = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(told, _ARROW_RUNS),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "th", "n_words", "runs", "collapsed"],
            )

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Per row: ``doc_id, th, n_words, runs`` (start, length and period in words, by start and then period) and ``collapsed``,
    the words joined by one space without what a run repeats after its first period."""
    if least_words < 2:
        raise ValueError("a run has two words at least")
    source = common.keyed(docs, id_col, text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType),
            T.StructField("th", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return source.mapInArrow(_scan(least_words), schema)


def report(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    told = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), told.alias("told")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2("told", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
