"""Sketched near copies, the conversation trie and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from hazeline.llm import periodic, queries, setsketch, trie

DOCS = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("text", "sid", "node", "runs", "th")])
TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("role", "text", "depth", "place", "words", "n")]
)
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def crc(value) -> int:
    return zlib.crc32(str(value).encode())


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s", "n", "r", "t") for i, t in rows], DOCS).repartition(3)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdEé-1") for _ in range(rng.randint(2, 6))) for _ in range(n))


def shingles(text):
    words = SPACE.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def components(rows):
    """Smallest id reachable over links, by brute force; ids are different."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("small", [96, 3])  # the second sends buckets through both ways of large ones
def test_near_copies_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(setsketch, "SMALL", small)
    monkeypatch.setattr(setsketch, "BLOCK", 40 if small == 96 else 4)
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "a b"), (7, "a  b"), (8, "é É"), (9, "é é")]
    n = 10
    for length in (4, 12, 40, 90, 300):
        for _ in range(3):
            base = sentence(rng, length).split()
            for _ in range(12):
                words = list(base)
                for _ in range(rng.randint(0, max(1, length // 14))):
                    words[rng.randrange(length)] = sentence(rng, 1)
                rows.append((n, " ".join(words)))
                n += 1
    chain = sentence(rng, 200).split()
    for k in range(30):  # neighbours are linked, the ends are not
        rows.append((n + k, " ".join(chain[k * 4 :])))
    got = {r["doc_id"]: (r["set_size"], r["component_id"], r["kept"]) for r in setsketch.near_copies(documents(spark, rows)).collect()}
    assert got == components(rows)


def test_near_copies_of_awkward_rows(spark):
    text = "the same words over and over until nobody listens any more"
    rows = [(7, text)] * 3000 + [(9, text), (None, text), (None, ""), (None, None), (3, "long " * 300_000)]
    got = sorted(((r["doc_id"], r["set_size"], r["component_id"], r["kept"]) for r in setsketch.near_copies(documents(spark, rows)).collect()), key=str)
    want = [(7, 9, 7, True)] * 3000 + [(9, 9, 7, False), (None, 9, 7, False), (None, 0, None, True), (None, 0, None, True), (3, 1, 3, True)]
    assert got == sorted(want, key=str)
    assert setsketch.near_copies(documents(spark, [])).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, 3000, dtype=np.uint64), rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    both = np.concatenate([a[600:], b])
    x, y = setsketch.registers(a), setsketch.registers(both)
    assert (setsketch.merged(x, y) == setsketch.registers(np.concatenate([a, b]))).all()
    size = np.array([3000])
    found = setsketch.estimated(size, size, np.array([(x > y).sum()]), np.array([(x < y).sum()]))
    assert abs(found[0] - 2400 / 3600) < 0.15


def brute_trie(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [v[2:] for v in sorted(turns)] for c, turns in convs.items()}
    made = {}
    for c, turns in convs.items():
        h = crc(c) % 4
        made[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        below = [v for v in members if v[: len(node)] == node]
        kids = [v for v in below if len(v) == len(node) + 1]
        leaves = [v for v in below if not any(w[: len(v)] == v and len(w) > len(v) for w in below)]
        saved = sum((len(members[v]) - 1) * len(SPACE.findall(v[-1][1])) for v in below if v)
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(made[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(inside), len(node), parent, len(inside), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie_equals_brute_force(spark):
    rng = random.Random(12)
    rows = [(None, 1, "user", "nobody"), (None, None, None, None), (500, None, None, None), (500, None, None, None), (500, 1, "user", "a  b\tc")]
    for c in range(130):
        if c in (40, 63):
            continue
        for t in range(rng.choice([1, 2, 3, 4, 7])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi there", "yes", "", None, "a b c"])))
    rows += [(5000 + 20 * k, t, "user", f"same {t}") for k in range(60) for t in range(5)]  # many of one kind
    rows += [(9000, t, "user", "long talk") for t in range(1500)] + [(9001, t, "user", "long talk") for t in range(1200)]
    frame = spark.createDataFrame([(*r, "d", "p", "w", "n") for r in rows], TURNS).repartition(5)
    got = trie.prefix_trie(*trie.rebuilt(trie.placed(frame)))
    short = [r for r in rows if r[0] is None or r[0] < 9000]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert len([r for r in found if r[0] >= 9000]) >= 1200
    again = trie.prefix_trie(*trie.rebuilt(trie.placed(frame.where("conv_id IS NULL OR conv_id < 9000"))))
    assert sorted((tuple(r) for r in again.collect()), key=str) == sorted(brute_trie(short), key=str)
    assert trie.prefix_trie(*trie.rebuilt(trie.placed(frame.limit(0)))).count() == 0


def brute_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def test_runs_equal_brute_force():
    rng = random.Random(13)
    for _ in range(400):
        some = "ab"[: rng.randint(1, 2)] + "cdefgh"[: rng.choice([0, 0, 1, 6])]
        parts = [[rng.choice(some) for _ in range(rng.randint(1, 9))] * rng.randint(1, 9) for _ in range(rng.randint(1, 6))]
        words = [w.encode() for p in parts for w in p]
        assert periodic.find([periodic.numbered(words), periodic.numbered(words[1:])]) == [brute_runs(words), brute_runs(words[1:])]


def test_run_query_equals_brute_force(spark, monkeypatch):
    rng = random.Random(14)
    rows = [(None, "a b " * 20), (None, None), (None, ""), (1, None), (2, " \n"), (3, "a  b\n" * 9), (3, "a  b\n" * 9), (4, "x")]
    rows += [(k, sentence(rng, rng.choice([0, 1, 5, 30, 200]))) for k in range(5, 150)]
    docs = documents(spark, rows)
    want = []
    for i, text in rows:
        words, h = SPACE.findall(text or ""), crc(i)
        n, g = len(words), h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        gone = {w for s, m, q in runs for w in range(s + q, s + m)}
        told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (told, kept)]
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha))
    found = periodic.report(periodic.find_runs(queries.with_planted_runs(docs)))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert periodic.find_runs(documents(spark, [])).count() == 0


def test_long_runs_stay_cheap():
    words = [b"0"] * 300_000 + [str(k).encode() for k in range(1, 300_000)]
    assert periodic.find([periodic.numbered(words)]) == [[(0, 300_000, 1)]]
