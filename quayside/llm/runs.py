"""Periodic runs of words: maximal stretches that repeat with a period of at most half their length.

The first phase of Baier's suffix sorter groups positions by the longest Lyndon word that starts there, so its groups give
the Lyndon array at once; it runs under the order of the word codes and under the reversed order. Every run holds a Lyndon
root that one of the two arrays names. Each root is extended to both sides by longest common extensions, taken exactly
from ranks of stretches of 1, 2, 4, ... words, and is a run if it comes to two periods.

A run of ``least`` words repeats at least half of them at a distance of its period, so words outside every repeated
stretch of that width belong to no run. They are left out first; what remains falls into regions, each holding its runs
whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import as_bytes, query, ship, table, text_slices
from quayside.llm.words import chain, mix

#: Words in the shortest run that counts.
LEAST = 12


def lyndon_array(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position, by Baier's grouping.

    Groups stand in a chain from low to high and start as one group per code. The highest group left is final: its
    positions are taken out, and each points to the nearest position left of it that is still in, which is in a lower
    group. A position that gets ``times`` pointers grows by as many copies of the group's word: with its like it moves to
    a new group just above its old one.
    """
    n = len(codes)
    names = {c: g for g, c in enumerate(sorted(set(codes)))}
    group = [names[c] for c in codes]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(names)
    below = list(range(-1, len(names) - 1))
    above = [*range(1, len(names)), -1]
    left = list(range(n + 1))  # left[i + 1] leads to the nearest position up to i that is still in, plus one
    out = [0] * n
    g = len(names) - 1
    while g >= 0:
        live = [i for i in members[g] if group[i] == g]
        size = length[g]
        for i in live:
            out[i] = size
            left[i + 1] = i
        seen: dict[int, int] = {}
        for i in live:
            j = i
            while left[j] != j:
                left[j] = j = left[left[j]]
            if j:
                seen[j - 1] = seen.get(j - 1, 0) + 1
        fresh: dict[tuple[int, int], int] = {}
        grown = seen.items() if len(seen) < 2 else sorted(seen.items(), key=lambda x: -x[1])
        for j, times in grown:
            old = group[j]
            new = fresh.get((old, times))
            if new is None:
                new = fresh[old, times] = len(length)
                length.append(length[old] + times * size)
                members.append([])
                below.append(old)
                above.append(above[old])
                if above[old] >= 0:
                    below[above[old]] = new
                above[old] = new
            group[j] = new
            members[new].append(j)
        g = below[g]
    return out


class Extensions:
    """Exact longest common extensions: ranks of all stretches of 1, 2, 4, ... codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.ranks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
        width = 1
        while 2 * width <= len(codes):
            last = self.ranks[-1]
            pairs = last[: len(last) - width] * (len(codes) + 1) + last[width:]
            self.ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal codes from ``a`` and from ``b`` (a < b) on."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks = self.ranks[k]
            fits = b + far < len(ranks)
            at, other = np.where(fits, a + far, 0), np.where(fits, b + far, 0)
            far += (fits & (ranks[at] == ranks[other])).astype(np.int64) << k
        return far

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal codes before ``a`` and before ``b`` (a < b)."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, width = self.ranks[k], 1 << k
            fits = a - far >= width
            at, other = np.where(fits, a - far - width, 0), np.where(fits, b - far - width, 0)
            far += (fits & (ranks[at] == ranks[other])).astype(np.int64) << k
        return far


def runs_of(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``least`` codes and two periods, by start, then period."""
    if len(codes) < max(2, least):
        return np.zeros((0, 3), np.int64)
    extend, found = Extensions(codes), []
    ranked = extend.ranks[0]
    for order in (ranked, -ranked):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.flatnonzero(np.arange(len(codes)) + period < len(codes))
        period = period[at]
        before = extend.left(at, at + period)
        length = period + before + extend.right(at, at + period)
        good = (length >= 2 * period) & (length >= least)
        found.append(np.stack([at - before, length, period], 1)[good])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def regions(codes: np.ndarray, cuts: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int]]]:
    """For each text (its codes lie between neighbouring ``cuts``) the stretches that may hold runs.

    A stretch is made of words in some run of ``least // 2`` words that its text holds twice. Hashes tell equal runs; an
    equal hash of unequal runs only adds words.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in cuts[1:]]
    width = max(1, least // 2)
    grams = chain(mix(codes.astype(np.uint64)), width)
    if not len(grams):
        return out
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    inside = np.flatnonzero(text[: len(grams)] == text[width - 1 :])
    keys = mix(grams[inside] ^ mix(text[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(order) + 1, np.int64)
    again[:-2] += same
    again[1:-1] += same
    starts = inside[order[again[:-1] > 0]]
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    covered = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    covered_text = np.concatenate([[-1], np.where(covered[1:-1], text, -1), [-1]])
    edge = np.flatnonzero(covered_text[1:] != covered_text[:-1])
    for a, b in zip(edge, edge[1:], strict=False):
        if covered[a + 1] and b - a >= least:
            t = int(text[a])
            out[t].append((int(a - cuts[t]), int(b - cuts[t])))
    return out


def text_runs(sequences: list[np.ndarray], least: int = LEAST) -> Iterator[np.ndarray]:
    """Runs of each sequence of codes."""
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
    whole = np.concatenate([*sequences, np.zeros(0, np.int64)])
    for codes, parts in zip(sequences, regions(whole, cuts, least), strict=True):
        found = [runs_of(codes[a:b], least) + np.array([a, 0, 0]) for a, b in parts]
        yield np.concatenate([np.zeros((0, 3), np.int64), *found])


def repeat_tail(n: int, key: bytes) -> np.ndarray | None:
    """For one key in ten, which word stands at each place once the words from a place on repeat with a period."""
    h = zlib.crc32(key)
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % period
    return at


def digest(words: list[bytes], runs: np.ndarray) -> dict:
    """What a query returns of a text: the longest run, and digests of all runs and of the words that repeat nothing."""
    kept = np.ones(len(words) + 1, np.int64)
    lines = []
    for start, length, period in runs.tolist():
        lines.append(f"{start},{length},{period}\n")
    if len(runs):
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(drop) == 0
        words = [w for w, keep in zip(words, kept.tolist(), strict=False) if keep]
    start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist() if len(runs) else (None,) * 3
    return {
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": 1000 * length // period if len(runs) else None,
        "runs_sha256": hashlib.sha256("".join(lines).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(words)).hexdigest(),
    }


def _word_runs(batch: pa.RecordBatch, least: int, planted: bool) -> Iterator[tuple[object, list[bytes], np.ndarray]]:
    """Key, words and runs of each row. Codes stand for words exactly, not by hash."""
    keys, codes, number = batch.column("key").to_pylist(), {}, count()
    texts, sequences = [], []
    for key, raw in zip(keys, as_bytes(batch.column("text")), strict=True):
        words = raw.split()
        sequence = np.fromiter(map(codes.setdefault, words, number), np.int64, len(words))
        at = repeat_tail(len(words), b"" if key is None else str(key).encode()) if planted else None
        if at is not None:
            sequence, words = sequence[at], [words[i] for i in at.tolist()]
        texts.append(words)
        sequences.append(sequence)
    yield from zip(keys, texts, text_runs(sequences, least), strict=True)


def _over(docs: DataFrame, rows, schema: str, key: str, text: str, least: int, planted: bool) -> DataFrame:
    ship(docs.sparkSession)
    two = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in text_slices(batches):
            out = [row for one in _word_runs(batch, least, planted) for row in rows(*one)]
            if out:
                target = target or pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])
                yield pa.RecordBatch.from_pylist(out, schema=target)

    kinds = {"long": pa.int64(), "string": pa.string()}
    return two.mapInArrow(run, schema)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per run: ``key``, ``start``, ``length``, ``period`` (words, from 0), for runs of at least ``least`` words.

    Words end at ASCII white space and are compared as they are. Null, empty and blank texts have no runs; an empty table
    gives no rows; rows that repeat a key are worked out one by one; other columns are not read. A text is worked on whole
    in one task, in memory of about 16 bytes a word and doubling for its repeated regions. ``key`` is an integer column.
    """
    rows = lambda k, words, runs: [{"key": k, "start": s, "length": n, "period": p} for s, n, p in runs.tolist()]
    return _over(docs, rows, "key long, start long, length long, period long", key, text, least, False)


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key`` and ``text`` without the words that a run repeats after its first period, joined by single spaces; rules as
    for ``find_runs``; a null text becomes empty."""

    def rows(k, words, runs):
        for start, length, period in runs.tolist():
            words[start + period : start + length] = [None] * (length - period)
        return [{"key": k, "text": b" ".join(w for w in words if w is not None).decode()}]

    return _over(docs, rows, "key long, text string", key, text, least, False)


def run_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, planted: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_runs``, the longest run (ties: first start, then period; nulls without a run),
    ``exponent_milli``, ``runs_sha256`` and ``collapsed_sha256``. With ``planted``, one key in ten gets a repeated tail first
    (``repeat_tail``; a null key counts as the empty text). Rules as for ``find_runs``."""
    longs = ", ".join(f"{c} long" for c in ("n_runs", "start", "length", "period", "exponent_milli"))
    rows = lambda k, words, runs: [{"doc_id": k, **digest(words, runs)}]
    return _over(docs, rows, f"doc_id long, {longs}, runs_sha256 string, collapsed_sha256 string", key, text, least, planted)


@query("op13_word_runs")
def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole document, after the planted repeats."""
    return run_digests(table(spark, sf_dir, "documents"), planted=True)

