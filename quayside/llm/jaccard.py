"""Exact similarity join of documents on sets of word shingles, by skipping over set relations.

1. Documents with the same set become one class; the class stands for them from then on.
2. Shingles are ordered rare ones first, judged by two tables of fixed size over all documents: how often a shingle's
   hash slot occurs (shingles of passages that many documents share go last) and how often those of its words do. Any
   order is exact: of two sets with a Jaccard similarity of at least ``t``, the first ``|x| - ceil(t |x|) + 1`` shingles
   share one. Each class is listed under this prefix.
3. Lists go to the task of their first member (the leader), so lists of one family meet. A small parity sketch goes with
   each class first: of two sets, as many shingles differ at least as bits of their sketches do. Classes of which no pair
   passes this bound go; it drops no link. The sets of the others are then sent, once per family. Inside, a list is ordered by set size; a set skips the block of too small ones by position, everything already in its
   component, and derives its overlaps from those of a very similar earlier set: they differ by no more than the few
   shingles in which the two sets differ, so most answers follow without looking at the sets.
4. What links is kept as a spanning forest per task, and components are closed over all tasks.
5. Links are counted, not written: a task compares all pairs of its lists, derived as above, and counts a pair only if the
   smallest prefix shingle that both have is one of its own. Counts are weighted by the documents of the other class.

A family with very many members is cut into blocks, and each pair of blocks is a task of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import as_bytes, query, table, text_slices
from quayside.llm.graph import components
from quayside.llm.words import mix, shingle_runs, shingle_sets
from quayside.session import run_dir, stage

#: Slots of each frequency table, in chunks; members of a family before it is cut into blocks; bits of the id filter.
SLOTS, CHUNK, FAMILY, BITS = 1 << 18, 1 << 12, 1024, 1 << 24
#: Classes a task remembers so as not to list copies again.
SEEN = 200_000


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return int(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).view(np.int64)), int(mix(s + np.uint64(0x51ED270B)).sum(dtype=np.uint64).view(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """Parity of the shingles on each of about ``n / 2`` bits (a power of two, 64 to 65,536)."""
    bits = 1 << min(max(6, (max(len(s), 1) // 2).bit_length()), 16)
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def fold(one: bytes, size: int) -> np.ndarray:
    """A sketch as one of ``size`` bytes."""
    out = np.frombuffer(one, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """Two kinds of rows: of each document ``id``, ``n`` (set size), ``a``, ``b`` (signature), ``sketch``; of each task's chunk of the
    frequency tables (shingles, then words) ``chunk``, ``counts`` (compressed)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, SLOTS), np.int64)
        for part in text_slices(batches):
            both = shingle_runs(as_bytes(part.column("text")), width)
            sets = [np.unique(runs) for runs, _ in both]
            for k, seen in enumerate((sets, [words for _, words in both])):
                tables[k] += np.bincount((np.concatenate(seen) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
            signs = [_signature(s) for s in sets]
            n = len(sets)
            yield pa.RecordBatch.from_pydict({
                "id": part.column("id"), "n": pa.array([len(s) for s in sets], pa.int64()), "a": pa.array([s[0] for s in signs], pa.int64()),
                "b": pa.array([s[1] for s in signs], pa.int64()), "sketch": pa.array([sketch(s) for s in sets], pa.binary()), "chunk": pa.nulls(n, pa.int32()), "counts": pa.nulls(n, pa.binary()),
            })
        rows = tables.reshape(-1, CHUNK)
        blank = pa.nulls(len(rows), pa.int64())
        packed = pa.array([zlib.compress(r.astype("<i8").tobytes(), 1) for r in rows], pa.binary())
        yield pa.RecordBatch.from_pydict({"id": blank, "n": blank, "a": blank, "b": blank, "sketch": pa.nulls(len(rows), pa.binary()), "chunk": pa.array(range(len(rows)), pa.int32()), "counts": packed})

    return docs.mapInArrow(run, "id long, n long, a long, b long, sketch binary, chunk int, counts binary")


def frequency_tables(rows: DataFrame) -> np.ndarray:
    """Both tables over all documents, as ranks: for shingles how many doublings above four times the mean their slot
    lies, for words the logarithm of the count in sixteenths. ``2 * SLOTS`` numbers, whatever the input."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), "<i8") for c in part["counts"])
        return pd.DataFrame({"chunk": part["chunk"].iloc[:1], "counts": [total.tobytes()]})

    chunks = rows.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary")
    tables = np.zeros((2 * SLOTS // CHUNK, CHUNK), np.int64)
    for chunk, counts in chunks.collect():
        tables[chunk] = np.frombuffer(counts, "<i8")
    shingles, words = tables.reshape(2, SLOTS)
    heavy = np.maximum(np.log2(np.maximum(shingles, 1) / max(float(shingles.mean()), 1.0)).astype(np.int32) - 1, 0)
    return np.stack([heavy, (np.log2(1 + words) * 16).astype(np.int32)])


def prefix(runs: np.ndarray, words: np.ndarray, width: int, percent: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set of a text and its prefix."""
    s, first = np.unique(runs, return_index=True)
    rank = ranks[1][(words % np.uint64(SLOTS)).astype(np.int64)]
    rare = sum(rank[first + k] for k in range(min(width, len(words))))
    order = np.lexsort((s, rare, ranks[0][(s % np.uint64(SLOTS)).astype(np.int64)]))
    return s, s[order[: len(s) + (-percent * len(s) // 100) + 1]]


def prefix_lists(docs: DataFrame, width: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """``token``, ``n``, ``a``, ``b`` of each class under its prefix shingles; a task lists a class once."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches) -> Iterator[pa.RecordBatch]:
        ranks, seen = shared.value, set()
        for part in text_slices(batches):
            tokens, sizes, signs = [], [], []
            for runs, words in shingle_runs(as_bytes(part.column("text")), width):
                if not len(runs):
                    continue
                s, rare = prefix(runs, words, width, percent, ranks)
                sign = _signature(s)
                if sign in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sign)
                tokens.append(rare.view(np.int64))
                sizes.append(np.full(len(rare), len(s)))
                signs.append(np.tile(np.array(sign, np.int64), (len(rare), 1)))
            if tokens:
                both = np.concatenate(signs)
                yield pa.RecordBatch.from_pydict({"token": np.concatenate(tokens), "n": np.concatenate(sizes), "a": both[:, 0].copy(), "b": both[:, 1].copy()})

    return docs.mapInArrow(run, "token long, n long, a long, b long")


def shared_tokens(lists: DataFrame, percent: int) -> DataFrame:
    """``token``, ``n``, ``a``, ``b`` and the leader's ``la``, ``lb``, for tokens that two classes share at least.

    Lists are ordered by set size and cut where the next size is too large for a link with any before it; the first member
    of a piece leads it. They pass as sorted streams, so a list of any length takes no memory.
    """
    ordered = lists.repartition("token").sortWithinPartitions("token", "n", "a", "b")

    def run(batches) -> Iterator[pa.RecordBatch]:
        leader = last = None  # first member of the list that is open, and the member seen last
        told, size_before = False, 0
        for batch in batches:
            token, n, a, b = (c.to_numpy() for c in batch.columns)
            if not len(token):
                continue
            same = np.zeros(len(token), bool)
            same[1:] = (token[1:] == token[:-1]) & (n[1:] == n[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            same[0] = last == (token[0], n[0], a[0], b[0])
            last = (token[-1], n[-1], a[-1], b[-1])
            token, n, a, b = token[~same], n[~same], a[~same], b[~same]
            if not len(token):
                continue
            carried = leader is not None and leader[0] == token[0] and 100 * size_before >= percent * n[0]
            first = np.concatenate([[not carried], (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:])])
            size_before = n[-1]
            group = np.cumsum(first) - first[0]
            heads = np.flatnonzero(first)
            if carried:
                la, lb = np.concatenate([[leader[2]], a[heads]])[group], np.concatenate([[leader[3]], b[heads]])[group]
            else:
                la, lb = a[heads][group], b[heads][group]
            size = np.bincount(group)
            keep = size[group] > 1
            if carried:
                keep |= group == 0
                if not told:
                    yield pa.RecordBatch.from_pydict({k: [int(v)] for k, v in zip(("token", "n", "a", "b", "la", "lb"), (*leader, leader[2], leader[3]), strict=True)})
            g = group[-1]
            if not (carried and g == 0):
                at = heads[-1]
                leader, told = (token[at], n[at], a[at], b[at]), bool(size[g] > 1)
            else:
                told = True
            if keep.any():
                yield pa.RecordBatch.from_pydict({"token": token[keep], "n": n[keep], "a": a[keep], "b": b[keep], "la": la[keep], "lb": lb[keep]})

    return ordered.mapInArrow(run, "token long, n long, a long, b long, la long, lb long")


def member_sets(docs: DataFrame, width: int, members: DataFrame) -> DataFrame:
    """``a``, ``b``, ``shingles`` of the classes in ``members`` (``a``, ``b``), once or more each.

    Documents are told apart by a bitmap of fixed size over signatures; false hits fall out in the later join.
    """
    slot = F.pmod("a", F.lit(BITS))
    cells = members.groupBy(F.shiftright(slot, 5).cast("int").alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 32).cast("int"))).alias("bits")
    ).toPandas()
    words = np.zeros(BITS // 32, np.uint32)
    words[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64).astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for part in text_slices(batches):
            rows = []
            for s in shingle_sets(as_bytes(part.column("text")), width):
                if len(s):
                    a, b = _signature(s)
                    at = a % BITS
                    if bits[at >> 5] >> np.uint32(at & 31) & np.uint32(1) and (a, b) not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add((a, b))
                        rows.append((a, b, s.tobytes()))
            if rows:
                yield pa.RecordBatch.from_pydict({"a": [r[0] for r in rows], "b": [r[1] for r in rows], "shingles": pa.array([r[2] for r in rows], pa.binary())})

    return docs.mapInArrow(run, "a long, b long, shingles binary").groupBy("a", "b").agg(F.first("shingles").alias("shingles"))


class Family:
    """Sets that share lists, and the links among them."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.sizes = percent, np.array([len(s) for s in sets], np.int64)
        vocabulary, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        own = np.repeat(np.arange(len(sets)), self.sizes)
        kept = times[inverse] > 1  # a shingle that only one set has is in no overlap
        self.flat, owners = inverse[kept], own[kept]
        self.cuts = np.searchsorted(owners, np.arange(len(sets) + 1))
        self.mark = np.zeros(len(vocabulary), bool)
        self.root = np.arange(len(sets))
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # set -> (others, overlaps)
        self.twin: dict[int, tuple[int, int]] = {}  # set -> (earlier linked set, their overlap)

    def linked(self, x: int, ys: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (self.sizes[x] + self.sizes[ys] - overlap)

    def overlaps(self, x: int, ys: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``x`` with sets ``ys``."""
        own = self.flat[self.cuts[x] : self.cuts[x + 1]]
        self.mark[own] = True
        lengths = self.cuts[ys + 1] - self.cuts[ys]
        ends = np.cumsum(lengths)
        where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.cuts[ys] - (ends - lengths), lengths)
        sums = np.concatenate([[0], np.cumsum(self.mark[self.flat[where]])])
        self.mark[own] = False
        return sums[ends] - sums[ends - lengths]

    def decide(self, x: int, ys: np.ndarray) -> np.ndarray:
        """Which of ``ys`` link with ``x``: derived from a similar earlier set where its bounds suffice."""
        sure, open_ = np.zeros(len(ys), bool), np.ones(len(ys), bool)
        for base in ys[::-1][:1].tolist():  # the nearest in size
            common = int(self.overlaps(x, np.array([base]))[0])
            if base in self.known and 100 * common >= 95 * max(self.sizes[x], self.sizes[base]):
                others, theirs = self.known[base]
                at = np.minimum(np.searchsorted(others, ys), max(len(others) - 1, 0))
                have = others[at] == ys if len(others) else np.zeros(len(ys), bool)
                bound = np.where(have, theirs[at] if len(others) else 0, 0)
                most = np.minimum(bound + self.sizes[x] - common, np.minimum(self.sizes[x], self.sizes[ys]))
                least = np.maximum(bound - (self.sizes[base] - common), 0)
                sure = have & self.linked(x, ys, least)
                open_ = ~have | (~sure & self.linked(x, ys, most))
        if open_.any():
            rest = ys[open_]
            found = self.overlaps(x, rest)
            self.known[x] = (rest, found)
            sure[open_] = self.linked(x, rest, found)
        return sure

    def forest(self, lists: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that span the components among members of common lists (sorted by size); with ``side``, only links
        between its two values are looked for."""
        by: dict[int, list[tuple[np.ndarray, int]]] = {}
        for members in lists:
            sizes = self.sizes[members]
            starts = np.searchsorted(sizes, -(-sizes * self.percent // 100))  # block of too small sets, by position
            for k, (x, start) in enumerate(zip(members.tolist(), starts.tolist(), strict=True)):
                if start < k:
                    by.setdefault(x, []).append((members[start:k], k))
        out = []
        for x in sorted(by, key=lambda i: (self.sizes[i], i)):
            ys = np.unique(np.concatenate([m for m, _ in by[x]]))
            if side is not None:
                ys = ys[side[ys] != side[x]]
            ys = ys[self.root[ys] != self.root[x]]
            if not len(ys):
                continue
            ys = ys[np.lexsort((ys, self.sizes[ys]))]
            chosen = np.sort(ys)
            for y in chosen[self.decide(x, chosen)].tolist():
                if self.root[y] != self.root[x]:
                    low, high = sorted((self.root[x], self.root[y]))
                    self.root[self.root == high] = low
                    out.append((x, y))
        return out

    def degrees(self, lists: list[np.ndarray], all_tokens: list[np.ndarray], own_tokens: list[np.ndarray], copies: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
        """Of each set, the documents of the sets it links with, among pairs whose smallest common token of ``all_tokens``
        is one of ``own_tokens``, so that each pair counts in one family."""
        by: dict[int, list[np.ndarray]] = {}
        for members in lists:
            sizes = self.sizes[members]
            starts = np.searchsorted(sizes, -(-sizes * self.percent // 100))
            for k, (x, start) in enumerate(zip(members.tolist(), starts.tolist(), strict=True)):
                if start < k:
                    by.setdefault(x, []).append(members[start:k])
        vocabulary, flat = np.unique(np.concatenate(all_tokens), return_inverse=True)
        cuts = np.concatenate([[0], np.cumsum([len(t) for t in all_tokens])])
        here, mark = np.zeros(len(vocabulary) + 1, bool), np.zeros(len(vocabulary), bool)
        out = np.zeros(len(self.sizes), np.int64)
        self.known = {}
        for x in sorted(by, key=lambda i: (self.sizes[i], i)):
            ys = np.unique(np.concatenate(by[x]))
            if side is not None:
                ys = ys[side[ys] != side[x]]
            if not len(ys):
                continue
            ys = ys[self.decide(x, ys)]
            if not len(ys):
                continue
            own, tokens = np.searchsorted(vocabulary, own_tokens[x]), flat[cuts[x] : cuts[x + 1]]
            here[own] = mark[tokens] = True
            lengths = cuts[ys + 1] - cuts[ys]
            starts = np.cumsum(lengths) - lengths
            theirs = flat[np.arange(int(lengths.sum())) + np.repeat(cuts[ys] - starts, lengths)]
            ys = ys[here[np.minimum.reduceat(np.where(mark[theirs], theirs, len(vocabulary)), starts)]]
            here[own] = mark[tokens] = False
            out[x] += copies[ys].sum()
            out[ys] += copies[x]
        return out


FAMILY_KEYS = ["la", "lb", "i", "j"]


def families(members: DataFrame, payload: DataFrame) -> DataFrame:
    """Rows of ``members`` (``la``, ``lb``, ``a``, ``b`` and others) with ``payload`` by class, for each family or pair of
    its blocks: ``i``, ``j``, and ``own``, the block of the row."""
    spark, others = members.sparkSession, [c for c in members.columns if c not in FAMILY_KEYS]
    blocks = members.groupBy("la", "lb").agg(F.count("*").alias("size")).select("la", "lb", F.ceil(F.col("size") / FAMILY).cast("int").alias("blocks"))
    blocks = stage(blocks, run_dir(spark, "blocks"))
    placed = members.join(blocks, ["la", "lb"]).withColumn("own", F.pmod(F.xxhash64("a", "b"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sent = placed.withColumn("other", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return sent.select(*FAMILY_KEYS, "own", *others).join(payload, ["a", "b"])


def unpack(family: pd.DataFrame) -> tuple[pd.DataFrame, list[np.ndarray], np.ndarray | None]:
    """Members by size, their lists as positions, and for a pair of blocks the side of each member."""
    family = family.sort_values(["n", "a", "b"], ignore_index=True)
    tokens = np.concatenate(family["tokens"].to_list())
    whose = np.repeat(np.arange(len(family)), family["tokens"].map(len))
    order = np.lexsort((whose, tokens))
    cuts = np.flatnonzero(np.diff(tokens[order])) + 1
    lists = [m for m in np.split(whose[order], cuts) if len(m) > 1]
    return family, lists, family["own"].to_numpy() if family["i"].iloc[0] != family["j"].iloc[0] else None


def passing(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``members`` of which some pair may link, by size and sketches.

    A set is held against all smaller ones of its family that are large enough, at the width of the smallest of these: folded
    any further, large sets would differ in no more bits than they may.
    """

    def run(family: pd.DataFrame) -> pd.DataFrame:
        family = family.sort_values(["n", "a", "b"], ignore_index=True)
        n, held = family["n"].to_numpy(), family["sketch"].to_list()
        side = family["own"].to_numpy() if family["i"].iloc[0] != family["j"].iloc[0] else None
        starts = np.searchsorted(n, -(-n * percent // 100))
        widths = np.array([len(h) for h in held])[starts]  # rising, as sizes are
        fine = np.zeros(len(family), bool)
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            first = int(starts[mine[0]])
            bits = np.stack([fold(h, width) for h in held[first : mine[-1] + 1]]).view(np.uint64)
            for k, start in zip(mine.tolist(), starts[mine].tolist(), strict=True):
                both = n[start:k] + n[k]
                most = both - 2 * -(-percent * both // (100 + percent))  # shingles in which a link may differ
                open_ = np.bitwise_count(bits[start - first : k - first] ^ bits[k - first]).sum(1, dtype=np.int64) <= most
                if side is not None:
                    open_ &= side[start:k] != side[k]
                if open_.any():
                    fine[k] = True
                    fine[start:k] |= open_
        return family.loc[fine, ["la", "lb", "a", "b"]]

    spark = members.sparkSession
    kept = families(members.drop("tokens"), sketches).groupBy(*FAMILY_KEYS).applyInPandas(run, "la long, lb long, a long, b long").distinct()
    return stage(members.join(kept, ["la", "lb", "a", "b"], "left_semi"), run_dir(spark, "passing"))


def links(members: DataFrame, sets: DataFrame, percent: int, counts: bool) -> DataFrame:
    """``a``, ``b``, ``a2``, ``b2``: pairs of classes that link, a spanning forest per family; with ``counts`` also rows
    without ``a2`` and ``b2``: the documents (``n_links``) that a class links with by pairs of the family.
    ``sets`` has ``shingles``, ``copies`` and ``all_tokens`` by class."""

    def run(family: pd.DataFrame) -> pd.DataFrame:
        family, lists, side = unpack(family)
        made = Family([np.frombuffer(s, np.uint64) for s in family["shingles"]], percent)
        found = made.forest(lists, side)
        a, b = family["a"].to_numpy(), family["b"].to_numpy()
        x, y = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        out = pd.DataFrame({"a": a[x], "b": b[x], "a2": pd.array(a[y], "Int64"), "b2": pd.array(b[y], "Int64"), "n_links": pd.array([None] * len(x), "Int64")})
        if not counts:
            return out
        n = made.degrees(lists, family["all_tokens"].to_list(), family["tokens"].to_list(), family["copies"].to_numpy(), side)
        at = np.flatnonzero(n)
        blank = pd.array([None] * len(at), "Int64")
        return pd.concat([out, pd.DataFrame({"a": a[at], "b": b[at], "a2": blank, "b2": blank, "n_links": pd.array(n[at], "Int64")})], ignore_index=True)

    return families(members, sets).groupBy(*FAMILY_KEYS).applyInPandas(run, "a long, b long, a2 long, b2 long, n_links long")


def join_documents(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", counts: bool = True) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id``, ``n_links``: documents whose sets have a Jaccard similarity of at least ``percent`` per
    cent link, and a component is named by the smallest key that links reach. ``n_links`` is the exact number of other documents (rows) that a document links with,
    those of an equal set included; ``counts=False`` leaves it out, and its work.

    Words are runs without white space, A-Z in lower case; fewer than ``width`` words are one shingle; a null or empty text
    has an empty set and links with nothing. Rows that repeat a key have a row each and link by their own texts; a null key
    never names a component that has another key. Keys are 64-bit integers; other columns are not read; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stage(profiles(source, width), run_dir(spark, "profiles"))
    ranks = frequency_tables(rows)
    ids = rows.where("chunk is null").select("id", "n", "a", "b")
    classes = rows.where("n > 0").groupBy("a", "b").agg(F.min("id").alias("first"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    classes = stage(classes, run_dir(spark, "classes"))
    texts = source.select("text")
    shared = shared_tokens(prefix_lists(texts, width, percent, ranks), percent)
    members = stage(shared.groupBy("la", "lb", "a", "b", "n").agg(F.collect_list("token").alias("tokens")), run_dir(spark, "members"))
    near = passing(members, classes.select("a", "b", "sketch"), percent)
    sets = stage(member_sets(texts, width, near.select("a", "b").distinct()), run_dir(spark, "sets"))
    if counts:
        tokens = near.groupBy("a", "b").agg(F.flatten(F.collect_list("tokens")).alias("all_tokens"))
        sets = sets.join(classes.select("a", "b", "copies"), ["a", "b"]).join(tokens, ["a", "b"])
    found = stage(links(near, sets, percent, counts), run_dir(spark, "links"))
    degrees = found.where("n_links is not null").groupBy("a", "b").agg(F.sum("n_links").alias("n_links"))
    found, sizes = found.where("a2 is not null").drop("n_links"), classes.select("a", "b", "copies")
    classes = classes.select("a", "b", "first")
    one, two = classes.toDF("a", "b", "x"), classes.toDF("a2", "b2", "y")
    edges = found.join(one, ["a", "b"]).join(two, ["a2", "b2"]).where("x is not null and y is not null").select(F.col("x").alias("a"), F.col("y").alias("b"))
    tied = components(edges)
    named = classes.join(tied, classes["first"] == tied["node"], "left").select("a", "b", F.coalesce("component", "first").alias("name"))
    named = stage(named, run_dir(spark, "named"))
    if counts:
        named = named.join(sizes, ["a", "b"]).join(degrees, ["a", "b"], "left")
        named = stage(named.select("a", "b", "name", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")), run_dir(spark, "counted"))
    extra = ["n_links"] if counts else []
    full = ids.where("n > 0").join(named, ["a", "b"]).select("id", "n", "name", *extra)
    none = ids.where("n = 0").select("id", "n", F.col("id").alias("name"), *[F.lit(0).cast("long").alias(c) for c in extra])
    return full.unionByName(none).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("name").alias("component_id"), *extra)


@query("op5_skip_join")
def skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and numbers of links of all documents under links of at least 90 % over 3-word shingles."""
    return join_documents(table(spark, sf_dir, "documents"), width=3, percent=90)
