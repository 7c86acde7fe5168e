"""Token ids in raw binary shards with a minimal perfect hash index.

A shard is a pair of files: ``NNNNNN.ids`` holds the ids of its documents one after another, little-endian, in two bytes
each where the vocabulary allows, else four; ``NNNNNN.idx`` holds a directory (key, ids per document, in order) and the
index: bit levels of a minimal perfect hash over the keys, and per slot a fingerprint, the offset and the number of ids.
A key is found in constant time: hash levels give the slot, the fingerprint rejects keys that are not there.

Documents are range-partitioned by key, so shards follow each other in key order. A task writes its shard under a name
of its own attempt and then renames it; a task that runs again writes the same bytes.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import SLICE_BYTES, as_text, query, table, text_slices
from quayside.session import run_dir

MAGIC = b"QIDS0001"
#: Pretoken chunks kept in memory by a worker.
CHUNKS = 600_000
#: Chunks of letters that the library encodes as one text.
JOINED = 64
#: Tab and line ends become spaces.
AS_SPACE = bytes(32 if c in b"\t\n\r" else c for c in range(256))
#: Letters that composition leaves alone and whose lower case is one letter, and ASCII signs after them.
PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-į]+)(?P<signs>[!-/:-@\[-`{-~]*)$"
#: Steps of a tokenizer that lowers case and parts letters from signs.
FOLDING = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PARTING = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: at each level a key alone on its bit stays, the others go on."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        counts = [int(x.sum()) for x in levels]
        self.bases = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.ranks = [np.cumsum(x, dtype=np.int64) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 2.0) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(8, int(len(keys) * spread))
            at = (mix64(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1 where no level holds it; a key not built in may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mix64(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.bases[k] + self.ranks[k][at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + b"".join(struct.pack("<Q", len(x)) for x in self.levels)
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", raw)
        sizes, at, levels = struct.unpack_from(f"<{n}Q", raw, 4), 4 + 8 * n, []
        for size in sizes:
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels)


class Shard:
    """A shard's index in memory: directory and keyed lookup."""

    def __init__(self, raw: bytes) -> None:
        magic, self.width, rows, keyed, hash_size = struct.unpack_from("<8sIQQQ", raw)
        if magic != MAGIC:
            raise ValueError("not an index of this format")
        at = struct.calcsize("<8sIQQQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += found.nbytes
            return found

        self.keys, self.known, self.counts = take("<i8", rows), take("u1", rows).astype(bool), take("<u8", rows)
        self.prints, self.offsets, self.sizes = take("<u4", keyed), take("<u8", keyed), take("<u8", keyed)
        self.hash = PerfectHash.from_bytes(raw[at : at + hash_size])

    @staticmethod
    def to_bytes(width: int, keys: np.ndarray, known: np.ndarray, counts: np.ndarray) -> bytes:
        """Of a key that repeats, the index holds the first row."""
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint64) if len(counts) else np.zeros(0, np.uint64)
        distinct, first = np.unique(keys[known], return_index=True)
        rows = np.flatnonzero(known)[first]
        hashed = PerfectHash.build(distinct.view(np.uint64))
        slots = hashed.slots(distinct.view(np.uint64))
        prints, offsets, sizes = np.zeros(len(rows), "<u4"), np.zeros(len(rows), "<u8"), np.zeros(len(rows), "<u8")
        prints[slots] = fingerprint(distinct)
        offsets[slots], sizes[slots] = starts[rows], counts[rows]
        tail = hashed.to_bytes()
        head = struct.pack("<8sIQQQ", MAGIC, width, len(keys), len(rows), len(tail))
        arrays = (keys.astype("<i8"), known.astype("u1"), counts.astype("<u8"), prints, offsets, sizes)
        return head + b"".join(x.tobytes() for x in arrays) + tail

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is held, its offset and its number of ids."""
        slots = self.hash.slots(keys.view(np.uint64))
        held = slots >= 0
        safe = np.where(held, slots, 0)
        if not len(self.prints):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        held &= self.prints[safe] == fingerprint(keys)
        return held, self.offsets[safe].astype(np.int64), self.sizes[safe].astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(np.ascontiguousarray(keys).view(np.uint64), 1 << 20) >> np.uint64(32)).astype(np.uint32)


class Encoder:
    """Whole texts through the tokenizers library, chunk by chunk.

    Space, tab and line ends never lie inside a token of a tokenizer that drops white space, so the chunks between them
    are encoded on their own, each different one of a call once, and none again as long as it is kept. Where the tokenizer
    lowers case and parts letters from signs (``folds``), a chunk of plain letters and signs after them is encoded as its
    letters in lower case and its signs. Chunks of letters alone go to the library many at a time: where tokens mark the
    ends of words, as many marks as chunks show that each chunk is one word.
    """

    def __init__(self, path: str, width: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), "H" if width == 2 else "I"
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True
        told = json.loads(self.tokenizer.to_str())
        self.folds = (told["normalizer"], told["pre_tokenizer"]) == (FOLDING, PARTING)

    def encode_chunks(self, chunks: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each chunk with its ids; chunks are distinct."""
        words = [c for c in chunks if c.isalpha()] if self.ends.any() else []
        single = list(set(chunks).difference(words))
        width = array(self.kind).itemsize
        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        for group, coded in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(coded.ids, f"<u{width}")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group) or stops[-1] != len(ids):
                single += group  # a letter that becomes several signs in lower case, for one
                continue
            raw, start = ids.tobytes(), 0
            for chunk, stop in zip(group, (stops * width).tolist(), strict=True):
                yield chunk, raw[start:stop]
                start = stop
        for chunk, coded in zip(single, self.tokenizer.encode_batch_fast(single, add_special_tokens=False), strict=True):
            yield chunk, array(self.kind, coded.ids).tobytes()

    def look_up(self, chunks: list[str]) -> pa.Array:
        """The ids of distinct chunks, from those kept or else from the library."""
        found = list(map(self.new.get, chunks))
        missing = [at for at, ids in enumerate(found) if ids is None]
        if len(self.new) + len(missing) > CHUNKS:
            self.old, self.new = self.new, {}
        for at in missing:
            found[at] = self.old.get(chunks[at])
        made = dict(self.encode_chunks([chunks[at] for at in missing if found[at] is None]))
        for at in missing:
            chunk = chunks[at]
            if found[at] is None:
                found[at] = made[chunk]
            self.new[chunk] = found[at]
        return pa.array(found, pa.large_binary())

    def encode_distinct(self, chunks: pa.Array) -> pa.Array:
        """The ids of distinct chunks."""
        if not self.folds:
            return self.look_up(chunks.to_pylist())
        parts = pc.extract_regex(chunks, PLAIN)  # null where it does not match
        heads = pc.coalesce(pc.utf8_lower(pc.struct_field(parts, "word")), chunks).dictionary_encode()
        tails = pc.fill_null(pc.struct_field(parts, "signs"), "").dictionary_encode()
        ids = [self.look_up(x.dictionary.to_pylist()).take(x.indices) for x in (heads, tails)]
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str]) -> list[bytes]:
        words = pc.split_pattern(pa.array([t.encode().translate(AS_SPACE) for t in texts], pa.string()), " ")
        coded = words.values.dictionary_encode()
        ids = self.encode_distinct(coded.dictionary).take(coded.indices)
        if not len(ids):
            return [b""] * len(texts)
        _, ends, raw = ids.buffers()
        cuts = np.frombuffer(ends, np.int64)[words.offsets.to_numpy()].tolist()
        data = memoryview(raw)
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def write_store(df: DataFrame, root: str, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, and write shards below ``root``; gives the manifest, one row a shard.

    Keys are 64-bit integers. A null text gives ``end_id`` alone; a null key sorts first and is in the directory but not
    in the index; rows that share a key keep the order of their texts' hash, and the index holds the first; an empty
    table writes no shard. ``path``, the tokenizer, is read on the executors; ``root`` is a folder they share.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ordered = source.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie").drop("tie")

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        width = 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        coder = _ENCODERS.get((path, width)) or _ENCODERS.setdefault((path, width), Encoder(path, width))
        end = np.array([end_id], f"<u{width}").tobytes()
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        disk, folder = pafs.FileSystem.from_uri(root)
        keys, known, counts, out = [], [], [], None
        draft = f"{folder}/{shard:06d}.{attempt}.tmp"
        for part in text_slices(batches):
            if out is None:
                disk.create_dir(folder, recursive=True)
                out = disk.open_output_stream(draft)
            coded = coder.encode(as_text(part.column("text")))
            for ids in coded:
                out.write(ids)
                out.write(end)
            column = part.column("key")
            keys.append(column.fill_null(0).to_numpy())
            known.append(column.is_valid().to_numpy(zero_copy_only=False))
            counts.append(np.fromiter((len(x) // width + 1 for x in coded), np.uint64, len(coded)))
        if out is None:
            return
        out.close()
        disk.move(draft, f"{folder}/{shard:06d}.ids")
        all_counts = np.concatenate(counts)
        with disk.open_output_stream(f"{draft}x") as index:
            index.write(Shard.to_bytes(width, np.concatenate(keys), np.concatenate(known), all_counts))
        disk.move(f"{draft}x", f"{folder}/{shard:06d}.idx")
        total = int(all_counts.sum())
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_rows": [len(all_counts)], "n_ids": [total]})

    manifest = ordered.mapInArrow(run, "shard int, n_rows long, n_ids long")
    manifest.write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.schema("shard int, n_rows long, n_ids long").parquet(f"{root}/manifest")


def read_store(spark: SparkSession, root: str, make: Callable[[list[np.ndarray]], dict[str, pa.Array]] | None = None, schema: str = "ids binary") -> DataFrame:
    """Read shards back in key order: ``key``, ``start`` (ids of all rows before it), and what ``make`` gives for the ids.

    Every key is looked up through the index; a row whose offset or size it gives otherwise ends the job. One task reads
    one shard, a few MB at a time.
    """
    manifest = spark.read.schema("shard int, n_rows long, n_ids long").parquet(f"{root}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = placed.repartition(max(1, manifest.count()), "shard")
    digest = make or (lambda rows: {"ids": pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())})

    def run(batches) -> Iterator[pa.RecordBatch]:
        disk, folder = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/{row['shard']:06d}"
                with disk.open_input_file(f"{name}.idx") as file:
                    index = Shard(file.read())
                counts = index.counts.astype(np.int64)
                starts = np.cumsum(counts) - counts
                check_index(index, starts)
                with disk.open_input_file(f"{name}.ids") as file:
                    lots = (starts * index.width) // SLICE_BYTES
                    cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(counts)]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        size = int(counts[a:b].sum()) * index.width
                        raw = np.frombuffer(file.read_at(size, int(starts[a]) * index.width), f"<u{index.width}")
                        rows = np.split(raw, np.cumsum(counts[a:b])[:-1])
                        columns = {"key": pa.array(index.keys[a:b], mask=~index.known[a:b]), "start": pa.array(starts[a:b] + row["first"])}
                        yield pa.RecordBatch.from_pydict(columns | digest(rows))

    return spread.mapInArrow(run, f"key long, start long, {schema}")


def check_index(index: Shard, starts: np.ndarray) -> None:
    """The index must give every directory row its place; of rows that share a key, the first."""
    distinct, first = np.unique(index.keys[index.known], return_index=True)
    rows = np.flatnonzero(index.known)[first]
    held, offsets, sizes = index.find(distinct)
    if not (held.all() and (offsets == starts[rows]).all() and (sizes == index.counts[rows].astype(np.int64)).all()):
        raise ValueError("index and directory disagree")


def look_up(root: str, shard: int, keys: list[int]) -> list[np.ndarray | None]:
    """Ids of some keys of a shard, by the index alone; None for a key that it does not hold."""
    disk, folder = pafs.FileSystem.from_uri(root)
    with disk.open_input_file(f"{folder}/{shard:06d}.idx") as file:
        index = Shard(file.read())
    held, offsets, sizes = index.find(np.array(keys, np.int64))
    out: list[np.ndarray | None] = []
    with disk.open_input_file(f"{folder}/{shard:06d}.ids") as file:
        for ok, at, n in zip(held.tolist(), offsets.tolist(), sizes.tolist(), strict=True):
            out.append(np.frombuffer(file.read_at(n * index.width, at * index.width), f"<u{index.width}") if ok else None)
    return out


def _checksums(rows: list[np.ndarray]) -> dict[str, pa.Array]:
    sums = [zlib.crc32(r.astype("<u4").tobytes()) for r in rows]
    return {"n_tokens": pa.array([len(r) for r in rows], pa.int64()), "ids_crc32": pa.array(sums, pa.int64())}


@query("op6_token_store")
def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as ids and read back from the files."""
    root = run_dir(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), root, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_store(spark, root, _checksums, "n_tokens long, ids_crc32 long").withColumnRenamed("key", "doc_id")
