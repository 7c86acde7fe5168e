"""Byte-pair encoding and decoding by speculation and verification.

Texts are cut into pretokens by the public byte-level pattern. For each different pretoken a greedy longest match
proposes tokens. A sequence of tokens is what merging gives exactly if each adjacent pair on its own merges to the same
pair, so all adjacent pairs of all proposals are checked together against tables of pairs known to hold or fail (a new
pair is decided once by merging its bytes). Only pretokens with a failing pair are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import as_text, query, table, text_slices

# The pretoken pattern of byte-level BPE, with white space spelled out.
_SPACE = r"\t-\r \x85\xa0  -     　"
_ANY = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: No merge; the part of a merge's value that is the new id (the rest is its rank).
_NONE, _ID = 1 << 62, (1 << 24) - 1


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder for one byte-level vocabulary; holds at most ``most`` pretokens and pairs in memory."""

    def __init__(self, path: str, most: int = 600_000) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of, vocab = byte_alphabet(), spec["model"]["vocab"]
        raw = lambda token: bytes(of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.reach: dict[bytes, int] = {}  # longest token by its first three bytes
        for token in self.ids:
            self.reach[token[:3]] = max(len(token), self.reach.get(token[:3], 0))
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = token
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.single = [self.ids[bytes([i])] for i in range(256)]
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = raw(a), raw(b)
            self.ranks[self.ids[left] << 32 | self.ids[right]] = rank << 24 | self.ids[left + right]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.most = most
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.holds: dict[int, bool] = {}
        self.merged = self.proposed = 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the pair of lowest rank first, the leftmost of equals."""
        if len(word) > 500:
            return self._merge_long(word)
        rank, parts = self.ranks.get, list(map(self.single.__getitem__, word))
        open_pairs = [rank(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while open_pairs:
            best = min(open_pairs)
            if best == _NONE:
                break
            at = open_pairs.index(best)
            parts[at] = best & _ID
            del parts[at + 1], open_pairs[at]
            if at:
                open_pairs[at - 1] = rank(parts[at - 1] << 32 | parts[at], _NONE)
            if at < len(open_pairs):
                open_pairs[at] = rank(parts[at] << 32 | parts[at + 1], _NONE)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap over a linked list: near-linear time for pretokens of any length."""
        rank, parts, n = self.ranks.get, list(map(self.single.__getitem__, word)), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(v, i) for i in range(n - 1) if (v := rank(parts[i] << 32 | parts[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or rank(parts[i] << 32 | parts[j], _NONE) != best:
                continue
            parts[i], parts[j] = best & _ID, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (v := rank(parts[left] << 32 | parts[right], _NONE)) != _NONE:
                    heapq.heappush(heap, (v, left))
        return [p for p in parts if p >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n, known, reach = [], 0, len(word), self.ids.get, self.reach.get
        while at < n:
            for end in range(min(n, at + reach(word[at : at + 3], 2)), at, -1):
                token = known(word[at:end])
                if token is not None:
                    out.append(token)
                    at = end
                    break
        return out

    def _verify(self, codes: np.ndarray) -> np.ndarray:
        """Whether each pair (first id, second id + 1, or 0 for none) is what merging its bytes gives."""
        distinct, back = np.unique(codes, return_inverse=True)
        answers = []
        for code in distinct.tolist():
            known = self.holds.get(code)
            if known is None:
                if len(self.holds) >= self.most:
                    self.holds.clear()
                a, b = code >> 32, (code & 0xFFFFFFFF) - 1
                want = [a] if b < 0 else [a, b]
                known = self.holds[code] = self.merge(b"".join(map(self.bytes.__getitem__, want))) == want
            answers.append(known)
        return np.array(answers, dtype=bool)[back]

    def learn(self, words: set[str]) -> None:
        """Encode pretokens not yet held."""
        if not words:
            return
        listed = sorted(words)
        raw = [w.encode() for w in listed]
        guess = [self.propose(w) for w in raw]
        sizes = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter(chain.from_iterable(guess), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        after = np.zeros(len(flat), np.int64)
        after[:-1] = flat[1:] + 1
        after[ends - 1] = 0
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = sizes == 1  # the last token has no successor; one that stands alone is checked itself
        good = np.ones(len(flat), bool)
        good[inner] = self._verify((flat[inner] << 32) | after[inner])
        whole = np.logical_and.reduceat(good, ends - sizes)
        flat = flat.astype("<u4").tobytes()
        at = 0
        for word, source, n, ok in zip(listed, raw, sizes.tolist(), whole.tolist(), strict=True):
            self.words[word] = flat[at : at + 4 * n] if ok else np.array(self.merge(source), "<u4").tobytes()
            at += 4 * n
        self.proposed += len(listed)
        self.merged += int((~whole).sum())

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The same for many texts, whose new pretokens are learned together."""
        cut: list[list[list[str] | bytes]] = []
        new: set[str] = set()
        for text in texts:
            row: list[list[str] | bytes] = []
            for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if i % 2:
                    row.append(self.special[part].to_bytes(4, "little"))
                elif part:
                    pieces = (_ASCII if part.isascii() else _ANY).findall(part)
                    new.update(pieces)
                    row.append(pieces)
            cut.append(row)
        fresh = new.difference(self.words)
        if len(self.words) + len(fresh) > self.most // 2:
            self.older, self.words, fresh = self.words, {}, new
        self.words.update((w, known) for w in fresh if (known := self.older.get(w)))
        self.learn(fresh.difference(self.words))
        of = self.words.__getitem__
        return [b"".join(x if isinstance(x, bytes) else b"".join(map(of, x)) for x in row) for row in cut]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become the replacement character."""
        joined = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined.decode("utf-8", "replace").encode()


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One encoder per worker and vocabulary."""
    return _LOADED.get(path) or _LOADED.setdefault(path, Bpe(path))


def encode_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (binary, little-endian unsigned 32-bit) of every whole text. ``path`` is read on the executors.

    One narrow pass. Null and empty texts give no ids; repeated rows give a row each; other columns are not read.
    """
    return _map(df, key, text, "ids binary", lambda x, part: [pa.array(x.encode_all(as_text(part.column("text"))), pa.binary())], path)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` decoded from ``ids``; null ids give an empty text."""
    return _map(df, key, ids, "text string", lambda x, part: [pa.array([x.decode(i or b"").decode() for i in part.column("text").to_pylist()])], path)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids: ``key``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""

    def digest(x: Bpe, part: pa.RecordBatch) -> list[pa.Array]:
        counts, ids, texts = [], [], []
        for coded in x.encode_all(as_text(part.column("text"))):
            counts.append(len(coded) // 4)
            ids.append(hashlib.sha256(coded).hexdigest())
            texts.append(hashlib.sha256(x.decode(coded)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids), pa.array(texts)]

    return _map(df, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest, path)


def _map(df: DataFrame, key: str, value: str, schema: str, make, path: str) -> DataFrame:
    source = df.select(F.col(key).alias("key"), F.col(value).alias("text"))
    names = ["key", *(field.split()[0] for field in schema.split(", "))]

    def run(batches):
        coder = loaded(path)
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("key"), *make(coder, part)], names)

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, {schema}").withColumnRenamed("key", key)


@query("op9_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
