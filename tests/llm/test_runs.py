"""Periodic runs against brute force, with planted repeats and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np

from quayside.llm import runs
from quayside.llm.common import ship


def brute(words, least):
    """All (start, length, period) by comparing words at every distance; the period must be the smallest one."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, 2 * q) and all(words[start : start + length - d] != words[start + d : start + length] for d in range(1, q)):
                out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeated(rnd, n, k):
    words = [rnd.randrange(k) for _ in range(n)]
    if n > 10 and rnd.random() < 0.5:
        a = rnd.randrange(n)
        p = 1 + (n - a) // rnd.randint(2, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_of_codes():
    rnd = random.Random(3)
    texts = [repeated(rnd, rnd.randint(0, 60), rnd.choice([1, 2, 2, 3, 5])) for _ in range(1200)]
    for least in (2, 5, 12):
        got = list(runs.text_runs([np.array(t, np.int64) for t in texts], least))
        for text, found in zip(texts, got, strict=True):
            assert [tuple(r) for r in found.tolist()] == brute(text, least)
            if least == 2:
                assert [tuple(r) for r in runs.runs_of(np.array(text, np.int64), 2).tolist()] == brute(text, 2)


def test_lyndon_array():
    rnd = random.Random(4)
    lyndon = lambda w: all(w < w[k:] for k in range(1, len(w)))
    for _ in range(500):
        w = [rnd.randrange(3) for _ in range(rnd.randint(0, 25))]
        assert runs.lyndon_array(w) == [max(m for m in range(1, len(w) - i + 1) if lyndon(w[i : i + m])) for i in range(len(w))]


def test_digests_and_odd_rows(spark):
    ship(spark)
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{c}é" for c in repeated(rnd, rnd.randint(0, 80), 3)) + rnd.choice(["", "\n", " \t"]), "a", 1) for i in range(300)]
    rows += [(None, "a b " * 20, "a", 1), (301, None, None, None), (302, "", "a", 1), (303, " \n\x0b", "a", 1), (304, "x y\x1c x y\x1c " * 9, "b", 1)]
    rows += [(305, "one two three " * 4000, "b", 1)] * 2 + [(-7, "Ab ab " * 8, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, period long")
    want, spans, collapsed = [], [], []
    for key, text, *_ in rows:
        for planted in (True, False):
            words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
            n, h = len(words), zlib.crc32(b"" if key is None else str(key).encode())
            if planted and h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            found = brute(words, 12) if key != 305 else [(0, 12000, 3)]
            gone = {i for s, m, q in found for i in range(s + q, s + m)}
            kept = " ".join(w for i, w in enumerate(words) if i not in gone)
            if planted:
                best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                milli = 1000 * best[1] // best[2] if found else None
                want.append((key, len(found), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(kept)))
            else:
                spans += [(key, *r) for r in found]
                collapsed.append((key, kept))
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in runs.run_digests(docs, planted=True).collect()) == order(want)
    assert order(tuple(r) for r in runs.find_runs(docs).collect()) == order(spans)
    assert order(tuple(r) for r in runs.collapse_runs(docs).collect()) == order(collapsed)
    assert runs.run_digests(docs.limit(0), planted=True).collect() == []
