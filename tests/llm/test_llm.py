"""The operators for training data against brute force, exact round trips and held-out labels, with odd rows."""

import dataclasses
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import ann, bpe, chat, jaccard, licenses, lines, mixing, search, store, toxicity
from quayside.llm.common import ship
from quayside.session import run_dir

DOCS = "doc_id long, text string, source string, size string, n long"
LONG = "word other thing " * 3000


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows, and columns with names used inside."""
    ship(spark)
    rows = [(1, None, "a", "x", 1), (2, "", None, None, 2), (None, "under the MIT License", "a", "x", 3), (3, LONG, "b", "x", 4)]
    rows += [(4, "Under the MIT license, and CC-BY-NC\nall rights reserved", "b", "y", 5)] * 2 + [(5, "ab", "a", "x", 6)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_licenses(odd, none):
    got = {r.doc_id: r for r in licenses.scan_licenses(odd).collect()}
    assert got[1].n_words == got[2].n_words == 0 and got[1].spans == []
    assert [(s.label, s.first_word) for s in got[4].spans] == [("mit", 0), ("cc-by-nc", 5), ("all-rights-reserved", 8)]
    assert got[3].n_words == 9000 and [s.label for s in got[None].spans] == ["mit"]
    assert licenses.scan_licenses(none).collect() == []


def test_license_containment():
    found = [("low", 50, 3, 5), ("high", 80, 2, 6), ("other", 80, 5, 9), ("in", 80, 3, 4)]
    assert [h[0] for h in licenses.Scanner.resolve(found, 10)] == ["high", "other"]
    assert len(licenses.rules()) >= 200


def test_license_gates_lose_nothing():
    """Texts of every form of every name, with and without the gates; mplv2 0 and gpl2 are single words with a number."""
    gated = licenses.Scanner(licenses.rules())
    free = licenses.Scanner([dataclasses.replace(r, keywords=frozenset(), gate=frozenset()) for r in licenses.rules()])
    texts = {f for tag, title, short, *_ in licenses.FAMILIES.values() for p in (tag, title, short) for f in licenses.forms(p)}
    texts |= {f for _, pattern, _ in licenses.SENTENCES for f in licenses.forms(pattern)}
    for text in sorted(texts):
        for lead in ("", "License: ", "released under "):
            for tail in ("", " license"):
                raw = f"{lead}{text}{tail}".replace("\0", "xy").encode()
                assert gated.scan(raw) == free.scan(raw), raw
    assert [h[0] for h in gated.scan(b"MPLv2.0")[1]] == ["mpl-2.0"] and gated.scan(b"License: PSF-2.0 License")[1]
    assert all(r.keywords or r.gate for r in licenses.rules())


def test_bpe_equals_library():
    mine, theirs = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"), most=400), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    signs = "ab'stre  \n\t\x1c\x85\xa0é中ß😀01½<|endoftext|>!?."
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50))) for _ in range(2000)] + ["<|endoftext|>x", "a" * 2000, "ACGT" * 400, ""]
    for text, ids in zip(texts, mine.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
        assert mine.decode(ids).decode() == theirs.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_bpe_odd_rows(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    for r in bpe.round_trip(odd, path).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and (r.n_tokens > 0) == bool(r.text)
    assert bpe.decode_ids(bpe.encode_texts(odd, path), path).count() == 7 and bpe.round_trip(none, path).collect() == []


def test_mixing(spark, odd, none):
    rows = mixing.assign(odd, key="doc_id").collect()
    assert len(rows) == 7 and mixing.assign(none).collect() == []
    many = spark.createDataFrame([(i, "w " * (i % 50), f"s{i % 7}" if i % 3 else "hot") for i in range(3000)], "doc_id long, text string, source string")
    by, again = defaultdict(int), sorted(mixing.assign(many).collect(), key=str)
    for r in again:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size
        by[r.source, r.target] += r.taken
    assert all(abs(taken - target) <= 1 for (_, target), taken in by.items())
    assert abs(sum(t for _, t in by) - 1.5 * sum(r.size for r in again)) < 1e-6 * sum(r.size for r in again)
    assert again == sorted(mixing.assign(many).collect(), key=str)
    drawn = Counter(r.doc_id for r in mixing.mix_documents(many).collect())
    assert max(drawn.values()) <= 2


def test_mixing_follows_the_schedules_in_every_pass(spark):
    many = spark.createDataFrame([(i, "w " * (5 + i % 7), "abc"[i % 20 % 9 % 3] if i % 20 < 9 else "c") for i in range(2000)], "doc_id long, text string, source string")
    by = defaultdict(list)
    for r in mixing.assign(many).collect():
        assert len(r.positions) == r.copies and (r.positions or [None])[0] == r.position
        by[r.source, r.target, r.source_size] += [(t, min(r.size, r.taken - turn * r.size)) for turn, t in enumerate(r.positions)]
    twice = 0
    for (source, target, size), drawn in by.items():
        schedule = mixing.Mix().schedules["abc".index(source)]
        (_, f0), (_, f1) = schedule.knots
        twice += target == 2 * size
        for t in np.linspace(0, 1, 21):
            assert abs(sum(words for at, words in drawn if at <= t) - target * (f0 * t + (f1 - f0) * t * t / 2) / schedule.integrals()[-1]) <= 12, (source, t)
    assert twice
    order = [(r.source, r.doc_id) for r in mixing.mix_documents(many).collect()]
    for source in "ab":
        ids = [i for s, i in order if s == source]
        first = len(set(ids))
        assert len(ids) > first == len(set(ids[:first]))


def test_schedule_inverse(spark):
    schedule = mixing.Schedule(2.0, ((0.0, 0.5), (0.4, 2.0), (1.0, 1.0)))
    shares = [(float(x),) for x in np.linspace(0, 0.999, 50)]
    times = [r.t for r in spark.createDataFrame(shares, "x double").select(schedule.invert(mixing.F.col("x")).alias("t")).collect()]
    grid = np.linspace(0, 1, 200_001)
    factor = np.interp(grid, [0, 0.4, 1], [0.5, 2, 1])
    total = np.concatenate([[0], np.cumsum((factor[1:] + factor[:-1]) / 2)])
    assert np.abs(np.interp(times, grid, total / total[-1]) - np.array(shares)[:, 0]).max() < 1e-6


def _links(docs, width, percent):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize(("width", "percent", "family"), [(3, 90, 1024), (5, 80, 7)])
def test_jaccard(spark, monkeypatch, width, percent, family):
    """With small families too, so that blocks are crossed."""
    ship(spark)
    monkeypatch.setattr(jaccard, "FAMILY", family)
    rnd = random.Random(2)
    bases = [[rnd.choice("abcdefghijklmnop") + str(rnd.randrange(30)) for _ in range(n)] for n in (1, 2, 5, 40, 60, 120)]
    docs = [(1000, None), (1001, ""), (1002, " \n")]
    for i in range(90):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(9)}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_documents(df, width, percent).collect()}
    assert got == _links(docs, width, percent)


@pytest.mark.parametrize(("width", "percent", "family"), [(3, 90, 1024), (5, 80, 7)])
def test_jaccard_counts_all_links(spark, monkeypatch, width, percent, family):
    """Families of near copies and exact copies, against all pairs."""
    ship(spark)
    monkeypatch.setattr(jaccard, "FAMILY", family)
    rnd = random.Random(6)
    bases = [[rnd.choice("abcdefghijklmnop") + str(rnd.randrange(30)) for _ in range(n)] for n in (3, 60, 150)]
    docs = [(1000, None), (1001, "")]
    for i in range(120):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(5)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(9)}"
        docs.append((i, " ".join(words)))
    sets = {i: {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()) for i, w in ((i, (t or "").split()) for i, t in docs)}
    want = {}
    for i, a in sets.items():
        want[i] = sum(1 for j, b in sets.items() if i != j and a & b and 100 * len(a & b) >= percent * len(a | b))
    got = {r.doc_id: r.n_links for r in jaccard.join_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), width, percent).collect()}
    assert got == want and max(want.values()) > 10


def test_jaccard_odd_rows(odd, none):
    got = Counter((r.doc_id, r.component_id) for r in jaccard.join_documents(odd).collect())
    assert got == Counter({(1, 1): 1, (2, 2): 1, (None, None): 1, (3, 3): 1, (4, 4): 2, (5, 5): 1})
    assert jaccard.join_documents(none).collect() == []


def test_store(spark, odd, none):
    path, root = public_tokenizers.path("word_bpe_49k.json"), run_dir(spark, "store-test")
    manifest = store.write_store(odd, root, path, end_id=2).collect()
    library, start = Tokenizer.from_file(path), 0
    rows = sorted(store.read_store(spark, root).collect(), key=lambda r: r.start)
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and ids == [*library.encode(texts[r.key] or "", add_special_tokens=False).ids, 2]
        start += len(ids)
    assert len(rows) == 7 and [r.key for r in rows] == [None, 1, 2, 3, 4, 4, 5]
    found = [x for m in manifest for x in store.look_up(root, m.shard, [4, 999]) if x is not None]
    assert {len(x) for x in found} == {len(library.encode(texts[4], add_special_tokens=False).ids) + 1}
    assert store.read_store(spark, store.write_store(none, empty := run_dir(spark, "store-none"), path, 2) and empty).collect() == []


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000)).astype(np.uint64)
    made = store.PerfectHash.from_bytes(store.PerfectHash.build(keys).to_bytes())
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = toxicity.weak_toxicity(spark, sf).where("held_out")
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    counts = Counter((r.toxic, r.predicted) for r in rows)
    assert counts[1, 1] / (counts[1, 1] + counts[0, 1]) > 0.95 and counts[1, 1] / (counts[1, 1] + counts[1, 0]) > 0.75


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1), (5, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for docs, n in ((odd, 7), (none, 0)):
        scores = toxicity.score_texts(docs, toxicity.train_model(docs, labels)).collect()
        assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(x) for x in v] for v in rng.integers(-3, 4, (600, 4))]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(900, None, "x"), (901, [0.0] * 4, "x"), (902, [1.0, None, 0.0, 0.0], "x"), (903, [float("nan")] * 4, "x"), (None, [1.0] * 4, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    asked = df.where("vec_id % 100 = 0")
    got = defaultdict(list)
    for r in sorted(ann.nearest(df, asked, 5, 1.0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    used = [(i, v) for i, v in enumerate(vectors) if any(v)]
    for q, v in used:
        if q % 100 == 0:
            assert got[q] == [(i, d) for d, i in sorted((math.dist(v, w), i) for i, w in used if i != q)[:5]]
    assert ann.nearest(df.limit(0), asked, 5).collect() == []


def test_search(spark, none):
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 60)))) for i in range(300)] + [(400, None), (401, ""), (None, "a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    totals = {r.term: r for r in search.frequencies(df).collect()}
    n, total = totals[None].df, totals[None].total
    queries = search.make_queries(df.where("doc_id % 20 = 0"), search.frequencies(df), n, 4)
    got = defaultdict(list)
    for r in sorted(search.search(df, queries, n, total / n, 7).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.doc_id, round(r.score, 9)))
    words = {i: Counter(re.findall(r"[a-z]+", t or "")) for i, t in docs if i is not None}
    df_ = Counter(w for c in words.values() for w in c)
    mean = sum(sum(c.values()) for c in words.values()) / len(words)
    idf = {w: math.log(1 + (len(words) - f + 0.5) / (f + 0.5)) for w, f in df_.items()}
    names = {int(h): w for w, h in zip(sorted(df_), search.word_hashes([" ".join(sorted(df_)).encode()], search.BY_SIGN)[0].view(np.int64), strict=True)}
    for q, terms in {q: [names[r.term] for r in queries.collect() if r.query_id == q] for q in got}.items():
        best = sorted((-sum(idf[t] * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for t in terms if c[t]), i) for i, c in words.items() if i != q and any(c[t] for t in terms))
        assert [(-round(s, 9), i) for s, i in best[:7]] == [(s, i) for i, s in got[q]] or [round(-s, 6) for s, _ in best[:7]] == [round(s, 6) for _, s in got[q]]
    assert len(got) == 15


def test_search_asks_with_all_words(spark, tmp_path):
    """Words of two documents alone must not crowd out the others; ranks are those of BM25 over the whole text."""
    rnd = random.Random(5)
    common = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    docs = [(i, " ".join([f"pair{i // 2}x{j}" for j in range(12)] + rnd.choices(common, range(1, 65), k=rnd.randint(5, 80)))) for i in range(500)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = defaultdict(list)
    for r in sorted(search.block_max_search(spark, str(tmp_path)).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.doc_id, round(r.score, 6)))
    words = {i: Counter(t.split()) for i, t in docs}
    df, mean = Counter(w for c in words.values() for w in c), sum(sum(c.values()) for c in words.values()) / len(words)
    idf = {w: math.log(1 + (len(words) - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    assert sorted(got) == list(range(0, 500, 20))
    for q, found in got.items():
        norm = {i: 1.2 * (0.25 + 0.75 * sum(c.values()) / mean) for i, c in words.items()}
        best = sorted((-sum(idf[t] * c[t] * 2.2 / (c[t] + norm[i]) for t in words[q] if c[t]), i) for i, c in words.items() if i != q)
        assert found == [(i, round(-s, 6)) for s, i in best[:10]]


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_lines(spark, none):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdé ") for _ in range(n)) for n in (12, 13, 14, 20, 63, 64, 65, 128, 129, 200)]

    def edit(s):
        p, kind = rnd.randrange(len(s)), rnd.randrange(3)
        return s[:p] + ("" if kind == 1 else rnd.choice("xyz")) + s[p + (kind < 2) :]

    docs = []
    for i in range(80):
        made = [edit(edit(rnd.choice(base))) if rnd.random() < 0.3 else edit(rnd.choice(base)) if rnd.random() < 0.5 else rnd.choice(base).upper() for _ in range(rnd.randint(0, 5))]
        docs.append((i, "\n".join(made + [rnd.choice(["", "  ", "hi", "ho"])] * (rnd.random() < 0.2))))
    docs += [(500, None), (501, ""), (502, "short"), (503, "shirt")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen, want = [], {}
    for i, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            form = line.strip(" \t\r\x0b\x0c").lower()
            if not form or not any(form == s or (min(len(form), len(s)) >= 12 and _near(form, s)) for s in seen):
                kept.append(line)
            seen += [form] if form else []
        want[i] = None if text is None else "\n".join(kept)
    assert got == want
    assert lines.dedup_lines(none).collect() == []


def test_lines_keep_columns(odd):
    out = lines.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == 7


def test_chat(spark):
    rows = [(1, 0, "ann", "hi <|end|>", "x"), (1, 1, "bob", None, "x"), (1, 1, "bob", None, "x"), (1, 70, "ann", "bye", "x"), (None, None, None, "lost", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    got = {(r.conv_id, r.assistant, r.part): r for r in chat.perspectives(df).collect()}
    first = got[1, "ann", 0]
    assert first.dialogue == "<|assistant|>\nhi < |end|><|end|>\n<|user name=bob|>\n<|end|>\n"
    a, b = map(int, first.mask_spans.split("-"))
    assert first.dialogue[a:b] == "hi < |end|><|end|>\n" and set(got) == {(1, "ann", 0), (1, "bob", 0), (1, "ann", 1), (1, "bob", 1), (None, "", -1)}
    assert chat.perspectives(df.limit(0)).collect() == []


def test_chat_cuts_hot_parts_in_order(spark):
    said = [(7, i % 40 if i % 3 else None, "ann" if i % 2 else "bob", f"m{i:05}") for i in range(5000)] + [(8, 1, "ann", "hi")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(6)
    got = {(r.conv_id, r.assistant, r.part, r.piece): r for r in chat.perspectives(df).collect()}
    for part, null in ((-1, True), (0, False)):
        want = [m for _, _, _, m in sorted((m for m in said if m[0] == 7 and (m[1] is None) == null), key=lambda m: (m[1] or 0, m[2], m[3]))]
        for who in ("ann", "bob"):
            rows = [got[7, who, part, k] for k in range(-(-len(want) // 1024))]
            assert [len(re.findall(r"m\d{5}", r.dialogue)) for r in rows] == [len(want[k : k + 1024]) for k in range(0, len(want), 1024)]
            assert re.findall(r"m\d{5}", "".join(r.dialogue for r in rows)) == want
    assert got[8, "ann", 0, 0].n_turns == 1


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "bpe"]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {name for _, name in _links([(r.doc_id, r.text) for r in docs.collect()], 5, 80).values()} and kept.columns == docs.columns
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_crc32_is_of_ids(spark):
    got = store.token_store(spark, "/root/testdata/sf0.001").orderBy("doc_id").limit(3).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array([*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4").tobytes())


def test_store_encodes_chunks_of_letters_as_the_library_does():
    """Letters that change their number in lower case, marks, added tokens and white space of other kinds."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["", " ", "İstanbul and ŉa ẞ ﬁ ǅ", "a<|endoftext|>b <|endof c", "é ́a é", "a\x85b c\xa0d \x0b", "it's we'll x'S", "word, " * 3]
    own = store.Encoder(path, 2).encode(texts)
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, own, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
