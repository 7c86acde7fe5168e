"""License scan by ordered signature rules.

Texts are reduced to words (A-Z in lower case; runs of digits, a-z and non-ASCII characters). A rule is a regular
expression over those words, the keywords that must occur before it is tried (all of some, one of others; each a
necessary condition, read off the expression), a label and a priority. Overlapping
detections are resolved in the order of priority, then length: a detection that lies inside a kept one is dropped.

The families below are written by hand, each with the patterns that name it; four templates turn a family into rules
(identifier tag, grant, title, short name), and a list of sentences taken from license texts adds more.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import as_bytes, query, table, text_slices

# Phrases that always count, with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_V = r"(?: version| v)?"
#: label: (tag words, title pattern, short pattern or "", keywords of title and short name)
FAMILIES: dict[str, tuple[str, str, str, str, str]] = {
    "mit": (r"mit", r"(?:the )?mit(?: x11| expat)? licen[sc]e", r"expat licen[sc]e", "mit", "expat"),
    "mit-0": (r"mit 0", r"mit no attribution", r"mit 0 licen[sc]e", "mit", "mit"),
    "x11": (r"x11", r"x11 licen[sc]e", r"x consortium licen[sc]e", "x11", "consortium"),
    "apache-1": (r"apache 1 [01]", rf"apache(?: software)? licen[sc]e{_V} 1(?: [01])?", r"apache 1 [01]", "apache", "apache"),
    "apache-2": (r"apache 2 0", rf"apache(?: software)? licen[sc]e{_V} 2(?: 0)?", r"(?:apache|asl) 2 0", "apache", "0"),
    "gpl-1": (r"gpl 1 0(?: only| or later)?", rf"gnu general public licen[sc]e{_V} 1(?: 0)?", r"gpl ?v ?1", "gnu", "gpl"),
    "gpl-2": (r"gpl 2 0(?: only| or later)?", rf"gnu general public licen[sc]e{_V} 2(?: 0)?", r"gpl ?v?2(?: 0)?", "gnu", ""),
    "gpl-3": (r"gpl 3 0(?: only| or later)?", rf"gnu general public licen[sc]e{_V} 3(?: 0)?", r"gpl ?v?3(?: 0)?", "gnu", ""),
    "lgpl-2": (r"lgpl 2 0(?: only| or later)?", rf"gnu library general public licen[sc]e{_V} 2(?: 0)?", r"lgpl ?v?2(?: 0)?", "gnu", ""),
    "lgpl-2.1": (r"lgpl 2 1(?: only| or later)?", rf"gnu lesser general public licen[sc]e{_V} 2 1", r"lgpl ?v?2 1", "gnu", "1"),
    "lgpl-3": (r"lgpl 3 0(?: only| or later)?", rf"gnu lesser general public licen[sc]e{_V} 3(?: 0)?", r"lgpl ?v?3(?: 0)?", "gnu", ""),
    "agpl-1": (r"agpl 1 0", rf"affero general public licen[sc]e{_V} 1(?: 0)?", r"agpl ?v?1", "affero", ""),
    "agpl-3": (r"agpl 3 0(?: only| or later)?", rf"(?:gnu )?affero general public licen[sc]e{_V} 3(?: 0)?", r"agpl ?v?3", "affero", ""),
    "gfdl-1.1": (r"gfdl 1 1", rf"gnu free documentation licen[sc]e{_V} 1 1", r"gfdl ?v?1 1", "gnu", "gfdl"),
    "gfdl-1.2": (r"gfdl 1 2", rf"gnu free documentation licen[sc]e{_V} 1 2", r"gfdl ?v?1 2", "gnu", "gfdl"),
    "gfdl-1.3": (r"gfdl 1 3", rf"gnu free documentation licen[sc]e{_V} 1 3", r"gfdl ?v?1 3", "gnu", "gfdl"),
    "mpl-1.0": (r"mpl 1 0", rf"mozilla public licen[sc]e{_V} 1 0", r"mpl ?v?1 0", "mozilla", "mpl"),
    "mpl-1.1": (r"mpl 1 1", rf"mozilla public licen[sc]e{_V} 1 1", r"mpl ?v?1 1", "mozilla", "mpl"),
    "mpl-2.0": (r"mpl 2 0", rf"mozilla public licen[sc]e{_V} 2 0", r"mpl ?v?2 0", "mozilla", "mpl"),
    "bsd-0": (r"0bsd", r"(?:zero|0) clause bsd", r"0bsd licen[sc]e", "bsd", "0bsd"),
    "bsd-1": (r"bsd 1 clause", r"(?:one|1) clause bsd", r"bsd 1 clause", "bsd", "bsd"),
    "bsd-2": (r"bsd 2 clause", r"(?:simplified|freebsd|two clause|2 clause) bsd", r"bsd 2 clause", "bsd", "bsd"),
    "bsd-3": (r"bsd 3 clause", r"(?:new|modified|revised|three clause|3 clause) bsd", r"bsd 3 clause", "bsd", "bsd"),
    "bsd-4": (r"bsd 4 clause", r"(?:original|four clause|4 clause) bsd", r"bsd 4 clause", "bsd", "bsd"),
    "isc": (r"isc", r"(?:the )?isc licen[sc]e", r"internet systems consortium licen[sc]e", "isc", "consortium"),
    "epl-1": (r"epl 1 0", rf"eclipse public licen[sc]e{_V} 1(?: 0)?", r"epl ?v?1(?: 0)?", "eclipse", ""),
    "epl-2": (r"epl 2 0", rf"eclipse public licen[sc]e{_V} 2(?: 0)?", r"epl ?v?2(?: 0)?", "eclipse", ""),
    "edl-1": (r"edl 1 0", rf"eclipse distribution licen[sc]e{_V} 1(?: 0)?", r"edl ?v?1 0", "eclipse", "edl"),
    "cddl-1.0": (r"cddl 1 0", rf"common development and distribution licen[sc]e{_V} 1 0", r"cddl ?v?1 0", "common", "cddl"),
    "cddl-1.1": (r"cddl 1 1", rf"common development and distribution licen[sc]e{_V} 1 1", r"cddl ?v?1 1", "common", "cddl"),
    "cpl-1": (r"cpl 1 0", rf"common public licen[sc]e{_V} 1(?: 0)?", r"cpl ?v?1 0", "common", "cpl"),
    "cpal-1": (r"cpal 1 0", rf"common public attribution licen[sc]e{_V} 1(?: 0)?", r"cpal ?v?1 0", "common", "cpal"),
    "ipl-1": (r"ipl 1 0", rf"ibm public licen[sc]e{_V} 1(?: 0)?", r"ipl ?v?1 0", "ibm", "ipl"),
    "eupl-1.1": (r"eupl 1 1", rf"european union public licen[sc]e{_V} 1 1", r"eupl ?v?1 1", "european", "eupl"),
    "eupl-1.2": (r"eupl 1 2", rf"european union public licen[sc]e{_V} 1 2", r"eupl ?v?1 2", "european", "eupl"),
    "osl-3": (r"osl 3 0", rf"open software licen[sc]e{_V} 3(?: 0)?", r"osl ?v?3 0", "open", "osl"),
    "afl-3": (r"afl 3 0", rf"academic free licen[sc]e{_V} 3(?: 0)?", r"afl ?v?3 0", "academic", "afl"),
    "artistic-1": (r"artistic 1 0(?: perl)?", rf"artistic licen[sc]e{_V} 1(?: 0)?", r"perl artistic licen[sc]e", "artistic", "perl"),
    "artistic-2": (r"artistic 2 0", rf"artistic licen[sc]e{_V} 2(?: 0)?", r"artistic 2 0", "artistic", "artistic"),
    "boost-1": (r"bsl 1 0", rf"boost software licen[sc]e{_V}(?: 1(?: 0)?)?", r"boost licen[sc]e", "boost", "boost"),
    "zlib": (r"zlib", r"(?:the )?zlib licen[sc]e", r"zlib libpng licen[sc]e", "zlib", "zlib"),
    "libpng": (r"libpng(?: 2 0)?", r"(?:the )?libpng licen[sc]e", r"png reference library licen[sc]e", "libpng", "png"),
    "unlicense": (r"unlicense", r"(?:the )?unlicense(?: org)?", r"unlicensed public domain dedication", "unlicense", "unlicensed"),
    "wtfpl": (r"wtfpl", r"do what the [^ ]+ you want to public licen[sc]e", r"wtfpl(?: version 2)?", "want", "wtfpl"),
    "cc0-1": (r"cc0 1 0", r"creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?", r"cc0(?: 1 0)?", "creative", "cc0"),
    "cc-by": (r"cc by [1-4] [05]", r"creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e", r"cc by [1-4] [05]", "creative", "cc"),
    "cc-by-sa": (r"cc by sa [1-4] [05]", r"creative commons attribution share ?alike", r"cc by sa(?: [1-4] [05])?", "creative", "cc"),
    "cc-by-nd": (r"cc by nd [1-4] [05]", r"creative commons attribution no ?deriv(?:ative)?s?", r"cc by nd(?: [1-4] [05])?", "creative", "cc"),
    "cc-by-nc": (r"cc by nc [1-4] [05]", r"creative commons attribution non ?commercial", r"cc by nc [1-4] [05]", "creative", "nc"),
    "cc-by-nc-sa": (r"cc by nc sa [1-4] [05]", r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa(?: [1-4] [05])?", "creative", "nc"),
    "cc-by-nc-nd": (r"cc by nc nd [1-4] [05]", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", r"cc by nc nd(?: [1-4] [05])?", "creative", "nc"),
    "odbl-1": (r"odbl 1 0", rf"open (?:data commons open )?database licen[sc]e{_V}(?: 1(?: 0)?)?", r"odbl(?: 1 0)?", "database", "odbl"),
    "odc-by-1": (r"odc by 1 0", r"open data commons attribution licen[sc]e", r"odc by(?: 1 0)?", "commons", "odc"),
    "pddl-1": (r"pddl 1 0", r"(?:open data commons )?public domain dedication and licen[sc]e", r"pddl(?: 1 0)?", "dedication", "pddl"),
    "ofl-1.1": (r"ofl 1 1(?: rfn)?", rf"(?:sil )?open font licen[sc]e{_V}(?: 1 1)?", r"ofl ?v?1 1", "font", "ofl"),
    "ms-pl": (r"ms pl", r"microsoft public licen[sc]e", r"ms pl", "microsoft", "ms"),
    "ms-rl": (r"ms rl", r"microsoft reciprocal licen[sc]e", r"ms rl", "microsoft", "ms"),
    "php-3": (r"php 3 0?1?", rf"php licen[sc]e{_V}(?: 3(?: 01?)?)?", r"php licen[sc]e", "php", "php"),
    "python-2": (r"(?:python|psf) 2 0", r"python software foundation licen[sc]e", r"psf licen[sc]e(?: agreement)?", "python", "psf"),
    "ruby": (r"ruby", r"(?:the )?ruby licen[sc]e", r"same terms as ruby(?: itself)?", "ruby", "ruby"),
    "perl": (r"perl 5", r"same terms as (?:the )?perl(?: 5)?(?: itself| programming language)?", r"perl 5 licen[sc]e", "perl", "perl"),
    "vim": (r"vim", r"(?:the )?vim licen[sc]e", r"vim charityware", "vim", "vim"),
    "w3c": (r"w3c", r"w3c software (?:notice and )?licen[sc]e", r"w3c document licen[sc]e", "w3c", "w3c"),
    "postgresql": (r"postgresql", r"(?:the )?postgresql licen[sc]e", r"postgres licen[sc]e", "postgresql", "postgres"),
    "openssl": (r"openssl", r"openssl licen[sc]e", r"original ssleay licen[sc]e", "openssl", "ssleay"),
    "ijg": (r"ijg", r"independent jpeg group licen[sc]e", r"based in part on the work of the independent jpeg group", "jpeg", "jpeg"),
    "curl": (r"curl", r"(?:the )?curl licen[sc]e", r"mit x derivate licen[sc]e", "curl", "derivate"),
    "ncsa": (r"ncsa", r"university of illinois(?: ncsa)? open source licen[sc]e", r"uiuc licen[sc]e", "illinois", "uiuc"),
    "upl-1": (r"upl 1 0", rf"universal permissive licen[sc]e{_V}(?: 1(?: 0)?)?", r"upl ?v?1 0", "permissive", "upl"),
    "ecl-2": (r"ecl 2 0", rf"educational community licen[sc]e{_V} 2(?: 0)?", r"ecl ?v?2 0", "educational", "ecl"),
    "lppl-1.3": (r"lppl 1 3[ac]?", rf"latex project public licen[sc]e{_V}(?: 1 3[ac]?)?", r"lppl(?: 1 3[ac]?)?", "latex", "lppl"),
    "qpl-1": (r"qpl 1 0", rf"q public licen[sc]e{_V}(?: 1(?: 0)?)?", r"qpl(?: 1 0)?", "q", "qpl"),
    "sleepycat": (r"sleepycat", r"sleepycat licen[sc]e", r"berkeley database licen[sc]e", "sleepycat", "berkeley"),
    "nasa-1.3": (r"nasa 1 3", rf"nasa open source agreement{_V}(?: 1 3)?", r"nosa 1 3", "nasa", "nosa"),
    "rpl-1": (r"rpl 1 [15]", rf"reciprocal public licen[sc]e{_V}(?: 1 [15])?", r"rpl 1 [15]", "reciprocal", "rpl"),
    "sspl-1": (r"sspl 1 0", rf"server side public licen[sc]e{_V}(?: 1)?", r"sspl(?: v?1)?", "server", "sspl"),
    "busl-1.1": (r"busl 1 1", rf"business source licen[sc]e{_V}(?: 1 1)?", r"busl(?: 1 1)?", "business", "busl"),
    "elastic-2": (r"elastic 2 0", rf"elastic licen[sc]e{_V}(?: 2(?: 0)?)?", r"elv2", "elastic", "elv2"),
    "polyform-nc": (r"polyform noncommercial 1 0 0", r"polyform non ?commercial licen[sc]e", r"polyform noncommercial", "polyform", "polyform"),
    "commons-clause": (r"commons clause", r"commons clause licen[sc]e condition", r"with commons clause", "clause", "clause"),
    "mulan-2": (r"mulanpsl 2 0", r"mulan permissive software licen[sc]e", r"mulanpsl ?v?2", "mulan", ""),
    "blueoak-1": (r"blueoak 1 0 0", r"blue oak model licen[sc]e", r"blueoak 1 0 0", "oak", "blueoak"),
    "hippocratic": (r"hippocratic 2 1", r"hippocratic licen[sc]e", r"hippocratic 2 1", "hippocratic", "hippocratic"),
    "json": (r"json", r"(?:the )?json licen[sc]e", r"shall be used for good not evil", "json", "evil"),
    "beerware": (r"beerware", r"(?:the )?beer ?ware licen[sc]e", r"you can buy me a beer", "", "beer"),
}

#: Sentences that license texts consist of: label, pattern, keyword.
SENTENCES: list[tuple[str, str, str]] = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("mit", r"the above copyright notice and this permission notice shall be included", "notice"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd", r"redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd-3", r"neither the name of .{1,80}? nor the names of its contributors", "neither"),
    ("bsd-4", r"all advertising materials mentioning features or use of this software", "advertising"),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "redistribute"),
    ("gpl", r"you should have received a copy of the gnu general public licen[sc]e", "gnu"),
    ("lgpl", r"you should have received a copy of the gnu lesser general public licen[sc]e", "lesser"),
    ("agpl", r"you should have received a copy of the gnu affero general public licen[sc]e", "affero"),
    ("apache-2", r"you may obtain a copy of the licen[sc]e at http www apache org licenses", "apache"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed", "applicable"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[sc]e", "mozilla"),
    ("boost-1", r"distributed under the boost software licen[sc]e", "boost"),
    ("zlib", r"altered source versions must be plainly marked as such", "altered"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc-by", r"licensed under a creative commons attribution", "creative"),
    ("cc", r"creativecommons org licenses by(?: nc| sa| nd)*", "creativecommons"),
    ("ofl-1.1", r"this font software is licensed under the sil open font licen[sc]e", "font"),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain"),
    ("no-warranty", r"the software is provided as is without warranty of any kind", "warranty"),
    ("all-rights-reserved", r"all rights reserved", "reserved"),
    ("proprietary", r"(?:unauthorized|unauthorised) copying of this file via any medium is strictly prohibited", "copying"),
    ("proprietary", r"proprietary and confidential", "proprietary"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: frozenset[bytes]
    priority: int
    gate: frozenset[bytes] = frozenset()  # one of these must occur


def rules() -> list[Rule]:
    """All rules, by falling priority; base phrases come first and so are never inside a kept detection."""
    made = [Rule(label, phrase, _words(phrase), 100) for phrase, label in BASE.items()]
    for label, (tag, title, short, title_key, short_key) in FAMILIES.items():
        verb = r"(?:licensed|released|distributed|available|published|provided|covered)"
        made.append(Rule(label, rf"spdx licen[sc]e identifier {tag}", _words("spdx identifier"), 90))
        made.append(Rule(label, rf"{verb} under (?:the )?(?:terms of )?(?:the )?(?:{title}|{short})", _words("under"), 80))
        any_name = rf"{title}|{short}|{tag} licen[sc]e"
        made.append(Rule(label, rf"licen[sc]e (?:is )?(?:{any_name})", frozenset(), 75, gate(any_name, title_key, short_key)))
        made.append(Rule(label, title, frozenset(), 70, gate(title, title_key)))
        made.append(Rule(label, short, frozenset(), 50, gate(short, short_key)))
    made += [Rule(label, pattern, frozenset(), 60, gate(pattern, key)) for label, pattern, key in SENTENCES]
    return sorted(made, key=lambda r: -r.priority)


def _words(text: str) -> frozenset[bytes]:
    return frozenset(text.encode().split())


#: Words that many texts hold; a gate has them only where a form of its pattern holds no other.
_COMMON = frozenset("license licence the version v public general software open source free of and to in or under as terms you".split())


def forms(pattern: str) -> list[str]:
    """All texts that a pattern matches; what is not one of few characters stands as a NUL."""

    def expand(items) -> list[str]:
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                now = [chr(arg)]
            elif name == "IN":
                spans = [range(a, a + 1) if str(k) == "LITERAL" else range(a[0], a[1] + 1) if str(k) == "RANGE" else None for k, a in arg]
                now = ["\0"] if None in spans else [chr(c) for r in spans for c in r]
            elif name == "BRANCH":
                now = [x for branch in arg[1] for x in expand(branch)]
            elif name == "SUBPATTERN":
                now = expand(arg[-1])
            elif name == "MAX_REPEAT" and arg[:2] == (0, 1):
                now = ["", *expand(arg[2])]
            else:
                now = ["\0"]
            out = [a + b for a in out for b in now]
        return out

    return sorted(set(expand(re._parser.parse(pattern))))


def gate(pattern: str, *wanted: str) -> frozenset[bytes]:
    """Few words of which every text that the pattern matches holds one: ``wanted`` ones first, common ones last."""
    open_ = [{w for w in text.split() if "\0" not in w} for text in forms(pattern)]
    chosen = set()
    while open_:
        if not all(open_):
            return frozenset()
        counts = Counter(w for words in open_ for w in words)
        best = max(counts, key=lambda w: (w in wanted, not (w in _COMMON or w.isdigit()), counts[w], w))
        chosen.add(best.encode())
        open_ = [words for words in open_ if best not in words]
    return frozenset(chosen)


#: A-Z to a-z, all other ASCII that is no digit or letter to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

class _Reach:
    """Largest end among kept intervals that start at or before a word (a Fenwick tree of maxima)."""

    def __init__(self, size: int) -> None:
        self.most = [-1] * (size + 1)

    def add(self, start: int, end: int) -> None:
        i = start + 1
        while i < len(self.most):
            self.most[i] = max(self.most[i], end)
            i += i & -i

    def holds(self, start: int, end: int) -> bool:
        i = start + 1
        while i:
            if self.most[i] >= end:
                return True
            i -= i & -i
        return False


class Scanner:
    """Compiled rules; ``scan`` gives the number of words and the kept detections of a text."""

    def __init__(self, ordered: list[Rule]) -> None:
        self.rules = [(r, re.compile(rb"(?<![^ ])(?:" + r.pattern.encode() + rb")(?![^ ])")) for r in ordered]
        self.keywords = frozenset().union(*(r.keywords | r.gate for r in ordered))
        self.gated = all(r.keywords or r.gate for r in ordered)

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int, int]]]:
        words = text.translate(_FOLD).split()
        present = self.keywords.intersection(words)
        if not present and self.gated:
            return len(words), []
        joined, found = b" ".join(words), []
        for rule, pattern in self.rules:
            if not rule.keywords <= present or (rule.gate and rule.gate.isdisjoint(present)):
                continue
            at = word = 0
            for m in pattern.finditer(joined):
                word += joined.count(b" ", at, m.start())
                at = m.start()
                found.append((rule.label, rule.priority, word, word + m.group().count(b" ") + 1))
        return len(words), self.resolve(found, len(words))

    @staticmethod
    def resolve(found: list[tuple[str, int, int, int]], n_words: int) -> list[tuple[str, int, int, int]]:
        """Keep a detection unless a kept one of higher priority (or as high, and longer or earlier) holds it."""
        if len(found) < 2:
            return found
        reach, kept = _Reach(n_words), []
        for hit in sorted(found, key=lambda h: (-h[1], h[2] - h[3], h[2], h[0])):
            if not reach.holds(hit[2], hit[3]):
                reach.add(hit[2], hit[3])
                kept.append(hit)
        return sorted(kept, key=lambda h: (h[2], h[3], h[0]))


_SPAN = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64())])
_SCANNERS: dict[tuple, Scanner] = {}


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text", ordered: list[Rule] | None = None) -> DataFrame:
    """Kept detections of every whole text: ``key``, ``n_words`` and ``spans`` (label, priority, words from/to).

    One narrow pass, no shuffle. A null or empty text has no words and no spans; rows that repeat give a row each; other
    columns are not read; an empty table gives no rows.
    """
    chosen = rules() if ordered is None else ordered

    def run(batches):
        cached = tuple(chosen)
        scanner = _SCANNERS.get(cached) or _SCANNERS.setdefault(cached, Scanner(chosen))
        names = ("label", "priority", "first_word", "end_word")
        for part in text_slices(batches):
            counts, spans = [], []
            for raw in as_bytes(part.column("text")):
                n, hits = scanner.scan(raw)
                counts.append(n)
                spans.append([dict(zip(names, h, strict=True)) for h in hits])
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_SPAN))], ["key", "n_words", "spans"]
            )

    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {source.schema['key'].dataType.simpleString()}, n_words long, spans array<struct<label string, priority int, first_word long, end_word long>>"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


@query("op2_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: all places of the base phrases, base labels, and labels of all kept detections."""
    spans = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["priority"] == 100)
    starts = F.transform("base", lambda s: s["first_word"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda s: s["label"]))), ",")
    doubt = F.aggregate("spans", F.lit(1.0), lambda a, s: a * (1.0 - s["priority"] * 0.0095))
    return spans.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("spans").alias("labels"),
        (1.0 - doubt).alias("score"),
        F.size("spans").cast("long").alias("n_detections"),
    )
