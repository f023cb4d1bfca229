"""License scan by ordered signature rules.

A text is normalised to its words (A-Z lowered, runs of ASCII letters, digits and non-ASCII characters) with single
spaces between. An Aho-Corasick automaton over the rules' keywords decides which of the rules
are tried at all; most texts hit no keyword and cost one scan. The detections of the tried rules are taken in order of priority (longer
first among equals), and one that lies inside the interval of a detection taken before is suppressed, so a name inside
a notice, or "gpl" inside "lgpl 2.1 or later", adds no label of its own.

The rules are written per family of licenses, each family's versions and clauses expanded into a regex each
(see ``RULES``). One projection over whole texts; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import id_and_text, map_batches, texts_of

#: Phrases of the base rule and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

#: Priorities: identifiers and full notices before grants, grants before names, names before mentions.
NOTICE, GRANT, NAME, MENTION = 400, 300, 200, 100
#: What a detection of each priority says of the text, as the score.
WEIGHT = {NOTICE: 1.0, GRANT: 0.9, NAME: 0.7, MENTION: 0.4}
BASE_WEIGHT = 0.3


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str  # over normalised words
    keyword: str  # stands in every match of the pattern
    priority: int


def _number(version: str) -> str:
    """A version as normalised words, with or without a trailing 0: 2.0 is "2 0" or "2"."""
    return version.replace(".0", "(?: 0)?").replace(".", " ")


def _gnu() -> list[Rule]:
    out = []
    names = {"gpl": ("general public license", "gpl", ("1.0", "2.0", "3.0")), "lgpl": ("(?:lesser|library) general public license", "lgpl", ("2.0", "2.1", "3.0")), "agpl": ("affero general public license", "agpl", ("1.0", "3.0"))}
    for label, (long, short, versions) in names.items():
        for version in versions:
            v = rf"(?:version |v ?|)?{_number(version)}"
            for keyword, name in (("general public license", f"(?:gnu )?{long}"), (short, f"(?:gnu )?{short}")):
                out += [
                    Rule(f"{label}-{version}-or-later", rf"{name},? {v} or (?:\(?at your option\)? )?(?:any )?later(?: version)?", keyword, GRANT),
                    Rule(f"{label}-{version}-or-later", rf"{name} as published by the free software foundation either {v} of the license or at your option any later version", keyword, NOTICE),
                    Rule(f"{label}-{version}-only", rf"{name} {v} only", keyword, GRANT),
                    Rule(f"{label}-{version}", rf"{name} {v}", keyword, NAME),
                ]
            out += [Rule(f"{label}-{version}{end}", rf"spdx license identifier {short} {_number(version)}{words}", "spdx license identifier", NOTICE) for end, words in (("-or-later", " or later"), ("-only", " only"), ("", ""))]
        out.append(Rule(label, rf"(?:gnu )?{long}", "general public license", MENTION))
    return out


def _creative_commons() -> list[Rule]:
    out = []
    parts = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative|ativ)?e?s?(?: works)?", "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative|ativ)?e?s?(?: works)?"}
    for (code, words), version in product(parts.items(), ("1.0", "2.0", "2.5", "3.0", "4.0")):
        short, v = code.replace("-", " "), _number(version)
        out += [
            Rule(f"cc-{code}-{version}", rf"creativecommons org licenses {short} {version.replace('.', ' ')}", "creativecommons", NOTICE),
            Rule(f"cc-{code}-{version}", rf"creative commons {words} {v}", "creative commons", GRANT),
            Rule(f"cc-{code}-{version}", rf"cc {short} (?:v ?)?{v}", "cc by", NAME),
        ]
    for code, words in parts.items():
        out += [Rule(f"cc-{code}", rf"creative commons {words}", "creative commons", NAME), Rule(f"cc-{code}", f"cc {code.replace('-', ' ')}", "cc by", MENTION)]
    out += [Rule("cc0-1.0", "creativecommons org publicdomain zero 1 0", "creativecommons", NOTICE), Rule("cc0-1.0", "cc0(?: 1 0)?", "cc0", NAME)]
    return out


#: Families with versions: label, name in words, versions, whether the bare name is a mention.
_VERSIONED = (
    ("apache", "apache (?:software )?license", "1.0 1.1 2.0", "apache"),
    ("mpl", "mozilla public license", "1.0 1.1 2.0", "mozilla"),
    ("epl", "eclipse public license", "1.0 2.0", "eclipse"),
    ("cpl", "common public license", "0.5 1.0", "common public"),
    ("cddl", "common development and distribution license", "1.0 1.1", "common development"),
    ("eupl", "european union public licen[cs]e", "1.0 1.1 1.2", "european union"),
    ("artistic", "artistic license", "1.0 2.0", "artistic"),
    ("afl", "academic free license", "1.1 1.2 2.0 2.1 3.0", "academic free"),
    ("osl", "open software license", "1.0 1.1 2.0 2.1 3.0", "open software"),
    ("ofl", "(?:sil )?open font license", "1.0 1.1", "open font"),
    ("bsl", "boost software license", "1.0", "boost"),
    ("busl", "business source license", "1.0 1.1", "business source"),
    ("php", "php license", "3.0 3.01", "php license"),
    ("zpl", "zope public license", "1.1 2.0 2.1", "zope"),
    ("ecl", "educational community license", "1.0 2.0", "educational community"),
    ("lppl", "latex project public license", "1.0 1.1 1.2 1.3", "latex project"),
    ("gfdl", "(?:gnu )?free documentation license", "1.1 1.2 1.3", "free documentation"),
    ("upl", "universal permissive license", "1.0", "universal permissive"),
    ("odbl", "open (?:data commons open )?database license", "1.0", "database license"),
    ("odc-by", "open data commons attribution license", "1.0", "open data commons"),
    ("pddl", "public domain dedication and licen[cs]e", "1.0", "public domain"),
    ("sspl", "server side public license", "1.0", "server side"),
    ("elastic", "elastic license", "1.0 2.0", "elastic"),
    ("polyform", "polyform [a-z]+ license", "1.0", "polyform"),
    ("qpl", "q public license", "1.0", "q public"),
    ("ipl", "ibm public license", "1.0", "ibm public"),
    ("apsl", "apple public source license", "1.0 1.1 1.2 2.0", "apple public"),
    ("nasa", "nasa open source agreement", "1.3", "nasa open"),
    ("python", "python (?:software foundation )?license", "2.0", "python"),
    ("vim", "vim license", "", "vim license"),
    ("isc", "isc license", "", "isc license"),
    ("zlib", "zlib(?: libpng)? license", "", "zlib"),
    ("wtfpl", "do what the fuck you want to public license", "2.0", "you want to public"),
    ("unlicense", "unlicense", "", "unlicense"),
    ("ncsa", "(?:university of illinois )?ncsa open source license", "", "ncsa"),
    ("postgresql", "postgresql licen[cs]e", "", "postgresql"),
    ("openssl", "openssl license", "", "openssl license"),
    ("ms-pl", "microsoft public license", "", "microsoft"),
    ("ms-rl", "microsoft reciprocal license", "", "microsoft"),
    ("w3c", "w3c software(?: notice and)? license", "", "w3c"),
    ("mit", "mit license", "", "mit license"),
    ("x11", "x11 license", "", "x11"),
    ("ruby", "ruby license", "", "ruby license"),
    ("beerware", "beer ?ware license", "42", "beer"),
    ("jpl", "jpl image use policy", "", "jpl image"),
)


def _versioned() -> list[Rule]:
    out = []
    for label, name, versions, keyword in _VERSIONED:
        for version in versions.split():
            v = rf"(?:version |v ?|)?{_number(version)}"
            out += [
                Rule(f"{label}-{version}", rf"licensed under (?:the )?(?:terms of the )?{name} {v}(?: the license)?", keyword, GRANT),
                Rule(f"{label}-{version}", rf"{name} {v}", keyword, NAME),
                Rule(f"{label}-{version}-or-later", rf"{name} {v} or (?:any )?later", keyword, GRANT),
                Rule(f"{label}-{version}", rf"spdx license identifier {label.replace('-', ' ')} {version.replace('.', ' ')}", "spdx license identifier", NOTICE),
            ]
        out += [
            Rule(label, rf"licensed under (?:the )?(?:terms of the )?{name}", keyword, NAME),
            Rule(label, name, keyword, MENTION),
            Rule(label, rf"spdx license identifier {label.replace('-', ' ')}", "spdx license identifier", NOTICE),
        ]
    return out


def _notices() -> list[Rule]:
    """Sentences that only one license has."""
    bsd = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    out = [Rule("bsd", bsd, "redistribution and use", NOTICE), Rule("bsd", "bsd(?: style)? license", "bsd", MENTION)]
    for clauses, name in (("0", "zero"), ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four")):
        out += [Rule(f"bsd-{clauses}-clause", rf"(?:bsd )?(?:{clauses}|{name}) clause bsd(?: license)?", "bsd", NAME), Rule(f"bsd-{clauses}-clause", rf"bsd (?:{clauses}|{name}) clause(?: license)?", "bsd", NAME), Rule(f"bsd-{clauses}-clause", rf"spdx license identifier bsd {clauses} clause", "spdx license identifier", NOTICE)]
    return out + [
        Rule("bsd-2-clause", "(?:simplified|freebsd) bsd license", "bsd license", NAME),
        Rule("bsd-3-clause", "(?:new|modified|revised) bsd license", "bsd license", NAME),
        Rule("bsd-4-clause", "(?:original|old) bsd license", "bsd license", NAME),
        Rule("bsd-3-clause", "neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products", "endorse or promote", NOTICE),
        Rule("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge", NOTICE),
        Rule("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee", NOTICE),
        Rule("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "without any express or implied", NOTICE),
        Rule("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software", NOTICE),
        Rule("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache", NOTICE),
        Rule("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", NOTICE),
        Rule("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain", GRANT),
        Rule("reserved", "all rights (?:are )?reserved", "reserved", MENTION),
        Rule("reserved", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})? .{1,60}? all rights reserved", "copyright", GRANT),
        Rule("copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright", MENTION),
        Rule("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary", GRANT),
        Rule("proprietary", "unauthorized (?:copying|reproduction|distribution) of this (?:file|document|work|text) .{0,40}?is (?:strictly )?prohibited", "unauthorized", GRANT),
        Rule("non-commercial", "for non ?commercial (?:use|purposes) only", "commercial", GRANT),
        Rule("no-derivatives", "no derivative works (?:are )?(?:allowed|permitted)", "derivative works", GRANT),
        Rule("reuse-permitted", "reproduction is (?:authori[sz]ed|permitted) provided the source is acknowledged", "reproduction is", GRANT),
    ]


RULES: tuple[Rule, ...] = tuple(sorted({*_gnu(), *_creative_commons(), *_versioned(), *_notices()}, key=lambda r: (-r.priority, r.label, r.pattern)))


@lru_cache(maxsize=1)
def _compiled() -> tuple[ahocorasick.Automaton, list[re.Pattern]]:
    by_keyword: dict[str, list[int]] = {}
    for k, rule in enumerate(RULES):
        by_keyword.setdefault(rule.keyword, []).append(k)
    gate = ahocorasick.Automaton()
    for keyword, rules in by_keyword.items():
        gate.add_word(keyword, tuple(rules))
    gate.make_automaton()
    return gate, [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in RULES]


def normalised(text: str) -> tuple[int, str]:
    """Number of words, and the words with a space around each."""
    words = text.encode().lower().translate(_PLAIN).split()
    return len(words), (b" " + b" ".join(words) + b" ").decode()


def detections(line: str) -> list[tuple[int, int, Rule]]:
    """What the rules find in a normalised text, without what is suppressed; sorted by place."""
    gate, patterns = _compiled()
    tried = {k for _, rules in gate.iter(line) for k in rules}
    if not tried:
        return []
    found = [(m.start(), m.end(), RULES[k]) for k in tried for m in patterns[k].finditer(line)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    return sorted(_not_inside(found), key=lambda d: (d[0], d[1], d[2].label))


def _not_inside(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Keep, in order, what is not contained in an interval kept before.

    The kept intervals that are not inside another stand by start, and so by end: the last one that
    starts at or before a detection has the furthest end of all that do.
    """
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    ends: list[int] = []
    for d in found:
        at = bisect_right(starts, d[0])
        if at and ends[at - 1] >= d[1]:
            continue
        kept.append(d)
        over = bisect_right(ends, d[1], lo=at)  # kept ones of lower priority order that now lie inside
        at -= bool(at and starts[at - 1] == d[0])
        starts[at:over] = [d[0]]
        ends[at:over] = [d[1]]
    return kept


def base_places(line: str) -> list[tuple[int, str]]:
    """``(word, label)`` of every place where the words of a base phrase stand one after the other."""
    at = []
    for phrase, label in BASE.items():
        k = line.find(f" {phrase} ")
        while k >= 0:
            at.append((k, label))
            k = line.find(f" {phrase} ", k + 1)
    out, word, before = [], 0, 0
    for k, label in sorted(at):
        word += line.count(" ", before, k)
        before = k
        out.append((word, label))
    return out


def _scan(batch: pa.RecordBatch) -> dict:
    names = "n_words n_base first_word last_word base_labels labels score n_rules".split()
    rows = []
    for text in texts_of(batch):
        n, line = normalised(text)
        base = base_places(line)
        found = detections(line)
        labels = {label for _, label in base}
        score = max([BASE_WEIGHT * bool(base), *(WEIGHT[d[2].priority] for d in found)])
        rows.append((n, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)), ",".join(sorted(labels | {d[2].label for d in found})), score, len(found)))
    return {"doc_id": batch.column("doc_id")} | {name: [r[k] for r in rows] for k, name in enumerate(names)}


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_rules)``, one row per input row.

    Null and empty texts: no words, no labels, score 0, first and last word null. Ids are passed on, null or repeated; equal rows get
    equal results. Empty table: empty result. Other columns are ignored.
    """
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_rules long"
    )
    return map_batches(id_and_text(docs), _scan, schema)
