"""License detection with an ordered set of signature rules.

Texts are lower-cased and cut into words; expressions run over the words joined by single blanks, so punctuation and line
breaks never matter. An Aho-Corasick pass over the text finds keywords, and a rule is tried only if all its keywords are
there. Overlapping detections are resolved by priority: one that lies inside a detection of higher or equal priority goes.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame

from lakegauge.llm.common import per_text

#: base phrases and their labels, fixed by contract
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_LIC = "licen[sc]e"
_VER = "(?:version |v |ver )?v?"
#: label: (keywords that must all occur, expression of the name, words of the SPDX tag, words of its address or "")
LICENSES: dict[str, tuple[tuple[str, ...], str, str, str]] = {
    "mit": (("mit",), rf"mit {_LIC}", "mit", "opensource org licenses mit"),
    "apache-1.1": (("apache",), rf"apache (?:software )?{_LIC} {_VER}1 1", "apache 1 1", "apache org licenses license 1 1"),
    "apache-2": (("apache",), rf"apache (?:software )?{_LIC} {_VER}2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    "gpl-1": (("general",), rf"gnu general public {_LIC} {_VER}1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    "gpl-2": (("general",), rf"gnu general public {_LIC} {_VER}2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    "gpl-3": (("general",), rf"gnu general public {_LIC} {_VER}3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    "lgpl-2": (("general",), rf"gnu library general public {_LIC} {_VER}2(?: 0)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    "lgpl-2.1": (("lesser",), rf"gnu lesser general public {_LIC} {_VER}2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    "lgpl-3": (("lesser",), rf"gnu lesser general public {_LIC} {_VER}3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    "agpl-3": (("affero",), rf"gnu affero general public {_LIC} {_VER}3(?: 0)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    "gfdl-1.1": (("documentation",), rf"gnu free documentation {_LIC} {_VER}1 1", "gfdl 1 1(?: only| or later)?", ""),
    "gfdl-1.2": (("documentation",), rf"gnu free documentation {_LIC} {_VER}1 2", "gfdl 1 2(?: only| or later)?", "gnu org licenses old licenses fdl 1 2"),
    "gfdl-1.3": (("documentation",), rf"gnu free documentation {_LIC} {_VER}1 3", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    "bsd-2-clause": (("bsd",), rf"(?:(?:2|two) clause|simplified|freebsd) bsd {_LIC}", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    "bsd-3-clause": (("bsd",), rf"(?:(?:3|three) clause|new|modified|revised) bsd {_LIC}", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    "bsd-4-clause": (("bsd",), rf"(?:(?:4|four) clause|original) bsd {_LIC}", "bsd 4 clause", ""),
    "0bsd": (("bsd",), rf"(?:zero clause|0) bsd {_LIC}", "0bsd", "opensource org licenses 0bsd"),
    "isc": (("isc",), rf"isc {_LIC}", "isc", "opensource org licenses isc"),
    "mpl-1.0": (("mozilla",), rf"mozilla public {_LIC} {_VER}1 0", "mpl 1 0", "mozilla org mpl 1 0"),
    "mpl-1.1": (("mozilla",), rf"mozilla public {_LIC} {_VER}1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    "mpl-2.0": (("mozilla",), rf"mozilla public {_LIC} {_VER}2(?: 0)?", "mpl 2 0", "mozilla org (?:en us )?mpl 2 0"),
    "epl-1.0": (("eclipse",), rf"eclipse public {_LIC} {_VER}1 0", "epl 1 0", "eclipse org legal epl v10"),
    "epl-2.0": (("eclipse",), rf"eclipse public {_LIC} {_VER}2(?: 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    "edl-1.0": (("eclipse",), rf"eclipse distribution {_LIC} {_VER}1 0", "edl 1 0", "eclipse org org documents edl v10"),
    "cddl-1.0": (("cddl",), rf"(?:common development and distribution {_LIC}|cddl) {_VER}1 0", "cddl 1 0", ""),
    "cddl-1.1": (("cddl",), rf"(?:common development and distribution {_LIC}|cddl) {_VER}1 1", "cddl 1 1", ""),
    "cpl-1.0": (("common",), rf"common public {_LIC} {_VER}1 0", "cpl 1 0", "opensource org licenses cpl1 0"),
    "ipl-1.0": (("ibm",), rf"ibm public {_LIC} {_VER}1 0", "ipl 1 0", ""),
    "eupl-1.1": (("european",), rf"european union public {_LIC} {_VER}1 1", "eupl 1 1", ""),
    "eupl-1.2": (("european",), rf"european union public {_LIC} {_VER}1 2", "eupl 1 2", ""),
    "osl-2.1": (("open",), rf"open software {_LIC} {_VER}2 1", "osl 2 1", ""),
    "osl-3.0": (("open",), rf"open software {_LIC} {_VER}3 0", "osl 3 0", "opensource org licenses osl 3 0"),
    "afl-3.0": (("academic",), rf"academic free {_LIC} {_VER}3 0", "afl 3 0", "opensource org licenses afl 3 0"),
    "artistic-1.0": (("artistic",), rf"artistic {_LIC} {_VER}1 0", "artistic 1 0", ""),
    "artistic-2.0": (("artistic",), rf"artistic {_LIC} {_VER}2 0", "artistic 2 0", "opensource org licenses artistic 2 0"),
    "bsl-1.0": (("boost",), rf"boost software {_LIC}(?: {_VER}1 0)?", "bsl 1 0", "boost org license 1 0"),
    "busl-1.1": (("business",), rf"business source {_LIC}(?: {_VER}1 1)?", "busl 1 1", "mariadb com bsl11"),
    "unlicense": (("unlicense",), r"(?:the )?unlicense", "unlicense", "unlicense org"),
    "wtfpl": (("want",), rf"do what the f\w+ you want to public {_LIC}", "wtfpl", "wtfpl net"),
    "zlib": (("zlib",), rf"zlib(?: libpng)? {_LIC}", "zlib", "opensource org licenses zlib"),
    "libpng": (("libpng",), rf"libpng {_LIC}", "libpng", ""),
    "openssl": (("openssl",), rf"openssl {_LIC}", "openssl", "openssl org source license"),
    "psf-2.0": (("python",), rf"python software foundation {_LIC}(?: {_VER}2)?", "(?:psf|python) 2 0", "docs python org 3 license"),
    "php-3.01": (("php",), rf"php {_LIC} {_VER}3 01", "php 3 01", "php net license 3 01"),
    "ruby": (("ruby",), rf"ruby {_LIC}", "ruby", ""),
    "postgresql": (("postgresql",), rf"postgresql {_LIC}", "postgresql", "opensource org licenses postgresql"),
    "ncsa": (("illinois",), rf"university of illinois ncsa open source {_LIC}", "ncsa", "opensource org licenses ncsa"),
    "ms-pl": (("microsoft",), rf"microsoft public {_LIC}", "ms pl", "opensource org licenses ms pl"),
    "ms-rl": (("microsoft",), rf"microsoft reciprocal {_LIC}", "ms rl", "opensource org licenses ms rl"),
    "upl-1.0": (("universal",), rf"universal permissive {_LIC} {_VER}1 0", "upl 1 0", "opensource org licenses upl"),
    "ofl-1.1": (("font",), rf"(?:sil )?open font {_LIC}(?: {_VER}1 1)?", "ofl 1 1", "scripts sil org ofl"),
    "lppl-1.3": (("latex",), rf"latex project public {_LIC}(?: {_VER}1 3c?)?", "lppl 1 3c", "latex project org lppl"),
    "odbl-1.0": (("database",), rf"open database {_LIC}", "odbl 1 0", "opendatacommons org licenses odbl"),
    "odc-by-1.0": (("commons",), rf"open data commons attribution {_LIC}", "odc by 1 0", "opendatacommons org licenses by"),
    "pddl-1.0": (("public",), r"(?:open data commons )?public domain dedication and license", "pddl 1 0", "opendatacommons org licenses pddl"),
    "cc0-1.0": (("cc0",), r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    "cc-by": (("by",), r"(?:cc by|creative commons attribution)(?: \d 0)?(?: international| unported)?(?! nc| nd| sa| noncommercial| non| no| share)", r"cc by \d 0", r"creativecommons org licenses by \d 0"),
    "cc-by-sa": (("by",), r"(?:cc by sa|creative commons attribution share ?alike)(?: \d 0)?", r"cc by sa \d 0", r"creativecommons org licenses by sa \d 0"),
    "cc-by-nd": (("by",), r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: \d 0)?", r"cc by nd \d 0", r"creativecommons org licenses by nd \d 0"),
    "cc-by-nc": (("by",), r"(?:cc by nc|creative commons attribution non ?commercial)(?: \d 0)?(?! sa| nd| share| no)", r"cc by nc \d 0", r"creativecommons org licenses by nc \d 0"),
    "cc-by-nc-sa": (("by",), r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: \d 0)?", r"cc by nc sa \d 0", r"creativecommons org licenses by nc sa \d 0"),
    "cc-by-nc-nd": (("by",), r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: \d 0)?", r"cc by nc nd \d 0", r"creativecommons org licenses by nc nd \d 0"),
}
_SPELLED = "creative commons"
#: the header of source files: label: (keywords, name, version); the version comes behind the publisher
HEADERS: dict[str, tuple[tuple[str, ...], str, str]] = {
    "gpl-1": (("general",), "gnu general", "1(?: 0)?"), "gpl-2": (("general",), "gnu general", "2(?: 0)?"),
    "gpl-3": (("general",), "gnu general", "3(?: 0)?"), "lgpl-2": (("general",), "gnu (?:library|lesser) general", "2(?: 0)?"),
    "lgpl-2.1": (("lesser",), "gnu lesser general", "2 1"), "lgpl-3": (("lesser",), "gnu lesser general", "3(?: 0)?"),
    "agpl-3": (("affero",), "gnu affero general", "3(?: 0)?"),
}
#: short names with a version: label: (keyword, name and version)
_ONLY = r"(?! \d )"
ACRONYMS: dict[str, tuple[str, str]] = {
    "gpl-1": ("gpl", rf"(?:gnu )?gpl {_VER}1(?: 0)?{_ONLY}"), "gpl-2": ("gpl", rf"(?:gnu )?gpl {_VER}2(?: 0)?{_ONLY}"),
    "gpl-3": ("gpl", rf"(?:gnu )?gpl {_VER}3(?: 0)?{_ONLY}"), "lgpl-2": ("lgpl", rf"(?:gnu )?lgpl {_VER}2(?: 0)?{_ONLY}"),
    "lgpl-2.1": ("lgpl", rf"(?:gnu )?lgpl {_VER}2 1"), "lgpl-3": ("lgpl", rf"(?:gnu )?lgpl {_VER}3(?: 0)?{_ONLY}"),
    "agpl-3": ("agpl", rf"(?:gnu )?agpl {_VER}3(?: 0)?{_ONLY}"), "gfdl-1.1": ("fdl", rf"(?:gnu )?g?fdl {_VER}1 1"),
    "gfdl-1.2": ("fdl", rf"(?:gnu )?g?fdl {_VER}1 2"), "gfdl-1.3": ("fdl", rf"(?:gnu )?g?fdl {_VER}1 3"),
    "mpl-1.0": ("mpl", rf"mpl {_VER}1 0"), "mpl-1.1": ("mpl", rf"mpl {_VER}1 1"), "mpl-2.0": ("mpl", rf"mpl {_VER}2(?: 0)?{_ONLY}"),
    "epl-1.0": ("epl", rf"epl {_VER}1 0"), "epl-2.0": ("epl", rf"epl {_VER}2 0"), "eupl-1.1": ("eupl", rf"eupl {_VER}1 1"),
    "eupl-1.2": ("eupl", rf"eupl {_VER}1 2"), "apache-2": ("apache", rf"apache {_VER}2 0"),
    "bsd-2-clause": ("bsd", "(?:bsd (?:2|two) clause|(?:2|two) clause bsd)"),
    "bsd-3-clause": ("bsd", "(?:bsd (?:3|three) clause|(?:3|three) clause bsd)"),
    "bsd-4-clause": ("bsd", "(?:bsd (?:4|four) clause|(?:4|four) clause bsd)"),
}
#: short names written as one word with their version, as in GPLv3
JOINED = {"gpl": ("gpl-1", "gpl-2", "gpl-3"), "lgpl": ("lgpl-2", "lgpl-3"), "agpl": ("agpl-3",), "mpl": ("mpl-2.0",)}
#: families named without a version: label: (keyword, name)
FAMILIES: dict[str, tuple[str, str]] = {
    "gpl": ("gpl", r"(?:gnu )?gpl"), "lgpl": ("lgpl", r"(?:gnu )?lgpl"), "agpl": ("agpl", r"(?:gnu )?agpl"), "mpl": ("mpl", "mpl"),
    "apache": ("apache", f"apache(?: software)? {_LIC}"), "bsd": ("bsd", f"bsd(?: style)? {_LIC}d?"),
    "mit": ("mit", "mit licen[sc]ed"), "artistic": ("artistic", f"artistic {_LIC}"),
}
_NOTICE = "(?:licen[sc]ed|released|distributed|available|published|provided|covered|offered|redistributed) under (?:the |an? )?(?:terms of (?:the )?)?"
#: sentences that only one license has
SENTENCES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-2-clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
    "wtfpl": "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed",
    "apache-2": "you may not use this file except in compliance with the license",
    "bsd-3-clause": r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products",
    "bsd-4-clause": "all advertising materials mentioning features or use of this software must display the following acknowledge?ment",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "gpl-3": "the gnu general public license is a free copyleft license for software and other kinds of works",
    "agpl-3": "the gnu affero general public license is a free copyleft license for software and other kinds of works",
    "bsl-1.0": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation",
    "postgresql": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement",
    "openssl": "this product includes software developed by the openssl project",
    "php-3.01": "this product includes php software freely available from",
    "psf-2.0": "psf is making python available to licensee on an as is basis",
    "lppl-1.3": "this work may be distributed and or modified under the conditions of the latex project public license",
    "cc0-1.0": "the person who associated a work with this deed has dedicated the work to the public domain",
    "all-rights-reserved": "all rights reserved",
    "public-domain": "(?:dedicated|released|placed) (?:in|into|to) the public domain",
}


class Rule(NamedTuple):
    label: str
    form: str
    priority: int                                 # larger wins
    score: float
    keywords: tuple[str, ...]
    pattern: str


def _rules() -> tuple[Rule, ...]:
    """All rules, highest priority first: tag, sentence, notice and header, later-version form, address, bare name; base phrases last.

    A rule with a group ``at`` is placed where that group is; the rest of its expression is context.
    """
    out = []
    tags = "|".join(sorted((t for _, _, t, _ in LICENSES.values()), key=lambda t: (-len(t), t)))
    for label, (keys, name, tag, address) in LICENSES.items():
        if keys == ("by",):
            keys = ("cc",) if name.startswith("(?:cc") else keys
        out.append(Rule(label, "tag", 6, 1.0, ("spdx",), f"spdx licen[sc]e identifier {tag}"))
        out.append(Rule(label, "expression", 6, 1.0, ("spdx",),
                        f"spdx licen[sc]e identifier (?:(?:{tags}) (?:or|and|with) ){{1,8}}(?P<at>{tag})"))
        out.append(Rule(label, "field", 3, 0.9, ("licen",), f"licen[sc]es? (?:is |are )?(?:the )?(?P<at>{tag})"))
        spelled = [(keys, name)]
        if label.startswith("cddl"):
            tail = name[name.index(")") + 1:]
            spelled = [(("cddl",), "cddl" + tail), (("distribution",), f"common development and distribution {_LIC}" + tail)]
        if _SPELLED in name:                      # the short and the spelled form have different keywords
            short, rest = name[3:].split("|creative commons", 1)
            tail = rest[rest.index(")") + 1:] if "deriv" not in rest else rest[rest.rindex("s)") + 2:]
            long = rest[:len(rest) - len(tail) - 1]
            spelled = [(("cc",), short + tail), (("creative",), "creative commons" + long + tail)]
        for k, n in spelled:
            out.append(Rule(label, "notice", 4, 0.95, (*k, "under"), _NOTICE + n))
            out.append(Rule(label, "later", 3, 0.9, (*k, "later"), f"{n} or (?:at your option )?any later version"))
            out.append(Rule(label, "name", 1, 0.7, k, n))
        if address:
            first = address.split(" ")[0]
            out.append(Rule(label, "address", 2, 0.9, (first,), address))
    short = [(label, k, n) for label, (k, n) in ACRONYMS.items()]
    short += [(label, k, f"(?:gnu )?{k}v?{label[len(k) + 1]}{_ONLY}") for k, ls in JOINED.items() for label in ls]
    for label, k, n in short:
        out.append(Rule(label, "notice", 4, 0.95, (k, "under"), _NOTICE + n))
        out.append(Rule(label, "later", 3, 0.9, (k, "later"), f"{n} or (?:at your option )?(?:any )?later(?: version)?"))
        out.append(Rule(label, "acronym", 1, 0.7, (k,), n))
    for label, (k, n) in FAMILIES.items():
        if label in ("gpl", "lgpl", "agpl", "mpl"):
            out.append(Rule(label, "family", 2, 0.6, (k, "under"), rf"{_NOTICE}{n}(?: {_LIC})?(?! v?\d| version)"))
        else:
            out.append(Rule(label, "family", 1, 0.6, (k,), rf"{n}(?! v?\d| version)"))
    for a, b in ((r"(?P<at>mit)", "apache"), ("mit", "(?P<at>apache")):    # a choice of two short names
        name, close = ("apache-2", ")") if b[0] == "(" else ("mit", "")
        tail = rf" {_VER}2(?: 0)?{close}{_ONLY}"
        out.append(Rule(name, "choice", 2, 0.8, ("mit", "apache"), f"{a} (?:or|and) (?:the )?{b}{tail}"))
        out.append(Rule(name, "choice", 2, 0.8, ("mit", "apache"), rf"{b} {_VER}2(?: 0)?{close} (?:{_LIC} )?(?:or|and) (?:the )?{a}"))
    for label, (keys, name, version) in HEADERS.items():
        out.append(Rule(label, "header", 4, 0.95, (*keys, "published"),
                        rf"{name} public {_LIC}(?: [al]?gpl)? as published by the free software foundation(?: inc)?(?: either)? {_VER}"
                        rf"{version}(?! \d )(?: of the {_LIC})?(?: or (?:at your option )?any later version)?"))
    for label, s in SENTENCES.items():
        word = max(re.findall(r"[a-z]+", s), key=len)
        out.append(Rule(label, "sentence", 5, 0.6 if label in ("all-rights-reserved", "public-domain") else 1.0,
                        ("domain",) if label == "public-domain" else (word,), s))
    for phrase, label in PHRASES.items():
        out.append(Rule(label, "base", 0, 0.8, tuple(w for w in phrase.split() if w not in ("under", "the")), phrase))
    return tuple(sorted(out, key=lambda r: -r.priority))


RULES = _rules()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Detection(NamedTuple):
    first: int                                    # words, from 0; last exclusive
    last: int
    label: str
    form: str
    priority: int
    score: float


def detector(rules: tuple[Rule, ...] = RULES) -> Callable[[str], tuple[int, list[Detection], list[Detection]]]:
    """A function from a text to (number of words, base places, detections left after suppression)."""
    automaton = ahocorasick.Automaton()
    keys = sorted({k for r in rules for k in r.keywords})
    for i, k in enumerate(keys):
        automaton.add_word(k, i)
    automaton.make_automaton()
    number = {k: i for i, k in enumerate(keys)}
    ready = [(frozenset(number[k] for k in r.keywords), re.compile(f"(?<= ){r.pattern}(?= )"), r) for r in rules]
    place = {r.pattern: "at" if "(?P<at>" in r.pattern else 0 for r in rules}

    def detect(text: str):
        lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")     # A-Z only
        there = {i for _, i in automaton.iter(lower)}
        open_rules = [(p, r) for need, p, r in ready if need <= there]
        words = _WORD.findall(lower)
        if not open_rules:
            return len(words), [], []
        line, starts, at = f" {' '.join(words)} ", [], 1
        for w in words:
            starts.append(at)
            at += len(w) + 1
        base, found = [], []
        for p, r in open_rules:
            g = place[r.pattern]
            for m in p.finditer(line):
                d = Detection(bisect_right(starts, m.start(g)) - 1, bisect_right(starts, m.end(g) - 1), r.label, r.form,
                              r.priority, r.score)
                (base if r.form == "base" else found).append(d)
        return len(words), base, suppress(found + base)

    return detect


def suppress(found: list[Detection]) -> list[Detection]:
    """Drop detections inside one of higher priority, or of equal priority and greater length; ties keep the first label."""
    rank = {f: i + 1 for i, f in enumerate(sorted({d.first for d in found}))}
    reach = [0] * (len(rank) + 1)                 # Fenwick tree: furthest end of the kept detections that start at or before
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.first - d.last, d.first, d.label)):
        i, far = rank[d.first], 0
        while i > 0:
            far, i = max(far, reach[i]), i & (i - 1)
        if far < d.last:
            kept.append(d)
            i = rank[d.first]
            while i < len(reach):
                reach[i] = max(reach[i], d.last)
                i += i & -i
    return sorted(kept)


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """License findings of every whole text: key, n_words, ``base`` and ``found`` as arrays of structs.

    Null and empty texts have no words and no findings; equal rows give equal results; other columns are dropped.
    """
    row = "array<struct<first:bigint,last:bigint,label:string,form:string,score:double>>"
    def make():
        detect = detector()
        cell = lambda ds: [{"first": d.first, "last": d.last, "label": d.label, "form": d.form, "score": d.score} for d in ds]
        def one(t):
            n, base, found = detect(t)
            return n, cell(base), cell(found)
        return one
    return per_text(docs, key, text, make, f"n_words bigint, base {row}, found {row}")
