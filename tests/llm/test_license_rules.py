"""Keywords never rule out a text that the expression matches, and headers of source files have a label."""

import re
from re import _constants as c
from re import _parser

import pyarrow.parquet as pq
import pytest

from lakegauge.llm import licenses


def forms(tree):
    """All texts of an expression, a character class by its first member, a repetition by its least and greatest count up to one more."""
    out = [""]
    for op, arg in tree:
        if op is c.LITERAL:
            more = [chr(arg)]
        elif op is c.IN:
            more = ["1" if arg[0][1] is c.CATEGORY_DIGIT else "x" if arg[0][0] is c.CATEGORY else chr(arg[0][1])]
        elif op is c.SUBPATTERN:
            more = forms(arg[3])
        elif op is c.BRANCH:
            more = [f for b in arg[1] for f in forms(b)]
        elif op is c.MAX_REPEAT:
            more = [f * n for f in forms(arg[2]) for n in {arg[0], min(arg[1], arg[0] + 1)}]
        else:
            assert op is c.ASSERT_NOT, op
            more = [""]
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_alternative_has_the_keywords():
    for r in licenses.RULES:
        for f in forms(_parser.parse(r.pattern)):
            assert all(k in f for k in r.keywords), (r, f)


def found(text):
    return [(d.label, d.form) for d in licenses.detector()(text)[2]]


def test_cddl_spelled_out():
    assert found("Licensed under the Common Development and Distribution License, Version 1.0") == [("cddl-1.0", "notice")]
    assert found("the CDDL v1.1") == [("cddl-1.1", "name")]


@pytest.mark.parametrize("name,version,label", [
    ("", "2", "gpl-2"), ("", "3", "gpl-3"), ("Lesser ", "2.1", "lgpl-2.1"), ("Lesser ", "2", "lgpl-2"), ("Lesser ", "3", "lgpl-3"),
    ("Library ", "2", "lgpl-2"), ("Affero ", "3", "agpl-3"), ("", "1", "gpl-1")])
def test_gnu_headers(name, version, label):
    head = f" * it under the terms of the GNU {name}General Public License as published by\n * the Free Software Foundation"
    for tail in (f"; either version {version} of the License, or\n * (at your option) any later version.",
                 f"; either version {version}, or (at your option)\n * any later version.", f", version {version} of the License."):
        assert found(head + tail) == [(label, "header")], tail
    assert found(head + "; either version 9 of the License") == []


@pytest.mark.parametrize("text,labels", [
    ("Licensed under GPLv3", "gpl-3"), ("GPL-3.0", "gpl-3"), ("GPL-2.0-or-later", "gpl-2"), ("License: Apache-2.0", "apache-2"),
    ("License: MIT", "mit"), ("a BSD license", "bsd"), ("MIT licensed", "mit"), ("LGPL v2.1", "lgpl-2.1"), ("LGPLv2", "lgpl-2"),
    ("AGPLv3", "agpl-3"), ("MIT or Apache 2", "apache-2,mit"), ("Apache 2.0 or MIT", "apache-2,mit"), ("GNU GPL version 2", "gpl-2"),
    ("released under the GPL", "gpl"), ("under the terms of the new BSD license", "bsd-3-clause"), ("BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH x", "gpl-2"), ("SPDX-License-Identifier: MIT AND (ISC OR Zlib)", "isc,mit,zlib"),
    ("You may not use this file except in compliance with the License.", "apache-2"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("Apache 2.4 serves pages, permit or apache", ""), ("gpl 9", ""), ("the MIT campus", ""), ("MPL 2.0", "mpl-2.0"), ("", "")])
def test_short_forms(text, labels):
    assert ",".join(sorted({label for label, _ in found(text)})) == labels


def test_base_places_against_brute_force():
    """Every place where the words of a base phrase follow each other, in all texts of a table."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    texts += ["Under the MIT license", "apache license, version 2.0 / CC-BY-NC; cc by nc by nc", "CC BY\nNC-SA cc by n", None, "\x7funder\x80the mit"]
    detect, n_found = licenses.detector(), 0
    for t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        want = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(words))
                      if words[i:i + len(p.split())] == p.split())
        n, base, kept = detect(t or "")
        assert (n, sorted((d.first, d.label) for d in base)) == (len(words), want), t
        n_found += len(want)
    assert n_found > 3
