from __future__ import annotations

import random

import pytest

from duelframe.llm import licences
from duelframe.llm.common import ship
from duelframe.llm.queries import QUERIES
from tests.llm.rows import ROWS, edges, nothing


def plain(text: str) -> tuple:
    """Base columns, comparing each place with each phrase."""
    words, word = [], ""
    for c in text + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or c > "\x7f":
            word += c
        else:
            words += [word] if word else []
            word = ""
    places = [(i, label) for i in range(len(words)) for phrase, label in licences.BASE.items() if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_random_texts_as_by_hand():
    rng = random.Random(6)
    parts = ["mit", "MIT", "license", "License.", "apache", "general", "public", "gnu", "lesser", "é", " ", "-", "mit-license", "x", "\n", "cc by", "0"]
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "-", "", ", "]) for _ in range(rng.randrange(0, 40)))
        assert licences.scan_text(text)[:5] == plain(text), text


@pytest.mark.parametrize(
    ("expression", "ways"),
    [
        ("MIT", [{"mit"}]),
        ("MIT OR Apache-2.0", [{"apache-2.0"}, {"mit"}]),
        ("(MIT OR BSD-3-Clause) AND ISC", [{"bsd-3-clause", "isc"}, {"isc", "mit"}]),
        ("MIT OR BSD-3-Clause AND ISC", [{"mit"}, {"bsd-3-clause", "isc"}]),
        ("GPL-2.0-only WITH Classpath-exception-2.0", [{"gpl-2.0-only", "with:classpath-exception-2.0"}]),
        ("MIT */ int x;", [{"mit"}]),
        ("(MIT", [{"mit"}]),
        ("MIT AND", [{"mit"}]),
        ("MIT) OR ISC", [{"isc"}, {"mit"}]),
        ("", []),
        ("AND OR", []),
        ("MIT is what we use", [{"mit"}]),
    ],
)
def test_expressions(expression, ways):
    assert licences.alternatives(expression) == [frozenset(w) for w in ways]


def test_many_alternatives_keep_every_licence():
    named = lambda n: " AND ".join(f"(a{i} OR b{i})" for i in range(n))
    assert len(licences.alternatives(named(10))) == 1024
    assert set(licences.identifiers(named(200))) == {f"{x}{i}" for x in "ab" for i in range(200)}
    assert licences.openness(named(200)) == (0.0, 1.0)


def test_labels_and_scores():
    scan = lambda text: licences.scan_text(text)[4:7]
    assert scan("Released under the MIT License.") == ("mit", "mit", 1.0)
    assert scan("SPDX-License-Identifier: GPL-2.0-only OR MIT\ncode") == ("", "gpl,mit", 1.0)
    assert scan("SPDX-License-Identifier: GPL-2.0-only AND MIT") == ("", "gpl,mit", 0.5)
    assert scan("Licensed under CC BY-NC 4.0. All rights reserved.") == ("", "cc,cc-nc,reserved", 0.0)
    assert scan("GNU Lesser General Public License") == ("gpl", "gpl,lgpl", 0.5)
    assert scan("no notice") == ("", "", 0.0)


def test_table_and_edge_rows(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op10_licences"](spark, folder).collect():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    ship(spark)
    rows = licences.scan(edges(spark)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in rows) == sorted((str(r[0]), plain(r[1] or "")[0]) for r in ROWS)
    assert licences.scan(nothing(spark)).count() == 0


def test_long_expressions_score_by_their_most_open_alternative():
    score = lambda expression: licences.scan_text(f"SPDX-License-Identifier: {expression}")[6]
    assert score(" AND ".join(f"(GPL-{i}.0 OR MIT-{i})" for i in range(12))) == 1.0
    assert score(" AND ".join([f"(GPL-{i}.0 OR MIT-{i})" for i in range(12)] + ["MPL-2.0"])) == 0.5
    rng = random.Random(9)
    for _ in range(200):
        parts = [f"({' OR '.join(rng.choices(['MIT', 'GPL-2.0-only', 'CC-BY-NC-4.0', 'ISC WITH x'], k=rng.randrange(1, 4)))})" for _ in range(rng.randrange(1, 5))]
        text = "".join(p + rng.choice([" AND ", " OR "]) for p in parts)
        ways = [[licences.OPENNESS[licences.family(x)] for x in way if not x.startswith("with:")] for way in licences.alternatives(text)]
        assert licences.openness(text) == (max(map(min, ways)),) * 2, text


def test_unknown_identifiers_are_labels_and_differ_from_no_notice():
    scan = lambda text: licences.scan_text(f"SPDX-License-Identifier: {text}")[4:8]
    for name in ("Zlib", "0BSD", "EUPL-1.2", "Artistic-2.0", "CDDL-1.0", "LicenseRef-own", "MITRE-X", "ISCX", "GPLX-1"):
        assert scan(name) == ("", name.lower(), 0.0, 1.0)
    assert scan("Zlib OR MIT") == ("", "mit,zlib", 1.0, 1.0)
    assert scan("Zlib AND MIT") == ("", "mit,zlib", 0.0, 1.0)
    assert scan("Zlib OR GPL-2.0-only") == ("", "gpl,zlib", 0.5, 1.0)
    assert scan("Zlib\nAll rights reserved.") == ("", "reserved,zlib", 0.0, 0.0)
    assert scan("GPL-2.0-only WITH Classpath-exception-2.0") == ("", "gpl", 0.5, 0.5)
    assert licences.scan_text("no notice")[4:8] == ("", "", 0.0, 0.0)


def test_prose_after_a_tag_names_no_licence():
    scan = lambda text: licences.scan_text(text)[4:8]
    for text in ("SPDX-License-Identifier: see LICENSE", "the SPDX-License-Identifier: line must be there", "SPDX-License-Identifier: none", "SPDX-License-Identifier: Read the file", "SPDX-License-Identifier:", "SPDX-License-Identifier: <id>"):
        assert scan(text) == ("", "", 0.0, 0.0), text
    assert scan("SPDX-License-Identifier: MIT, as the file says") == ("", "mit", 1.0, 1.0)
    for text in ("Zlib */", "(Zlib)", "Zlib -->", 'Zlib"', "(Zlib OR Zlib)  # x"[:16]):
        assert scan(f"SPDX-License-Identifier: {text}") == ("", "zlib", 0.0, 1.0), text


@pytest.mark.parametrize(("name", "label"), [("mit", "mit"), ("mit-0", "mit"), ("apache-2.0", "apache"), ("apache2", "apache"), ("gplv3", "gpl"), ("gpl-2.0+", "gpl"), ("lgpl-2.1-only", "lgpl"), ("bsd-3-clause", "bsd"), ("bsdx", None), ("mitre", None), ("cc0-1.0", "cc0"), ("cc-by-nc-4.0", "cc-nc"), ("cc-by-4.0", "cc"), ("iscx", None)])
def test_families(name, label):
    assert licences.family(name) == label


def test_scores_are_never_null(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "SPDX-License-Identifier: Zlib"), (2, "none"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"], r["score_most"]) for r in licences.scan(docs).collect()}
    assert found == {1: ("zlib", 0.0, 1.0), 2: ("", 0.0, 0.0), 3: ("", 0.0, 0.0)}
