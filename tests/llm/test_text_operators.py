"""Decontamination, pseudonyms, fingerprints, sentence spans, licences and pieces against plain restatements."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from shopperflow.llm import decontaminate, duckdb_sql, html_blocks, license_rules, order_minhash, piece_lattice, pseudonyms, sentence_spans
from shopperflow.llm.queries import model_file

from .conftest import edited, prose

# --- decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def hits(text, items):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        v = words(item)
        for k in range(max(1, len(v) - 9) if v else 0):
            window = v[k : k + 10]
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    names |= {str(name)} - {"None"}
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("several", [False, True])
def test_decontamination(spark, docs, monkeypatch, several):
    if several:
        monkeypatch.setattr(decontaminate, "PART_BYTES", 100)
    items = [(10, prose(1, 25)), (9, "one two"), (9, "one two"), (8, "Two, THREE!"), (7, None), (6, "..."), (5, "é x ß"), (None, "alone here"), (4, prose(2, 10))]
    rows = [(1, None), (2, ""), (3, "x " + prose(1, 25).upper() + " y"), (4, "one-two three one two"), (5, "é x ß"), (6, "oneé two"),
            (7, prose(1, 25)[:90]), (8, prose(2, 10) + prose(1, 25)), (8, prose(2, 10) + prose(1, 25)), (9, "alone here"), (10, prose(4, 5000) + " one two")]
    found = decontaminate.automata(spark.createDataFrame(items, "item_id long, text string"))
    assert (len(found) > 1) == several
    out = decontaminate.contaminated(docs(*rows), found)
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect())
    assert got == sorted((i, *hits(t, items)) for i, t in rows)
    assert "score" in out.columns and out.columns.count("n_words") == 1


def test_hit_places_in_the_original_text(spark, docs):
    found = decontaminate.automata(spark.createDataFrame([(1, "two THREE")], "item_id long, text string"))
    row = decontaminate.contaminated(docs((1, "Ä one, Two -- three; four")), found).first()
    assert [("Ä one, Two -- three; four".encode()[s.start : s.stop]).decode() for s in row.hit_spans] == ["Two -- three"]


def test_decontamination_of_nothing(spark, docs):
    none = decontaminate.automata(spark.createDataFrame([], "item_id long, text string"))
    assert [r.contaminated for r in decontaminate.contaminated(docs((1, "a")), none).collect()] == [False]
    assert decontaminate.contaminated(docs(), none).collect() == []


def test_pieces_hold_every_window_once():
    words = [b"w%d" % i for i in range(57)]
    for n in (0, 1, 9, 10, 11, 29, 30, 57):
        pieces = [p.split() for p in decontaminate.pieces_of(words[:n], 10, 20)]
        assert set().union(*(decontaminate.windows_of(p) for p in pieces)) == decontaminate.windows_of(words[:n])
        assert sum(max(1, len(p) - 9) for p in pieces) == (max(1, n - 9) if n else 0)


def test_long_items_in_many_parts(spark, docs, monkeypatch):
    """One item far beyond a part: the same hits, and one part's windows at a time."""
    long = prose(31, 5000, 0)
    words = long.split()
    items = spark.createDataFrame([(1, long), (2, "short one")], "item_id long, text string")
    rows = [(1, " ".join(words[1995:2012])), (2, "a short one b"), (3, " ".join(words[4990:])), (4, " ".join(words[100:109])), (5, None)]
    whole = decontaminate.contaminated(docs(*rows), decontaminate.automata(items)).select("doc_id", "n_hit", "items_sha256").collect()
    monkeypatch.setattr(decontaminate, "PART_BYTES", 8000)
    found = decontaminate.automata(items)
    assert len(found) > 2 and max(len(one.windows) for one in found) <= 2 * decontaminate.PIECE_WINDOWS
    parts = decontaminate.contaminated(docs(*rows), found).select("doc_id", "n_hit", "items_sha256").collect()
    assert sorted(whole) == sorted(parts) and {r.doc_id: r.n_hit for r in whole} == {1: 17, 2: 2, 3: 10, 4: 0, 5: 0}


# --- pseudonyms

VALUES = {
    "email": ["ann.lee@mail.example.org", "A.B+c@x-y.example.com"], "ip": ["10.0.0.255", "255.255.255.255", "0.0.0.0"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005", "3782-822463-10005"], "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "phone": ["+1 (212) 555-0123", "212-555-0123", "+49 30 1234567", "+442071234567"], "ssn": ["078-05-1120", "899-99-9999"],
    "date": ["1999-12-31", "29.02.2004", "31/12/1999", "12/31/1999", "2001/02/03"], "secret": ['token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567', "API_KEY: Zz9Yy8Xx7Ww6Vv5U"],
}


@pytest.mark.parametrize("kind, value", [(k, v) for k, values in VALUES.items() for v in values])
def test_pseudonym_keeps_form_and_goes_back(kind, value):
    tool = pseudonyms.Pseudonyms(b"key")
    new = tool.value(kind, value)
    assert new != value and (kind == "ip" or re.sub(r"\w", "x", new) == re.sub(r"\w", "x", value))
    assert tool.value(kind, new) is not None and tool.value(kind, new, back=True) == value
    text, finds = tool.text(f"so {value}, and")
    assert text == f"so {new}, and" and finds == [(kind, 3, 3 + len(value))]
    assert pseudonyms.Pseudonyms(b"other").value(kind, value) != new


@pytest.mark.parametrize("value", ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "01.2.3.4", "2001-02-29", "1899-12-31", "666-12-3456", "DE88370400440532013000", "0000000000000000", "5 or 6", "token = aaaaaaaaaaaaaaaaaaaaaaaa", "version 1.2.3"])
def test_what_fails_its_check_stays(value):
    assert pseudonyms.Pseudonyms(b"key").text(f"so {value} and") == (f"so {value} and", [])


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 256, 1000])
def test_permutation(size):
    tool = pseudonyms.Pseudonyms(b"key")
    assert sorted(tool.permuted("k", v, size) for v in range(size)) == list(range(size))
    assert all(tool.permuted("k", tool.permuted("k", v, size), size, back=True) == v for v in range(size))


def test_pseudonyms_link_across_documents(docs):
    rows = [(1, "mail ann@example.org now"), (2, "ANN@EXAMPLE.ORG"), (3, None), (4, ""), (5, "nothing here"), (5, "nothing here"), (6, prose(1, 20000) + " 10.1.2.3")]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(docs(*rows), b"key").collect()}
    assert out[1].text.split()[1].upper() == out[2].text and out[3].text is None and out[4].text == "" and out[5].n_private == 0
    assert out[6].n_private == 1 and "10.1.2.3" not in out[6].text and out[1].score == "kept"
    assert pseudonyms.pseudonymised(docs(), b"key").collect() == []


# --- fingerprints


def plain_fingerprint(text):
    grams = order_minhash.numbered_kmers(order_minhash.code_points(text)).tolist()
    out = []
    for sketch in range(64):
        own = sorted((h, i) for i, h in enumerate(grams) if h >> 58 == sketch)[:2]
        value = np.full(1, 0x27D4EB2F165667C5, np.uint64)
        for _, i in sorted((i, i) for _, i in own):
            value = order_minhash.mix(value * np.uint64(0x9FB21C651E98DF25) + np.uint64(grams[i]))
        for _ in range(2 - len(own)):
            value = order_minhash.mix(value * np.uint64(0x9FB21C651E98DF25))
        out.append(int(value[0]) if own else 0)
    return out


@pytest.mark.parametrize("text", ["", "a", "abcdefg", "abcdefgh" * 40, prose(1, 30), prose(2, 3000), "é漢😀" * 9])
def test_fingerprint_is_the_plain_selection(text):
    assert order_minhash.fingerprint(order_minhash.code_points(text)).tolist() == plain_fingerprint(text)


def test_occurrences_count():
    grams = order_minhash.numbered_kmers(order_minhash.code_points("abcdefghabcdefghabcdefgh"))
    assert len(set(grams.tolist())) == len(grams) == 17


@pytest.mark.parametrize("stretch", [2, 3, 1000])
def test_next_document(docs, varied, stretch):
    rows = sorted(((r.doc_id, r.text or "") for r in varied.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for at, (i, t) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        f, g, o = (order_minhash.fingerprint(order_minhash.code_points(x)) for x in (t, new, following))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), order_minhash.said(f), order_minhash.said(g), order_minhash.likeness(f, g), order_minhash.likeness(f, o)))
    got = [tuple(r) for r in order_minhash.fingerprinted(varied, stretch=stretch).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_next_of_few(docs):
    one = order_minhash.fingerprinted(docs((1, "abc"))).first()
    assert (one.n_chars, one.near_next) == (3, 1.0) and one.edited_sha256 == hashlib.sha256(b"aba").hexdigest()
    assert order_minhash.fingerprinted(docs()).collect() == []


def test_order_matters():
    one, two = prose(1, 150), prose(2, 150)
    f, swapped, near = (order_minhash.fingerprint(order_minhash.code_points(t)) for t in (one + two, two + one, edited(one + two, 3, 6)))
    assert order_minhash.likeness(f, near) > order_minhash.likeness(f, order_minhash.fingerprint(order_minhash.code_points(prose(4, 300))))
    assert order_minhash.likeness(f, f) == 1.0


# --- sentence spans


def plain_spans(rows):
    """Kept text by row, by listing all runs."""
    places = {}
    named = sorted({(i is not None, i or 0, t) for i, t in rows if t}, key=lambda r: r[:2])
    for known, i, t in named:
        for h, first, size in sentence_spans.runs(t):
            places.setdefault(h, []).append((known, i, t, first, size))
    gone = {}
    for found in places.values():
        if len(found) > 1:
            least = min((k, i, f) for k, i, _, f, _ in found)
            for k, i, t, first, size in found:
                if (k, i, first) != least:
                    gone.setdefault((i if k else None, t), set()).update(range(first, first + size))
    return [(i, t if not t else "".join(s for k, s in enumerate(sentence_spans.sentences(t)) if k not in gone.get((i, t), ()))) for i, t in rows]


def test_sentence_spans(docs):
    passage = prose(7, 60, 0.15)
    rows = [(1, None), (2, ""), (3, "One. Two. Three."), (4, prose(4, 40) + ". " + passage + " " + prose(5, 40)), (5, prose(6, 30) + ".\n" + passage.upper().lower() + "\n" + prose(8, 30)),
            (6, passage + ". " + passage), (7, prose(9, 50)), (7, prose(9, 50)), (8, prose(11, 6000) + passage), (None, passage), (9, "Er. Er. Er. Er. Er."), (10, "Er. Er. Er. Er. Er.")]
    out = sentence_spans.without_repeats(docs(*rows))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(plain_spans(rows), key=str)
    assert "score" in out.columns and sentence_spans.without_repeats(docs()).collect() == []


def test_sentences_join_to_the_text():
    for text in ["", "a", "A. B!  C?\n\n D", " lead. ", "...", "a.b. c\n", prose(1, 300)]:
        assert "".join(sentence_spans.sentences(text)) == text


def test_long_sentences_need_shorter_runs():
    long = " ".join(f"w{i}" for i in range(60)) + "."
    assert [(f, s) for _, f, s in sentence_spans.runs(long + " Short one.")] == [(0, 1), (0, 2)]


def test_spans_of_any_shape(docs):
    verse = "\n".join(f"line {i}" for i in range(30))
    listed = "\n".join(f"item{i}" for i in range(40))
    two = "This sentence holds seven words in all. And this one holds as many again here."
    unspaced = "\n".join("春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"[i:] for i in range(6))
    joined = "今天天气很好我们去公园散步吧。明天可能会下雨所以要带伞出门！后天再说其他的事情好不好？"
    thai = "\n".join(["สวัสดีครับวันนี้อากาศดีมาก", "พรุ่งนี้ฝนอาจจะตกหนักทั้งวัน", "เราไปเดินเล่นที่สวนกันเถอะ"])
    passages = [verse, listed, two, unspaced, joined, thai]
    rows = [(10 * k + i, f"{prose(10 * k + i, 40)}.\n{p}\n{prose(10 * k + i + 5, 40)}.") for k, p in enumerate(passages) for i in range(2)]
    got = {r.doc_id: r.text for r in sentence_spans.without_repeats(docs(*rows)).collect()}
    for k, p in enumerate(passages):
        assert got[10 * k] == dict(rows)[10 * k]
        assert got[10 * k + 1] == dict(rows)[10 * k + 1].replace(p + "\n", "")


def test_a_run_in_most_texts_and_other_kinds_of_ids(spark):
    """Every text bears one passage; ids are text; the caller has columns with the names used inside."""
    passage = prose(21, 40, 0.2) + ". End."
    rows = [(f"d{i:03}", f"{prose(100 + i, 20, 0)}.\n{passage}\n{prose(300 + i, 20, 0)}.", i, i, "x") for i in range(150)]
    table = spark.createDataFrame(rows, "`doc.id` string, text string, __row int, __covered int, n_removed string")
    got = sentence_spans.without_repeats(table, doc_id="doc.id").collect()
    assert [r.n_removed > 0 for r in sorted(got)] == [False] + [True] * 149
    assert {r["doc.id"]: r.text for r in got} == {d: t if d == "d000" else t.replace(passage + "\n", "") for d, t, *_ in rows}
    assert all(r["__row"] == r["__covered"] == int(r["doc.id"][1:]) for r in got)


def test_single_sentences_count_from_the_words_asked_for(docs):
    line = "one two three four five six seven eight."
    rows = [(i, f"{prose(400 + i, 9, 0)}\n{line}\n{prose(500 + i, 9, 0)}") for i in range(2)]
    assert {r.n_removed for r in sentence_spans.without_repeats(docs(*rows)).collect()} == {0}
    assert {r.doc_id: r.n_removed for r in sentence_spans.without_repeats(docs(*rows), alone=8).collect()} == {0: 0, 1: 1}


def test_runs_cover_every_passage_inside_it():
    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes = rng.choice([1, 2, 5, 11, 14], rng.integers(2, 12))
        text = "\n".join(" ".join(f"w{k}x{i}" for i in range(n)) for k, n in enumerate(sizes))
        places = [(f, f + n) for _, f, n in sentence_spans.runs(text)]
        for a, b in itertools.combinations(range(len(sizes) + 1), 2):
            covered = {k for f, e in places if a <= f and e <= b for k in range(f, e)}
            assert covered == (set(range(a, b)) if b - a > 1 and sizes[a:b].sum() >= 12 else set())


# --- licences


def test_licences(docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    condition = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, None), (2, ""), (3, "Text. Licensed under the Apache License, Version 2.0."), (4, f"{mit}\n\nA line between.\n{condition}"), (5, f"{condition}\n{mit}"),
            (6, "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!"), (7, "released | under | the | mit | license"), (8, "not released under the mit license"),
            (9, prose(1, 9000) + "\nLicensed under CC BY-NC 4.0."), (9, "Released under the MIT License. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.")]
    out = license_rules.scanned(docs(*rows))
    got = sorted((r.doc_id, ",".join(r.licenses), len(r.sentence_ids)) for r in out.collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "Apache-2.0", 1), (4, "MIT", 2), (5, "", 2), (6, "MIT", 1), (7, "MIT", 1), (8, "", 0), (9, "Apache-2.0,MIT", 3), (9, "CC-BY-NC-4.0", 1)]
    assert license_rules.scanned(docs()).collect() == []


def test_each_rule_is_recognised(docs):
    rows = [(k, ".\n".join(license_rules.SENTENCES[i] for i in ids)) for k, (_, ids) in enumerate(license_rules.RULES)]
    got = {r.doc_id: r.licenses for r in license_rules.scanned(docs(*rows)).collect()}
    assert all(name in got[k] for k, (name, _) in enumerate(license_rules.RULES))


APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software"""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
LGPL = GPL.replace("This program", "This library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
BSD = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
ASF = """Licensed to the Apache Software Foundation (ASF) under one
or more contributor license agreements.  See the NOTICE file
distributed with this work for additional information
regarding copyright ownership.  The ASF licenses this file
to you under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance
with the License.  You may obtain a copy of the License at"""
ECL = APACHE.replace("Apache License", "Educational Community License").replace("http://www.apache.org/licenses/LICENSE-2.0", "http://opensource.org/licenses/ECL-2.0")


def test_wrapped_licences(docs):
    headers = [(APACHE, "Apache-2.0"), (MIT, "MIT"), (GPL, "GPL-3.0"), (LGPL, "LGPL-2.1"), (GPL.replace("GNU General Public License as", "GNU Affero General Public License as"), "AGPL-3.0"),
               (BSD, "BSD"), (MPL, "MPL-2.0"), (ASF, "Apache-2.0"), (ECL, ""), (prose(5, 30, 0) + "\nReleased under\nthe MIT License\n" + prose(6, 30), "MIT"),
               ("Released under\n\nthe MIT License", ""), ("Not\nreleased under the MIT License yet", ""), ("Released under. the MIT License", "")]
    marks = [("", "\n"), (" * ", "\n"), ("# ", "\n"), ("// ", "\r\n"), ("    ", " \n")]
    rows = [(len(marks) * k + j, end.join(mark + line for line in text.split("\n"))) for k, (text, _) in enumerate(headers) for j, (mark, end) in enumerate(marks)]
    got = {r.doc_id: ",".join(r.licenses) for r in license_rules.scanned(docs(*rows)).collect()}
    assert [got[i] for i in range(len(rows))] == [name for _, name in headers for _ in marks]


GRANT = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
THIRD = "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission."
DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\n"
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED. More words follow."
)
NOTICES = [
    ("This project is licensed under the terms of the MIT license.", "MIT"), ("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"),
    ("SPDX-License-Identifier: MIT-0", ""), ("Distributed under the Boost Software License, Version 1.0.\n(See the file)", "BSL-1.0"),
    (GRANT + "\n\n1. Keep.\n\n2. Show.\n\n" + DISCLAIMER, "BSD,BSD-2-Clause"), (GRANT + "\n\n1. Keep.\n\n" + THIRD + "\n\n" + DISCLAIMER, "BSD,BSD-3-Clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
    ("Licensed under the Apache License, Version 2.0. Released under\nthe MIT License", "Apache-2.0,MIT"),
]


def test_notices_tags_and_clauses(docs):
    got = {r.doc_id: ",".join(r.licenses) for r in license_rules.scanned(docs(*((k, t) for k, (t, _) in enumerate(NOTICES)))).collect()}
    assert [got[k] for k in range(len(NOTICES))] == [name for _, name in NOTICES]


def test_licence_sql_joins_lines_as_the_code_does(docs):
    texts = [APACHE, MIT, GPL, LGPL, BSD, MPL, ASF, ECL, None, "", "\n\n", "MIT License\nMIT License", "Licensed under the MIT license\nsee", "This project is licensed under\nthe MIT license\n see the LICENSE\nfile for details"]
    texts += [t for t, _ in NOTICES] + [t.replace("\n", "\r\n # ") for t, _ in NOTICES] + ["\n".join(t for t, _ in NOTICES)]
    table = docs(*enumerate(texts)).select("doc_id", "text")
    found = license_rules.scanned(table).collect()
    with duckdb.connect() as connection:
        connection.register("documents", pa.Table.from_pylist([r.asDict() for r in table.collect()]))
        stated = connection.execute(duckdb_sql.OP9).fetchall()
    assert sorted(stated) == sorted((r.doc_id, len(r.sentence_ids), ",".join(r.sentence_ids), ",".join(r.licenses)) for r in found)


# --- pieces


@pytest.fixture(scope="module")
def vocabulary():
    return piece_lattice.Pieces(model_file())


def all_paths(model, text):
    raw, form = " " + text, (" " + text).replace("▁", "\0").replace(" ", "▁")

    def go(at):
        if at == len(form):
            yield 0, ()
            return
        steps = [(n, model.ids[form[at : at + n]]) for n in range(1, model.longest + 1) if at + n <= len(form) and form[at : at + n] in model.ids]
        steps = [(n, score, (i,)) for n, (i, score) in steps]
        if not any(n == 1 for n, _, _ in steps):
            steps.append((1, model.unknown, tuple(model.bytes[b] for b in raw[at].encode())))
        for n, score, ids in steps:
            for rest, tail in go(at + n):
                yield score + rest, ids + tail

    return sorted(go(0), key=lambda p: -p[0])


@pytest.mark.parametrize("text", ["hello wor", "a  bb c", "the in", "é漢x", "▁a b", "\n\tz", " ", "ab ab ab", "\0", "😀 ok\nno"])
def test_n_best_segmentations(vocabulary, text):
    paths = all_paths(vocabulary, text)
    got = vocabulary.n_best(text, 4)
    assert [s for s, _ in got] == [s for s, _ in paths[:4]]
    assert len({tuple(i) for _, i in got}) == len(got) and all((s, tuple(i)) in paths for s, i in got)
    assert all(vocabulary.decode(i) == text for _, i in got)


def test_pieces_round_trip(docs, varied):
    extra = docs((500, "▁▁ a▁b  "), (501, "tab\tnew\r\nline  end "), (502, "漢字😀" * 500), (503, "Straße ñandú œuvre"), (504, "a" * 5000))
    rows = varied.unionByName(extra)
    out = piece_lattice.encoded(rows, model_file())
    texts = {(r.doc_id, r.text) for r in rows.collect()}
    back = piece_lattice.decoded(out, model_file()).collect()
    assert all((r.doc_id, r.decoded) in texts or (r.decoded == "" and (r.doc_id, None) in texts) for r in back) and len(back) == rows.count()
    assert all(r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest() and r.n_pieces == len(r.ids) for r in back)
    assert all(list(r.scores) == sorted(r.scores, reverse=True) for r in back)
    assert piece_lattice.encoded(docs(), model_file()).collect() == []


def test_units_at_once_equal_units_alone(vocabulary):
    for text in (prose(1, 60), "Straße\nñandú  œuvre 漢 x", "w" * 70):
        ids, scores, _ = vocabulary.best([text], 3)[0]
        assert (scores[0], ids.tolist()) == vocabulary.n_best(text, 1)[0]
        alone = [vocabulary.unit(u, 1)[0] for u in piece_lattice._UNIT.findall(" " + text)]
        assert ids.tolist() == list(itertools.chain.from_iterable(i for _, i in alone)) and scores[0] == sum(s for s, _ in alone)


def test_quotes_without_an_equals_sign_open_no_value():
    page = "<body><div data-x=don't><p>Lost text here?</p><div data-y=can't><p>End.</p></div></div></body>"
    assert [b.text for b in html_blocks.blocks(page)] == ["Lost text here?", "End."]
    page = '<p title="a > b" data-q = \'c > "d"\'>Seen.</p><p title="open>Still seen.</p><p>Last.</p>'
    assert "Seen." in " ".join(b.text for b in html_blocks.blocks(page)) and "Last." in " ".join(b.text for b in html_blocks.blocks(page))


def test_hidden_elements_inside_lines():
    page = "<p>One <span hidden>unseen <span>deep</span></span>two <b aria-hidden='true'>not</b> <i style='display:none'>nor</i> <em>three</em>.</p>"
    assert [b.text for b in html_blocks.blocks(page)] == ["One two three ."] or [b.text for b in html_blocks.blocks(page)] == ["One two three."]
