import re

from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmart.llm import license_scan as scan
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD


def plain_base(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [
        (i, label)
        for i in range(len(words))
        for phrase, label in scan.BASE_PHRASES
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min((i for i, _ in places), default=None),
        "last_word": max((i for i, _ in places), default=None),
        "base_labels": ",".join(sorted({label for _, label in places})),
    }


PIECES = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "BY-", "GNU ", "\n", ".", " ", "é", "x", "2.0", "sa"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25), st.sampled_from(["", " "]))
def test_base_by_definition(parts, between):
    text = between.join(parts)
    row = scan.scan_text(text.encode())
    assert {k: row[k] for k in plain_base(text)} == plain_base(text)
    assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
    assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])


def test_hundreds_of_rules_that_each_need_a_keyword():
    assert len(scan.rules()) > 300
    assert all(rule.keywords[0] for rule in scan.rules())
    assert [r.priority for r in scan.rules()] == sorted((r.priority for r in scan.rules()), reverse=True)


def test_labels():
    def labels(text):
        return scan.scan_text(text.encode())["labels"]

    assert labels("Licensed under the Apache License, Version 2.0.") == "apache"
    assert labels("the GNU Lesser General Public License version 2.1") == "lgpl"
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert labels("CC BY-NC 4.0") == "cc-by,cc-by-nc"
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy") == "mit"
    for clean in ("a licence to kill", "submit licenses", "I left MIT by noon", "bsd and gpl in one breath", "", "cc: by mail"):
        assert labels(clean) in ("", "cc-by"), clean
    assert labels("I left MIT by noon") == ""


def test_containment_suppression():
    def found(start, end, priority, label="x"):
        return scan.Found(label, start, end, priority, 0.5)

    inner, outer = found(3, 6, 2), found(0, 9, 5)
    assert scan.suppressed([inner, outer]) == [outer]
    assert scan.suppressed([found(3, 6, 9), found(0, 9, 5)]) == [found(3, 6, 9)]
    assert scan.suppressed([found(0, 5, 2), found(4, 9, 2)]) == [found(0, 5, 2), found(4, 9, 2)]
    assert scan.suppressed([found(0, 9, 2, "b"), found(0, 9, 2, "a")]) == [found(0, 9, 2, "a")]
    assert scan.suppressed([]) == []


def test_odd_rows(odd, nothing):
    rows = scan.scanned(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r.asDict() for r in rows}
    for doc_id, text, *_ in ODD:
        assert {k: by_id[doc_id][k] for k in plain_base(text)} == plain_base(text)
    assert by_id[1]["labels"] == "" and by_id[1]["score"] == 0.0
    assert scan.scanned(nothing).count() == 0


def test_registered_query_against_definition(spark, sf_dir):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_license_signatures"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for row in rows:
        assert {k: row[k] for k in plain_base(texts[row.doc_id])} == plain_base(texts[row.doc_id])


def test_spans_stand_where_their_words_do():
    words = b"use the mit license or the apache license version 2 0 or else spdx license identifier mit".split()
    spans = scan.scan_text(b" ".join(words))["spans"]
    said = [(s["label"], b" ".join(words[s["first_word"] : s["first_word"] + s["n_words"]])) for s in spans]
    assert said == [
        ("mit", b"mit license"),
        ("apache", b"apache license version 2 0"),
        ("mit", b"spdx license identifier mit"),
    ]


NOTICES = {
    "gpl": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "lgpl": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License. You should have received a copy of the GNU Lesser General Public License along with it.""",
    "agpl": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "bsd,bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. Neither the name of the University nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. The origin of this software must not be misrepresented; you
        must not claim that you wrote the original software.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "perl": "It is free software; you can redistribute it and/or modify it under the same terms as Perl itself.",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "boost": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license""",
    "mit,apache-or-mit": "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
    "proprietary": "Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential.",
    "wtfpl": "You just DO WHAT THE FUCK YOU WANT TO.",
    "linux-syscall-note": "NOTE! This copyright does *not* cover user programs that use kernel services by normal system calls",
}


def test_labels_of_real_notices():
    for want, text in NOTICES.items():
        row = scan.scan_text(text.encode())
        said = set(row["labels"].split(","))
        assert set(want.split(",")) <= said, (want, said)
        assert row["score"] >= 0.85, want
    assert scan.scan_text(NOTICES["gpl"].encode())["labels"] == "gpl"
    assert scan.scan_text(NOTICES["apache"].encode())["labels"] == "apache"
    assert scan.scan_text(NOTICES["lgpl"].encode())["labels"] == "lgpl"
    assert scan.scan_text(NOTICES["zlib"].encode())["labels"] == "zlib"


def test_a_wider_notice_wins_over_the_name_in_it():
    row = scan.scan_text(NOTICES["agpl"].encode())
    assert [(s["label"], s["first_word"]) for s in row["spans"]] == [("agpl", 0)]


def test_signatures_hold_their_keywords_and_say_one_thing():
    assert len(scan.SIGNATURES) > 150 and len({s[4] for s in scan.SIGNATURES}) == len(scan.SIGNATURES)
    for label, priority, weight, keywords, pattern in scan.SIGNATURES:
        assert re.compile(pattern) and keywords and 5 <= priority <= 9 and 0.5 < weight <= 1, label
        assert not re.search("[A-Z,;()]", re.sub(r"\(\?:|\)|\{\d+,\d+\}|\\d", "", pattern)), pattern


def test_clean_prose_has_no_license():
    for text in (
        "We granted the team permission to use the kitchen and sell cakes.", "The warranty of the car is void.", "Rights and duties.",
        "He licensed a song and distributed copies of the tape.", "Public data, open to all; no fee.", "The Apache helicopter, 2.0 tons.",
    ):
        assert scan.scan_text(text.encode())["labels"] == "", text
