"""The two operators with SQL, on awkward rows, and their own rules."""

from collections import defaultdict

import pytest

from tests.llm.data import documents, frame, in_duck, row, texts, tuples
from wardlake.llm import licenses, mixing
from wardlake.llm.mixing import Mix

ROWS = documents(seed=5)
MIXES = [
    Mix(),
    Mix(max_epochs=1, budget_percent=100),
    Mix({"src0": "web", "src1": "web"}, "rest", {"domain": {"web": 9}, "lang": {"en": 3}, "source": {"src2": 0}}, 2, 150, 3, 5),
    Mix({"src0": "web"}, "rest", {"domain": {"web": 1000}}, 1, 90, 1, 5),
]


@pytest.mark.parametrize("mix", MIXES)
@pytest.mark.parametrize("bucket_rows", [10_000, 3])
def test_mix_equals_its_sql(spark, monkeypatch, mix, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    columns, expected = in_duck(ROWS, mixing.oracle(mix))
    assert tuples(mixing.mix_sources(frame(spark, ROWS), mix), *columns) == expected


def test_mix_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    columns, expected = in_duck(ROWS, mixing.oracle(MIXES[0]))
    assert tuples(mixing.mix_sources(frame(spark, ROWS), MIXES[0]), *columns) == expected


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(frame(spark, []), Mix()).count() == 0


def test_shortage_goes_to_siblings_before_ancestors(spark):
    def many(start, n, lang, source):
        return [row(start + i, "a b c d e f g h i j", lang, source) for i in range(n)]

    rows = many(0, 3, "en", "s1") + many(100, 40, "en", "s2") + many(200, 40, "de", "s3")
    mix = Mix(weights={"lang": {"en": 1, "de": 1}}, budget_percent=50, max_epochs=1)
    budgets = {(r["source"], r["leaf_budget"]) for r in mixing.mix_sources(frame(spark, rows), mix).collect()}
    # 415 words: 207 for each language; s1 has 30 of its 103, and its sibling gets the rest.
    assert budgets == {("s1", 30), ("s2", 177), ("s3", 207)}


def test_taken_rows_keep_their_columns(spark):
    docs, mix = frame(spark, ROWS), MIXES[2]
    taken = mixing.take_mix(docs, mix)
    assert taken.columns == docs.columns
    expected = defaultdict(int)
    for r in mixing.mix_sources(docs, mix).collect():
        expected[r["doc_id"], r["source"]] += r["copies"]
    found = defaultdict(int)
    for r in taken.collect():
        found[r["doc_id"], r["source"] or "(none)"] += 1
    assert found == {k: n for k, n in expected.items() if n}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. In no other case."""
CASES = [
    (1, MIT, "MIT"),
    (2, "Some text\nReleased under the MIT License.\nMore text", "MIT"),
    (3, "Intro. Licensed under the Apache License, Version 2.0. And all rights reserved.", "Apache-2.0"),
    (4, "All rights reserved.\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0|all-rights-reserved"),
    (5, "This is not licensed under anything; the MIT License is long.", ""),
    (6, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.", ""),
    (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.", "GPL-3.0-or-later"),
    (8, "// SPDX-License-Identifier: MIT", "MIT"),
    (9, "x\nSPDX-License-Identifier CC0-1.0\ny", "CC0-1.0"),
    (10, "/* SPDX-License-Identifier: MIT OR Apache-2.0 */\nint x;", "MIT OR Apache-2.0"),
    (11, "This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"),
    (12, "The code in here is available under the terms of the Apache License 2.0. See LICENSE.", "Apache-2.0"),
    (13, "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public "
         "License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any "
         "later version.\n", "GPL-2.0-or-later"),
    (14, "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
         "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
         "any later version.", "LGPL-2.1-or-later"),
    (15, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
         "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
         "later version.", "AGPL-3.0-or-later"),
    (16, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
         "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    (17, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
         "granted, provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
    (18, "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
         "is available at https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
    (19, "This is free and unencumbered software released into the public domain.\n\nAnyone may use it.", "Unlicense"),
    (20, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
         "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list "
         "of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright "
         "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
         "with the distribution.", "BSD-2-Clause"),
    (21, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    (22, "Photos: licensed under CC BY 4.0", "CC-BY-4.0"),
    (23, "Distributed under the BSD 3-Clause License.\nLibrary parts are licensed under the LGPL-2.1.", "BSD-3-Clause"),
    (24, "This text is not licensed under the MIT License, and under the MIT License rules apply.", ""),
]


def test_licenses():
    known = set(licenses.sentence_table().values())
    assert known == {i for names in (licenses.SENTENCES, licenses.NAMES, licenses.SPDX) for i in names}
    assert not [i for _, ids in licenses.RULES for i in ids if i not in known]
    assert all(licenses.one_form(t) == t for t in licenses.sentence_table())


def test_every_short_name_and_line(spark):
    """Each name in a usual sentence, each SPDX line, against the licence that its rule names."""
    of = {ids[0]: name for name, ids in licenses.RULES if len(ids) == 1}
    cases = [(f"Intro.\nThis small tool is released under the terms of the {n} license; enjoy.", of[i]) for i, ns in licenses.NAMES.items() for n in ns]
    cases += [(f"# SPDX-License-Identifier: {n}\nrest", of[i]) for i, ns in licenses.SPDX.items() for n in ns]
    found = licenses.license_scan(frame(spark, [row(k, t) for k, (t, _) in enumerate(cases)]))
    assert {r["doc_id"]: r["licenses"] for r in found.collect()} == {k: e for k, (_, e) in enumerate(cases)}


def test_rules(spark):
    found = licenses.license_scan(frame(spark, [row(i, t) for i, t, _ in CASES]))
    assert {r["doc_id"]: r["licenses"] for r in found.collect()} == {i: e for i, _, e in CASES}
    left = {r["doc_id"]: r["unmatched"] for r in found.collect()}
    assert left[6] == "mit_notice" and left[1] == ""


def test_scan_equals_its_sql(spark):
    rows = [*ROWS, *[row(i, t) for i, t, _ in CASES]]
    columns, expected = in_duck(rows, licenses.oracle())
    assert tuples(licenses.license_scan(frame(spark, rows)), *columns) == expected
    assert licenses.license_scan(frame(spark, [])).count() == 0


def test_every_row_is_scanned(spark):
    found = licenses.license_scan(frame(spark, ROWS))
    assert [r[0] for r in tuples(found, "doc_id")] == sorted((i for i, _ in texts(ROWS)), key=lambda i: repr((i,)))
