"""Operator 10: licence scans by sentence rules. DataFrame functions only.

A text is cut into sentences, each is normalised (A to Z lower-cased, everything but letters a to z
and digits to one space, "this project is released under the terms of the X license, see the LICENSE file"
to "licensed under X"), and known licence sentences become identifiers. The colon of an SPDX line does not cut it. The sequence of identifiers is
then matched against ordered rules, each a sequence of identifiers that must follow one another; a
rule that matches takes its sentences away from the rules behind it. Known sentences that no rule
takes are reported as such.

Texts are read twice, since licences are wrapped at line ends and also stand in single
lines: with line ends as spaces, cut behind a full stop; and cut at line ends as well. A
licence counts if either reading shows it.

All of it happens inside a row: no shuffle, no join, and a document of any length is one array of sentences.

Defined cases: NULL and empty texts hold no sentence; repeated rows each give a row;
a NULL id stays NULL; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.common import ascii_lower, id_and_text

# Sentences of public licences, normalised.
SENTENCES = {
    "mit_short": [
        "released under the mit license", "licensed under the mit license", "this project is licensed under the mit license",
        "distributed under the mit license", "spdx license identifier mit",
    ],
    "mit_grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ],
    "mit_notice": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the software",
    ],
    "as_is": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ],
    "no_liability": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ],
    "apache_short": [
        "licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
        "released under the apache license version 2 0", "spdx license identifier apache 2 0",
    ],
    "apache_comply": ["you may not use this file except in compliance with the license"],
    "apache_copy": [
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may obtain a copy of the license at",
    ],
    "apache_basis": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "apache_see": [
        "see the license for the specific language governing permissions and limitations under the license",
    ],
    "gpl3_short": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3", "released under the gnu general public license version 3",
        "spdx license identifier gpl 3 0 only", "spdx license identifier gpl 3 0 or later",
    ],
    "gpl2_short": [
        "licensed under the gnu general public license version 2", "spdx license identifier gpl 2 0 only",
        "spdx license identifier gpl 2 0 or later",
    ],
    "gpl_free": ["this program is free software"],
    "gpl3_terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
    ],
    "gpl2_terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 2 of the license or at your option any later version",
    ],
    "gpl_warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty",
    ],
    "gpl_implied": [
        "without even the implied warranty of merchantability or fitness for a particular purpose",
    ],
    "gpl_see": ["see the gnu general public license for more details"],
    "bsd_grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ],
    "bsd_names": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "cc_by_nc": [
        "licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "spdx license identifier cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc_by_sa": [
        "licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0", "spdx license identifier cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc_by": [
        "licensed under cc by 4 0", "this work is licensed under cc by 4 0", "spdx license identifier cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "cc0": ["this work is dedicated to the public domain", "spdx license identifier cc0 1 0", "licensed under cc0 1 0"],
    "reserved": ["all rights reserved"],
    "gpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation",
    ],
    "lgpl_free": ["this library is free software"],
    "lgpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation",
    ],
    "lgpl21_terms": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 2 1 of the license or at your option any later version",
    ],
    "lgpl3_terms": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ],
    "agpl_terms": [
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ],
    "either_2": ["either version 2 of the license or at your option any later version"],
    "either_21": ["either version 2 1 of the license or at your option any later version"],
    "either_3": ["either version 3 of the license or at your option any later version"],
    "mpl_terms": [
        "this source code form is subject to the terms of the mozilla public license v",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "this source code form is subject to the terms of the mozilla public license version 2 0",
    ],
    "mpl_copy": [
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ],
    "isc_grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "unlicense_free": ["this is free and unencumbered software released into the public domain"],
    "unlicense_any": [
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as "
        "a compiled binary for any purpose commercial or non commercial and by any means",
    ],
}

# How licences are called behind "licensed under" (without "the" before and "license" behind).
NAMES = {
    "mit_short": ["mit", "expat"],
    "apache_short": ["apache 2 0", "apache license 2 0", "apache license version 2 0", "apache version 2 0", "apache 2"],
    "gpl3_short": ["gpl 3 0", "gplv3", "gpl v3", "gnu gpl v3", "gnu gplv3", "gnu general public license v3 0"],
    "gpl2_short": ["gpl 2 0", "gplv2", "gpl v2", "gnu gpl v2", "gnu gplv2", "gnu general public license v2 0"],
    "lgpl3_short": ["lgpl 3 0", "lgplv3", "lgpl v3", "gnu lesser general public license version 3", "gnu lesser general public license v3 0"],
    "lgpl21_short": ["lgpl 2 1", "lgplv2 1", "lgpl v2 1", "gnu lesser general public license version 2 1", "gnu lesser general public license v2 1"],
    "agpl3_short": ["agpl 3 0", "agplv3", "agpl v3", "gnu affero general public license version 3", "gnu affero general public license v3 0"],
    "mpl_short": ["mpl 2 0", "mozilla public license 2 0", "mozilla public license version 2 0", "mozilla public license v2 0"],
    "epl_short": [
        "epl 2 0", "eclipse public license 2 0", "eclipse public license version 2 0", "eclipse public license v2 0",
        "eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    ],
    "isc_short": ["isc"],
    "bsd2_short": ["bsd 2 clause", "2 clause bsd", "simplified bsd"],
    "bsd3_short": ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd"],
    "cc_by": ["cc by 4 0", "creative commons attribution 4 0"],
    "cc_by_sa": ["cc by sa 4 0", "creative commons attribution sharealike 4 0"],
    "cc_by_nc": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0"],
    "cc0": ["cc0", "cc0 1 0", "cc0 1 0 universal"],
    "unlicense_short": ["unlicense"],
    "mit_or_apache": ["mit or apache 2 0", "apache 2 0 or mit"],
}
# What SPDX lines call them.
SPDX = {
    "mit_short": ["mit"],
    "apache_short": ["apache 2 0"],
    "gpl3_short": ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"],
    "gpl2_short": ["gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"],
    "lgpl3_short": ["lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"],
    "lgpl21_short": ["lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"],
    "agpl3_short": ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"],
    "mpl_short": ["mpl 2 0"],
    "epl_short": ["epl 2 0"],
    "isc_short": ["isc"],
    "bsd2_short": ["bsd 2 clause"],
    "bsd3_short": ["bsd 3 clause"],
    "cc_by": ["cc by 4 0"],
    "cc_by_sa": ["cc by sa 4 0"],
    "cc_by_nc": ["cc by nc 4 0"],
    "cc0": ["cc0 1 0"],
    "unlicense_short": ["unlicense"],
    "mit_or_apache": ["mit or apache 2 0", "apache 2 0 or mit"],
}

# Ordered rules: a licence and the sentences that must follow one another.
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "as_is", "no_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "as_is"]),
    ("MIT-partial", ["mit_grant", "mit_notice"]),
    ("MIT-partial", ["mit_grant"]),
    ("Apache-2.0", ["apache_short", "apache_comply", "apache_copy", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_short", "apache_comply"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_terms", "gpl_warranty", "gpl_implied", "gpl_see"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_terms"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_terms", "gpl_warranty", "gpl_implied", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_terms"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms", "either_3"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms", "either_2"]),
    ("LGPL-3.0-or-later", ["lgpl_free", "lgpl3_terms"]),
    ("LGPL-3.0-or-later", ["gpl_free", "lgpl3_terms"]),
    ("LGPL-3.0-or-later", ["lgpl_free", "lgpl_terms", "either_3"]),
    ("LGPL-2.1-or-later", ["lgpl_free", "lgpl21_terms"]),
    ("LGPL-2.1-or-later", ["lgpl_free", "lgpl_terms", "either_21"]),
    ("AGPL-3.0-or-later", ["gpl_free", "agpl_terms"]),
    ("MPL-2.0", ["mpl_terms", "mpl_copy"]),
    ("ISC", ["isc_grant"]),
    ("Unlicense", ["unlicense_free", "unlicense_any"]),
    ("Unlicense", ["unlicense_free"]),
    ("MIT", ["mit_short"]),
    ("Apache-2.0", ["apache_short"]),
    ("GPL-3.0", ["gpl3_short"]),
    ("GPL-2.0", ["gpl2_short"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC0-1.0", ["cc0"]),
    ("LGPL-3.0", ["lgpl3_short"]),
    ("LGPL-2.1", ["lgpl21_short"]),
    ("AGPL-3.0", ["agpl3_short"]),
    ("MPL-2.0", ["mpl_short"]),
    ("EPL-2.0", ["epl_short"]),
    ("ISC", ["isc_short"]),
    ("BSD-2-Clause", ["bsd2_short"]),
    ("BSD-3-Clause", ["bsd3_short"]),
    ("Unlicense", ["unlicense_short"]),
    ("MIT OR Apache-2.0", ["mit_or_apache"]),
    ("all-rights-reserved", ["reserved"]),
]
TAKEN = "<>"  # stands where a rule took sentences, so that those around it do not meet

# The sentence ends (and, in the second reading, line ends) at which texts are cut.
SPACE = r"[\x20\x09-\x0D]"
READINGS = ((r"([.!?;:])" + SPACE + "+", SPACE + r"*[\n\r]" + SPACE + r"*[\n\r]" + SPACE + "*"), (r"([.!?;:])" + SPACE + "+", r"[\n\r]+"))


# The colon of an SPDX line does not end its sentence.
SPDX_COLON = r"spdx-license-identifier:"
# Normalised sentences that hold one of these are brought to one form: the tail goes, and what
# stands around the name of a licence.
HINTS = ("under ", "see the license")
TAIL = (
    r" (?:please )?see (?:the )?(?:accompanying )?(?:file )?licen[sc]e(?: md| txt)?(?: file)?"
    r"(?: in the [a-z ]*)?(?: for (?:more |full |further )?(?:details|information))?$"
)
LEAD = (
    r"^(?:(?:this|the) (?:[a-z0-9]+ ){1,5}(?:is|are) )?(?:licensed|released|distributed|published|available|made available) "
    r"under (?:the terms (?:and conditions )?of )?(?:the |an? )?(.*?)(?: international| the)?(?: licen[sc]e)?$"
)


def one_form(sentence: str) -> str:
    """A known sentence in the form in which normalised sentences are looked up."""
    if not any(hint in sentence for hint in HINTS):
        return sentence
    return re.sub(LEAD, r"licensed under \1", re.sub(TAIL, "", sentence))


def sentence_table() -> dict[str, str]:
    """Each known sentence and its identifier."""
    called = {f"licensed under {n}": i for i, names in NAMES.items() for n in names}
    lines = {f"spdx license identifier {n}": i for i, names in SPDX.items() for n in names}
    return {one_form(t): i for i, texts in SENTENCES.items() for t in texts} | called | lines


def _pattern(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def known_sentences(sentences: Column) -> Column:
    """The sentences' identifiers in order, as one string."""
    table = F.create_map(*[F.lit(x) for text, name in sentence_table().items() for x in (text, f"<{name}>")])
    plain = F.transform(sentences, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))

    def formed(s: Column) -> Column:
        hinted = F.contains(s, F.lit(HINTS[0])) | F.contains(s, F.lit(HINTS[1]))
        return F.when(hinted, F.regexp_replace(F.regexp_replace(s, TAIL, ""), LEAD, "licensed under $1")).otherwise(s)

    found = F.transform(F.transform(plain, formed), lambda s: table[s])
    return F.array_join(F.filter(found, lambda i: i.isNotNull()), "")


def identifiers(text: Column) -> Column:
    """Both readings of a text as one string of identifiers, a mark between them."""
    lower, read = F.replace(ascii_lower(text), F.lit(SPDX_COLON), F.lit(SPDX_COLON[:-1] + " ")), []
    for ends, breaks in READINGS:
        cut = F.regexp_replace(F.regexp_replace(lower, breaks, "\u0001"), ends, "$1\u0001")
        read.append(known_sentences(F.split(cut, "\u0001")))
    return F.when(F.concat(*read) == "", F.lit("")).otherwise(F.concat(read[0], F.lit(TAKEN), read[1]))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences (known ones in the second reading), the licences in the order of
    the rules, and, sorted, the known sentences that no rule took."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", identifiers(F.col("text")).alias("ids"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_pattern(ids)).alias("ids")) for name, ids in RULES])
    empty = F.struct(F.col("ids").alias("rest"), F.array().cast("array<string>").alias("found"), F.lit("").alias("taken"))

    def match(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit(TAKEN))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
            F.when(hit, F.concat(state["taken"], rule["ids"])).otherwise(state["taken"]).alias("taken"),
        )

    done = rows.withColumn("done", F.when(F.col("ids") != "", F.aggregate(rules, empty, match)))

    def free(i: Column) -> Column:
        # What one reading gave to a rule is not left over in the other.
        return (i != "") & ~F.contains(F.col("done.taken"), F.concat(F.lit("<"), i, F.lit(">")))

    second = F.element_at(F.split("ids", TAKEN), -1)
    left = F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace("done.rest", "[<>]+", " "), " "), free)))
    return done.select(
        "doc_id",
        (F.length(second) - F.length(F.replace(second, F.lit("<"), F.lit("")))).cast("long").alias("n_sentences"),
        F.coalesce(F.array_join(F.array_distinct("done.found"), "|"), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(left, "|"), F.lit("")).alias("unmatched"),
    )


def oracle() -> str:
    """The same scan as DuckDB SQL: a step for each rule."""
    table = ", ".join(f"'{text}': '<{name}>'" for text, name in sentence_table().items())
    hinted = " OR ".join(f"contains(s, '{hint}')" for hint in HINTS)
    formed = rf"CASE WHEN {hinted} THEN regexp_replace(regexp_replace(s, '{TAIL}', ''), '{LEAD}', 'licensed under \1') ELSE s END"

    def reading(ends: str, breaks: str) -> str:
        cut = rf"regexp_replace(regexp_replace(lower, '{breaks}', chr(1), 'g'), '{ends}', '\1' || chr(1), 'g')"
        plain = f"list_transform(string_split({cut}, chr(1)), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))"
        return f"coalesce(array_to_string(list_filter(list_transform(list_transform({plain}, lambda s: {formed}), lambda s: known[s]), lambda i: i IS NOT NULL), ''), '')"

    steps = []
    for k, (name, ids) in enumerate(RULES):
        p = _pattern(ids)
        steps.append(
            f"r{k + 1} AS (SELECT doc_id, n_sentences, replace(rest, '{p}', '{TAKEN}') AS rest, "
            f"CASE WHEN contains(rest, '{p}') AND NOT list_contains(found, '{name}') THEN list_append(found, '{name}') "
            f"ELSE found END AS found, CASE WHEN contains(rest, '{p}') THEN taken || '{p}' ELSE taken END AS taken FROM r{k})"
        )
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    lower = f"replace({lower}, '{SPDX_COLON}', '{SPDX_COLON[:-1]} ')"
    return (
        f"WITH l AS (SELECT doc_id, {lower} AS lower, MAP {{{table}}} AS known FROM documents), "
        f"b AS (SELECT doc_id, {reading(*READINGS[0])} AS one, {reading(*READINGS[1])} AS two FROM l), "
        f"r0 AS (SELECT doc_id, CAST(length(two) - length(replace(two, '<', '')) AS BIGINT) AS n_sentences, "
        f"CASE WHEN one || two = '' THEN '' ELSE one || '{TAKEN}' || two END AS rest, CAST([] AS VARCHAR[]) AS found, '' AS taken FROM b), "
        + ", ".join(steps)
        + f" SELECT doc_id, n_sentences, array_to_string(found, '|') AS licenses, coalesce(array_to_string("
        f"list_sort(list_distinct(list_filter(string_split(regexp_replace(rest, '[<>]+', ' ', 'g'), ' '), lambda i: i <> '' AND NOT contains(taken, '<' || i || '>')))), '|'), '') AS unmatched "
        f"FROM r{len(RULES)}"
    )
