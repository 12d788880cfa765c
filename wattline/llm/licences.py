"""License scan: sentences become identifiers, identifier sequences meet ordered rules.

A text is cut twice: at sentence ends and blank lines (a line break inside a sentence is a
blank, and so are the marks that begin comment lines), and at every line end. Known sentences
are cut by the same ends, so one of several parts is a sequence of its parts' identifiers.
Normalised sentences that are known get an identifier, numbers and letters of lists are left
out, and others break the sequence. Rules are tried in order on each sequence; sentences that a rule has
taken are not seen by later rules, so long licences come before the notices they contain.
The known sentences and rules are fixed lists, looked up inside the row: nothing is shuffled.

Cases: null and empty texts have no sentences and no licences; every input row gives one
output row, repeated rows too; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import ascii_lower

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "agpl-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-notice": "Released under the BSD License.",
    "cc0-notice": "This work is dedicated to the public domain under CC0 1.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-redistribute3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-only2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    "lgpl-redistribute21": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "lgpl3-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit-notice": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# Licences and the sentence sequences that show them, first match first.
RULES = [
    ("Apache-2.0", ["apache-grant", "apache-use", "apache-copy"]),
    ("Apache-2.0", ["apache-grant", "apache-use"]),
    ("Apache-2.0", ["apache-as-is", "apache-see"]),
    ("MIT", ["mit-title", "mit-grant", "mit-keep"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("LGPL-2.1-or-later", ["lgpl-redistribute21"]),
    ("GPL-2.0-or-later", ["gpl-redistribute2", "gpl-warranty", "gpl-implied"]),
    ("GPL-3.0-or-later", ["gpl-redistribute3", "gpl-warranty", "gpl-implied"]),
    ("AGPL-3.0", ["agpl-notice"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("BSD", ["bsd-grant"]),
    ("BSD", ["bsd-notice"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-long"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-2.0", ["spdx-gpl2"]),
    ("GPL-2.0", ["gpl-only2"]),
    ("GPL-2.0-or-later", ["gpl-redistribute2"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("GPL-3.0-or-later", ["gpl-redistribute3"]),
    ("ISC", ["isc-grant"]),
    ("LGPL-3.0", ["lgpl3-notice"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["spdx-mit"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("Unlicense", ["unlicense"]),
    ("all rights reserved", ["reserved"]),
]

#: What normalising turns into one blank; \x1e separates sentences.
FILLER = r"[\x00-\x1D\x1F-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_END = r"[.!?;]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D#*/-]*\n"
LINE_END = r"\n"
#: What numbers the items of a list; it is no sentence.
MARKER = r"^([0-9]{1,2}|[a-z])$"


def normalised(sentence: str) -> str:
    """A known sentence as the columns of `_sentences` give it."""
    lower = re.sub("[A-Z]", lambda letter: letter[0].lower(), sentence)
    return re.sub(FILLER, " ", lower).strip(" ")


def code_of(position: int) -> str:
    """One character per known part of a sentence; a dot stands for any other."""
    return chr(0x4E00 + position)


def parts_of(sentence: str) -> list[str]:
    """A known sentence cut and normalised as texts are."""
    parts = [normalised(part) for part in re.split(SENTENCE_END, sentence)]
    return [part for part in parts if part and not re.search(MARKER, part)]


def _part_codes(sentences: dict[str, str]) -> dict[str, str]:
    parts = dict.fromkeys(part for text in sentences.values() for part in parts_of(text))
    return {part: code_of(at) for at, part in enumerate(parts)}


def coded_sentences(sentences: dict[str, str] = SENTENCES) -> dict[str, str]:
    """Codes by normalised sentence, and code by part of a sentence."""
    codes = _part_codes(sentences)
    whole = {normalised(text): "".join(codes[part] for part in parts_of(text)) for text in sentences.values()}
    return {**whole, **codes}


def coded_rules(
    rules: Sequence[tuple[str, Sequence[str]]] = tuple(RULES), sentences: dict[str, str] = SENTENCES
) -> list[tuple[str, str]]:
    """(licence, codes in a row), in order."""
    codes = _part_codes(sentences)
    return [
        (licence, "".join(codes[part] for name in sequence for part in parts_of(sentences[name])))
        for licence, sequence in rules
    ]


def _sentences(text: Column, ends: str) -> Column:
    broken = F.regexp_replace(text, ends, "\x1e")
    plain = F.regexp_replace(ascii_lower(broken), FILLER, " ")
    trimmed = F.transform(F.split(plain, "\x1e", -1), lambda s: F.trim(s))
    return F.filter(trimmed, lambda sentence: (sentence != "") & ~F.regexp_like(sentence, F.lit(MARKER)))


def _identified(sentences: Column, known: Column) -> Column:
    return F.array_join(F.transform(sentences, lambda s: F.coalesce(F.try_element_at(known, s), F.lit("."))), "")


def _matched(sequence: Column, rules: Column) -> Column:
    """Licences of the rules that apply, each taking its sentences away."""
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["codes"])
        return F.struct(
            F.replace(state["rest"], rule["codes"], rule["blank"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(rules, start, apply, lambda state: state["found"])


def license_scan(
    docs: DataFrame,
    sentences: dict[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = tuple(RULES),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_sentences, n_known (both of the cut at sentence ends) and `licences`, sorted."""
    known = F.create_map(*[F.lit(v) for pair in coded_sentences(sentences).items() for v in pair])
    steps = F.array(
        *[
            F.struct(F.lit(lic).alias("licence"), F.lit(c).alias("codes"), F.lit("." * len(c)).alias("blank"))
            for lic, c in coded_rules(rules, sentences)
        ]
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        F.col(id_col).alias("doc_id"),
        _identified(_sentences(text, SENTENCE_END), known).alias("by_sentence"),
        _identified(_sentences(text, LINE_END), known).alias("by_line"),
    )
    known_count = F.length(F.replace("by_sentence", F.lit("."), F.lit("")))
    found = F.flatten(
        F.transform(
            F.filter(F.array("by_sentence", "by_line"), lambda s: F.regexp_like(s, F.lit("[^.]"))),
            lambda sequence: _matched(sequence, steps),
        )
    )
    return cut.select(
        "doc_id",
        F.length("by_sentence").cast("long").alias("n_sentences"),
        known_count.cast("long").alias("n_known"),
        F.array_sort(F.array_distinct(found)).alias("licences"),
    )
