"""Licence scans: known licence sentences, then ordered rules over their sequence.

Only column functions are used. A text is cut into sentences twice: once with a line break as
white space (wrapped licence texts) and once with a line break as a separator (notices on lines
of their own). Every sentence is normalised and looked up among the known ones; the identifiers
of both cuts, in order of occurrence, are then matched against the rules.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    2: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    3: "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    4: "Released under the MIT License.",
    5: "Licensed under the MIT License.",
    6: "Licensed under the Apache License, Version 2.0.",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    8: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    10: "This work is licensed under the GNU General Public License, version 3.",
    11: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    12: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    13: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    15: "See the GNU General Public License for more details.",
    16: "Licensed under CC BY-NC 4.0.",
    17: "Licensed under CC BY 4.0.",
    18: "Licensed under CC BY-SA 4.0.",
    19: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    20: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    21: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    22: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    23: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    24: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    25: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    26: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    27: "All rights reserved.",
    28: "This is free and unencumbered software released into the public domain.",
    29: "No rights reserved.",
}
# Rules in order of precedence; a rule takes its sentences away from later ones.
RULES = [
    ("Apache-2.0", (7, 8)),
    ("Apache-2.0", (7,)),
    ("Apache-2.0", (6,)),
    ("MIT", (1, 2, 3)),
    ("MIT", (1, 2)),
    ("MIT", (1,)),
    ("MIT", (4,)),
    ("MIT", (5,)),
    ("GPL-3.0-or-later", (11, 13, 15)),
    ("GPL-3.0-or-later", (11,)),
    ("GPL-2.0-or-later", (12, 13, 15)),
    ("GPL-2.0-or-later", (12,)),
    ("GPL-3.0-only", (10,)),
    ("BSD-3-Clause", (21, 22, 23, 24)),
    ("BSD-2-Clause", (21, 22, 23)),
    ("ISC", (25,)),
    ("MPL-2.0", (26,)),
    ("CC-BY-NC-4.0", (16,)),
    ("CC-BY-NC-4.0", (20,)),
    ("CC-BY-SA-4.0", (18,)),
    ("CC-BY-4.0", (17,)),
    ("CC-BY-4.0", (19,)),
    ("Unlicense", (28,)),
    ("CC0-1.0", (29,)),
    ("LicenseRef-all-rights-reserved", (27,)),
]
#: Every known sentence holds one of these, so texts without any of them need no sentences.
KEYWORDS = "licen|permi|warrant|rights reserved|redistribut|endorse|public domain"
SENTENCE_END = r"([.!?])[ \t\n\r\f]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def normalised(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


def pieces(sentence: str) -> list[str]:
    """The normalised pieces into which the cut of a text splits a known sentence."""
    return [normalised(p) for p in re.sub(SENTENCE_END, "\\1\n", sentence).split("\n") if normalised(p)]


def _known() -> dict[str, int]:
    """Piece to identifier. A sentence that the cut splits is known by its first piece, and the
    others are left out as unknown."""
    out: dict[str, int] = {}
    for number, sentence in SENTENCES.items():
        first = pieces(sentence)[0]
        if out.setdefault(first, number) != number:
            raise ValueError(f"sentences {out[first]} and {number} start alike")
        if not re.search(KEYWORDS, sentence.lower()):
            raise ValueError(f"sentence {number} holds no keyword")
    return out


def _ids(cut: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in _known().items() for x in pair])
    marks = F.split(F.regexp_replace(cut, SENTENCE_END, "$1\n"), "\n")
    found = F.transform(marks, lambda s: F.try_element_at(known, F.trim(F.regexp_replace(s, NOT_WORD, " "))))
    return F.filter(found, lambda x: x.isNotNull())


def _row(ids: Column) -> Column:
    return F.concat(F.lit(","), F.array_join(F.transform(ids, lambda x: F.concat(x.cast("string"), F.lit(","))), ","))


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentence_ids, licences, licence) for every row.

    ``sentence_ids``: identifiers of known sentences found by either cut, sorted, each once.
    ``licences``: names of the rules met, in order of precedence, each once; ``licence``: the
    first of them or null. Null and empty texts have empty lists. The map of known sentences is a
    fixed literal; nothing is shuffled, and other columns of ``docs`` are not read.
    """
    low = F.lower(F.col(text))
    wrapped = _ids(F.regexp_replace(F.regexp_replace(low, r"\n[ \t\r\f]*\n", ". \n"), r"[\n\r]", " "))
    by_line = _ids(low)
    empty = F.array().cast("array<int>")
    worth = F.coalesce(low.rlike(KEYWORDS), F.lit(False))
    found = docs.select(
        F.col(key),
        F.when(worth, wrapped).otherwise(empty).alias("_a"),
        F.when(worth, by_line).otherwise(empty).alias("_b"),
    ).select(key, "_a", "_b", F.concat(_row(F.col("_a")), F.lit("|"), _row(F.col("_b"))).alias("_left"))
    names = []
    for i, (name, sequence) in enumerate(RULES):
        pattern = "," + ",,".join(map(str, sequence)) + ","
        found = found.withColumn(f"_m{i}", F.when(F.contains("_left", F.lit(pattern)), F.lit(name)))
        if len(sequence) > 1 or any(len(s) > 1 and sequence[0] in s for _, s in RULES[i:]):
            found = found.withColumn("_left", F.replace("_left", F.lit(pattern), F.lit(",0,")))
        names.append(F.col(f"_m{i}"))
    licences = F.array_distinct(F.array_compact(F.array(*names)))
    return found.select(
        key,
        F.array_sort(F.array_distinct(F.concat("_a", "_b"))).alias("sentence_ids"),
        licences.alias("licences"),
        F.try_element_at(licences, F.lit(1)).alias("licence"),
    )
