"""Licence scans by sentence rules (DataFrame functions only).

1. A text is cut into sentences.  A sentence that is not known is cut at
   blank and copyright lines, a part of it that is not known at colons, and
   such a part into lines (a notice below a line without a full stop is found
   as a line, one that is wrapped over lines as a sentence or part).
2. Sentences are normalised: lower case, every run of characters other than
   letters and digits one space, ``licence`` spelt ``license``.
3. Known normalised sentences become identifiers, others ``?``; neighbouring
   unknown sentences are one.  A text is now a short sequence.
4. Ordered rules are matched against the sequence; a match is taken out, so
   that a later, more general rule cannot claim it again.

Every known sentence holds one of a few anchor words, chosen from the sentence
table (``anchor_words``).  A text or sentence without one is not cut further:
no part of it can be known.  Sentences are looked up by a hash.

The sentence table and the rules are literals of the plan: small, fixed
tables.  Every row is worked on alone; nothing is shuffled, so that neither
a hot source nor repeated texts can skew.

Edge cases: null and empty texts have no licence.  Repeated rows and null ids
are scanned each.  Known sentences that no rule takes are reported in
``unmatched``.  Numbers of list items are no sentences.  A very long text is
cut as a whole in its row's task.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licences by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mitName": ("released under the mit license", "licensed under the mit license",
                "this project is licensed under the mit license", "the mit license", "mit license",
                "spdx license identifier mit"),
    "mitGrant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions the above copyright notice and this permission notice shall be included "
                 "in all copies or substantial portions of the software",
                 "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions"),
    "mitNotice": ("the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",),
    "asIs": ("the software is provided as is without warranty of any kind express or implied including but not "
             "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "apache2Name": ("licensed under the apache license version 2 0", "released under the apache license version 2 0",
                    "licensed under the apache license version 2 0 the license", "apache license version 2 0",
                    "spdx license identifier apache 2 0"),
    "apache2Comply": ("you may not use this file except in compliance with the license",),
    "apache2Copy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "gpl3Name": ("this work is licensed under the gnu general public license version 3",
                 "licensed under the gnu general public license version 3",
                 "released under the gnu general public license version 3",
                 "spdx license identifier gpl 3 0 only"),
    "gpl3Later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
                  "spdx license identifier gpl 3 0 or later"),
    "gpl2Later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation either version 2 of the "
                  "license or at your option any later version",
                  "spdx license identifier gpl 2 0 or later"),
    "ccByNc4Name": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0",
                    "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
                    "spdx license identifier cc by nc 4 0"),
    "ccBy4Name": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0",
                  "this work is licensed under a creative commons attribution 4 0 international license",
                  "spdx license identifier cc by 4 0"),
    "bsdGrant": ("redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met",),
    "bsdSource": ("redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",),
    "bsdBinary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the "
                  "distribution",),
    "bsdNames": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission",),
    "bsdAsIs": ("this software is provided by the copyright holders and contributors as is and any express or implied "
                "warranties including but not limited to the implied warranties of merchantability and fitness for a "
                "particular purpose are disclaimed",),
    "bsd2Name": ("licensed under the bsd 2 clause license", "released under the bsd 2 clause license",
                 "spdx license identifier bsd 2 clause"),
    "bsd3Name": ("licensed under the bsd 3 clause license", "released under the bsd 3 clause license",
                 "spdx license identifier bsd 3 clause"),
    "gpl2Only": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license version 2 as published by the free software foundation",
                 "licensed under the gnu general public license version 2",
                 "this work is licensed under the gnu general public license version 2",
                 "spdx license identifier gpl 2 0 only"),
    "lgpl21Later": ("this library is free software you can redistribute it and or modify it under the terms of the gnu "
                    "lesser general public license as published by the free software foundation either version 2 1 of "
                    "the license or at your option any later version",
                    "spdx license identifier lgpl 2 1 or later"),
    "lgpl21Name": ("licensed under the gnu lesser general public license version 2 1",
                   "spdx license identifier lgpl 2 1 only"),
    "lgpl3Later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 3 of the "
                   "license or at your option any later version",
                   "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 3 of the "
                   "license or at your option any later version",
                   "spdx license identifier lgpl 3 0 or later"),
    "lgpl3Name": ("licensed under the gnu lesser general public license version 3",
                  "spdx license identifier lgpl 3 0 only"),
    "agpl3Later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "affero general public license as published by the free software foundation either version 3 of the "
                   "license or at your option any later version",
                   "spdx license identifier agpl 3 0 or later"),
    "agpl3Name": ("licensed under the gnu affero general public license version 3",
                  "spdx license identifier agpl 3 0 only"),
    "mpl2Name": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                 "licensed under the mozilla public license version 2 0", "mozilla public license version 2 0",
                 "spdx license identifier mpl 2 0"),
    "mpl2Copy": ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
                 "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    "iscGrant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",),
    "iscName": ("licensed under the isc license", "released under the isc license", "spdx license identifier isc"),
    "unlicense": ("this is free and unencumbered software released into the public domain",
                  "spdx license identifier unlicense"),
    "cc0Name": ("to the extent possible under law the author has waived all copyright and related or neighboring "
                "rights to this work", "licensed under cc0 1 0", "this work is licensed under cc0 1 0",
                "spdx license identifier cc0 1 0"),
    "ccBySa4Name": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0",
                    "this work is licensed under a creative commons attribution sharealike 4 0 international license",
                    "spdx license identifier cc by sa 4 0"),
    "epl2Name": ("this program and the accompanying materials are made available under the terms of the eclipse public "
                 "license 2 0", "licensed under the eclipse public license version 2 0",
                 "spdx license identifier epl 2 0"),
    "boost1Name": ("distributed under the boost software license version 1 0", "spdx license identifier bsl 1 0"),
    "allRights": ("all rights reserved",),
}

# Ordered rules, (licence, sequence of sentence identifiers).
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mitName", "mitGrant", "mitNotice", "asIs")),
    ("MIT", ("mitGrant", "mitNotice", "asIs")),
    ("MIT", ("mitName", "mitGrant", "asIs")),
    ("MIT", ("mitGrant", "asIs")),
    ("MIT", ("mitGrant", "mitNotice")),
    ("Apache-2.0", ("apache2Name", "apache2Comply", "apache2Copy")),
    ("Apache-2.0", ("apache2Name", "apache2Comply")),
    ("GPL-3.0-or-later", ("gpl3Later",)),
    ("GPL-2.0-or-later", ("gpl2Later",)),
    ("Apache-2.0", ("apache2Name",)),
    ("GPL-3.0-only", ("gpl3Name",)),
    ("CC-BY-NC-4.0", ("ccByNc4Name",)),
    ("CC-BY-4.0", ("ccBy4Name",)),
    ("MIT", ("mitName",)),
    ("MIT", ("mitGrant",)),
    ("BSD-3-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdNames", "bsdAsIs")),
    ("BSD-3-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdNames")),
    ("BSD-2-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdAsIs")),
    ("BSD-2-Clause", ("bsdGrant", "bsdSource", "bsdBinary")),
    ("BSD-3-Clause", ("bsd3Name",)),
    ("BSD-2-Clause", ("bsd2Name",)),
    ("BSD-style", ("bsdGrant",)),
    ("AGPL-3.0-or-later", ("agpl3Later",)),
    ("AGPL-3.0-only", ("agpl3Name",)),
    ("LGPL-3.0-or-later", ("lgpl3Later",)),
    ("LGPL-3.0-only", ("lgpl3Name",)),
    ("LGPL-2.1-or-later", ("lgpl21Later",)),
    ("LGPL-2.1-only", ("lgpl21Name",)),
    ("GPL-2.0-only", ("gpl2Only",)),
    ("MPL-2.0", ("mpl2Name", "mpl2Copy")),
    ("MPL-2.0", ("mpl2Name",)),
    ("ISC", ("iscName", "iscGrant")),
    ("ISC", ("iscGrant",)),
    ("ISC", ("iscName",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0Name",)),
    ("CC-BY-SA-4.0", ("ccBySa4Name",)),
    ("EPL-2.0", ("epl2Name",)),
    ("BSL-1.0", ("boost1Name",)),
    ("Proprietary", ("allRights",)),
)

SENTENCE_END = r"([.!?])[ \t\r\n]+"
# A line without a letter or digit (blank, or a bare comment marker), and the end of a copyright line.
BLOCK_END = r"(?i)(\n[^\p{L}\p{N}\n]*(?=\n)|(?:^|(?<=[\n\u0001]))[^\p{L}\p{N}\n]*(?:copyright[ \t]+(?:[(]c[)]|\u00a9|[0-9]{4})|[(]c[)]|\u00a9)[^\n]*(?=\n))"
COLON = r"(:)[ \t\r\n]+"
LINE_END = r"(\n)"
# What would part a known sentence: comment words before a line, the colon of
# an SPDX tag, the break before the address of the Apache licence, the stop of
# "v. 2.0".
COMMENT_WORD = r"(?im)^[ \t]*(?:dnl|rem)(?=[ \t\r\n]|$)"
SPDX_TAG = r"(?i)(spdx-license-identifier)[ \t]*:[ \t]*"
LICENSE_AT = r"(?i)(copy of the licen[cs]e at)[^a-z0-9]+(?=http)"
VERSION_AT = r"(?i)(\bv)[.][ \t]+(?=[0-9])"
ITEM_NUMBER = r"^[^\p{L}\p{N}]*[0-9]{1,2}[^\p{L}\p{N}]*$"
LOOKUP_CELLS = 64
_MARK = "\u0001"


def normalised(sentence: Column) -> Column:
    words = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    return F.replace(words, F.lit("licence"), F.lit("license"))


def normal(sentence: str) -> str:
    """The same of a Python string."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ").replace("licence", "license")


def anchor_words(sentences=SENTENCES) -> list[str]:
    """Words such that every known sentence holds one: of the sentences still
    without a word, the word of most (then the longest) is taken.

    A ``k`` is left out: it has a second capital, the Kelvin sign."""
    open_ = [set(re.findall("[a-jl-z]{5,}", s)) or set(s.split()) for said in sentences.values() for s in said]
    words = []
    while open_:
        count = Counter(w for s in open_ for w in s)
        words.append(max(count, key=lambda w: (count[w], len(w), w)))
        open_ = [s for s in open_ if words[-1] not in s]
    return words


def _parts(s: Column, end: str) -> Column:
    return F.split(F.regexp_replace(s, end, f"$1{_MARK}"), _MARK)


def _lookup(sentences) -> Column:
    """The identifier (as an array of one) of sentences by the cell of their hash."""
    cells: list[list[Column]] = [[] for _ in range(LOOKUP_CELLS)]
    for name, said in sentences.items():
        for s in said:
            cells[zlib.crc32(s.encode()) % LOOKUP_CELLS] += [F.lit(s), F.array(F.lit(name))]
    none = F.expr("cast(map() as map<string, array<string>>)")
    return F.array(*[F.create_map(*c) if c else none for c in cells])


def identifiers(text: Column, sentences=SENTENCES) -> Column:
    """The sequence of a text as ``,a,b,?,c,`` (every identifier between two
    commas of its own: ``,a,,b,``).

    A sentence that is not known is cut at blank and copyright lines, a part
    that is not known at colons, and such a part into lines."""
    known = _lookup(sentences)
    least = min(len(s) for said in sentences.values() for s in said)
    anchors = F.lit("(?i)" + "|".join(sorted(w.replace("license", "licen[cs]e") for w in anchor_words(sentences))))
    whole = F.coalesce(text, F.lit(""))
    body = whole
    for pattern, by in ((COMMENT_WORD, ""), (SPDX_TAG, "$1 "), (LICENSE_AT, "$1 "), (VERSION_AT, "$1 ")):
        body = F.regexp_replace(body, pattern, by)
    unknown = F.array(F.lit("?"))

    def found_in(s):
        return F.transform(F.array(normalised(s)),
                           lambda n: F.element_at(known, (F.crc32(n) % LOOKUP_CELLS + 1).cast("int"))[n])[0]

    def named(s, ends):
        finer = F.flatten(F.transform(_parts(s, ends[0]), lambda x: named(x, ends[1:]))) if ends else unknown
        short = F.when(F.regexp_like(s, F.lit(ITEM_NUMBER)), F.expr("cast(array() as array<string>)")).otherwise(unknown)
        # Nothing in a text that is too short, or without an anchor, is known.
        return (F.when(F.length(s) < least, short)
                .when(F.regexp_like(s, anchors), F.coalesce(found_in(s), finer)).otherwise(unknown))

    found = F.flatten(F.transform(_parts(body, SENTENCE_END), lambda s: named(s, (BLOCK_END, COLON, LINE_END))))
    return F.when(F.regexp_like(whole, anchors),
                  F.concat(F.lit(","), F.array_join(found, ",,"), F.lit(","))).otherwise(",?,")


def find_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  sentences=SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, licenses, sequence, unmatched) of every row.

    ``licenses``: names by rule order, comma-joined, each once; ``sequence``:
    the identifiers in text order with ``?`` for a run of unknown sentences;
    ``unmatched``: identifiers that no rule took."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{s}," for s in seq)).alias("seq"))
                      for name, seq in rules])
    start = F.struct(F.col("whole").alias("left"), F.expr("cast(array() as array<string>)").alias("names"))

    def take(acc, rule):
        hit = acc["left"].contains(rule["seq"])
        return F.struct(F.when(hit, F.replace(acc["left"], rule["seq"], F.lit(",/,"))).otherwise(acc["left"]).alias("left"),
                        F.when(hit, F.array_append(acc["names"], rule["name"])).otherwise(acc["names"]).alias("names"))

    whole = F.regexp_replace(identifiers(F.col(text), sentences), r"(,[?],)+", ",?,")
    found = (docs.select(F.col(doc_id).alias("doc_id"), whole.alias("whole"))
             .withColumn("found", F.when(F.regexp_like("whole", F.lit("[a-z]")), F.aggregate(table, start, take))))

    def listed(c):
        return F.array_join(F.filter(F.split(c, ",+"), lambda x: x != ""), ",")

    left = F.filter(F.split(F.col("found.left"), ",+"), lambda x: ~x.isin("", "?", "/"))
    return found.select("doc_id",
                        F.coalesce(F.array_join(F.array_distinct("found.names"), ","), F.lit("")).alias("licenses"),
                        F.when(F.col("found").isNotNull(), listed(F.col("whole"))).otherwise("").alias("sequence"),
                        F.coalesce(F.array_join(left, ","), F.lit("")).alias("unmatched"))
