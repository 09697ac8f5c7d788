"""Licence recognition by sentence rules.

A text is cut into sentences (after ``. ! ? : ;`` before white space, and at
blank lines; an SPDX tag stays with its value).  A sentence that spans lines is tried whole, as wrapped text,
and if unknown line by line.  Normalised (lower case, every run of other
characters than a-z and 0-9 one space) it is looked up among known licence
sentences, which gives an identifier; where a sentence names a holder, any
name of up to 200 characters may stand (``HOLDERS``).  The licences of an SPDX
expression (OR, AND, WITH, parentheses, -only, -or-later) and of a notice that
lists several give an identifier each.  The identifiers of a document, in
order, form a sequence, against which the rules are matched in their order;
a rule that matches uses its identifiers up, so a full licence text is not
also reported as the shorter one it contains.  The sentences that "*" lets
stand between stay in the sequence for later rules, and "*" passes no sentence
that opens a rule, used up or not: there another licence begins.

A sequence is a string of one character per identifier.  What may stand
between is a possessive class of characters, so a rule neither backtracks nor
recurses, and each of its openings reads as far as the next one.

Only sentences with a word that every known sentence has some of
(``TRIGGER``) are normalised and looked up, which changes no result.

Everything happens inside the row with array functions: no shuffle, no
Python, texts of any length, repeated rows and null ids unchanged.  Null and
empty texts have no licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import text_of

TRIGGER = ("licen[sc]e|copyright|warrant|permission|redistribut|(released|distributed|available)[^a-z0-9]+under|"
           "public[^a-z0-9]+domain|all[^a-z0-9]+rights|free[^a-z0-9]+software")

# Identifier and names of licences.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License", "MIT licence", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GPL-2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GPL-3.0", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "Zlib": ("zlib License", "Zlib"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero 1.0", "CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0", "CC-BY-ND-4.0"),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
                        "CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
}

# Phrases that refer to a licence by name.
REFERENCES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
              "Distributed under the {}", "Available under the {}", "This work is licensed under {}",
              "This work is licensed under the {}", "This work is licensed under a {}",
              "This project is licensed under the {}", "This software is licensed under the {}",
              "This file is licensed under the {}", "This program is licensed under the {}",
              "SPDX-License-Identifier: {}")

# Sentences of licence texts and notices (public texts).
SENTENCES: dict[str, str] = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-asis": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-asis": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "apache-notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "gpl2-later": "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-free": "This program is free software:",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl-2": "either version 2 of the License, or (at your option) any later version.",
    "gpl-3": "either version 3 of the License, or (at your option) any later version.",
    "lgpl-grant": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl-21": "either version 2.1 of the License, or (at your option) any later version.",
    "agpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-nowarranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "rights": "All rights reserved.",
}

# Sentences that name a holder, as patterns over normalised
# sentences with a bounded gap for the name, and the sentence they stand for.
# A name with a full stop ends a sentence early, so the rest counts as well.
_ENDORSE = "may (?:not )?be used to endorse or promote products derived from this software without (?:specific )?prior written permission"
HOLDERS: list[tuple[str, str]] = [
    (f"^(?:neither the names? of [a-z0-9 ]{{1,200}} )?nor the names of (?:its |the |their |any |other )?contributors {_ENDORSE}$", "bsd-endorse"),
    (f"^the names? of [a-z0-9 ]{{1,200}} {_ENDORSE}$", "bsd-endorse"),
    ("^this software is provided by [a-z0-9 ]{1,200} as is and any express or implied warranties including but not limited to "
     "the implied warranties of merchantability and fitness for a particular purpose are disclaimed$", "bsd-asis"),
    ("^in no event shall [a-z0-9 ]{1,200} be liable for any claim damages or other liability whether in an action of contract tort "
     "or otherwise arising from out of or in connection with the software or the use or other dealings in the software$", "mit-liable"),
    ("^the software is provided as is and [a-z0-9 ]{1,200} disclaims all warranties with regard to this software including all "
     "implied warranties of merchantability and fitness$", "isc-asis"),
]

#: The expression behind an SPDX tag, and the licences that a notice lists.
SPDX = "(?i)^[^a-z0-9]*spdx-license-identifier:? (.+)"
LISTED = ("^(?:this (?:work|project|software|file|program) is )?(?:dual )?(?:licensed|released|distributed|available) under "
          "(?:(?:the|a|either) ){0,2}(.+ (?:or|and) .+)$")

# Rules in order, each a sequence of sentences; "*" lets other
# sentences stand between, up to one that opens a rule.
RULES: list[tuple[str, str]] = [
    ("MIT", "mit-grant * mit-notice * mit-asis * mit-liable"),
    ("MIT", "mit-grant * mit-notice"),
    ("BSD-3-Clause", "bsd-grant * bsd-source * bsd-binary * bsd-endorse * bsd-asis"),
    ("BSD-3-Clause", "bsd-grant * bsd-source * bsd-binary * bsd-endorse"),
    ("BSD-2-Clause", "bsd-grant * bsd-source * bsd-binary * bsd-asis"),
    ("BSD-2-Clause", "bsd-grant * bsd-source * bsd-binary"),
    ("ISC", "isc-grant * isc-asis"),
    ("ISC", "isc-grant"),
    ("Apache-2.0", "apache-notice apache-comply * apache-copy * apache-asis"),
    ("Apache-2.0", "apache-notice apache-comply"),
    ("AGPL-3.0", "agpl3-later"),
    ("LGPL-2.1", "lgpl-grant lgpl-21"),
    ("LGPL-3.0", "lgpl-grant gpl-3"),
    ("GPL-2.0", "gpl-grant gpl-2 * gpl-nowarranty"),
    ("GPL-2.0", "gpl-grant gpl-2"),
    ("GPL-3.0", "gpl3-later * gpl-nowarranty"),
    ("GPL-3.0", "gpl3-later"),
    ("GPL-3.0", "gpl-grant gpl-3"),
    ("MPL-2.0", "mpl-terms"),
    ("Unlicense", "unlicense-free"),
    ("Zlib", "zlib-asis * zlib-grant"),
    ("BSL-1.0", "boost-grant"),
]


def normalise(sentence: str) -> str:
    """As the Spark expression does it (for building the table)."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier: the fixed sentences and every
    reference phrase with every name."""
    out = {}
    for ident, names in NAMES.items():
        for name in names:
            for phrase in REFERENCES:
                out.setdefault(normalise(phrase.format(name)), "ref-" + ident.lower())
    for ident, sentence in SENTENCES.items():
        out[normalise(sentence)] = ident
    return out


def rule_table() -> list[tuple[str, str]]:
    """(pattern over ``,id,id,``, licence), in order; one rule per reference
    after the rules of texts.  The SQL's table: its "*" passes every sentence
    and uses it up, so the two agree on texts of one licence."""
    def pattern(sequence: str) -> str:
        out = ""
        for part in sequence.split():
            out += "([^,]+,)*?" if part == "*" else re.escape(part).replace("\\-", "-") + ","
        return "," + out
    return ([(pattern(seq), ident) for ident, seq in RULES]
            + [("," + "ref-" + ident.lower().replace(".", "[.]") + ",", ident) for ident in NAMES])


#: Identifiers; each is one character of a sequence.
IDENTIFIERS = [*SENTENCES, *("ref-" + ident.lower() for ident in NAMES)]
CHARS = [chr(0x100 + k) for k in range(len(IDENTIFIERS))]
#: Stands where a rule has used up its opening sentence.
USED = "\u0001"


def matchers() -> list[tuple[str, str, str]]:
    """(pattern, replacement, licence) over sequences, in order."""
    char = dict(zip(IDENTIFIERS, CHARS))
    barrier = USED + "".join(sorted({char[seq.split()[0]] for _, seq in RULES}))
    out = []
    for ident, seq in RULES:
        pattern, kept, gap = "", USED, False
        for part in seq.split():
            if gap:
                kept += f"${kept.count('$') + 1}"
                pattern += f"([^{barrier}{char[part]}]*+)"
            gap = part == "*"
            pattern += "" if gap else char[part]
        out.append((pattern, kept, ident))
    return out + [(char["ref-" + ident.lower()], "", ident) for ident in NAMES]


def _norm(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def _named(known: Column, s: Column) -> Column:
    """Identifier of a normalised sentence, also with a holder's name in it."""
    out = F.try_element_at(known, s)
    for pattern, ident in HOLDERS:
        out = F.coalesce(out, F.when(s.rlike(pattern), F.lit(IDENTIFIERS.index(ident) + 1)))
    return out


def _of_line(line: Column, known: Column) -> Column:
    """Identifiers of a line: of its sentence, of the licences of an SPDX
    expression (an exception after WITH has none) or of those it lists."""
    s = _norm(line)
    tag = F.regexp_replace(F.regexp_extract(line, SPDX, 1), "[()\\s]+", " ")
    listed = F.regexp_extract(s, LISTED, 1)

    def by(phrase: str, part: Column) -> Column:
        return F.try_element_at(known, F.concat(F.lit(phrase), F.regexp_replace(_norm(part), " (?:only|or later)$", "")))

    named = _named(known, s)
    return (F.when(named.isNotNull(), F.array(named))
            .when(tag != "", F.transform(F.split(tag, "(?i) (?:or|and|with) "), lambda x: by("spdx license identifier ", x)))
            .when(listed != "", F.transform(F.split(listed, " (?:or|and) (?:the |a )?"), lambda x: by("licensed under ", x)))
            .otherwise(F.array().cast("array<int>")))


def _identifiers(text: Column, known: Column) -> Column:
    """Identifiers of the known sentences of a text, in order, by their
    place in ``IDENTIFIERS`` from 1."""
    whole_tags = F.regexp_replace(text, "(?i)(spdx-license-identifier):[ \\t]+", "$1 ")
    marked = F.regexp_replace(whole_tags, "([.!?;:])\\s+|\\n[ \\t\\r]*\\n", "$1\u0001")
    sentences = F.filter(F.split(marked, "\u0001"), lambda s: F.lower(s).rlike(TRIGGER))

    def of(s: Column) -> Column:
        whole = _named(known, _norm(s))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(
            F.flatten(F.transform(F.split(s, "\n"), lambda line: _of_line(line, known))))

    return F.filter(F.flatten(F.transform(sentences, of)), lambda i: i.isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_known`` sentences, their
    ``identifiers`` in order and the ``licenses`` found (both comma-joined;
    licences distinct, in order of the rules), ``unmatched`` (identifiers no
    rule has used)."""
    place = {ident: k for k, ident in enumerate(IDENTIFIERS, start=1)}
    known = F.create_map(*(F.lit(x) for s, ident in sorted(known_sentences().items()) for x in (s, place[ident])))
    names, chars = F.array(*map(F.lit, IDENTIFIERS)), F.array(*map(F.lit, CHARS))
    rules = F.array(*(F.struct(F.lit(p).alias("pattern"), F.lit(k).alias("kept"), F.lit(i).alias("license"))
                      for p, k, i in matchers()))
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = base.select("doc_id", F.when(F.lower("text").rlike(TRIGGER), _identifiers(F.col("text"), known))
                        .otherwise(F.array().cast("array<int>")).alias("ids"))

    def joined(values: Column, sep: str) -> Column:
        return F.array_join(F.transform("ids", lambda k: F.element_at(values, k)), sep)

    start = F.struct(joined(chars, "").alias("seq"), F.array().cast("array<string>").alias("found"))

    def use(acc: Column, rule: Column) -> Column:
        hit = F.regexp_like(acc["seq"], rule["pattern"])
        return F.when(hit, F.struct(
            F.regexp_replace(acc["seq"], rule["pattern"], rule["kept"]).alias("seq"),
            F.array_union(acc["found"], F.array(rule["license"])).alias("found"))).otherwise(acc)

    matched = F.when(F.size("ids") > 0, F.aggregate(rules, start, use)).otherwise(start)
    return (found.select("doc_id", "ids", matched.alias("m"))
            .select("doc_id", F.size("ids").cast("long").alias("n_known"), joined(names, ",").alias("identifiers"),
                    F.array_join("m.found", ",").alias("licenses"),
                    F.length(F.translate("m.seq", USED, "")).cast("long").alias("unmatched")))
