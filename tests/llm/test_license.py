import random
import re
from collections import Counter

from shoal.llm import license as L
from tests.llm import cases

S = L.SENTENCES
MIT = "\n".join(["MIT License", "", "Copyright (c) 2020 Someone", "",
                 S["mit-grant"].replace("associated ", "associated\n").replace("including ", "including\n  "), "",
                 S["mit-notice"], "", S["mit-asis"] + " " + S["mit-liable"]])
BSD3 = " ".join([S["bsd-grant"], "1.", S["bsd-source"], "2.", S["bsd-binary"], "3.", S["bsd-endorse"], S["bsd-asis"]])
BSD2 = "\n\n".join([S["bsd-grant"], "* " + S["bsd-source"], "* " + S["bsd-binary"], S["bsd-asis"]])
APACHE = "\n".join(["Copyright 2020 X", "", S["apache-notice"], S["apache-comply"], S["apache-copy"], "",
                    "   http://www.apache.org/licenses/LICENSE-2.0", "", S["apache-asis"]])
TEXTS = {
    MIT: "MIT", BSD3: "BSD-3-Clause", BSD2: "BSD-2-Clause", APACHE: "Apache-2.0",
    "line without end\nReleased under the MIT License.\nnext line": "MIT",
    "Licensed under CC BY-NC 4.0. And more. This work is licensed under the GNU General Public License, version 3.": "GPL-3.0,CC-BY-NC-4.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    S["gpl-grant"] + " " + S["gpl-2"] + " words. " + S["gpl-nowarranty"]: "GPL-2.0",
    S["lgpl-grant"] + " " + S["lgpl-21"]: "LGPL-2.1",
    "We licensed under pressure the copyright of a song.": "", "nothing here": "", "": "", None: "",
}


def plain(text):
    """The same recognition in plain Python."""
    known = L.known_sentences()
    ids = []
    text = re.sub(r"(?i)(spdx-license-identifier):[ \t]+", r"\1 ", text or "")
    for s in re.sub(r"([.!?;:])\s+|\n[ \t\r]*\n", lambda m: (m[1] or "") + "\1", text).split("\1"):
        whole = known.get(L.normalise(s))
        found = [whole] if whole or "\n" not in s else [known.get(L.normalise(x)) for x in s.split("\n")]
        ids += [f for f in found if f]
    seq, out = "," + ",".join(ids) + ",", []
    for pattern, ident in L.rule_table():
        if ids and re.search(pattern, seq):
            seq = re.sub(pattern, ",", seq)
            out += [ident] if ident not in out else []
    return ",".join(ids), ",".join(out)


def test_recognises(spark):
    rows = [(k, t, "en", "a", 1, *cases.EXTRA) for k, t in enumerate(TEXTS)]
    for r in L.scan(cases.docs(spark, rows)).collect():
        text = list(TEXTS)[r.doc_id]
        assert r.licenses == TEXTS[text], text
        assert (r.identifiers, r.licenses) == plain(text)


def test_order_of_sentences_matters(spark):
    rows = [(1, S["mit-notice"] + " " + S["mit-grant"], "en", "a", 1, *cases.EXTRA)]
    r = L.scan(cases.docs(spark, rows)).first()
    assert r.licenses == "" and r.unmatched == 2


def test_trigger_loses_no_known_sentence():
    for sentence in [*S.values(), *(p.format(n) for p in L.REFERENCES for ns in L.NAMES.values() for n in ns)]:
        assert re.search(L.TRIGGER, sentence.lower()) and re.search(L.TRIGGER, sentence.lower().replace(" ", "\n"))


def test_every_rule_can_match_and_names_known_sentences():
    for ident, seq in L.RULES:
        assert all(x == "*" or x in S for x in seq.split()) and ident in L.NAMES


def test_awkward_rows(spark):
    out = L.scan(cases.docs(spark)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in cases.rows()) and {r.licenses for r in out} == {""}
    assert L.scan(cases.empty(spark)).count() == 0


def brute(ids):
    """Licences and number of identifiers left, by trying every start; a rule
    is followed sentence by sentence."""
    opens, used, found = {seq.split()[0] for _, seq in L.RULES}, set(), []

    def ends(start, parts):
        at, hit = start + 1, [start]
        for gap, part in zip(parts, parts[1:]):
            if part == "*":
                continue
            while at < len(ids) and gap == "*" and ids[at] not in opens and (at in used or ids[at] != part):
                at += 1
            if at == len(ids) or at in used or ids[at] != part:
                return None
            hit.append(at)
            at += 1
        return hit

    rules = [(ident, seq.split()) for ident, seq in L.RULES] + [(i, ["ref-" + i.lower()]) for i in L.NAMES]
    for ident, parts in rules:
        for start in range(len(ids)):
            hit = ends(start, parts) if start not in used and ids[start] == parts[0] else None
            if hit:
                used.update(hit)
                found += [ident] if ident not in found else []
    return ",".join(found), len(ids) - len(used)


ISC = S["isc-grant"] + "\n\n" + S["isc-asis"]


def test_several_licences_in_one_text(spark):
    notice = "\n\n".join([BSD2, ISC, "Licensed under the MIT License.", BSD3])
    both = "\n\n".join([S["bsd-grant"], S["bsd-source"], "Released under the MIT License.", S["bsd-binary"], S["bsd-endorse"], S["bsd-asis"]])
    rng, texts = random.Random(5), [notice, both, "\n\n".join([MIT, APACHE, MIT, BSD2])]
    sentences = list(S.values()) + ["Licensed under the MIT License.", "SPDX-License-Identifier: ISC"]
    for _ in range(60):
        parts = [rng.choice([MIT, BSD2, BSD3, ISC, APACHE, *sentences]) for _ in range(rng.randint(2, 8))]
        whole = "\n\n".join(parts).split("\n\n")
        texts.append("\n\n".join(x for x in whole if rng.random() < 0.95))
    got = {r.doc_id: r for r in L.scan(cases.docs(spark, [(k, t, "en", "a", 1, *cases.EXTRA) for k, t in enumerate(texts)])).collect()}
    assert (got[0].licenses, got[0].unmatched) == ("BSD-3-Clause,BSD-2-Clause,ISC,MIT", 0)
    assert (got[1].licenses, got[1].unmatched) == ("BSD-3-Clause,MIT", 0)
    assert (got[2].licenses, got[2].unmatched) == ("MIT,BSD-2-Clause,Apache-2.0", 0)
    for k in range(len(texts)):
        assert (got[k].licenses, got[k].unmatched) == brute(got[k].identifiers.split(",") if got[k].identifiers else []), texts[k]


def test_long_texts(spark):
    n = 50_000
    texts = [S["mit-grant"] + "\n\n" + "All rights reserved.\n\n" * n,
             (S["mit-grant"] + "\n\n") * n + S["mit-notice"]]
    rows = [(k, t, "en", "a", 1, *cases.EXTRA) for k, t in enumerate(texts)]
    got = {r.doc_id: (r.n_known, r.licenses, r.unmatched) for r in L.scan(cases.docs(spark, rows)).collect()}
    assert got == {0: (n + 1, "", n + 1), 1: (n + 1, "MIT", n - 1)}


NAMED = {
    BSD3.replace("the copyright holder", "Google Inc."): "BSD-3-Clause",
    BSD3.replace("the copyright holder", "the University of\n  Somewhere").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS"): "BSD-3-Clause",
    BSD3.replace(S["bsd-endorse"], "The name of the author may not be used to endorse or promote products derived from this software "
                 "without specific prior written permission."): "BSD-3-Clause",
    MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "THE X CONSORTIUM"): "MIT",
    ISC.replace("THE AUTHOR DISCLAIMS", "INTERNET SOFTWARE CONSORTIUM DISCLAIMS"): "ISC",
    "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
    "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode": "MIT,Apache-2.0,BSD-3-Clause",
    "// SPDX-License-Identifier: LGPL-2.1-only WITH Some-exception": "LGPL-2.1",
    "/* SPDX-License-Identifier:\tGPL-3.0+ */": "GPL-3.0",
    "SPDX-License-Identifier: Unknown-1.0 or ISC": "ISC",
    "Licensed under the Apache License 2.0 or the MIT license.": "MIT,Apache-2.0",
    "Dual licensed under MIT and GPLv3.": "MIT,GPL-3.0",
    "This project is licensed under either the zlib License or the Unlicense.": "Zlib,Unlicense",
    "Licensed under the GNU General Public License, version 2 or later.": "GPL-2.0",
    "Licensed under pressure and duress.": "",
    "Neither the name of " + "a" * 300 + " nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.": "",
    "SPDX-License-Identifier: MIT" + " " * 50_000 + "OR" + "(" * 50_000 + "ISC": "MIT,ISC",
    "Licensed under " + "the " * 50_000 + "MIT or ISC": "ISC",
}


def test_holders_expressions_and_lists(spark):
    """Also against the SQL."""
    import duckdb

    from shoal.llm.oracle import SQL

    texts = list(NAMED) + list(TEXTS)
    got = {r.doc_id: r for r in L.scan(cases.docs(spark, [(k, t, "en", "a", 1, *cases.EXTRA) for k, t in enumerate(texts)])).collect()}
    for k, (text, want) in enumerate(NAMED.items()):
        assert got[k].licenses == want, (text[:200], got[k])
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
        rows = con.execute(f"SELECT doc_id, n_known, identifiers, licenses, unmatched FROM ({SQL['op5_license_scan']})").fetchall()
    assert {tuple(r) for r in rows} == {(k, *(r[c] for c in ("n_known", "identifiers", "licenses", "unmatched"))) for k, r in got.items()}
