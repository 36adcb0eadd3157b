import re
import textwrap

from helpers import odd_rows, table
from incidentlab.llm.licenses import GAP, RULES, SENTENCES, Recogniser, scan_licenses
from incidentlab.llm.queries import op10_license_scan

MIT = "\n".join(["The MIT License (MIT)", SENTENCES["mit-grant"], SENTENCES["mit-notice"]])


RECOGNISER = Recogniser()


def names(text):
    return [n for n, _, _ in RECOGNISER.match(text)]


def test_every_rule_is_recognised():
    for name, ids in RULES:
        assert names("Intro.\n" + "\n".join(SENTENCES[i] for i in ids) + "\nEnd.") == [name]


def test_order_gaps_and_longest_first():
    assert names(MIT) == ["MIT"]
    assert names(MIT.replace("\n", "\nA line.\nAnother line.\n")) == ["MIT"]
    assert names(MIT.replace("\n", "\nx y." * (GAP + 1) + "\n")) == []
    assert names("\n".join([SENTENCES["mit-notice"], SENTENCES["mit-grant"]])) == []
    bsd = [SENTENCES[f"bsd-{x}"] for x in ("grant", "source", "binary", "endorse")]
    assert names("\n".join(bsd)) == ["BSD-3-Clause"] and names("\n".join(bsd[:3])) == ["BSD-2-Clause"]
    assert names("RELEASED under###  the mit license!\nLicensed under CC BY-NC 4.0.") == ["MIT", "CC-BY-NC-4.0"]
    assert names("Released under the MIT License agreement.") == []


def test_wrapped_and_behind_comment_marks():
    filler = "This sentence is not in the table and is long enough to be wrapped as well, at 70 columns. "
    for eol in ("\n", "\r\n"):
        for mark in ("", "    ", " * ", "# ", "// ", ";; "):
            for name, ids in (*RULES[:40], *RULES[40::9]):
                for between in ("\n", "\n\n", f"\n{filler * GAP}\n"):
                    parts = [x for s in ("Intro.", *(SENTENCES[i] for i in ids), "End.") for x in (s, between)]
                    lines = [y for x in "".join(parts).split("\n") for y in textwrap.wrap(x, 70) or [""]]
                    assert names(eol.join(mark + x for x in lines)) == [name]
    far = f"{SENTENCES['mit-grant']}\n{filler * (GAP + 1)}\n{SENTENCES['mit-notice']}"
    assert names("\n".join(textwrap.wrap(far, 70))) == []
    apache = [SENTENCES[f"apache-{x}"] for x in ("under", "comply", "copy")]
    text = "# " + " ".join(apache[:2]) + "\n# " + apache[2].replace(" at ", " at\n#\n#     ") + "\n#\n# Unless"
    ((name, a, b),) = Recogniser().match(text)
    assert name == "Apache-2.0" and text[a:b].endswith("LICENSE-2.0")
    assert names("Released under\nthe BSD or\nthe MIT License.") == []


def test_fields_take_names():
    bsd = [SENTENCES[f"bsd-{x}"] for x in ("grant", "source", "binary", "endorse")]
    for holder in ("the copyright holder", "Example Org., Inc.", "the University of Somewhere", "X"):
        assert names("\n".join(bsd).replace("<holder>", holder)) == ["BSD-3-Clause"]
    many = " ".join(f"w{i}" for i in range(20))
    assert names("\n".join(bsd).replace("<holder>", many)) == ["BSD-2-Clause"]
    advert = SENTENCES["bsd-advert"].replace("<holder>", "the Example Project and its contributors")
    assert names("\n".join([*bsd[:3], advert, bsd[3].replace("<holder>", "Y")])) == ["BSD-4-Clause"]
    both = SENTENCES["bsd-endorse-or"].replace("<holder>", "Y").replace("<contributors>", "other contributors")
    assert names("\n".join([*bsd[:3], both])) == ["BSD-3-Clause"]


def test_sentences_within_a_line():
    assert names("This project is released under the MIT License.") == ["MIT"]
    assert names("Copyright 2020 X, Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    assert names("It is not released under the MIT License.") == []
    assert names("Never licensed under the ISC License.\nlicensed under the ISC License") == ["ISC"]
    text = "é. All of it is distributed under the GNU General Public License, version 2 or later. Tail"
    ((name, a, b),) = RECOGNISER.match(text)
    assert name == "GPL-2.0-or-later" and text[a:b].startswith("distributed under") and text[a:b].endswith("later.")


def test_spdx_tags():
    for tag, want in (
        ("MIT", "MIT"), ("GPL-2.0-only", "GPL-2.0"), ("LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("MPL-2.0", "MPL-2.0"),
        ("Apache-2.0 OR MIT", "Apache-2.0"), ("GPL-2.0 WITH Classpath-exception-2.0", "GPL-2.0"), ("0BSD", "0BSD"),
    ):
        for mark, close in (("# ", ""), ("/* ", " */"), ("// ", "")):
            assert names(f"x = 1\n{mark}SPDX-License-Identifier: {tag}{close}\nimport y") == [want]
    assert names("SPDX-License-Identifier: Unknown-1.0") == []


def test_table_covers_many_licences():
    assert len({name for name, _ in RULES}) >= 30


def test_spans():
    text = "é Intro. Released under the MIT License. Tail"
    ((name, a, b),) = Recogniser().match(text)
    assert text[a:b].strip() == "Released under the MIT License."


def test_edges(spark):
    rows = [*odd_rows(), (70, "x. " * 50_000 + MIT)]
    got = scan_licenses(table(spark, rows))
    assert got.columns.count("matches") == 1 and got.count() == len(rows)
    assert {r.doc_id for r in got.collect() if r.matches} == {70}
    assert scan_licenses(table(spark, [])).count() == 0


def test_registered_query_against_brute_force(spark):
    """The single-sentence notices of the test tables, found line by line."""
    sf = "/root/testdata/sf0.01"
    single = {ids[0]: name for name, ids in RULES if len(ids) == 1}
    known = {re.sub("[^a-z0-9]+", " ", SENTENCES[k].lower()).strip(): n for k, n in single.items()}
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        parts = re.split(r"(?<=[.!?;])\s|[\r\n]", r.text or "")
        want[r.doc_id] = [known[x] for p in parts if (x := re.sub("[^a-z0-9]+", " ", p.lower()).strip()) in known]
    assert sum(map(len, want.values())) > 5
    for r in op10_license_scan(spark, sf).collect():
        assert [s.rsplit(":", 2)[0] for s in r.spans.split(",") if s] == want[r.doc_id]
        assert r.licenses == ",".join(sorted(set(want[r.doc_id]))) and r.n_notices == len(want[r.doc_id])
