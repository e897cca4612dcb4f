"""License scans: planted templates, edited ones, and all notices of the test table against plain search."""

import os
import random

import pytest
from common import documents, prose

from tidelog.llm.licenses import TEMPLATES, Scanner, candidate_blocks, differences, scan, wording

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", TEMPLATES)
def test_templates_are_told_apart(name):
    scanner = Scanner(TEMPLATES)
    best = scanner.best(TEMPLATES[name], TEMPLATES[name])
    assert (best["license"], best["missing"], best["added"], best["confirmed"]) == (name, 0, 0, True)
    noise = " ".join(prose(1, 12))
    (_, *block), *_ = candidate_blocks(f"{noise}\n\n\n\n{TEMPLATES[name]}\n\n\n\n{noise}")
    assert scanner.best(*block)["license"] == name and scanner.best(*block)["confirmed"]


def test_own_dictionary_saves_most():
    scanner = Scanner(TEMPLATES)
    for name, text in TEMPLATES.items():
        if len(text) > 100:
            assert scanner.reductions(text)[0][1] == name


def test_differences():
    template = wording("a b c d e f g h i j")
    assert differences(template, wording("x a b c d e f g h i j y")) == (0, 0)
    assert differences(template, wording("a b c z z d e f g i j")) == (1, 2)
    assert differences(template, wording("nothing of it")) == (10, 0)


def test_scan(spark):
    mit = TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "for a fee").replace("shall be included", "should be included")
    texts = [
        mit, "Copyright 2020 Somebody\n" + mit + "\n" + " ".join(prose(1, 50)), changed, None, "", "no such words",
        "permission to speak freely is a nice thing to have", " ".join(prose(2, 60000)) + " Licensed under CC BY-SA 4.0. " + " ".join(prose(3, 500)), mit,
        TEMPLATES["GPL-2.0-or-later"] + "\n" * 9 + TEMPLATES["MPL-2.0"],
    ]
    docs = documents(spark, texts, extra="row,start,license,findings")
    got = {}
    for r in scan(docs, "text", ["doc_id"]).select("row.doc_id", "license", "missing", "added", "confirmed").collect():
        if r.confirmed:
            got.setdefault(r.doc_id, []).append((r.license, r.missing, r.added))
    assert got[0] == got[1] == got[8] == [("MIT", 0, 0)]
    assert got[2] == [("MIT", 4, 4)] and got[7] == [("CC-BY-SA-4.0 (notice)", 0, 0)]
    assert sorted(x for x, *_ in got[9]) == ["GPL-2.0-or-later", "MPL-2.0"] and set(got) == {0, 1, 2, 7, 8, 9}
    assert scan(docs.where("false"), "text", ["doc_id"]).collect() == []


def confirmed(spark, texts):
    got = {i: [] for i in range(len(texts))}
    for r in scan(documents(spark, texts), "text", ["doc_id"]).orderBy("start").collect():
        if r.confirmed:
            got[r.row.doc_id].append((r.start, r.license))
    return got


def test_licenses_side_by_side(spark):
    mit, apache, isc, notice = TEMPLATES["MIT"], TEMPLATES["Apache-2.0"], TEMPLATES["ISC"], "Licensed under CC BY 4.0."
    edited = mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "ACME CORPORATION")
    other = mit.replace("free of charge", "for a fee")
    within = mit.replace("THE SOFTWARE IS PROVIDED", f"{notice} THE SOFTWARE IS PROVIDED")
    texts = [
        f"Released under the MIT License.\n{notice}", f"{mit}\n{notice}\n{isc}", "\n".join([apache, mit] * 8), f"{edited} {other} {edited}",
        within, f"{TEMPLATES['GPL-2.0-or-later']} {TEMPLATES['GPL-3.0-or-later']}", f"İ {notice} {notice}",
    ]
    got = confirmed(spark, texts)
    names = {i: [name for _, name in x] for i, x in got.items()}
    assert names == {
        0: ["MIT (notice)", "CC-BY-4.0 (notice)"], 1: ["MIT", "CC-BY-4.0 (notice)", "ISC"], 2: ["Apache-2.0", "MIT"] * 8, 3: ["MIT"] * 3,
        4: ["MIT", "CC-BY-4.0 (notice)"], 5: ["GPL-2.0-or-later", "GPL-3.0-or-later"], 6: ["CC-BY-4.0 (notice)"] * 2,
    }
    assert got[0][1][0] == texts[0].index("Licensed") and got[4][1][0] == within.index("Licensed")
    assert [start for start, _ in got[3]] == [0, len(edited) + 1, len(edited) + len(other) + 2]


def test_edited_licenses_in_long_lines(spark):
    mit = " ".join(TEMPLATES["MIT"].split())
    edited = mit.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "ACME CORPORATION")
    far = mit[: mit.index("THE SOFTWARE IS PROVIDED")]  # half of it
    before, after = " ".join(prose(1, 4000))[:2000], " ".join(prose(2, 4000))[:2000]
    texts = [f"{before} {x} {after}" for x in (edited, far)]
    assert confirmed(spark, texts) == {0: [(2001, "MIT")], 1: []}
    rows = scan(documents(spark, texts), "text", ["doc_id"]).where("row.doc_id = 1").collect()
    assert [(r.license, r.confirmed) for r in rows] == [("MIT", False)]
    scanner = Scanner(TEMPLATES)
    assert dict((name, r) for r, name in scanner.reductions(texts[0]))["MIT"] > 0.8


def test_relatives_are_told_apart(spark):
    """No license goes by the name of another one, also where that one is not among the templates."""
    names = [n for n in TEMPLATES if "GPL" in n or "BSD" in n or n in ("MIT", "ISC")]
    texts = [TEMPLATES[n] for n in names]
    assert confirmed(spark, texts) == {i: [(0, n)] for i, n in enumerate(names)}
    unknown = [
        TEMPLATES["LGPL-2.1-or-later"].replace("2.1", "2").replace("Lesser", "Library"), TEMPLATES["AGPL-3.0-or-later"].replace("version 3", "version 4"),
        TEMPLATES["GPL-2.0-or-later"].replace("either version 2", "either version 5"), TEMPLATES["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED", "Neither the name may be used. THIS SOFTWARE IS PROVIDED"),
    ]
    assert confirmed(spark, unknown) == {i: [] for i in range(4)}
    rest = {n: t for n, t in TEMPLATES.items() if not n.startswith(("LGPL", "AGPL", "BSD-3"))}
    docs = documents(spark, [TEMPLATES[n] for n in ("LGPL-3.0-or-later", "AGPL-3.0-or-later", "BSD-3-Clause")])
    assert scan(docs, "text", ["doc_id"], rest).where("confirmed").collect() == []


def test_against_every_window_and_template():
    """Windows that are compressed lose no place that differs little, wherever it stands."""
    scanner = Scanner(TEMPLATES)
    draw = random.Random(5)
    for round_ in range(60):
        words: list[str] = prose(round_, draw.randint(0, 300))
        for _ in range(draw.randint(1, 4)):
            name = draw.choice(list(TEMPLATES))
            own = list(scanner.words[name])
            for _ in range(draw.randint(0, int(0.06 * len(own)))):
                own[draw.randrange(len(own))] = draw.choice(["other", "new", "words"])
            words += own + prose(draw.random(), draw.randint(0, 120))
        text = " ".join(words)
        want: dict[str, set] = {}
        for name in TEMPLATES:  # all windows, without compression
            for taken, missing, added in scanner.places(name, words):
                want.setdefault(name, set()).add((-len(scanner.words[name]), missing + added, name, tuple(taken)))
        used, plain = set(), []
        for _, _, name, taken in sorted(x for found in want.values() for x in found):
            if used.isdisjoint(taken):
                used.update(taken)
                plain.append(name)
        assert sorted(f["license"] for f in scanner.confirmed(text)) == sorted(plain)


def test_nothing_of_a_table_without_licenses(spark):
    assert confirmed(spark, ["the license of " + " ".join(prose(i, 3000)) for i in range(3)]) == {0: [], 1: [], 2: []}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
def test_notices_of_the_table(spark):
    from tidelog.llm.queries import QUERIES

    want = set()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        want |= {(r.doc_id, name) for name, t in TEMPLATES.items() if "notice" in name and f" {' '.join(wording(t))} " in f" {' '.join(wording(r.text))} "}
    got = {(r.doc_id, r.license) for r in QUERIES["op6_licenses"](spark, SF_DIR).where("confirmed").collect()}
    assert len(want) > 10 and got == want
