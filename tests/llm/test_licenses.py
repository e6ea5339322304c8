"""License scans on quotations, near misses, and against a plain search for the notices in the given table."""

import re
import textwrap

from cirrolake.llm import licenses

SCHEMA = "doc_id bigint, text string, license string, line int"


def names(text):
    return [row[1] for row in licenses.Scanner(licenses.TEMPLATES).of(text)]


def test_every_template_is_found():
    for name, text in licenses.TEMPLATES.items():
        assert names(f"Some words before.\n{text}\nSome words after.") == [name]
        assert names(text.upper().replace(" ", "  ")) == [name]


def test_near_misses_and_slips():
    assert names("Released under the BSD License.") == []
    assert names("This work is licensed under the GNU General Public License, version 2.") == []
    assert names("He had no permission; the license plate was old.") == []
    text = licenses.TEMPLATES["MIT-text"].replace("free of charge", "free of any charge")
    ((_, name, _, covered, differences),) = licenses.Scanner(licenses.TEMPLATES).of(text)
    assert name == "MIT-text" and covered == 1.0 and differences == ["- +any"]


def test_two_in_a_block_and_long_lines():
    assert names("Licensed under CC BY-NC 4.0.\nAll rights reserved.") == ["CC-BY-NC-4.0", "reserved"]
    filler = "plain words of no interest " * 20_000
    assert names(f"{filler}Released under the MIT License. {filler}") == ["MIT"]


def test_rows_of_all_kinds(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, None), (3, ""), (None, "All rights reserved.")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = sorted(((r.doc_id, r.line, r.license) for r in licenses.scanned(df).collect()), key=str)
    assert got == sorted([(1, 0, "MIT"), (1, 0, "MIT"), (None, 0, "reserved")], key=str)
    assert licenses.scanned(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op10_licenses

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for r in rows:
        flat = re.sub(r"\s+", " ", r.text)
        expected |= {(r.doc_id, name) for name, notice in licenses.TEMPLATES.items() if notice in flat}
    got = {(r.doc_id, r.license) for r in op10_licenses(spark, "/root/testdata/sf0.01").collect()}
    assert got == expected and len({name for _, name in got}) > 3


def test_wrapped_notices_and_their_surroundings():
    for name, text in licenses.TEMPLATES.items():
        for width in range(60, 81):
            for mark in ("", "# ", " * "):
                lines = "\n".join(mark + line for line in textwrap.wrap(text, width))
                assert names(f"Some words before.\n{lines}\n\nSome words after.") == [name], (name, width, mark)


def test_parts_and_repeated_notices(monkeypatch):
    monkeypatch.setattr(licenses, "PART", 700)
    header, filler = textwrap.fill(licenses.TEMPLATES["Apache-2.0-header"], 70), "plain words of no interest\n"
    for words_before in range(560, 720, 3):
        assert names("word " * words_before + "\n" + header + "\n" + filler * 300) == ["Apache-2.0-header"]
    rows = licenses.Scanner(licenses.TEMPLATES).of(f"{filler * 10}{header}\n{filler}{header}\n{filler * 200}All rights\nreserved.")
    high = header.count("\n") + 1
    assert [(r[0], r[1]) for r in rows] == [(10, "Apache-2.0-header"), (11 + high, "Apache-2.0-header"), (211 + 2 * high, "reserved")]


def test_siblings_have_their_own_names():
    gpl3, bsd3 = licenses.TEMPLATES["GPL-3.0-header"], licenses.TEMPLATES["BSD-3-Clause"]
    assert names(gpl3.replace("version 3", "version 2")) == ["GPL-2.0-header"]
    assert names(gpl3.replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0-header"]
    assert names(gpl3.replace("GNU General", "GNU Affero General")) == ["AGPL-3.0-header"]
    assert names(gpl3.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")) == ["LGPL-2.1-header"]
    assert names(gpl3.replace("GNU General", "GNU Library General").replace("version 3", "version 2")) == ["LGPL-2.0-header"]
    assert names(gpl3.replace("version 3", "version 4")) == []
    assert names(bsd3.replace(licenses.BSD_NAMES + " ", "")) == ["BSD-2-Clause"]
    assert names(bsd3.replace(licenses.BSD_NAMES, f"{licenses.BSD_ADVERTISING} {licenses.BSD_NAMES}")) == ["BSD-4-Clause"]
    assert names(licenses.BSD) == []
    listed = bsd3.replace("Redistributions of", "1. Redistributions of").replace("Redistributions in", "2. Redistributions in")
    assert names(listed.replace("Neither the name of the copyright holder", "3. Neither the name of Example Inc.")) == ["BSD-3-Clause"]


def test_every_template_is_compressed_and_ranked():
    """On its own notice each template saves most, also among siblings that differ in a word or hold the whole text."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, notice in licenses.TEMPLATES.items():
        alone, ranked = scanner.reductions(licenses.words(notice))
        assert {n for _, n in ranked} == set(licenses.TEMPLATES) and alone > 0
        best = [n for less, n in ranked if less == ranked[0][0]]
        assert name in best, (name, ranked[:3])
    assert [less for less, _ in ranked] == sorted((less for less, _ in ranked), reverse=True)


def test_compression_decides(monkeypatch):
    """A block that two templates' wording confirms goes to the one that saves more; without compression it would not."""
    header = licenses.TEMPLATES["Apache-2.0-header"]
    assert names(header) == ["Apache-2.0-header"]
    monkeypatch.setattr(licenses.Scanner, "reductions", lambda self, block: (1, [(1, n) for n in sorted(self.words)]))
    monkeypatch.setattr(licenses.Scanner, "saved", lambda self, name, found: (1, 1.0))
    assert names(header) != ["Apache-2.0-header"]


def test_ties_go_by_name():
    twins = {"b": licenses.TEMPLATES["ISC"], "a": licenses.TEMPLATES["ISC"]}
    assert [row[1] for row in licenses.Scanner(twins).of(licenses.TEMPLATES["ISC"])] == ["a"]


def test_random_slips_against_all_templates():
    """With a word replaced or added at random places, winner and differences are those of a plain search of all templates."""
    import random

    rng, scanner = random.Random(4), licenses.Scanner(licenses.TEMPLATES)
    for name, notice in licenses.TEMPLATES.items():
        expected = licenses.words(notice)
        for _ in range(6):
            found = list(expected)
            for _ in range(rng.randrange(scanner.slips[name] + 1)):
                found.insert(rng.randrange(1, len(found)), "zebra")
            text = " ".join(["words", "before", *found, "words", "after", "license"])
            every = [n for n in licenses.TEMPLATES if scanner.confirmed(n, licenses.words(text))]
            got = scanner.of(text)
            assert [row[1] for row in got] == [name] and name in every
            assert " ".join(got[0][4]).count("+zebra") <= found.count("zebra")
            assert sum(x.count("zebra") for x in got[0][4]) == found.count("zebra")
