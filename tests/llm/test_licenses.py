import random

from sparkloom.llm import licenses


def test_templates_find_themselves():
    scanner = licenses.Scanner()
    for name, text in licenses.TEMPLATES:
        found = scanner.scan(f"Some words before it.\n{text}\nAnd words after it")
        assert [(f["license"], f["exact"]) for f in found] == [(name, True)], text
        assert found[0]["start"] >= 22


def test_changed_words_are_reported():
    scanner = licenses.Scanner()
    text = licenses.TEMPLATES[1][1].replace("may not", "must not")
    found = scanner.scan(text)
    assert [(f["license"], f["exact"], f["differences"]) for f in found] == [("Apache-2.0", False, [{"template": "may", "text": "must"}])]
    assert scanner.scan("This work is licensed under the GNU General Public License, version 9.") == []


def test_two_licenses_in_one_block():
    text = "Released under the MIT License. Licensed under CC BY-NC 4.0."
    assert [f["license"] for f in licenses.Scanner().scan(text)] == ["MIT", "CC-BY-NC-4.0"]


def test_prose_about_licenses():
    for text in ("She had a license to drive.", "Without permission nobody may enter the house.", "The copyright of this book is old.", "license " * 500):
        assert licenses.Scanner().scan(text) == []


def test_notice_inside_a_long_line():
    text = "word " * 20_000 + "Licensed under CC BY 4.0. " + "word " * 20_000
    found = licenses.Scanner().scan(text)
    assert [(f["license"], text[f["start"] : f["end"]]) for f in found] == [("CC-BY-4.0", "Licensed under CC BY 4.0")]


def test_long_runs_of_cues():
    notice = "Released under the MIT License."
    text = "the license of the work is a license. " * 3000 + notice + " conditions of the license apply." * 3000
    found = licenses.Scanner().scan(text)
    assert [(f["license"], text[f["start"] : f["end"]]) for f in found] == [("MIT", notice[:-1])]


def test_rows(documents, odd_texts):
    assert licenses.license_notices(documents(odd_texts)).count() == 0
    rows = licenses.license_notices(documents([(None, "é Released under the MIT License."), (1, "Released under the MIT License."), (1, "Released under the MIT License.")])).collect()
    assert sorted(((r["doc_id"], r["start"]) for r in rows), key=repr) == [(1, 0), (1, 0), (None, 2)]
    assert licenses.license_notices(documents([(1, "a")]).limit(0)).count() == 0


def test_short_notices_in_prose_about_licenses():
    prose = (
        "Permission to use a work is given by its holder under conditions that a license states. The copyright notice names the person who holds the copyright. "
        "A license may permit any person to copy, modify, publish and distribute copies of the software for any purpose with or without fee, subject to the following conditions. "
        "The conditions of redistribution in source and binary forms are stated in the documentation and in other materials provided with the distribution. "
    )
    scanner = licenses.Scanner()
    for name, notice in [t for t in licenses.TEMPLATES if len(t[1]) < 120]:
        text = f"{prose}{notice} {prose}"
        found = scanner.scan(text)
        assert [(f["license"], f["exact"]) for f in found] == [(name, True)], notice
        assert text[found[0]["start"] :].startswith(notice[:-1])
    assert scanner.scan(prose) == scanner.scan("Licensed under the Apache license.") == []


def test_bsd_by_its_clauses():
    two = next(t for name, t in licenses.TEMPLATES if name == "BSD-2-Clause")
    third = " Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    assert [f["license"] for f in licenses.Scanner().scan(two)] == ["BSD-2-Clause"]
    assert [f["license"] for f in licenses.Scanner().scan(two + third)] == ["BSD-3-Clause"]
    assert [f["license"] for f in licenses.Scanner().scan("SPDX-License-Identifier: BSD-2-Clause")] == ["BSD-2-Clause"]


def test_names_that_a_text_adds_are_another_license():
    scanner = licenses.Scanner()
    cases = {
        "This work is licensed under the GNU Affero General Public License, version 3.": ["AGPL-3.0"],
        "This work is licensed under the GNU Lesser General Public License, version 3.": ["LGPL-3.0"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
        "Licensed under the Lesser Apache License, Version 2.0.": [],
        "Licensed under CC0 1.0 Universal.": ["CC0-1.0"],
        "Released under the terms of the MIT license.": ["MIT"],
        "Licensed under CC BY 3.0.": [],
        **{f"Licensed under CC {v} 4.0.": [f"CC-{v}-4.0"] for v in licenses._CC},
        **{f"This work is licensed under a Creative Commons {long} 4.0 International License.": [f"CC-{v}-4.0"] for v, long in licenses._CC.items()},
    }
    for text, want in cases.items():
        assert [f["license"] for f in scanner.scan(f"Some words. {text} More words.")] == want, text


def confirmed_by_wording(words):
    """Every template against every run of words, by the stated rule and without compression."""
    out = set()
    for name, text in licenses.TEMPLATES:
        want = [w[0].lower() for w in licenses._WORD.finditer(text)]
        for start in range(len(words)):
            have = words[start : start + len(want)]
            if sum(a == b for a, b in zip(want, have)) >= 0.8 * len(want) and licenses._telling(want) == licenses._telling(have):
                out.add(name)
    return out


def test_findings_equal_brute_force():
    rng = random.Random(6)
    scanner = licenses.Scanner()
    plain = [t for t in licenses.TEMPLATES if len(t[1]) < 500]
    for name, notice in plain * 2:
        words = notice.split(" ")
        free = [k for k, w in enumerate(words) if not licenses._CUE.search(w) and _plain(w)]
        if free and rng.random() < 0.7 and len(words) >= 8:
            at = rng.choice(free)
            changed = [*words[:at], "other", *words[at + 1 :]]
            words = changed if licenses._CUE.search(" ".join(changed)) else words
        text = "A few words come first.\n" + " ".join(words) + "\nThen some more words"
        want = confirmed_by_wording([w[0].lower() for w in licenses._WORD.finditer(text)])
        found = scanner.scan(text)
        assert {f["license"] for f in found} <= want and (name in {f["license"] for f in found}) == (name in want), text


def _plain(word):
    names, numbers = licenses._telling([w[0].lower() for w in licenses._WORD.finditer(word)])
    return not names and not numbers and word.isalpha()


def test_the_reduction_decides_among_confirmed_templates(monkeypatch):
    text = "Released under the MIT License."
    first = licenses.Scanner().scan(text)[0]
    assert (first["template"], first["exact"]) == (next(k for k, t in enumerate(licenses.TEMPLATES) if t[1] == text), True)
    real = licenses.Scanner.reductions
    monkeypatch.setattr(licenses.Scanner, "reductions", lambda self, block, templates: {k: -g for k, g in real(self, block, templates).items()})
    other = licenses.Scanner().scan(text)[0]
    assert other["template"] != first["template"] and not other["exact"] and other["license"] == "MIT"


def test_long_templates_cross_no_border():
    rng = random.Random(8)
    long = "License of the long kind. " + " ".join(f"term{rng.randint(0, 10**6)}" for _ in range(900))
    scanner = licenses.Scanner((("Long", long),))
    text = "the license says so. " * 2000 + long + " the license says so." * 2000
    assert [(f["license"], f["exact"]) for f in scanner.scan(text)] == [("Long", True)]
