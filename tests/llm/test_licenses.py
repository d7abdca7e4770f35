from __future__ import annotations

from newsmart.llm import licenses

FOUND = [
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("Distributed under the terms of the GNU General Public License, version 2", ["GPL-2.0"]),
    ("under the GNU Lesser General Public License, version 3 or later", ["LGPL-3.0"]),
    ("Released under the MIT License.", ["MIT"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("// SPDX-License-Identifier: MIT", ["MIT"]),
    ("Released%%% under*** the MIT### License.", ["MIT"]),
    ("licensed under the MIT License or the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]),
    ("x " * 40_000 + "Released under the MIT License. " + "y " * 40_000, ["MIT"]),
    ("Copyright 2020, all rights reserved", []),
    ("He got a driving licence in June and a fishing license.", []),
    ("the mit students have a license", []),
    ("license " * 5000, []),
    ("", []),
]


def test_notices():
    listed = licenses.templates()
    for text, want in FOUND:
        assert sorted(r[1] for r in licenses.scan(text, listed)) == want, text[:60]


def test_every_form_is_found_as_its_own():
    listed = licenses.templates()
    for t in listed:
        for notice in licenses.NOTICES[:4]:
            got = [r[1] for r in licenses.scan("Some words before. " + notice.format(t.name) + " And after.", listed)]
            if t.name != t.license:
                assert got == [t.license], (t, got)


def test_rows(spark, documents):
    rows = [(1, "a\n" + FOUND[0][0] + "\n" + FOUND[4][0]), (1, FOUND[4][0]), (None, FOUND[4][0]), (2, None), (3, "none")]
    got = sorted(((r.doc_id, r.line, r.license) for r in licenses.find(documents(rows)).collect()), key=repr)
    assert got == sorted([(1, 1, "Apache-2.0"), (1, 2, "MIT"), (1, 0, "MIT"), (None, 0, "MIT")], key=repr)
    assert licenses.find(documents(rows).limit(0)).count() == 0


def of(text):
    return sorted(r[1] for r in licenses.scan(text, licenses.templates()))


def test_bodies_need_no_name():
    """Whole texts and standard headers, as one line, wrapped, and behind comment marks, with small changes."""
    for license_, (body, _) in licenses.BODIES.items():
        words = body.split()
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        for text in (body, wrapped, "\n".join(f" * {x}" for x in wrapped.split("\n"))):
            assert set(of("Some prose before.\n\n" + text + "\n\nint main() { return 0; }")) == {license_}, (license_, text[:80])
        changed = [w for i, w in enumerate(words) if i % 17 != 9]
        if len(words) > 100:
            assert set(of(" ".join(changed))) <= {license_}
    mit, bsd = licenses.BODIES["MIT"][0], licenses.BODIES["BSD-3-Clause"][0]
    assert of(mit.replace("Software", "Program").replace("SOFTWARE", "PROGRAM")) == ["MIT"]
    assert of(f"{mit}\n\n{bsd}") == ["BSD-3-Clause", "MIT"]
    lines = [r[0] for r in licenses.scan(f"a\n{mit}\nb\n" + "word " * 200 + f"\n{mit}", licenses.templates())]
    assert lines == [1, 4]


def test_wrapped_notices_and_headings():
    assert of("Licensed under the Apache License,\nVersion 2.0") == ["Apache-2.0"]
    assert of("# Released under the GNU General\n# Public License, version 3\n") == ["GPL-3.0"]
    assert of("Licensed under Creative\nCommons Attribution 4.0") == ["CC-BY-4.0"]
    assert of("MIT License") == ["MIT"] and of("text\n\nThe MIT License (MIT)\n\nmore text") == ["MIT"]
    assert of("Apache License\nVersion 2.0, January 2004\nTERMS") == ["Apache-2.0"]
    assert of("## License\n\nMIT\n") == ["MIT"]
    assert of("He lost his license\nMIT students helped") == []
