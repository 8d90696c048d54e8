"""License scans: alignment against plain versions, planted notices, quick test without loss."""

import random

from sluice.llm import licenses

SCHEMA = "doc_id long, text string, license string, coverage double, key int"
SF = "/root/testdata/sf0.01"


def _longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_increasing_is_longest():
    rnd = random.Random(1)
    for _ in range(200):
        v = rnd.sample(range(30), rnd.randrange(0, 12))
        got = [v[i] for i in licenses.increasing(v)]
        best = [0] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max([best[j] for j in range(i) if v[j] < v[i]], default=0)
        assert got == sorted(got) and len(got) == max(best, default=0)


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 14))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= _longest_common(a, b)
    a = "x one two three two four y".split()
    assert len(licenses.align(a, "one two three two four".split())) == 5


def _brute(scanner, raw):
    """Licenses with a window anywhere that aligns enough; no quick test, no counting."""
    text, out = licenses.words_of(raw), set()
    for name, words, _ in scanner.templates:
        width = int(len(words) * scanner.reach) + 2
        for i in range(len(text)):
            if text[i] in words and len(licenses.align(text[i:i + width], words)) >= scanner.min_coverage * len(words):
                out.add(name)
                break
    return out


def test_quick_test_and_windows_lose_nothing():
    rnd = random.Random(3)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for _ in range(60):
        name = rnd.choice(sorted(licenses.TEMPLATES))
        words = licenses.TEMPLATES[name].split()
        for _ in range(rnd.choice([0, 1, len(words) // 10, len(words) // 5])):
            k = rnd.randrange(len(words))
            words[k:k + 1] = rnd.choice([[], [words[k], "inserted"], ["changed"]])
        raw = " ".join(rnd.choices("the of license version und la".split(), k=20) + words
                       + rnd.choices("to and software or public".split(), k=20)).encode()
        assert {x[0] for x in scanner.scan(raw)} == _brute(scanner, raw)


def test_findings(spark):
    mit, gpl = licenses.TEMPLATES["MIT text"], licenses.TEMPLATES["GPL-3.0"]
    rows = [(1, "intro\n" + mit.upper()), (2, mit.replace("associated", "linked") + " filler " * 50 + gpl + " x " + gpl),
            (3, "license " * 5000), (4, None), (5, ""), (6, "word " * 30_000 + "Released under the MIT License."),
            (None, gpl), (7, "Released under the license of MIT")]
    df = spark.createDataFrame([(*r, "x", 0.0, 1) for r in rows], SCHEMA)
    got = sorted((str(r["doc_id"]), r["license"], r["end_word"] - r["start_word"]) for r in licenses.scan_licenses(df).collect())
    n = len(licenses.words_of(mit.encode()))
    assert got == [("1", "MIT text", n), ("2", "GPL-3.0", 12), ("2", "GPL-3.0", 12), ("2", "MIT text", n),
                   ("6", "MIT", 5), ("None", "GPL-3.0", 12)]
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    assert licenses.scan_licenses(df, templates={}).count() == 0


def test_planted_notices_are_found(spark):
    notices = {k: licenses.TEMPLATES[k] for k in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r["doc_id"], r["license"]) for r in licenses.op10_query(spark, SF).collect()}
    planted = {(i, k) for i, t in docs.items() for k, v in notices.items() if v.lower() in t.lower()}
    assert len(planted) > 20 and planted <= got
    assert all("licens" in docs[i].lower() for i, _ in got)


def test_deciding_words_tell_licenses_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES, strict=True)
    found = lambda text: {x[0] for x in scanner.scan(text.encode())}
    gpl, header = licenses.TEMPLATES["GPL-3.0"], licenses.TEMPLATES["GPL-3.0 header"]
    for text, wrong in [
            ("Licensed under CC BY 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-NC-4.0"),
            ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC 3.0.", "CC-BY-NC-4.0"),
            (gpl.replace("3", "2"), "GPL-3.0"), (gpl.replace("GNU", "GNU Lesser"), "GPL-3.0"),
            (gpl.replace("GNU", "GNU Affero"), "GPL-3.0"), (gpl.replace("3.", "3.1."), "GPL-3.0"),
            (header.replace("version 3", "version 2"), "GPL-3.0 header"),
            (header.replace("GNU", "GNU Lesser"), "GPL-3.0 header"),
            ("Licensed under the Academic License, Version 2.0.", "Apache-2.0"),
            ("Licensed under the Apache License, Version 1.1.", "Apache-2.0")]:
        assert wrong not in found(text), text
    for name, text in licenses.TEMPLATES.items():
        assert name in found("see below 2. " + text + " 2 more"), name
    assert "Apache-2.0" in found("Licensed under the Apache License, Version 2")
    assert "GPL-3.0" in found(gpl.replace("License,", "License (GPL),"))
    assert "GPL-3.0 header" in found(header.replace("program", "library"))
    assert "CC-BY-NC-4.0" in found("Licensed under CC BY-SA 4.0. Licensed under CC BY-NC 4.0.")


def test_usual_licenses_have_a_row(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES, strict=True)
    assert licenses.TEMPLATES["MIT full text"].endswith("OTHER DEALINGS IN THE SOFTWARE.")
    assert licenses.TEMPLATES["ISC text"].endswith("PERFORMANCE OF THIS SOFTWARE.")
    for name, text in licenses.TEMPLATES.items():
        assert [x[0] for x in scanner.findings(("on 2. " + text + " 2 more").encode())] == [name]
    lines = {"Licensed under CC BY 4.0.": ["CC-BY-4.0"], "Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0"],
             licenses.TEMPLATES["GPL-3.0"].replace("3", "2"): ["GPL-2.0"],
             licenses.TEMPLATES["GPL-3.0"].replace("GNU", "GNU Lesser"): ["LGPL-3.0"],
             "SPDX-License-Identifier: BSD-3-Clause\nor more": ["BSD-3-Clause"],
             "// SPDX-License-Identifier: (MIT OR Zlib) AND GPL-2.0-only WITH Classpath-exception-2.0 and X11":
                 ["GPL-2.0-only", "MIT", "X11", "Zlib"],
             "SPDX-License-Identifier:": [], "see SPDX": []}
    df = spark.createDataFrame([(i, t, "x", 0.0, 1) for i, t in enumerate(lines)], SCHEMA)
    got = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(df).collect()}
    assert got == {(i, k) for i, v in enumerate(lines.values()) for k in v}
    raw = b"one two SPDX-License-Identifier: MIT\nthree spdx-license-identifier: ISC"
    assert licenses.spdx_lines(raw) == [("MIT", 1.0, 5, 6), ("ISC", 1.0, 10, 11)]
