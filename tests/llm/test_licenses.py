"""License scan against exact containment."""

import re

from stagecheck.llm.licenses import TEMPLATES, find_licenses


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(text):
    found = shingles(text)
    best = {}
    for name, template in TEMPLATES:
        wanted = set(shingles(template))
        at = [i for i, s in enumerate(found) if s in wanted]
        for a in at:
            near = [p for p in at if a <= p < a + 2 * len(wanted)]
            share = len({found[p] for p in near}) / len(wanted)
            if share >= 0.8:
                best[name] = min(best.get(name, (0, 0, name, 0, 0)), (-share, -len(wanted), name, a, near[-1] + 4))
    return sorted(m[2] for m in best.values() if not any(n < m and n[3] <= m[4] and m[3] <= n[4] for n in best.values() if n[2] != m[2]))


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in df.collect()}
    assert {r.doc_id: r.licenses for r in find_licenses(df).collect()} == want
    assert any(want.values())


def test_places_and_defined_cases(spark):
    long = next(t for n, t in TEMPLATES if n == "MIT" and "merge" in t)
    cut = long.replace("merge", "blend")  # a changed word costs five shingles
    texts = [None, "", "one two", "released UNDER the mit license", "x " * 30 + long + " y" * 40, cut, long[:120], (TEMPLATES[1][1] + "\n") * 500]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    got = {r.doc_id: r for r in find_licenses(df).collect()}
    assert {i: got[i].licenses for i in got} == {i: brute(t) for i, t in enumerate(texts)}
    assert [tuple(m) for m in got[3].matches] == [("MIT", 1.0, 0, 4)]
    assert got[4].matches[0].first_word == 30 and got[5].matches[0].containment < 1
    assert find_licenses(df, templates=()).where("size(licenses) > 0").count() == 0
    assert find_licenses(df.where("false")).count() == 0


def test_licenses_with_shared_wording_are_told_apart(spark):
    names = [n for n, _ in TEMPLATES]
    rows = [(i, f"Copyright 2020 somebody else here {t} and so on it goes") for i, (_, t) in enumerate(TEMPLATES)]
    got = {r.doc_id: r.licenses for r in find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i] for i in got} == {i: [n] for i, n in enumerate(names)}
    assert {"BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1"} <= set(names)
