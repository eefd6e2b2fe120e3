"""Base counts against brute force; robust distances against numpy."""

import math
import random
import re
from collections import Counter

import numpy as np

from stagecheck.llm import quality
from stagecheck.llm.quality import CUTOFF, judge_quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_base_counts_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in df.collect()}
    assert {r.doc_id: counts(r) for r in judge_quality(df).collect()} == want


def test_odd_texts_groups_and_columns(spark):
    texts = [None, "", " \n\t", "a b", "a b c a b c a b c", "x\x0by\x0cz\rw", "é#🎉 |<\n\nq\nq\n \nq", "w " * 5000, "l\n" * 400]
    rows = [(i if i else None, t, None if i % 2 else "en", None, 3.0, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, distance double, n int")
    got = judge_quality(df).collect()
    assert sorted(counts(r) for r in got) == sorted(brute(t) for t in texts)
    assert all(r.distance is None for r in got)  # no group is large enough to be judged
    assert all(r.kept == (not r.base_failed) for r in got)
    assert judge_quality(df.where("false")).count() == 0


def test_outliers_go_and_clean_texts_stay(spark):
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(400)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(60, 300))), "en", "a") for i in range(120)]
    rows += [(1000 + i, " ".join(w + "$$$###" for w in draw.choices(words, k=100)), "en", "a") for i in range(15)]
    rows += [(2000 + i, "only one text like this " * 30, "en", "tiny") for i in range(3)]
    got = {r.doc_id: r for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i].kept and got[i].distance < CUTOFF for i in range(120))
    assert not any(got[1000 + i].kept for i in range(15))
    assert all(got[2000 + i].base_failed for i in range(3))


def test_every_statistic_rejects_alone(spark):
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(400)]

    def lines(n, k=8):
        return [" ".join(draw.choices(words, k=k)) for _ in range(n)]

    def replaced(text, n):
        return "".join("#" if i % n == n - 1 and c != " " else c for i, c in enumerate(text))

    def repeated(phrases):  # words repeat in no repeated line
        said = [" ".join(draw.choices(words, k=5)) for _ in range(phrases)] * 2
        return "\n".join(f"{phrase} {' '.join(draw.choices(words, k=6))}" for phrase in said)

    rows = [(i, "\n".join(lines(draw.randint(10, 40)))) for i in range(150)]
    planted = {
        "word_length": " ".join(w + "abcdef" for w in draw.choices(words, k=100)),
        "symbol_rate": replaced("\n".join(lines(30)), 35),  # 3 %
        "dup_line_share": "\n".join([*lines(30), *["up on"] * 30]),
        "repeat_share": repeated(12),
    }
    light = "\n".join([*lines(20), "go up", "go up", replaced(lines(1)[0], 20)])
    rows += [(1000 + i, t) for i, t in enumerate([*planted.values(), light])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'a' AS source")
    got = {r.doc_id: r for r in judge_quality(df).collect()}
    assert all(got[i].kept for i in range(150)) and got[1004].kept
    assert not any(got[1000 + i].base_failed for i in range(5))
    assert [name for i, name in enumerate(planted) if got[1000 + i].kept] == []


def mcd(x, floors, share=quality.SHARE):
    """Minimum covariance determinant by concentration steps in numpy, with exact order statistics."""
    ridge = np.diag(np.square(floors))
    low, middle, high = (np.quantile(x, q, axis=0) for q in (0.25, 0.5, 0.75))
    best = None
    for centre, scatter in ((middle, np.diag(((high - low) / 1.349) ** 2) + ridge), (x.mean(0), np.cov(x.T, bias=True) + ridge)):
        last = np.inf
        while True:
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            near = x[d2 <= np.sort(d2)[math.ceil(share * len(x)) - 1]]
            centre, scatter = near.mean(0), np.cov(near.T, bias=True) + ridge
            det = np.linalg.slogdet(scatter)[1] / 2
            if det > last - 1e-6:
                break
            last = det
        if best is None or last < best[0]:
            best = last, centre, scatter
    return best[1:]


def test_verdicts_agree_with_numpy(spark):
    """Every text that passes the base rules is judged, and as exact concentration steps would judge it."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = judge_quality(df).collect()
    assert all(r.base_failed or r.distance is not None for r in rows)
    where = {r.doc_id: (r.lang or "", r.source or "", len([s for s in (r.text or "").split("\n") if WORD.search(s)])) for r in df.collect()}
    passed = [r for r in rows if not r.base_failed]
    x = {r.doc_id: [r.word_chars / r.n_words, *(math.log1p(a / max(b, 1) / u) for a, b, u in (
        (r.n_symbols, r.word_chars, 0.005), (r.n_dup_lines, where[r.doc_id][2], 0.05), (r.n_repeat_words, r.n_words, 0.05)))] for r in passed}
    sizes = Counter(where[r.doc_id][:2] for r in passed)
    pool = {g: g if n >= quality.MIN_GROUP else g[0] for g, n in sizes.items()}
    same = total = 0
    for group in set(pool.values()):
        ids = [i for i in x if pool[where[i][:2]] == group]
        if len(ids) < quality.MIN_GROUP:
            continue
        points = np.array([x[i] for i in ids])
        centre, scatter = mcd(points, quality.FLOORS)
        d2 = np.einsum("ij,jk,ik->i", points - centre, np.linalg.inv(scatter), points - centre)
        kept = d2 / max(1.0, np.median(d2) / 3.357) <= CUTOFF
        got = {r.doc_id: r.kept for r in passed}
        same += sum(bool(k) == got[i] for k, i in zip(kept, ids))
        total += len(ids)
    assert total > 200 and same >= 0.99 * total


def test_small_groups_are_judged_by_all_texts(spark):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(300)]
    text = lambda k=80: " ".join(draw.choices(words, k=k))
    rows = [(i, text(), "en", "a") for i in range(90)] + [(200 + i, text(), "de", f"s{i}") for i in range(7)]
    rows += [(300, " ".join(w + "##" for w in draw.choices(words, k=80)), "de", "s1"), (301, text(), None, None)]
    got = {r.doc_id: r for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(r.distance is not None for r in got.values())
    assert not got[300].kept and sum(r.kept for i, r in got.items() if i != 300) >= 97
