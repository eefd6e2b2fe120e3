"""Personal data against plain patterns, and disclosing terms against a count by hand."""

import hashlib
import math
import random
import re
import time

from stagecheck.llm import privacy
from stagecheck.llm.privacy import find_private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    found = sorted((m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PATTERNS.items())
                   for m in re.finditer(p, text or "") if valid(kind, m[0]))
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
    return [sum(f[3] == k for f in found) for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest(), joined


def agree(rows, texts):
    for r in rows:
        counts, digest, joined = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        assert [s for s in r.spans.split(",") if not s.startswith("term")] == joined.split(",")


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    agree(find_private(df).collect(), {r.doc_id: r.text for r in df.collect()})


def test_odd_and_random_texts(spark):
    draw = random.Random(6)
    texts = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 x@y.zz@q.rr", "256.1.1.1 001.002.003.0004", "", "a" * 30_000 + "@b.co", None,
             "é🎉 bob@x.org +49(0)30-123456.7", "1" * 50_000, "@@@ a@ b@c a@b.", "a@b.c" + ".f" * 20_000, "+1(((2 +12345678901 +1 2" * 3]
    texts += ["".join(draw.choices("ab@.-+ ()0123456789é\n", k=120)) for _ in range(400)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, term int")
    rows = find_private(df, with_text=True).collect()
    assert len(rows) == len(texts)
    agree(rows, texts)
    by = {r.doc_id: r.sanitised for r in rows}
    assert by[6] == "é🎉 <email> <phone>" and by[5] == "" and by[7] == texts[7]
    assert find_private(df.where("false")).count() == 0


def test_terms_that_give_an_entity_away(spark):
    filler = ["alpha beta gamma", "delta epsilon", "zeta eta theta", "iota kappa"]
    rows = [(i, f"{filler[i % 4]} number {i}") for i in range(60)]
    rows += [(100 + i, f"{filler[i]} write to Zorblax at zed@x.org today") for i in range(3)]  # three contexts, one rare term
    rows += [(200 + i, "Quibble has mail q@x.org") for i in range(3)]  # copies: one context only
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in find_private(df, with_text=True).collect()}
    at = rows[60][1].index("Zorblax")
    assert f"term:{at}:{at + 7}" in got[100].spans and "Zorblax" not in got[100].sanitised
    assert all("term" not in got[200 + i].spans for i in range(3))
    assert all(got[i].spans == "" for i in range(60))


def test_copies_of_a_disclosing_text_add_nothing(spark):
    rows = [(i, f"alpha beta gamma number {i}") for i in range(3000)]
    rows += [(5000 + i, f"delta {'one' if i % 2 else 'two'} write to Zorblax at zed@x.org") for i in range(2000)]  # 1,000 copies each
    got = find_private(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).where("doc_id >= 5000").collect()
    assert len(got) == 2000 and not any("Zorblax" in r.sanitised for r in got)


def test_terms_are_found_in_whole_texts(spark):
    """In all of the entity's texts from one bit on; in other texts only from the higher bound on."""
    draw = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    long = lambda: " ".join(draw.choices(words, k=60))
    rows = [(i, f"{long()} number {i}") for i in range(3000)]
    rows += [(5000 + i, f"Zorblax {long()} zed@x.org {long()} ZORBLAX") for i in range(4)]
    rows += [(5100 + i, f"Quibble {long()} q@x.org {long()}") for i in range(30)]
    rows += [(6000, f"{long()} Zorblax, alpha"), (6001, "zed y@x.org"), (6002, f"{long()} Quibble, alpha")]
    got = {r.doc_id: r for r in find_private(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    for i in range(4):
        text, end = rows[3000 + i][1], len(rows[3000 + i][1])
        at = text.index("zed@")
        assert got[5000 + i].spans == f"term:0:7,email:{at}:{at + 9},term:{end - 7}:{end}"
        assert got[5000 + i].sanitised.startswith("<term> ")
    assert got[6000].spans == "" and got[6000].sanitised == rows[3034][1]  # 4 of 5 texts: bound 0.58
    at = rows[3036][1].index("Quibble")
    assert got[6002].spans == f"term:{at}:{at + 7}" and got[6002].sanitised.endswith("a , alpha")  # 30 of 31: 0.92
    assert all(got[5100 + i].spans.startswith("term:0:7,email") for i in range(30))
    assert got[6001].spans == "email:4:11" and all(got[i].spans == "" for i in range(3000))


def brute_terms(texts, generalise=privacy.GENERALISE, remove=privacy.REMOVE, z=privacy.Z):
    """Term spans of each text, counted pair by pair."""
    seen = {}
    for text in set(texts):
        spans = [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in brute(text)[2].split(",") if x)]
        rest = list(text)
        for a, b, _ in spans:
            rest[a:b] = " " * (b - a)
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", "".join(rest))]
        seen[text] = {f"{k}:{text[a:b].lower()}" for a, b, k in spans}, words
    df, n, both = {}, {}, {}
    for entities, words in seen.values():
        terms = {w for _, _, w in words}
        for t in terms:
            df[t] = df.get(t, 0) + 1
        for e in entities:
            n[e] = n.get(e, 0) + 1
            for t in terms:
                both[e, t] = both.get((e, t), 0) + 1
    told = {}
    for (e, t), c in both.items():
        if c < 2 or n[e] == len(seen):
            continue
        share, d, p = c / df[t], df[t], n[e] / len(seen)
        bound = (share + z * z / (2 * d) - z * math.sqrt(share * (1 - share) / d + z * z / (4 * d * d))) / (1 + z * z / d)
        bits = 0.0 if share <= p else c * math.log2(share / p) + ((d - c) * math.log2((1 - share) / (1 - p)) if share < 1 else 0.0)
        if bound >= generalise and bits >= math.log2(max(2, len(df))) + privacy.SURPLUS:
            told.setdefault(t, {})[e] = bound
    out = []
    for text in texts:
        entities, words = seen[text]
        out.append([f"term:{a}:{b}" for a, b, w in words if w in told and (max(told[w].values()) >= remove or entities & set(told[w]))])
    return out


def test_terms_agree_with_a_count_by_hand(spark):
    draw = random.Random(8)
    vocabulary = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in "mnrst"]
    names = ["ann", "bob", "cyd", "dan"]
    texts = []
    for i in range(400):
        words = draw.choices(vocabulary, k=12)
        if draw.random() < 0.2:
            name = draw.choice(names)
            words += [f"{name}@x.org", f"{name}ville"[: draw.choice([5, 7])], draw.choice([f"10.0.0.{names.index(name)}", "street"])]
            draw.shuffle(words)
        texts += [" ".join(words)] * draw.choice([1, 1, 3])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("term")] for r in find_private(df).collect()}
    want = brute_terms(texts)
    assert [got[i] for i in range(len(texts))] == want and sum(map(len, want)) > 50


def test_many_entities_and_words_in_one_text(spark):
    """Two texts with 3,000 addresses and 3,000 words: all pairs would be nine million rows a text."""
    letters = lambda i: "".join(chr(97 + int(d)) for d in f"{i:05d}")
    body = " ".join(f"{letters(i)} a{i}@x.org" for i in range(3000))
    rows = [(0, body + " one"), (1, body + " two")] + [(2 + i, f"plain text {letters(90000 + i)}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    start = time.monotonic()
    got = {r.doc_id: r for r in find_private(df).collect()}
    assert time.monotonic() - start < 60  # on a loaded machine
    assert got[0].n_email == 3000 and got[0].spans.count("term") == 3000 and "term" not in got[2].spans


def test_kept_columns_of_any_name(spark):
    names = ["email", "n_email", "spans", "_row", "_text", "_kept", "term", "sanitised", "card", "_told", "a.b"]
    df = spark.createDataFrame([("x@y.zz", *range(len(names))), (None, *range(len(names)))], ["text", *names])
    got = find_private(df, keep=names, with_text=True)
    assert got.columns == [*names, "n_email_", "n_ip", "n_card", "n_phone", "base_sha256", "spans_", "sanitised_"]
    assert sorted(tuple(r)[: len(names)] for r in got.collect()) == [tuple(range(len(names)))] * 2
