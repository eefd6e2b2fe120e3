"""Operator 8: personal data, and the terms that would give it away.

Emails, addresses, cards and phone numbers are found by pattern in whole texts. Each found value
is a protected entity; the whole text that holds it is its context. How strongly a term t reveals an
entity e is estimated from co-occurrence: of the n(t) different texts with the term n(e, t) hold the
entity, and the lower confidence bound q of n(e, t) / n(t) leaves -log2 q bits unknown about the entity to
whoever reads the term. Up to one bit (q of ``GENERALISE``) the term is generalised in the entity's texts; from
``REMOVE`` on it is removed, and that in every text. The bound does not depend on the size of the corpus. The
coincidence must be more than chance, too: its divergence from the entity's share p of all texts,
n(t) KL(n(e, t) / n(t) || p) bits, has to exceed the logarithm of the number of terms by ``SURPLUS``, so
that by chance not even one term of the corpus is expected to pass. Copies of a text add nothing to any count.

Entities that occur in the same texts have the same counts with every term, and so have terms that do. Both
are counted as one class, by two 64-bit sums over their texts; a text with thousands of addresses
and words is a product of few classes.

Only DataFrame operations. Document frequencies combine per task before their shuffle; texts are joined
by keys that no two rows share, so that no entity, term or copied text makes a task long. Patterns never back up or start
twice in one run of characters, so long runs stay linear.

Defined cases: a null text counts as empty; repeated rows are judged alike and each returned; equal
starts go by kind in the order of ``KINDS``; an entity of a single text, or that every document holds, has no terms;
an empty table gives no rows; other columns are passed by, those of ``keep`` whatever their names: result columns
whose names they bear get underscores at their end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stagecheck.llm.common import free_names, settle, text_key

KINDS = ("email", "ip", "card", "phone", "term")
# A match can only begin where its run begins, or where the last match ended.
_LOCAL, _DIGIT = "[A-Za-z0-9._%+-]", "[0-9]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?:(?<!{_DIGIT})|\G){_DIGIT}++\.{_DIGIT}++\.{_DIGIT}++\.{_DIGIT}++",
    "card": rf"{_DIGIT}(?:[\x20-]?{_DIGIT})++",
    "phone": rf"\+{_DIGIT}[\x20().0-9-]+{_DIGIT}",
}
#: Text without this holds no match; it saves the pattern's two passes.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
SUPPORT = 2
#: Bytes of a narrow table up to which a join with texts sends it to the tasks.
SENT_BYTES = 64 << 20
#: Lower bounds of the share of a term's texts that hold the entity: one bit, and a seventh of a bit, are left.
GENERALISE, REMOVE = 0.5, 0.9
#: One standard error below the estimate, by Wilson's interval.
Z = 1.0
#: Bits by which the evidence for a term exceeds the logarithm of the number of terms.
SURPLUS = 4.0
_WORD = r"\p{L}{3,}"


def _is_ip(value: Column) -> Column:
    plain = lambda part: F.regexp_replace(part, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda part: F.when(
        F.length(plain(part)) <= 3, F.concat(F.lit("0"), plain(part)).cast("int") <= 255).otherwise(False))


def _is_card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    number = F.reverse(digits)

    def luhn(total: Column, i: Column) -> Column:
        d = F.substring(number, i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), luhn)
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


def _is_phone(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)


VALID = {"email": lambda value: F.lit(True), "ip": _is_ip, "card": _is_card, "phone": _is_phone}
_FOUND = "array<struct<start:int,order:int,end:int,kind:string,value:string>>"


def _placed(found: Column, between: Column) -> Column:
    """(start, i) of each match, from the texts between matches."""
    return F.aggregate(
        F.sequence(F.lit(1), F.size(found)), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, i: F.struct(
            (a["at"] + F.length(F.get(between, i - 1)) + F.length(F.get(found, i - 1))).alias("at"),
            F.concat(a["starts"], F.array(a["at"] + F.length(F.get(between, i - 1)))).alias("starts")),
        lambda a: a["starts"])


def _matches(rows: DataFrame, kind: str) -> DataFrame:
    """Adds column ``kind``: the valid matches with places."""
    text = F.col("_text")
    pattern = F.lit(PATTERNS[kind])
    hint = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_found", F.when(hint, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none))
    rows = rows.withColumn("_between", F.when(F.size("_found") > 0, F.split(text, PATTERNS[kind])).otherwise(none))
    rows = rows.withColumn("_starts", F.when(F.size("_found") > 0, _placed(F.col("_found"), F.col("_between"))).otherwise(F.array().cast("array<int>")))

    def row(start: Column, i: Column) -> Column:
        value = F.get("_found", i)
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), (start + F.length(value)).alias("end"),
                        F.lit(kind).alias("kind"), value.alias("value"))

    every = F.transform(F.col("_starts"), row)
    return rows.withColumn(kind, F.filter(every, lambda m: VALID[kind](m["value"])).cast(_FOUND)).drop("_found", "_between", "_starts")


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def _free(text: Column, spans: Column) -> Column:
    """The text with blanks in place of its found values, so that what is left keeps its places."""
    def step(a: Column, m: Column) -> Column:
        start = F.greatest(a["at"], m["start"])
        put = F.concat(a["out"], F.substring(text, a["at"] + 1, start - a["at"]), F.repeat(F.lit(" "), m["end"] - start))
        return F.struct(F.greatest(a["at"], m["end"]).alias("at"), F.when(m["end"] > start, put).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _terms(free: Column) -> Column:
    """The different words of a text in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(free, F.lit(_WORD), F.lit(0)), F.lower))


_PLACES = "array<struct<start:int,end:int,disclosure:double>>"


def _places(told: Column) -> Column:
    """Where those of _words that are in ``told``, a map of disclosures, stand, with _between around them. Only those are gathered, so long texts stay linear."""
    def step(a: Column, i: Column) -> Column:
        start = a["at"] + F.length(F.get("_between", i))
        end = start + F.length(F.get("_words", i))
        own = F.element_at(told, F.lower(F.get("_words", i)))
        found = F.struct(start.alias("start"), end.alias("end"), own.alias("disclosure"))
        return F.struct(end.alias("at"), F.when(own.isNotNull(), F.concat(a["places"], F.array(found))).otherwise(a["places"]).alias("places"))

    none = F.array().cast(_PLACES)
    walked = F.aggregate(F.sequence(F.lit(0), F.size("_words") - 1), F.struct(F.lit(0).alias("at"), none.alias("places")), step, lambda a: a["places"])
    return F.when(F.size("_words") > 0, walked).otherwise(none)


def _sent(keys: DataFrame, column: str) -> DataFrame:
    """``keys`` sent to all tasks if they are small, so that no texts move to meet them; the join's rows are the same."""
    size = keys.agg(F.coalesce(F.sum(F.octet_length(F.col(column).cast("string")) + 64), F.lit(0))).first()[0]
    return F.broadcast(keys) if size <= SENT_BYTES else keys


def _same_texts(name: str) -> Column:
    """Stands for a set of texts, from its size and two sums over its members."""
    sums = [F.bit_xor(F.xxhash64(F.lit(seed), "_row")) for seed in (1, 2)]
    return F.concat_ws(":", F.count("*"), *sums).alias(name)


def wilson(part: Column, whole: Column) -> Column:
    """Lower bound of a share."""
    share, z2 = part / whole, F.lit(Z * Z)
    spread = Z * F.sqrt(share * (1 - share) / whole + z2 / (4 * whole * whole))
    return (share + z2 / (2 * whole) - spread) / (1 + z2 / whole)


def divergence(part: Column, whole: Column, prior: Column) -> Column:
    """Bits that tell the share of ``part`` in ``whole`` from ``prior``, over all of ``whole``; 0 if it is not above it."""
    share = part / whole
    rest = F.when(share < 1, (whole - part) * F.log2((1 - share) / (1 - prior))).otherwise(0.0)
    return F.when(share > prior, part * F.log2(share / prior) + rest).otherwise(0.0)


def disclosing_terms(rows: DataFrame, free: Column) -> tuple[DataFrame, DataFrame]:
    """The terms that give entities away, and the entities' classes.

    The first holds (term, of, disclosure): the class of entities that the term discloses, and the bound. The
    second holds (entity, of). ``rows`` holds _row, _copy, which rows of one text share, and _entities; ``free``
    is the text outside them.
    """
    first = rows.groupBy("_copy").agg(F.min("_row").alias("_row"))
    extra = settle(rows.select("_row").join(first, "_row", "left_anti"), "private-copies")
    texts = rows.join(_sent(extra, "_row"), "_row", "left_anti")
    documents = rows.count() - extra.count()
    holding = texts.where(F.size("_entities") > 0)
    pairs = settle(holding.select("_row", F.explode("_entities").alias("entity")), "private-pairs")
    entities = pairs.groupBy("entity").agg(F.count("*").alias("n_entity"), _same_texts("of"))
    entities = settle(entities.where((F.col("n_entity") >= SUPPORT) & (F.col("n_entity") < documents)), "private-entities")
    classes = settle(pairs.join(entities, "entity").select("_row", "of", "n_entity").distinct(), "private-classes")
    words = texts.select("_row", F.explode(_terms(free)).alias("term")).groupBy("term").agg(
        F.count("*").alias("df"), _same_texts("alike"))
    words = settle(words, "private-words")
    needed = math.log2(max(2, words.count())) + SURPLUS
    # A term of more texts than this can't be told by any entity.
    most = (classes.agg(F.max("n_entity")).first()[0] or 0) / GENERALISE
    usual = words.where((F.col("df") >= SUPPORT) & (F.col("df") <= most))
    read = holding.select("_row", free.alias("_free")).join(_sent(classes.select("_row").distinct(), "_row"), "_row", "left_semi")
    held = read.select("_row", F.explode(_terms(F.col("_free"))).alias("term")).join(usual, "term").select("_row", "alike", "df").distinct()
    both = held.join(classes, "_row").where(F.col("df") <= F.col("n_entity") / GENERALISE).groupBy("of", "n_entity", "alike", "df").agg(
        F.count("*").alias("both")).where(F.col("both") >= SUPPORT)
    evidence = divergence(F.col("both"), F.col("df"), F.col("n_entity") / float(max(documents, 1)))
    scored = both.withColumn("disclosure", wilson(F.col("both"), F.col("df")))
    told = scored.where((F.col("disclosure") >= GENERALISE) & (evidence >= needed)).select("of", "alike", "disclosure")
    return usual.join(told, "alike").select("term", "of", "disclosure"), entities.select("entity", "of")


def _told(rows: DataFrame, free: Column) -> DataFrame:
    """(_row, _told): for every row with such terms, each of them with how much it discloses there."""
    terms, classes = (settle(d, "private-disclosing") for d in disclosing_terms(rows, free))
    by_term = terms.groupBy("term").agg(
        F.max("disclosure").alias("most"), F.map_from_entries(F.collect_list(F.struct("of", "disclosure"))).alias("own"))
    hits = rows.select("_row", F.explode(_terms(free)).alias("term")).join(_sent(settle(by_term, "private-terms"), "term"), "term")
    holding = rows.select("_row", F.explode("_entities").alias("entity")).join(_sent(classes, "entity"), "entity")
    holding = holding.groupBy("_row").agg(F.collect_set("of").alias("_of"))
    near = F.array_max(F.transform(F.array_intersect(F.map_keys("own"), "_of"), lambda c: F.element_at("own", c)))
    found = F.when(F.col("most") >= REMOVE, F.col("most")).otherwise(near)
    hits = hits.join(holding, "_row", "left").withColumn("disclosure", found).where(F.col("disclosure").isNotNull())
    return hits.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("_told"))


def find_private(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """``keep``, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row of ``df``.

    ``with_text`` adds ``sanitised``: the text with base spans and generalised terms replaced by
    their kind in angle brackets and removed terms left out.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept")
    rows = df.select(kept, F.coalesce(F.col(text), F.lit("")).alias("_text"), text_key(text).alias("_copy"),
                     F.monotonically_increasing_id().alias("_row"))
    for kind in PATTERNS:
        rows = _matches(rows, kind)
    rows = rows.withColumn("_base", F.sort_array(F.concat(*PATTERNS)))
    rows = rows.withColumns({f"n_{k}": F.size(k).cast("long") for k in PATTERNS})
    # Row numbers come from the scan; written once, they stay what they are.
    rows = settle(rows.drop(*PATTERNS), "private-rows")
    free = _free(F.col("_text"), F.col("_base"))
    entity = lambda m: F.concat_ws(":", m["kind"], F.lower(m["value"]))
    held = rows.withColumn("_entities", F.array_distinct(F.transform("_base", entity)))
    out = rows.join(_told(held, free), "_row", "left").withColumn("_seen", F.when(F.col("_told").isNotNull(), free))
    out = out.withColumn("_words", F.regexp_extract_all("_seen", F.lit(_WORD), F.lit(0))).withColumn("_between", F.split("_seen", _WORD))
    out = out.withColumn("_terms", _places(F.col("_told")))
    own = F.transform(F.coalesce("_terms", F.array().cast(_PLACES)), lambda t: F.struct(
        t["start"].alias("start"), F.lit(KINDS.index("term")).alias("order"), t["end"].alias("end"),
        F.when(t["disclosure"] >= REMOVE, "removed").otherwise("term").alias("label"), F.lit("term").alias("kind")))
    base = F.transform("_base", lambda m: F.struct(m["start"].alias("start"), m["order"].alias("order"), m["end"].alias("end"),
                                                   m["kind"].alias("label"), m["kind"].alias("kind")))
    out = out.withColumn("_spans", F.sort_array(F.concat(base, own)))
    made = [*[F.col(f"n_{k}") for k in PATTERNS], F.sha2(_spans_text(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
            _spans_text(F.col("_spans")).alias("spans")]
    if with_text:
        made.append(_sanitised(F.col("_text"), F.col("_spans")).alias("sanitised"))
    names = free_names([*(f"n_{k}" for k in PATTERNS), "base_sha256", "spans", *(["sanitised"] if with_text else [])], keep)
    return out.select(*[F.col(f"_kept.`{c}`") for c in keep], *[m.alias(n) for m, n in zip(made, names, strict=True)])


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with spans replaced; of spans that overlap the first gives the label."""
    def step(a: Column, m: Column) -> Column:
        label = F.when(m["label"] == "removed", "").otherwise(F.concat(F.lit("<"), m["label"], F.lit(">")))
        put = F.concat(a["out"], F.substring(text, a["at"] + 1, m["start"] - a["at"]), label)
        return F.struct(F.greatest(a["at"], m["end"]).alias("at"), F.when(m["start"] >= a["at"], put).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
