"""Operator 8: personal data by weak supervision, with DataFrame functions only.

Strict patterns give the base spans, which always stay. Looser patterns propose more. Labelers vote on every span: the
strict patterns, gazetteers (top-level domains, calling codes, card issuers, address ranges), words before it and
the characters at its ends. Expectation-maximisation estimates how reliable each labeler is from how often
each pattern of votes occurs; its posteriors then train a logistic span classifier, which decides on the looser spans.

All patterns stay inside a line. Repeats are possessive and starts are anchored by what stands before, which
changes no match but keeps every scan linear in the text and the matcher's stack flat.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read

KINDS = ("email", "ip", "card", "phone")
#: Least probability of an added span.
ACCEPT = 0.9

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Looser forms, by kind and in the order of trial (a later one that meets an earlier one goes), each with a pattern that
#: texts without any can be told by: cards beside other digits; phone numbers beside an address, and without a plus; spelt-out
#: mail addresses; eight groups of hex digits.
LOOSE = (
    ("card", r"(?<![0-9])(?:[0-9]{13,19}|(?:3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5})|(?:[3-6][0-9]{3}|2[2-7][0-9]{2})(?:[\x20-][0-9]{4}){3})(?![0-9])", r"[0-9](?:[\x20-]?[0-9]){12}"),
    ("phone", r"\+[0-9]{1,3}(?:[\x20.-]?[(]?[0-9]{2,4}[)]?){2,3}(?![0-9])", r"\+[0-9]"),
    ("phone", r"(?<![0-9+.-])[(]?[0-9]{2,5}[)]?(?:[\x20.-][0-9]{2,6}){1,6}(?![0-9])", r"[0-9][)]?[\x20.-][0-9]"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}){1,8}", r"[(\[]at[)\]]"),
    ("ip", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])", r":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"),
)

#: Fixed values of the gazetteers: top-level domains beside all of two letters (countries); calling codes; card issuers.
DOMAINS = r"^(?:[a-z]{2}|com|org|net|edu|gov|mil|int|arpa|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|tel|cat|asia|post|app|dev|xyz|online|site|shop|store|tech|blog|cloud|email|page|news|example|test|invalid)$"
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|(?:2[1-689]|3[578]|42|5[09]|6[7-9]|80|8[578]|9[679])[0-9])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|35|6011|65|62)"
#: Words that speak for and against a kind in the 40 characters before a span.
FOR = {"email": r"(?i)e-?mail|contact|write|correo|adresse|courriel", "ip": r"(?i)\bip\b|host|server|addr|login|from", "card": r"(?i)card|visa|master|amex|carte|karte|tarjeta|credit|pay", "phone": r"(?i)phone|tel\b|tel[.:]|call|fax|mobil|m[oó]vil|t[eé]l[eé]|handy|ring"}
AGAINST = r"(?i)isbn|issn|version|\bv\b|page|order|invoice|serial|doi|chapter|section|score|total"
LABELERS = ("regex", "gazetteer", "context", "edges")


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: leftmost non-overlapping matches; ends exclusive, in code points.

    Text before and between matches comes from split, matches from regexp_extract_all: the same engine finds the
    same matches in both, and lengths add up to positions.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))).alias("out"))

    pairs = F.filter(F.arrays_zip(gaps.alias("g"), found.alias("m")), lambda x: x["m"].isNotNull())
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """d: digits. Every second digit from the right but one counts double, 9 less if over 9; the sum ends in 0."""
    n = F.length(d)
    worth = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _octets_fit(m: Column) -> Column:
    """Parts at most 255, leading zeros or not."""
    return ~F.exists(F.split(m, r"\."), lambda p: ~p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _card(m: Column) -> Column:
    d = digits(m)
    return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)


EMPTY = "array<struct<s:int,e:int,m:string>>"


def base_spans(text: Column) -> dict[str, Column]:
    none = F.array().cast(EMPTY)

    def where(hint: Column, pattern: str, fits=None) -> Column:
        found = matches(text, pattern)
        return F.when(hint, F.filter(found, fits) if fits else found).otherwise(none)

    return {
        "email": where(F.contains(text, F.lit("@")), EMAIL),
        "ip": where(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP, lambda x: _octets_fit(x["m"])),
        "card": where(text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), CARD, lambda x: _card(x["m"])),
        "phone": where(F.contains(text, F.lit("+")), PHONE, lambda x: F.length(digits(x["m"])).between(9, 15)),
    }


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(text: Column, span: Column, kind: Column, strict: bool) -> Column:
    """struct<kind, s, e, strict, v0..v3, size>: the labelers' votes (1 for, -1 against, 0 none) on a span."""
    m, d = span["m"], digits(span["m"])
    before = F.substring(text, F.greatest(span["s"] - 39, F.lit(1)), F.least(span["s"], F.lit(40)))
    left, right = F.substring(text, F.greatest(span["s"], F.lit(1)), F.least(span["s"], F.lit(1))), F.substring(text, span["e"] + 1, F.lit(1))
    tail = F.regexp_extract(F.lower(m), "([a-z0-9-]+)$", 1)
    long_enough = F.length(d).between(9, 15)
    gaz = (
        F.when(kind == "email", _vote(tail.rlike(DOMAINS), F.length(tail) > 6))
        .when(kind == "ip", _vote(m.contains(":") | m.rlike(r"^(?:[1-9]|1[0-9]|[2-9][0-9]|1[0-9][0-9]|2[0-4][0-9])\."), m.rlike(r"^0")))
        .when(kind == "card", _vote(d.rlike(ISSUERS), ~d.rlike(ISSUERS)))
        .otherwise(_vote(m.startswith("+") & d.rlike(CALLING), ~long_enough | m.startswith("+")))
    )
    says = F.when(kind == "email", before.rlike(FOR["email"])).when(kind == "ip", before.rlike(FOR["ip"])).when(kind == "card", before.rlike(FOR["card"])).otherwise(before.rlike(FOR["phone"]))
    # the labeler of patterns: sure of strict spans; of looser ones it asks for the kind's check digit or length, and says nothing of numbers without a plus
    loose = F.when(kind == "card", _vote(_card(m), ~_card(m))).when(kind == "phone", _vote(m.startswith("+") & long_enough, ~long_enough)).otherwise(1)
    strong = F.lit(1) if strict else loose
    return F.struct(
        kind.alias("kind"), span["s"].alias("s"), span["e"].alias("e"), F.lit(strict).alias("strict"), strong.cast("int").alias("v0"), gaz.cast("int").alias("v1"),
        _vote(says, before.rlike(AGAINST)).cast("int").alias("v2"), _vote(~(left.rlike(r"[\p{L}\p{N}]") | right.rlike(r"[\p{L}\p{N}]")), left.rlike(r"[\p{L}\p{N}]")).cast("int").alias("v3"),
        F.when(F.length(m) < 12, 0).when(F.length(m) < 20, 1).otherwise(2).alias("size"),
    )


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 40) -> dict[tuple[int, ...], float]:
    """votes -> count: votes -> probability of a true span, by expectation-maximisation over labelers that err independently."""
    post = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in counts}
    for _ in range(rounds):
        total = sum(counts.values())
        prior = min(max(sum(n * post[v] for v, n in counts.items()) / total, 0.05), 0.9)
        rate: dict[tuple[int, int, int], float] = {}
        for j in range(len(LABELERS)):
            for z in (0, 1):
                mass = {x: 1.0 for x in (-1, 0, 1)}
                for v, n in counts.items():
                    mass[v[j]] += n * (post[v] if z else 1 - post[v])
                for x in mass:
                    rate[j, z, x] = mass[x] / sum(mass.values())
        for v in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rate[j, 1, x] / rate[j, 0, x]) for j, x in enumerate(v))
            post[v] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
    return post


def names_of(kind: str, votes: tuple[int, ...], size: int) -> list[str]:
    """Features of a span in the classifier: all are present or absent."""
    return [f"kind {kind}", *(f"{name} {x:+d}" for name, x in zip(LABELERS, votes, strict=True) if x), f"size {size}"]


def train(rows: list[tuple[str, tuple[int, ...], int, int]], rounds: int = 200) -> dict[str, float]:
    """rows (kind, votes, size, count), one per pattern: weights of a logistic model fitted to the posteriors."""
    soft: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in {r[0] for r in rows}:
        counts: dict[tuple[int, ...], int] = {}
        for k, v, _, n in rows:
            if k == kind:
                counts[v] = counts.get(v, 0) + n
        soft |= {(kind, v): p for v, p in reliabilities(counts).items()}
    weights: dict[str, float] = {}
    total = sum(r[3] for r in rows)
    for _ in range(rounds):
        slope: dict[str, float] = {}
        for kind, v, size, n in rows:
            names = names_of(kind, v, size)
            z = sum(weights.get(x, 0.0) for x in names)
            error = soft[kind, v] - 1 / (1 + math.exp(-min(max(z, -30), 30)))
            for x in names:
                slope[x] = slope.get(x, 0.0) + error * n
        for x, g in slope.items():
            weights[x] = weights.get(x, 0.0) + 2.0 * (g / total - 1e-4 * weights.get(x, 0.0))
    return weights


def probability(weights: dict[str, float], span: Column) -> Column:
    """The classifier as an expression."""
    z = F.lit(0.0)
    for name, w in sorted(weights.items()):
        what, value = name.split(" ")
        z = z + F.when(span[{"kind": "kind", "size": "size"}.get(what) or f"v{LABELERS.index(what)}"] == (value if what == "kind" else int(value)), w).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find_pii(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...): (doc_id, base, spans), a row for each row of docs; base and spans are arrays of struct<kind, s, e>
    by kind (email, ip, card, phone), then start: the strict spans, and these with the added ones.

    Defined cases: null text is an empty one, without spans; positions are code points, ends exclusive; a looser span
    that meets a base span is not added, and of looser spans that meet the one of the earlier form counts; a looser span is added
    if the trained classifier gives it ACCEPT or more; rows that share a doc_id are judged row by row; other columns are not read.
    """
    text = F.col("text")
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    some = text.rlike("[0-9@(\\[]")
    base = {k: F.when(some, c).otherwise(F.array().cast(EMPTY)) for k, c in base_spans(text).items()}
    d = d.select("doc_id", "text", *(c.alias(k) for k, c in base.items()))
    meets = lambda x, spans: F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    none = F.array().cast(EMPTY)
    forms = [f"loose{i}" for i in range(len(LOOSE))]
    d = d.select("doc_id", "text", *KINDS, *(F.when(text.rlike(hint), matches(text, p)).otherwise(none).alias(name) for name, (_, p, hint) in zip(forms, LOOSE, strict=True)))
    free = lambda i: lambda x: ~meets(x, F.concat(*KINDS, *forms[:i]))
    clear = [F.filter(name, free(i)).alias(name) for i, name in enumerate(forms)]
    d = d.select("doc_id", "text", *KINDS, *clear)
    judge = lambda k, sure: lambda x: _judged(text, x, F.lit(k), sure)
    judged = F.concat(*(F.transform(k, judge(k, True)) for k in KINDS), *(F.transform(name, judge(k, False)) for name, (k, _, _) in zip(forms, LOOSE, strict=True)))
    found = materialize(d.select("doc_id", judged.alias("found")), "spans")
    # a row for each pattern of kind, votes and size: at most 4 * 3^4 * 3
    rows = found.select(F.explode("found").alias("x")).groupBy("x.kind", "x.v0", "x.v1", "x.v2", "x.v3", "x.size").agg(F.count("*").alias("n")).orderBy("kind", "v0", "v1", "v2", "v3", "size").collect()
    weights = train([(r["kind"], (r["v0"], r["v1"], r["v2"], r["v3"]), r["size"], r["n"]) for r in rows])
    place = F.array(*map(F.lit, KINDS))
    plain = lambda x: F.struct(F.array_position(place, x["kind"]).alias("o"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))
    ordered = lambda keep: F.transform(F.array_sort(F.transform(F.filter("found", keep), plain)), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    added = lambda x: x["strict"] | (probability(weights, x) >= ACCEPT)
    return found.select("doc_id", ordered(lambda x: x["strict"]).alias("base"), ordered(added).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(read(spark, sf_dir, "documents"))
    of = lambda k: lambda x: x["kind"] == k
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
