"""Personal data (operator 9): weak supervision, in DataFrame functions throughout.

Candidate spans come from the base patterns (email, ip, card, phone: matches that
pass their test always stay) and from two looser ones: ``number`` (7 to 19 digits
with separators) and ``handle`` (an address with the at sign spelled out).  Four
labelers vote for, against or not at all on each candidate: the *pattern* (base
match or loose one), the *structure* (check digit, part sizes, digit count), a
*gazetteer* (top-level domains, country codes, issuer prefixes) and the *context*
(words before the span).  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and the posteriors train a
logistic span classifier; loose candidates of a probability of at least 0.5 that
do not touch a base span are added.

Scale: one scan; no text is shuffled, and all spans of a text are found inside
its row by built-in functions.  What is gathered is the table of vote patterns
(at most kinds x 3**4 x size classes rows, however large the corpus).  Regular
expressions start only where a match can start and have possessive loops, so
long runs of digits or letters cost neither quadratic time nor Java stack; the
list of a text's spans is built by appending, so its cost grows with the square
of the *number of matches* in one text.

Defined results: null or empty text has no spans; repeated rows get equal
results; an empty table gives an empty result (the classifier then accepts what
most labelers vote for); a null id is carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored, texts

KINDS = ("email", "ip", "card", "phone", "number", "handle")
BASE = KINDS[:4]
LABELERS = ("pattern", "structure", "gazetteer", "context")

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Patterns; equal to the base patterns, begun only at the start of a run.
#: email: after a match the search goes on inside a run, hence \G.
#: card: a chain of digits with single separators is one match, 16 digits at least are asked for.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9A-Za-z.+])(?<![0-9][\x20().-])[0-9](?:[\x20().-]?[0-9]){6,}+(?![0-9A-Za-z])",
    "handle": rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(](?:at|AT)[\])]\x20?{_HOST}++(?:\.{_HOST}++)++",
}
#: Fixed values of the gazetteer and context labelers.
DOMAINS = "com|org|net|edu|gov|io|info|biz|de|fr|es|it|nl|at|ch|be|uk|eu|us|mx|ar|ca"
COUNTRY = r"^\+(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|62|35)"
FOR_WORDS = (r"\b(?:phone|tel|telephone|call|fax|mobile|cell|whatsapp|sms|mail|email|e-mail|contact|card|visa|"
             r"mastercard|amex|credit|iban|ssn|passport|address|telefon|handy|anruf|karte|correo|tarjeta|llame|"
             r"courriel|carte|appelez|ip|host|server)\b")
AGAINST_WORDS = (r"\b(?:version|isbn|issn|doi|page|order|invoice|sku|part|item|build|release|figure|table|"
                 r"section|chapter|id|timestamp|serial)\b")
NEAR = 40  # characters of context before a span

_SPAN = "array<struct<start: int, end: int, value: string>>"


def _spans(pieces: Column, values: Column) -> Column:
    """Places of the matches: each follows the piece of text before it."""
    steps = F.zip_with(F.slice(pieces, 1, F.size(values)), values,
                       lambda p, v: F.struct(F.length(p).alias("gap"), v.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(steps, start, add, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    back = F.reverse(digits)

    def weight(i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + weight(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    """The base kinds' tests."""
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"))
    if kind == "card":
        d = _digits(value)
        return F.length(d).between(16, 19) & luhn(d)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _test(kind: str):
    return lambda s: _valid(kind, s["value"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def _votes(kind: str, text: Column, span: Column) -> list[Column]:
    """Votes 1, 0 or -1 of the four labelers on a span."""
    value, digits = span["value"], _digits(span["value"])
    pattern = F.lit(1 if kind in BASE else -1 if kind == "number" else 0)
    if kind in ("email", "handle"):
        structure = F.when(value.rlike(r"^[A-Za-z0-9]") & ~value.contains(".."), 1).otherwise(-1)
        gazetteer = F.when(F.lower(value).rlike(rf"\.(?:{DOMAINS})$"), 1).otherwise(0)
    elif kind == "ip":
        structure, gazetteer = F.lit(1), F.when(value.rlike(r"^(?:0|255)\."), -1).otherwise(0)
    elif kind == "phone":
        structure, gazetteer = F.lit(1), F.when(value.rlike(COUNTRY), 1).otherwise(-1)
    else:
        structure = F.when(F.length(digits).between(13, 19) & luhn(digits), 1).otherwise(
            F.when(F.length(digits).between(9, 12) & value.rlike(r"[\x20().-]"), 0).otherwise(-1))
        gazetteer = F.when((F.length(digits) >= 13) & digits.rlike(ISSUER), 1).otherwise(
            F.when(F.length(digits) >= 13, -1).otherwise(0))
    begin = F.greatest(span["start"] - NEAR, F.lit(0))
    before = F.lower(F.substring(text, begin + 1, span["start"] - begin))
    context = F.when(before.rlike(FOR_WORDS), 1).otherwise(F.when(before.rlike(AGAINST_WORDS), -1).otherwise(0))
    return [c.cast("int").alias(f"v_{name}") for name, c in
            zip(LABELERS, (pattern, structure, gazetteer, context), strict=True)]


def candidates(docs: DataFrame, text_col: str = "text", out: str = "candidates") -> DataFrame:
    """``docs`` with an array of candidates: kind, start, end, value, votes, size class.

    Base spans come first and loose ones that touch a base span are left out.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("_pii_text")
    can = {"email": text.contains("@"), "phone": F.col("_pii_digit") & text.contains("+"),
           "handle": F.lower(text).rlike(r"[\[(]at[\])]")}
    x = docs.select("*", F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_pii_text"))
    x = x.select("*", text.rlike("[0-9]").alias("_pii_digit"))
    none = F.array().cast("array<string>")
    for kind in KINDS:
        gate = can.get(kind, F.col("_pii_digit"))
        x = x.select("*", F.when(gate, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)))
                     .otherwise(none).alias(f"_pii_m_{kind}"))
    for kind in KINDS:
        found = F.col(f"_pii_m_{kind}")
        spans = F.when(F.size(found) > 0, _spans(F.split(text, PATTERNS[kind], -1), found)) \
            .otherwise(F.array().cast(_SPAN))
        if kind in BASE:
            spans = F.filter(spans, _test(kind))
        x = x.select("*", spans.alias(f"_pii_{kind}"))

    base = F.concat(*[F.transform(f"_pii_{k}", lambda s: F.struct(s["start"], s["end"])) for k in BASE])
    x = x.select("*", base.alias("_pii_base"))

    def full(kind):
        def one(s):
            size = F.least(F.floor(F.length(_digits(s["value"])) / 4), F.lit(4)).cast("int")
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                            s["value"].alias("value"), *_votes(kind, text, s), size.alias("size"))
        spans = F.col(f"_pii_{kind}")
        if kind not in BASE:
            spans = F.filter(spans, lambda s: ~F.exists(
                "_pii_base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
        return F.transform(spans, one)

    return x.select(*keep, F.concat(*[full(k) for k in KINDS]).alias(out))


def votes_table(found: DataFrame) -> list:
    """Counts by kind, vote pattern and size class: the sufficient statistics."""
    c = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.size", *[f"c.v_{x}" for x in LABELERS])
    return c.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n")).collect()


def posteriors(patterns: dict[tuple, int], rounds: int = 40) -> dict[tuple, float]:
    """EM for labelers that vote -1, 0, 1 independently given the truth.

    ``patterns``: vote tuple -> count.  Starts from the majority; the truth is
    the class for which labelers say 1.
    """
    total = sum(patterns.values())
    p = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v in patterns}
    for _ in range(rounds if total else 0):
        prior = (1 + sum(n * p[v] for v, n in patterns.items())) / (2 + total)
        table = []
        for j in range(len(LABELERS)):
            rows = []
            for y in (0, 1):
                # prior counts: a labeler is right rather than wrong
                c = {s: (4.0 if s == 2 * y - 1 else 2.0 if s == 0 else 1.0) for s in (-1, 0, 1)}
                for v, n in patterns.items():
                    c[v[j]] += n * (p[v] if y else 1 - p[v])
                whole = sum(c.values())
                rows.append({s: x / whole for s, x in c.items()})
            table.append(rows)
        for v in patterns:
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(table[j][1][s] / table[j][0][s]) for j, s in enumerate(v))
            p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return p


def _inputs(votes: tuple, size: int) -> list[float]:
    return [1.0, *[float(v == s) for v in votes for s in (1, -1)], *[float(size == k) for k in range(5)]]


def train(rows: list, steps: int = 300) -> list[float]:
    """Logistic weights, fitted to the posteriors of the aggregated patterns."""
    patterns: dict[tuple, int] = {}
    for r in rows:
        v = tuple(r[f"v_{x}"] for x in LABELERS)
        patterns[v] = patterns.get(v, 0) + r["n"]
    p = posteriors(patterns)
    data = [(_inputs(v := tuple(r[f"v_{x}"] for x in LABELERS), r["size"]), p[v], math.sqrt(r["n"])) for r in rows]
    weights = [0.0, *[0.8, -0.8] * len(LABELERS), *[0.0] * 5]
    total = sum(n for _, _, n in data) or 1.0
    for _ in range(steps):
        slope = [0.02 * w / total for w in weights]
        for x, y, n in data:
            z = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x, strict=True))))))
            for i, xi in enumerate(x):
                slope[i] += n * (z - y) * xi / total
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _accepted(c: Column, weights: list[float]) -> Column:
    """Base candidates, and loose ones that the classifier takes for personal data."""
    score = F.lit(weights[0])
    at = 1
    for name in LABELERS:
        v = c[f"v_{name}"]
        score = score + F.when(v == 1, weights[at]).when(v == -1, weights[at + 1]).otherwise(0.0)
        at += 2
    score = score + F.coalesce(F.element_at(F.array(*[F.lit(w) for w in weights[at:]]), c["size"] + 1), F.lit(0.0))
    return (c["kind"] < len(BASE)) | (score >= 0.0)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans array<struct<kind, start, end>>)`` of every row, by kind and start."""
    found = candidates(texts(docs, id_col, text_col)).select(
        "doc_id", F.transform("candidates", lambda c: c.dropFields("value")).alias("candidates"))
    found = stored(found)
    weights = train(votes_table(found))
    return found.select("doc_id", _named(F.filter("candidates", lambda c: _accepted(c, weights))).alias("spans"))


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(spans, lambda c: F.struct(F.element_at(names, c["kind"] + 1).alias("kind"),
                                                 c["start"].alias("start"), c["end"].alias("end")))


def digest(spans: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans, and all spans as text."""
    def joined(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter("spans", _is(k))).cast("bigint").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets; nulls stay null."""
    columns = docs.columns
    found = candidates(docs, text_col, "_pii_found")
    rows = found.where(F.size("_pii_found") > 0).select(F.transform(
        "_pii_found", lambda c: c.dropFields("value")).alias("candidates"))
    weights = train(votes_table(rows))
    text = F.col(f"`{text_col}`")
    spans = F.array_sort(F.transform(F.filter("_pii_found", lambda c: _accepted(c, weights)), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def add(acc, s):  # a span that lies in an earlier one adds nothing
        piece = F.when(s["start"] >= acc["at"], F.concat(
            F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))) \
            .otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    changed = F.aggregate("_pii_spans", start, add,
                          lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    x = found.select("*", spans.alias("_pii_spans"))
    new = F.when(F.size("_pii_spans") > 0, changed).otherwise(text)
    return x.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns])
