"""Personal data: candidates, labelers that vote, expectation-maximisation, a span classifier.

Regular expressions propose spans. Labelers (format, gazetteer, context) vote on each or
abstain. Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is, without labels; its posteriors are the soft labels of a naive Bayes
classifier over the shape of a span and the words around it, never over the votes, which decides on the spans
beyond the base ones. Only counts of patterns and of feature values, both of fixed number, reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from veil.llm.common import stored, tidy

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with possessive quantifiers: the same matches without backtracking.
# A run that leads to no match is not tried again from its middle.
BASE = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
# Looser forms, which only the classifier can make spans.
LOOSE = {
    "email": "(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\\(at\\)|\\[at\\]|\\{at\\}) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\\.|\\(dot\\)|\\[dot\\]) ?[A-Za-z0-9-]{1,63}+){1,5}+",
    "ip": "(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}+:){7}[0-9a-f]{1,4}+(?![0-9a-f:])",
    "card": "(?<![0-9./])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9./])",
    "phone": "(?<![0-9+.(-])(?:\\([0-9]{3}\\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}
# Access keys, which are counted but are no span of a kind.
SECRET = "(?<![A-Z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Z0-9])"
# Gazetteers.
TOP_DOMAINS = "com|net|org|edu|gov|mil|int|info|biz|io|dev|app|de|fr|es|it|nl|uk|us|ca|ch|at|be|eu|au|jp|in|br|mx|pl|se|no|dk|fi|pt|ru|cn"
CARD_ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|35|6011|65|62)"
COUNTRY_CODES = "^\\+?(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
# Words before a span that speak for or against each kind.
FOR = {
    "email": "e-?mail|mail|contact|write|reach|address", "ip": "\\bip\\b|address|server|host|login|client",
    "card": "card|visa|mastercard|credit|debit|payment|account", "phone": "phone|tel|call|mobile|cell|fax|whatsapp|contact",
}
AGAINST = "version|section|figure|isbn|issn|order|chapter|page|part no|serial|invoice|\\bv\\.?$"
# Toll-free and other numbers that reach no person.
NO_PERSON = "^(?:800|833|844|855|866|877|888|900|[0-9]11)"
# The first group of addresses that are in use or are private.
V6_PREFIXES = "^(?:2[0-9a-f]{3}|3[0-9a-f]{3}|f[cd][0-9a-f]{2}|fe[89ab][0-9a-f]):"
CONTEXT = 40
#: Buckets of the word before a span, as a feature.
WORD_BUCKETS = 32
LABELERS = ("format", "gazetteer", "context")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") >= 5, 9).otherwise(0)
    )
    return F.aggregate(F.transform(F.filter(each, lambda d: d != ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, span: Column) -> Column:
    """The checks a base match must pass."""
    digits = _digits(span)
    part_ok = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3
    small = F.forall(F.split(span, "\\."), lambda p: part_ok(p) & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == "email", True).when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, loose, start, end, span, before) of (doc_id, text); a document without any has one row of nulls.

    A pattern's matches and the pieces between them give the places: a match starts where
    all pieces up to it and all matches before it end. Those sums are a window of one
    document and pattern, over rows that hold no text.
    """
    text = F.col("text")
    may = {
        "email": text.contains("@"), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9][\\x20-]?[0-9]"), "phone": text.rlike("\\+[0-9]"),
    }
    may_loose = {
        "email": text.rlike("(?i)[({\\[]at[)}\\]]"), "ip": text.rlike("(?i)[0-9a-f]:[0-9a-f]"), "card": text.rlike("[0-9]{4}[./][0-9]{4}"), "phone": text.rlike("[0-9]{3}[ .-][0-9]{4}"),
    }
    found = []
    for loose, patterns, guard in ((False, BASE, may), (True, LOOSE, may_loose)):
        for kind in KINDS:
            pieces, matches = F.split(text, patterns[kind], -1), F.regexp_extract_all(text, F.lit(patterns[kind]), 0)
            one = F.transform(
                F.arrays_zip(F.transform(pieces, lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(CONTEXT)).alias("before"))).alias("p"), matches.alias("m")),
                lambda z, i: F.struct(F.lit(kind).alias("kind"), F.lit(loose).alias("loose"), i.alias("k"), z["p"]["gap"].alias("gap"), z["p"]["before"].alias("before"), z["m"].alias("span")),  # noqa: B023
            )
            found.append(F.when(guard[kind], F.filter(one, lambda s: s["span"].isNotNull())).otherwise(F.array()))
    # The number is given below the explode, and the stored rows keep it.
    secrets = F.when(text.rlike("A[KS]IA"), F.regexp_count(text, F.lit(SECRET))).otherwise(0).alias("n_secrets")
    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", secrets, F.explode_outer(F.flatten(F.array(*found))).alias("s"))
    rows = stored(rows.select("row", "doc_id", "n_secrets", "s.*"), "pii-candidates")
    up_to = Window.partitionBy("row", "kind", "loose").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("span")).over(up_to)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("span")).drop("k", "gap")


def votes(rows: DataFrame) -> DataFrame:
    """``rows`` with a vote (1, -1 or 0 for none) of each labeler."""
    kind, span, before = F.col("kind"), F.col("span"), F.col("before")
    digits = _digits(span)
    # Loose forms: one way to write at and dot, hexadecimal groups that aren't a clock or a hardware address, an area
    # and an exchange that exist.
    spelled = F.when(F.size(F.array_distinct(F.regexp_extract_all(F.lower(span), F.lit("[(\\[{](?=at|dot)"), 0))) == 1, 1).otherwise(-1)
    grouped = F.when(span.rlike("(?i)^[0-9a-f]{2}(?::[0-9a-f]{2})+$") | ~span.rlike("(?i)[a-f]"), -1).otherwise(1)
    numbered = F.when(digits.rlike("^[2-9][0-8][0-9][2-9][0-9]{6}$"), 1).otherwise(-1)
    form = F.when(~F.col("loose"), F.when(valid(kind, span), 1).otherwise(-1)).otherwise(
        F.when(kind == "card", F.when(luhn(digits), 1).otherwise(-1)).when(kind == "email", spelled).when(kind == "ip", grouped).otherwise(numbered)
    )
    known = (
        F.when(kind == "email", F.when(F.lower(span).rlike(f"(?:\\.|dot[)\\]] ?)(?:{TOP_DOMAINS})$"), 1).otherwise(-1))
        .when((kind == "ip") & ~F.col("loose"), F.when(span.rlike("^0*(?:0|127|22[4-9]|2[34][0-9]|25[0-5])\\."), -1).otherwise(1))
        .when(kind == "ip", F.when(F.lower(span).rlike(V6_PREFIXES), 1).otherwise(-1))
        .when(kind == "card", F.when(digits.rlike(CARD_ISSUERS), 1).otherwise(-1))
        .when((kind == "phone") & ~F.col("loose"), F.when(span.rlike(COUNTRY_CODES), 1).otherwise(-1))
        .otherwise(F.when(digits.rlike(NO_PERSON), -1).otherwise(1))
    )
    near = F.lower(before)
    speaks = F.lit(False)
    for name, pattern in FOR.items():
        speaks = F.when(kind == name, near.rlike(pattern)).otherwise(speaks)
    around = F.when(near.rlike(AGAINST), -1).when(speaks, 1).otherwise(0)
    return rows.withColumn("format", form).withColumn("gazetteer", known).withColumn("context", around)


@dataclass(frozen=True)
class Reliability:
    """Of one kind: share of true spans, and how often each labeler casts each vote on true and false ones."""

    prior: float
    cast: dict[tuple[str, int], tuple[float, float]]

    def posterior(self, pattern: tuple[int, ...]) -> float:
        true, false = math.log(self.prior), math.log(1 - self.prior)
        for name, vote in zip(LABELERS, pattern, strict=True):
            yes, no = self.cast[(name, vote)]
            true, false = true + math.log(yes), false + math.log(no)
        return 1 / (1 + math.exp(min(700, false - true)))


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 50) -> Reliability:
    """Expectation-maximisation over counts of vote patterns; starts from the majority of the votes.

    Beta priors (votes count 2 for a labeler being right more often than wrong) keep the two
    classes from swapping and rare votes from certainty.
    """
    belief = {p: 0.5 + 0.4 * (sum(p) > 0) - 0.4 * (sum(p) < 0) for p in counts}
    found = None
    for _ in range(rounds):
        true = sum(n * belief[p] for p, n in counts.items())
        false = sum(n * (1 - belief[p]) for p, n in counts.items())
        cast = {}
        for i, name in enumerate(LABELERS):
            for vote in (-1, 0, 1):
                yes = sum(n * belief[p] for p, n in counts.items() if p[i] == vote)
                no = sum(n * (1 - belief[p]) for p, n in counts.items() if p[i] == vote)
                cast[(name, vote)] = ((yes + 1 + (vote == 1)) / (true + 4), (no + 1 + (vote == -1)) / (false + 4))
        found = Reliability((true + 1) / (true + false + 2), cast)
        belief = {p: found.posterior(p) for p in counts}
    return found or Reliability(0.5, {(n, v): (1 / 3, 1 / 3) for n in LABELERS for v in (-1, 0, 1)})


def features(rows: DataFrame) -> Column:
    """What the classifier sees of a span: its shape and what stands before it; text values, a fixed number of each.

    The votes are none of them: the classifier is to learn what spans look like, also where no labeler had a word.
    """
    span = F.col("span")
    near = F.lower(F.col("before"))
    last = F.regexp_extract(near, "([\\p{L}]+)[^\\p{L}]*$", 1)
    touching = F.right(F.col("before"), F.lit(1))
    spoken = F.lit("none")
    for name, pattern in FOR.items():
        spoken = F.when((F.col("kind") == name) & near.rlike(pattern), "for").otherwise(spoken)
    capped = lambda c, most: F.least(c, F.lit(most)).cast("string")
    digits = F.length(_digits(span))
    tail = F.lower(F.regexp_extract(span, "([A-Za-z0-9]+)[^A-Za-z0-9]*$", 1))
    first = F.regexp_extract(span, "^[^A-Za-z0-9]*([A-Za-z0-9]+)", 1)
    return F.array(
        F.concat(F.lit("length="), capped(F.floor(F.length(span) / 4), 12)),
        F.concat(F.lit("digits="), capped(F.floor(digits * 10 / F.greatest(F.length(span), F.lit(1))), 10)),
        F.concat(F.lit("marks="), capped(F.length(F.regexp_replace(span, "[A-Za-z0-9]", "")), 8)),
        F.concat(F.lit("groups="), capped(F.size(F.split(span, "[^A-Za-z0-9]+")), 8)),
        F.concat(F.lit("edge="), F.when(touching == "", "none").when(touching.rlike("\\p{L}"), "letter").when(touching.rlike("[0-9]"), "digit")
                 .when(touching.rlike("[:=]"), "colon").when(touching.rlike("\\s"), "space").otherwise("mark")),
        F.concat(F.lit("spoken="), F.when(near.rlike(AGAINST), "against").otherwise(spoken)),
        F.concat(F.lit("word="), F.when(last == "", "none").otherwise(F.pmod(F.xxhash64(last), F.lit(WORD_BUCKETS)).cast("string"))),
        F.concat(F.lit("head="), F.regexp_replace(F.substring(span, 1, 1), "[A-Za-z]", "a")),
        F.concat(F.lit("sum="), F.when(digits >= 12, luhn(_digits(span)).cast("string")).otherwise("none")),
        F.concat(F.lit("tail="), F.when(tail.rlike("^[0-9]*$"), "digits").otherwise(F.pmod(F.xxhash64(tail), F.lit(WORD_BUCKETS)).cast("string"))),
        F.concat(F.lit("first="), F.when(first.rlike("^[0-9]+$"), F.substring(first, 1, 1)).when(first.rlike("^[0-9a-fA-F]+$"), "hex").otherwise("word")),
        F.concat(F.lit("letters="), span.rlike("[A-Za-z]").cast("string")),
    )


def classify(rows: DataFrame) -> DataFrame:
    """``rows`` (candidates with votes) with ``probability``, by classifiers trained on all of them.

    A kind's base and looser forms have reliabilities and a classifier of their own: what a labeler is worth on runs of
    digits says little about what it is worth on a number written with dots.
    """
    given = rows.columns
    rows = rows.withColumn("form", F.concat("kind", F.when(F.col("loose"), "~").otherwise("")))
    counted = rows.where("kind is not null").groupBy("form", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()  # 27 patterns a form
    forms = [kind + mark for kind in KINDS for mark in ("", "~")]
    belief = {}
    for kind in forms:
        counts = {tuple(r[x] for x in LABELERS): r["n"] for r in counted if r["form"] == kind}
        model = estimate(counts)
        belief |= {(kind, p): model.posterior(p) for p in counts}
    table = lambda entries: F.create_map(*(F.lit(x) for e in entries.items() for x in e)) if entries else F.create_map(F.lit(""), F.lit(0.0))
    key = lambda kind, pattern: ",".join([kind, *map(str, pattern)])
    soft = F.element_at(table({key(k, p): v for (k, p), v in belief.items()}), F.concat_ws(",", "form", *LABELERS))
    rows = rows.withColumn("features", features(rows))
    seen = (
        rows.where("kind is not null").select("form", soft.alias("p"), F.explode("features").alias("feature"))
        .groupBy("form", "feature").agg(F.sum("p").alias("yes"), F.sum(F.lit(1.0) - F.col("p")).alias("no")).collect()
    )  # some hundreds of values a form
    weight, start = {}, {}
    for kind in forms:
        mine = [r for r in seen if r["form"] == kind]
        base = [r for r in mine if r["feature"].startswith("edge=")]
        yes, no = sum(r["yes"] for r in base), sum(r["no"] for r in base)
        start[kind] = math.log((yes + 1) / (no + 1))
        for r in mine:
            weight[f"{kind},{r['feature']}"] = math.log(((r["yes"] + 1) / (yes + 20)) / ((r["no"] + 1) / (no + 20)))
    odds = F.aggregate(
        F.transform("features", lambda f: F.coalesce(F.element_at(table(weight), F.concat_ws(",", F.col("form"), f)), F.lit(0.0))),
        F.element_at(table(start), F.col("form")), lambda a, x: a + x,
    )
    return rows.withColumn("probability", F.when(F.col("kind").isNotNull(), F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))).select(*given, "probability")


@tidy
def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(row, doc_id, kind, start, end, base, probability, n_secrets) of every span found; a document without any has one row of nulls,
    and so have all others beside their spans, with the number of access keys.

    Base spans always stay; a looser one is added when its probability reaches ``threshold``, no base
    span overlaps it and no earlier looser one does. Offsets are code points, end exclusive. Null and
    empty texts have none. Every row is a document of its own, also if ids repeat or are null; ``row`` tells them apart.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = stored(votes(candidates(docs)), "pii-votes")
    rows = classify(rows).withColumn("base", ~F.col("loose") & (F.col("format") == 1))
    live = F.col("base") | (F.col("loose") & (F.col("probability") >= threshold))
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    of = lambda which, c: F.when(which, F.col(c))
    whole = rows
    rows = rows.where("kind is not null").where(live)
    clear = (
        F.coalesce(F.max(of(F.col("base") | F.col("loose"), "end")).over(before) <= F.col("start"), F.lit(True))
        & F.coalesce(F.min(of(F.col("base"), "start")).over(after) >= F.col("end"), F.lit(True))
    )
    names = ["row", "doc_id", "kind", "start", "end", "base", "probability"]
    spans = rows.withColumn("clear", clear).where("base or clear").select(*names)
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("kind", "string"), ("start", "bigint"), ("end", "bigint"), ("base", "boolean"), ("probability", "double"))]
    documents = whole.select("row", "doc_id", "n_secrets").distinct().select("row", "doc_id", *nothing, "n_secrets")
    return spans.withColumn("n_secrets", F.lit(0)).union(documents)


def pii_by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans, n_secrets, personal), one row for each row of ``docs``; see ``find_pii``.

    The counts by kind and the digest are of base spans, ``spans`` holds all of them. ``personal``: the document has a span or an access key.
    """
    found = find_pii(docs, id_col, text_col)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.when(F.col("kind").isNotNull(), F.struct("start", place.alias("place"), "end", F.concat_ws(":", "kind", "start", "end").alias("name"), "base"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: s["name"]), ",")
    grouped = found.groupBy("row", "doc_id").agg(
        *(F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS), F.sort_array(F.collect_list(one)).alias("s"),
        F.sum("n_secrets").cast("bigint").alias("n_secrets"),
    )
    n_spans = F.size("s").cast("bigint")
    return grouped.select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(joined(F.filter("s", lambda s: s["base"])), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"), F.size(F.filter("s", lambda s: ~s["base"])).cast("bigint").alias("n_added"),
        n_spans.alias("n_spans"), "n_secrets", ((n_spans > 0) | (F.col("n_secrets") > 0)).alias("personal"),
    )
