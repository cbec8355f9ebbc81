r"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates: the matches of the base patterns, valid or not, and of one wider pattern (spelled addresses,
   national numbers, social security numbers, bank accounts, names after a title or a known first name).
   Places come from the lengths of the pieces between matches. One pass over the texts; what is kept of a
   candidate is its kind, place, votes and features.
2. Five labelers vote for, against or not at all: the strict pattern or checksum, a gazetteer, words before
   the candidate, the characters that touch it, and the variety of its digits.
3. Candidates are counted by kind and votes (at most 3^5 rows a kind, whatever the corpus holds);
   expectation-maximisation on these counts estimates how each labeler votes on true and on false
   candidates of a kind, starting from, and held by, labelers that are somewhat better than chance.
4. The posteriors train a span classifier: log odds of features (length, shape, digits, touching characters,
   word before) of each kind, from sums over all candidates. It sees no votes, so it also judges a candidate
   on which no labeler speaks.

Base spans always stay. A candidate of the wider pattern is added where the classifier gives it at least
``LEAST_SCORE``. An added span may overlap with a base span of another kind.

The patterns match what the stated base patterns match: quantifiers are possessive where what follows can't
start with the same characters, and runs are entered at their start (or where the last match ended), so
very long runs cost linear time and no stack.

Results: one row per input row, also for repeated rows and ids, null ids and texts included; a null text
counts as empty. Without spans ``base_sha256`` is the hash of the empty string and ``spans`` is empty. Spans
that start together stand in the order of ``KINDS``. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import cut

LEAST_SCORE = 0.5
ROUNDS = 40
CHUNK = 512
# Base kinds come first, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "name")

LOCAL = "[A-Za-z0-9._%+-]"
# Base patterns.
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Gazetteers.
TOP_DOMAINS = (
    "com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "me", "app", "dev", "eu", "us", "uk", "ca", "au", "nz", "ie", "de",
    "at", "ch", "fr", "be", "nl", "lu", "es", "pt", "it", "pl", "cz", "se", "no", "fi", "dk", "jp", "cn", "in", "br", "mx",
)
ACCOUNT_COUNTRIES = ("AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
FIRST_NAMES = (
    "James", "John", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Daniel", "Mary", "Patricia", "Jennifer", "Linda",
    "Elizabeth", "Susan", "Jessica", "Sarah", "Anna", "Maria", "Peter", "Hans", "Klaus", "Pierre", "Marie", "Carlos", "Carmen",
)
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")
# Words before a candidate that speak for and against it.
FOR = r"(?i)(mail|phone|tel|call|mobile|fax|contact|ssn|security|iban|account|konto|compte|cuenta|card|visa|host|addr|name|reach|write)[^\p{L}]*+(\p{L}{1,6}[^\p{L}]*+)?$"
AGAINST = r"(?i)(version|isbn|issn|order|invoice|part|page|build|sku|serial|item|figure|table)[^\p{L}]*+(\p{L}{1,6}[^\p{L}]*+)?$"

WIDER = "|".join((
    rf"(?<!{LOCAL}){LOCAL}{{1,64}}+(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{{1,63}}+(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]{{1,63}}+)++",
    r"(?<![0-9A-Za-z+-])(?<!\+[0-9]{1,3}[ .-]?)(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[ .-][0-9])",
    r"(?<![0-9A-Za-z+-])00[1-9][0-9](?:[ .-]?[0-9]){6,12}+(?![0-9A-Za-z]|[ .-][0-9])",
    r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? |(?:{'|'.join(FIRST_NAMES)}) )\p{{Lu}}\p{{Ll}}++(?:-\p{{Lu}}\p{{Ll}}++)?",
))


def running(values: Column) -> Column:
    """Sums of the array's items up to each of them, chunk by chunk, so that a long array costs little more than its length."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")), lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK)))

    def inner(chunk: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("sums"))
        return F.aggregate(chunk, start, lambda held, x: F.struct((held["at"] + x).alias("at"), F.concat(held["sums"], F.array(held["at"] + x)).alias("sums")))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("parts"))
    joined = F.aggregate(F.transform(chunks, inner), start, lambda held, c: F.struct(
        (held["at"] + c["at"]).alias("at"), F.concat(held["parts"], F.array(F.transform(c["sums"], lambda s: s + held["at"]))).alias("parts")))
    return F.flatten(joined["parts"])


NO_PLACES = "array<struct<start: bigint, end: bigint, word: string, before: string, after: string>>"


def places(matches: Column, text: Column, pattern: str) -> Column:
    """(start, end, word, 32 code points before, 2 after) of the matches; texts without one are not split."""
    n = F.size(matches)
    pieces = F.split(text, pattern, -1)
    ahead, behind = F.slice(pieces, F.lit(1), n), F.slice(pieces, F.lit(2), n)
    ends = running(F.zip_with(ahead, matches, lambda piece, word: (F.length(piece) + F.length(word)).cast("bigint")))
    zipped = F.arrays_zip(ends.alias("end"), matches.alias("word"), ahead.alias("ahead"), behind.alias("behind"))
    found = F.transform(zipped, lambda x: F.struct(
        (x["end"] - F.length(x["word"])).alias("start"), x["end"].alias("end"), x["word"].alias("word"),
        F.right(x["ahead"], F.lit(32)).alias("before"), F.substring(x["behind"], 1, 2).alias("after")))
    return F.when(n > 0, found.cast(NO_PLACES)).otherwise(F.array().cast(NO_PLACES))


def only_digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]++", "")


def valid(kind: str, word: Column) -> Column:
    """Whether a match of a base pattern is one of its kind."""
    if kind == "ip":
        return word.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.length(only_digits(word)).between(12, 19) & F.call_function("luhn_check", only_digits(word))
    if kind == "phone":
        return F.length(only_digits(word)).between(9, 15)
    return F.lit(True)


def wider_kind(word: Column) -> Column:
    return (F.when(word.rlike(r" at |[\[(]at[\])]"), "email").when(word.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(word.rlike("^[A-Z]{2}[0-9]{2}"), "iban").when(word.rlike("^[0-9(]"), "phone").otherwise("name"))


def account_checks(word: Column) -> Column:
    """Whether a bank account number passes its check: the number, first four characters last, is 1 modulo 97."""
    plain = F.regexp_replace(word, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(held: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (held * 10 + F.ascii(c) - 48) % 97).otherwise((held * 100 + F.ascii(c) - 55) % 97).cast("int")

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def vote(yes: Column, no: Column) -> Column:
    return F.when(no, "-").when(yes, "+").otherwise("0")


def votes(kind: Column, strict: Column, word: Column, before: Column, after: Column) -> Column:
    """A character for each labeler: + for, - against, 0 silent."""
    digits = only_digits(word)
    never = F.lit(False)
    by_kind = lambda choices, other: reduce(lambda held, item: F.when(kind == item[0], item[1]).otherwise(held), choices.items(), other)
    spelled = word.rlike(r"[\[(]at[\])].*[\[(]dot[\])]| at .* dot ")
    pattern = by_kind({
        "email": vote(strict | spelled, ~strict & ~spelled),
        "phone": vote(strict | word.rlike(r"^\(") | word.rlike("^00"), ~strict & word.startswith("+")),
        "ssn": vote(F.lit(True), word.rlike("^(000|666|9)|-00-|-0000$")),
        "iban": vote(account_checks(word), ~account_checks(word)),
        "name": vote(word.rlike(f"^({'|'.join(TITLES)})[. ]"), never),
    }, vote(strict, ~strict))
    domain = F.lower(F.regexp_extract(word, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_DOMAINS)
    gazetteer = by_kind({
        "email": vote(domain, ~domain),
        "ip": vote(never, word.rlike(r"^0*(0|127|255|2[2-5][0-9])\.")),
        "card": vote(word.rlike("^[3-6]"), ~word.rlike("^[3-6]")),
        "phone": vote(word.rlike(r"^(\+[1-9]|00[1-9]|\(?[2-9])"), ~word.rlike(r"^(\+[1-9]|00[1-9]|\(?[2-9])")),
        "iban": vote(F.substring(word, 1, 2).isin(*ACCOUNT_COUNTRIES), ~F.substring(word, 1, 2).isin(*ACCOUNT_COUNTRIES)),
        "name": vote(F.element_at(F.split(word, " "), 1).isin(*FIRST_NAMES), never),
    }, F.lit("0"))
    context = vote(before.rlike(FOR), before.rlike(AGAINST) & ~before.rlike(FOR))
    touched = before.rlike(r"""[\p{L}0-9_=/"'#-]$""") | after.rlike(r"""^[\p{L}0-9_=/"'#-]""")
    varied = vote(never, (F.length(digits) > 5) & (F.size(F.array_distinct(F.split(digits, ""))) <= 2))
    return F.concat(pattern, gazetteer, context, vote(~touched, touched), varied)


def features(word: Column, before: Column, after: Column) -> Column:
    """Bounded feature values: length, digits, shape, touching characters and the word before."""
    def touching(text: Column, end: str) -> Column:
        return (F.when(text == "", "none").when(text.rlike(rf"^\s{end}" if not end else rf"\s{end}"), "space")
                .when(text.rlike(rf"^\p{{L}}{end}" if not end else rf"\p{{L}}{end}"), "letter")
                .when(text.rlike(rf"^[0-9]{end}" if not end else rf"[0-9]{end}"), "digit").otherwise("other"))

    bucket = lambda text, n: F.pmod(F.xxhash64(text), F.lit(n)).cast("string")
    shape = F.regexp_replace(F.regexp_replace(word, "[0-9]++", "9"), r"\p{L}++", "a")
    last_word = F.lower(F.regexp_extract(before, r"(\p{L}++)[^\p{L}]*+$", 1))
    return F.array(
        F.concat(F.lit("length "), F.floor(F.least(F.length(word), F.lit(40)) / 4).cast("string")),
        F.concat(F.lit("digits "), F.least(F.length(only_digits(word)), F.lit(20)).cast("string")),
        F.concat(F.lit("shape "), bucket(shape, 64)),
        F.concat(F.lit("left "), touching(before, "$")),
        F.concat(F.lit("right "), touching(after, "")),
        F.concat(F.lit("word "), bucket(last_word, 128)),
    )


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the candidates of every row: kind, start, end, base, strict, votes, features."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    patterns = {**BASE, "wider": WIDER}
    matched = texts.withColumns({f"m_{name}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for name, p in patterns.items()})
    placed = matched.select("doc_id", *[places(F.col(f"m_{name}"), F.col("text"), p).alias(name) for name, p in patterns.items()])

    def described(name: str) -> Column:
        return F.transform(F.col(name), lambda x: F.struct(
            (wider_kind(x["word"]) if name == "wider" else F.lit(name)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.lit(name != "wider").alias("base"), (F.lit(False) if name == "wider" else valid(name, x["word"])).alias("strict"),
            x["word"].alias("word"), x["before"].alias("before"), x["after"].alias("after")))

    joined = placed.select("doc_id", F.concat(*[described(name) for name in patterns]).alias("found"))
    return joined.select("doc_id", F.transform("found", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"), x["strict"].alias("strict"),
        votes(x["kind"], x["strict"], x["word"], x["before"], x["after"]).alias("votes"),
        features(x["word"], x["before"], x["after"]).alias("features"))).alias("found"))


def estimate(counts: dict[tuple[str, str], int], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Posterior of truth for each (kind, votes), by expectation-maximisation on their counts.

    Each labeler has, for true and for false candidates of a kind, a distribution over its three votes.
    Pseudo-counts say that a labeler which speaks is right three times of four.
    """
    pseudo = {True: {"+": 3.0, "0": 2.0, "-": 1.0}, False: {"+": 1.0, "0": 2.0, "-": 3.0}}
    posterior = {}
    for kind in sorted({kind for kind, _ in counts}):
        held = {pattern: n for (k, pattern), n in sorted(counts.items()) if k == kind}
        labelers = len(next(iter(held)))
        speak = {truth: [{v: c / 6 for v, c in pseudo[truth].items()} for _ in range(labelers)] for truth in (True, False)}
        share = 0.5
        for _ in range(rounds):
            believed = {}
            for pattern in held:
                yes = math.log(share) + sum(math.log(speak[True][i][v]) for i, v in enumerate(pattern))
                no = math.log(1 - share) + sum(math.log(speak[False][i][v]) for i, v in enumerate(pattern))
                believed[pattern] = 1 / (1 + math.exp(min(max(no - yes, -700), 700)))
            weight = {True: believed, False: {p: 1 - b for p, b in believed.items()}}
            total = sum(held.values())
            share = (sum(n * believed[p] for p, n in held.items()) + 1) / (total + 2)
            for truth in (True, False):
                for i in range(labelers):
                    sums = dict(pseudo[truth])
                    for p, n in held.items():
                        sums[p[i]] += n * weight[truth][p]
                    whole = sum(sums.values())
                    speak[truth][i] = {v: s / whole for v, s in sums.items()}
        posterior |= {(kind, p): round(b, 9) for p, b in believed.items()}
    return posterior


def train(found: DataFrame) -> dict[str, float]:
    """Log odds by kind and feature; the key of a kind alone has its prior odds. ``found`` is read twice."""
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.features")
    counts = {(row.kind, row.votes): row["count"] for row in each.groupBy("kind", "votes").count().collect()}
    if not counts:
        return {}
    believed = lookup({f"{kind} {pattern}": p for (kind, pattern), p in estimate(counts).items()}, F.concat_ws(" ", "kind", "votes"))
    sums = each.withColumn("p", believed).select("kind", "p", F.explode("features").alias("feature")).groupBy("kind", "feature").agg(
        F.sum("p").alias("yes"), F.count(F.lit(1)).alias("n")).collect()
    odds, groups = {}, defaultdict(list)
    for row in sums:
        groups[row.kind, row.feature.split(" ")[0]].append((row.feature, row.yes, row.n - row.yes))
    for (kind, _), rows in groups.items():
        yes, no = sum(r[1] for r in rows), sum(r[2] for r in rows)
        odds[kind] = round(math.log((yes + 1) / (no + 1)), 6)
        for feature, y, n in rows:
            odds[f"{kind} {feature}"] = round(math.log((y + 1) / (yes + len(rows))) - math.log((n + 1) / (no + len(rows))), 6)
    return odds


def lookup(values: dict[str, float], key: Column) -> Column:
    """The value of a key, 0 without one; the table is a constant of the plan, bounded by kinds, votes and features."""
    if not values:
        return F.lit(0.0)
    names = sorted(values)
    table = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(float(values[n])) for n in names]))
    return F.coalesce(F.try_element_at(table, key), F.lit(0.0))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    found = cut(candidates(docs, id_column, text_column))
    odds = train(found)

    def score(x: Column) -> Column:
        total = F.aggregate(x["features"], lookup(odds, x["kind"]), lambda held, f: held + lookup(odds, F.concat_ws(" ", x["kind"], f)))
        return 1 / (1 + F.exp(-total))

    base = F.filter("found", lambda x: x["base"] & x["strict"])
    added = F.filter("found", lambda x: F.when(x["base"], F.lit(False)).otherwise(score(x) >= LEAST_SCORE))
    order = F.array(*[F.lit(kind) for kind in KINDS])

    def listed(spans: Column) -> Column:
        sorted_ = F.array_sort(F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"), F.array_position(order, x["kind"]).alias("number"), x["end"].alias("end"), x["kind"].alias("kind"))))
        return F.array_join(F.transform(sorted_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    parted = found.select("doc_id", base.alias("base"), added.alias("added"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return parted.select(
        F.col("doc_id").alias(id_column), *[number(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
