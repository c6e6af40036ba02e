"""Personal data by weak supervision: voting labelers, expectation-maximisation, a span classifier.

Candidates are spans of the base patterns (always kept) and of looser patterns that
alone prove little: phone numbers without country code, social security
numbers, account numbers (IBAN), obfuscated e-mail addresses, names after a
form of address and secrets (keys, tokens, passwords). Labelers vote for or against each candidate or abstain:

* regex: the strict form of the kind, with checksum or valid groups
* gazetteer: known reserved or dummy values speak against, known provider and
  country parts for it
* context before: words that announce such data stand in front of it
* context against: words that announce something else (version, invoice, ..)
* border: letters or digits touch the span; a secret must follow an assignment

Votes are counted per kind and pattern of votes (a table bounded by the number of
patterns). Expectation-maximisation on these counts estimates each labeler's
reliability and the share of true spans. The resulting probabilities train the
final classifier, a logistic regression over kind, votes and form of the
span: its digits, its distinct characters, the sign before it; candidates with a probability of at least ``threshold`` are kept.

Everything that touches rows is DataFrame expressions. Positions come from the pieces
between matches; patterns start at a run's border or where the last match ended,
with possessive repeats, so no pattern rescans a long run, and ends are running sums
in levels, so a text full of matches takes near linear time. Spans are stored once
and read for counting and for deciding.

Null text is empty. An input row gives one output row, also repeated rows and null
ids; columns other than id and text aren't read. Among equal spans of one kind the
base one stays; a looser span inside a base span is dropped. An empty table learns nothing and gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored

BASE = ("email", "ip", "card", "phone")
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
# Kind -> pattern. A leading \G or lookbehind says where a leftmost match can start; results are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "spelled_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++",
    "name": r"(?<![0-9A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+",
}
ORDER = {kind: i for i, kind in enumerate(PATTERNS)}
# A cheap test that a text may hold a kind at all.
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
    "local_phone": lambda t: t.rlike("[0-9]{3}[ .-][0-9]{4}"),
    "ssn": lambda t: t.rlike("-[0-9]{2}-"),
    "iban": lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
    "spelled_email": lambda t: t.rlike(r"[\[(]at[\])]"),
    "name": lambda t: t.rlike("(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)[. ]"),
    "secret": lambda t: t.rlike("[A-Za-z0-9+/_-]{16}"),
}
ANNOUNCED = {
    "email": "mail|contact|write|schreib|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|telefon|appel|llam",
    "local_phone": "phone|call|tel|mobile|fax|telefon|appel|llam",
    "ssn": "ssn|social|security|tax",
    "iban": "iban|account|konto|compte|cuenta",
    "spelled_email": "mail|contact|write|schreib|courriel|correo",
    "name": "name|contact|from|signed|author|dear",
    "secret": "token|secret|passw|pwd|api|key|bearer|auth|credential",
}
AGAINST_SECRET = "sha|md5|digest|checksum|commit|revision|hash|uuid"
AGAINST = "version|release|invoice|order|part|isbn|serial|chapter|section|build|page"
GAZETTEER_FOR = r"^(?:AKIA|ghp_|gho_|sk-|sk_|xox[abp]-|AIza)|gmail|yahoo|outlook|hotmail|proton|^\+(?:1|33|34|44|49)[ (.-]|^(?:DE|FR|ES|GB|IT|NL)[0-9]"
GAZETTEER_AGAINST = r"^(?:127|0|255)\.|^0+$|^(.)\1+$|^123-45-6789|555-01[0-9]{2}$|noreply|no-reply|(?i:example|sample|dummy|changeme|placeholder)"
LABELERS = ("regex", "gazetteer", "announced", "against", "border")
# Digits, distinct characters, sign before: the form of a span, each with values 0 to 3.
FORM = ("digits", "variety", "lead")
CONTEXT = 24


def valid(kind: str, m: Column) -> Column:
    """The check a base match must pass, or the strict form of a looser kind."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return m.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return (n >= 14) & (n <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return (n >= 10) & (n <= 15)
    if kind == "local_phone":
        return m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-]?[2-9]")
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":
        return (F.length(m) >= 20) & (n >= 3) & m.rlike("[A-Za-z](?:[^A-Za-z]*+[A-Za-z]){2}")
    if kind == "iban":
        return m.rlike("^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PT)[0-9]{2}")
    return F.lit(True)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals, from 0, of an array of whole numbers, each element included.

    Totals of 32 elements and of 32 such blocks are made first, so an element adds up at most 63 numbers
    and those before its block of 1024.
    """
    fold = lambda part: F.aggregate(part, F.lit(0), combine)
    blocks = lambda x: F.transform(
        F.filter(x, lambda _, i: i % 32 == 0), lambda _, b: fold(F.slice(x, b * 32 + 1, F.lit(32))))
    first = lambda i: F.shiftleft(F.shiftright(i, 5), 5) + 1

    def before(parts: Column, wholes: Column) -> Column:
        """Total of the elements before each of ``parts``, given those before each block of 32 of them."""
        return F.transform(parts, lambda _, i: combine(
            F.get(wholes, F.shiftright(i, 5)), fold(F.slice(parts, first(i), i % 32))))

    def of(x: Column, one: Column, two: Column) -> Column:
        tops = F.transform(two, lambda _, c: fold(F.slice(two, F.lit(1), c)))
        return bind(tops, lambda t: bind(before(one, t), lambda b: F.transform(
            x, lambda v, i: combine(combine(F.get(b, F.shiftright(i, 5)), fold(F.slice(x, first(i), i % 32))), v))))

    return bind(values, lambda x: bind(blocks(x), lambda one: bind(blocks(one), lambda two: of(x, one, two))))


def matches(text: Column) -> Column:
    """Array with the matches, the pieces between them and the ends of the matches of every kind, null if it can't occur."""
    found = F.array(*[F.when(NEEDS[k](text), F.struct(
        F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("m"), F.split(text, p, -1).alias("p"))) for k, p in PATTERNS.items()])

    def ends(s: Column) -> Column:
        steps = F.transform(s["m"], lambda x, i: F.length(x) + F.length(F.get(s["p"], i)))
        return running(steps, lambda a, y: a + y)

    return F.transform(found, lambda s: F.struct(s["m"].alias("m"), s["p"].alias("p"), ends(s).alias("ends")))


def kind_spans(kind: str, found: Column) -> Column:
    """Array of candidates of one kind with position, votes and form."""

    def spans(m: Column, p: Column, ends: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            end = F.get(ends, i)
            before, after = F.lower(F.right(F.get(p, i), F.lit(CONTEXT))), F.left(F.get(p, i + 1), F.lit(1))
            touch = F.concat(F.right(F.get(p, i), F.lit(1)), F.lit("\n"), after)
            secret = kind == "secret"
            border = (
                F.when(before.rlike("[=:] ?[\"'`]?$"), 1).otherwise(-1) if secret
                else F.when(touch.rlike("[0-9A-Za-z]"), -1).otherwise(1))
            ok = valid(kind, x)
            votes = F.struct(
                F.when(ok, 1).otherwise(-1).alias("regex"),
                F.when(x.rlike(GAZETTEER_AGAINST), -1).when(x.rlike(GAZETTEER_FOR), 1).otherwise(0).alias("gazetteer"),
                F.when(before.rlike(ANNOUNCED[kind]), 1).otherwise(-1 if secret else 0).alias("announced"),
                F.when(before.rlike(f"{AGAINST}|{AGAINST_SECRET}" if secret else AGAINST), -1).otherwise(0).alias("against"),
                border.alias("border"))
            shape = F.least(F.lit(3), F.floor(F.length(F.regexp_replace(x, "[^0-9]", "")) / 5)).cast("int")
            variety = F.least(F.lit(3), F.floor(F.size(F.array_distinct(F.split(x, ""))) / 5)).cast("int")
            lead = F.when(before.rlike("[=:\"'`]$"), 2).when(before.rlike("[^ \n]$"), 1).otherwise(0)
            return F.struct(
                (end - F.length(x)).alias("start"), F.lit(ORDER[kind]).alias("place"), end.alias("end"), F.lit(kind).alias("kind"),
                ok.alias("ok"), votes.alias("votes"), F.struct(*[
                    v.alias(name) for name, v in zip(FORM, (shape, variety, lead))]).alias("form"))

        every = F.transform(m, one)
        return F.filter(every, lambda s: s["ok"]) if kind in BASE else every

    return spans(found["m"], found["p"], found["ends"])


def candidates(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """``doc_id, spans`` (sorted by start, then kind) of every row, stored."""
    source = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = bind(matches(F.col("text")), lambda found: F.flatten(F.filter(
        F.array(*[kind_spans(k, found[i]) for k, i in ORDER.items()]), lambda a: a.isNotNull())))
    return stored(source.select("doc_id", F.sort_array(every).alias("spans")), "spans")


def vote_model(patterns: dict[tuple, int], rounds: int = 100) -> tuple[dict[tuple, float], list[tuple[float, float]], float]:
    """Probability of each vote pattern, (true, false) agreement of each labeler, share of true spans.

    ``patterns``: votes -> count. A labeler that votes says the truth with one
    probability for true and one for false spans; abstentions say nothing.
    """
    n = len(LABELERS)
    rates, share = [(0.8, 0.8)] * n, 0.5
    total = sum(patterns.values())
    truth: dict[tuple, float] = {}
    for _ in range(rounds):
        for votes in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for v, (a, b) in zip(votes, rates):
                if v:
                    yes += math.log(a if v > 0 else 1 - a)
                    no += math.log(1 - b if v > 0 else b)
            truth[votes] = 1 / (1 + math.exp(min(700, no - yes)))
        # Beta priors keep labelers better than chance and probabilities off 0 and 1.
        share = (sum(truth[v] * c for v, c in patterns.items()) + 2) / (total + 4)
        rates = []
        for i in range(n):
            a = [(truth[v] * c, v[i] > 0) for v, c in patterns.items() if v[i]]
            b = [((1 - truth[v]) * c, v[i] < 0) for v, c in patterns.items() if v[i]]
            rates.append(tuple(
                min(0.999, max(0.5, (sum(w for w, right in side if right) + 8) / (sum(w for w, _ in side) + 10))) for side in (a, b)))
    return dict(truth), rates, share


def vector(kind: str, votes: tuple, form: tuple) -> list[float]:
    """Features: constant, kinds, votes for and against per labeler, form."""
    return [
        1.0, *[float(kind == k) for k in PATTERNS], *[float(v > 0) for v in votes], *[float(v < 0) for v in votes],
        *[float(v == s) for v in form for s in range(4)]]


def span_classifier(rows: list[tuple[list[float], float, int]], rounds: int = 300, ridge: float = 0.1) -> list[float]:
    """Weights of a logistic regression on (features, probability, count), by gradient steps on counts."""
    if not rows:
        return []
    weights = [0.0] * len(rows[0][0])
    scale = sum(math.log1p(c) for _, _, c in rows)
    for _ in range(rounds):
        gradient = [ridge / scale * w for w in weights]
        for x, y, c in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x))))))
            for i, v in enumerate(x):
                if v:
                    gradient[i] += math.log1p(c) / scale * (p - y) * v
        weights = [w - 1.5 * g for w, g in zip(weights, gradient)]
    return weights


def learn(spans: DataFrame) -> dict[tuple[str, tuple, tuple], float]:
    """Probability of every (kind, votes, form) that occurs."""
    s = F.col("s")
    counted = spans.select(F.explode("spans").alias("s")).groupBy(
        s["kind"].alias("kind"), s["votes"].alias("votes"), s["form"].alias("form")).count().collect()
    rows = [(r["kind"], tuple(r["votes"]), tuple(r["form"]), r["count"]) for r in counted]
    truth: dict[tuple[str, tuple], float] = {}
    for kind in {r[0] for r in rows}:
        patterns: dict[tuple, int] = {}
        for k, votes, _, c in rows:
            if k == kind:
                patterns[votes] = patterns.get(votes, 0) + c
        truth |= {(kind, votes): p for votes, p in vote_model(patterns)[0].items()}
    weights = span_classifier([(vector(k, v, h), truth[k, v], c) for k, v, h, c in sorted(rows)])
    return {
        (k, v, h): 1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, vector(k, v, h))))) for k, v, h, _ in rows}


def decided(spans: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, spans``: base spans and those the classifier accepts."""
    accepted = [key for key, p in learn(spans).items() if p >= threshold and key[0] not in BASE]
    signature = lambda x: F.concat_ws(
        " ", x["kind"], *[x["votes"][name].cast("string") for name in LABELERS], *[x["form"][name].cast("string") for name in FORM])
    # At most kinds * 3 ** labelers * 4 ** forms strings, a few dozen in practice.
    names = F.array(*[F.lit(" ".join(map(str, (k, *v, *h)))) for k, v, h in sorted(accepted)]) if accepted else F.array().cast("array<string>")
    base = lambda x: x["kind"].isin(*BASE)
    # Spans are sorted by start, base kinds first: the furthest end of a base span so far tells what lies inside one.
    reach = running(F.transform("spans", lambda x: F.when(base(x), x["end"]).otherwise(0)), lambda a, y: F.greatest(a, y))
    return spans.select("doc_id", bind(reach, lambda ends: F.filter("spans", lambda x, i: base(x) | (
        F.array_contains(names, signature(x)) & (F.get(ends, i) < x["end"])))).alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def personal_data(docs: DataFrame, threshold: float = 0.5, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, counts and digest of base spans, all ``spans`` and their number ``n_spans`` of every row."""
    found = decided(candidates(docs, text, id_column), threshold)
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.size(of_kind("spans", k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"))


def mask(docs: DataFrame, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in angle brackets; null text stays null.

    Spans that overlap are masked from the first start to the last end, under the first one's kind.
    """
    # The text travels with its spans, so that repeated or missing ids need no join.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    spans = candidates(rows, "text", "row")
    found = decided(spans, threshold).withColumnRenamed("doc_id", "row")
    body = F.col(f"row.{text}")
    start = F.named_struct(F.lit("out"), F.lit(""), F.lit("at"), F.lit(0))

    def step(a: Column, x: Column) -> Column:
        gap = F.substring(body, a["at"] + 1, F.greatest(F.lit(0), x["start"] - a["at"]))
        tag = F.when(x["start"] >= a["at"], F.concat(F.lit("<"), x["kind"], F.lit(">"))).otherwise("")
        return F.named_struct(
            F.lit("out"), F.concat(a["out"], gap, tag), F.lit("at"), F.greatest(a["at"], x["end"]))

    rest = lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body)))
    masked = F.when(F.size("spans") == 0, body).otherwise(F.aggregate("spans", start, step, rest))
    return found.select(*[(masked.alias(c) if c == text else F.col(f"row.{c}").alias(c)) for c in docs.columns])
