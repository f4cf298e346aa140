"""Personal data by weak supervision, in built-in expressions only.

Base spans (email, ip, card, phone) come from fixed patterns and checks; they
always stay. Further spans (``secret``: keys, passwords, tokens) are learned:

1. candidates are words that hold a digit or look like an access key;
2. labelers vote on each (1 private, 0 not, null abstains): regular
   expressions, a gazetteer of key words, and the context before the value;
3. the votes are aggregated to one row per vote pattern (a few dozen rows,
   whatever the corpus), on which expectation-maximisation estimates each
   labeler's reliability and each pattern's probability;
4. a logistic regression over the candidates' features, fitted to those
   probabilities (again one weighted row per feature pattern), is the span
   classifier; it is compiled into a column expression and filters each
   document's candidates in place.

One pass reads the texts: base spans and candidates are staged per document
in the shared folder. Nothing is shuffled but aggregated patterns.

Offsets: ``split`` gives the gaps and ``regexp_extract_all`` the matches of a
pattern, so a match starts at the summed lengths before it (code points).
The sums run over chunks of 256 matches, so a text with a great many matches
stays cheap. Quantifiers are possessive and matches are anchored at the start
of a run, so that no text makes a pattern backtrack or recurse far.

Defined cases: a null text is empty; an empty text has no spans; ids may be
null or repeated (rows are independent); without candidates there is no
classifier and only base spans are returned.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Fixed patterns, written so that they match the same spans as
#: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``,
#: ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, card ``[0-9]([\\x20-]?[0-9])+``
#: and phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` from left to right. ``\\G`` lets
#: a match begin where the last one ended, inside a run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Words with a digit, or like an access key.
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?:[^0-9\x20\x09-\x0D]*+[0-9]|AKIA[0-9A-Z]{12})[^\x20\x09-\x0D]*+"
KEY_WORDS = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key", "key", "bearer", "credential")
KINDS = ("email", "ip", "card", "phone")
LABELERS = ("known", "form", "gazetteer", "context", "mix")
FEATURES = ("keyed", "assigned", "known", "hex", "number", "mixed", "long", "capital")
ROUNDS = 50
THRESHOLD = 0.5
_CHUNK = 256


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before>> of a pattern's matches;
    ``before``: the last characters between the previous match and this."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("value"))
    pairs = F.transform(pairs, lambda p: F.struct(F.length(p["gap"]).alias("skip"), F.right(p["gap"], F.lit(24)).alias("before"), p["value"].alias("value")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")

    def add(a: Column, p: Column) -> Column:
        start = a["at"] + p["skip"]
        end = start + F.length(p["value"])
        return F.struct(end.alias("at"), F.array_append(a["out"], F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"), p["before"].alias("before"))).alias("out"))

    def chunk(a: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(a["at"].alias("at"), empty.alias("out")), add)
        return F.struct(done["at"].alias("at"), F.array_append(a["out"], done["out"]).alias("out"))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _CHUNK).cast("int")), lambda i: F.slice(pairs, i * _CHUNK + 1, _CHUNK))
    lists = F.array().cast("array<array<struct<start:int,end:int,value:string,before:string>>>")
    all_parts = F.aggregate(parts, F.struct(F.lit(0).alias("at"), lists.alias("out")), chunk, lambda a: F.flatten(a["out"]))
    return F.when(F.size(found) > 0, all_parts).otherwise(empty)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(a: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return a + twice

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the matches that pass its checks."""
    digit = F.rlike(text, F.lit("[0-9]"))
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")
    number = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    card = F.filter(matches(text, CARD), lambda m: F.length(_digits(m["value"])).between(16, 19) & luhn(_digits(m["value"])))
    phone = F.filter(matches(text, PHONE), lambda m: F.length(_digits(m["value"])).between(8, 15))
    return {
        "email": F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)).otherwise(none),
        "ip": F.when(digit, F.filter(matches(text, IP), lambda m: F.rlike(m["value"], F.lit(rf"^{number}(?:\.{number}){{3}}$")))).otherwise(none),
        "card": F.when(digit, card).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), phone).otherwise(none),
    }


def candidates(text: Column) -> Column:
    """array<struct<start, end, value, lead>> of the values inside candidate
    words; ``lead``: what stands before a value, lower-cased."""
    def core(m: Column) -> Column:
        kept = F.regexp_replace(m["value"], r"(?<=[0-9A-Za-z])[^0-9A-Za-z]++$", "")
        value = F.regexp_extract(kept, r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]++$", 0)
        at = F.length(kept) - F.length(value)
        lead = F.lower(F.concat(m["before"], F.right(F.substring(m["value"], F.lit(1), at), F.lit(24))))
        return F.struct((m["start"] + at).alias("start"), (m["start"] + F.length(kept)).alias("end"), value.alias("value"), lead.alias("lead"))

    none = F.array().cast("array<struct<start:int,end:int,value:string,lead:string>>")
    words = F.filter(matches(text, CANDIDATE), lambda m: ~F.contains(m["value"], F.lit("@")))
    some = F.rlike(text, F.lit("[0-9]|AKIA"))
    return F.when(some, F.filter(F.transform(words, core), lambda c: F.length(c["value"]) > 0)).otherwise(none)


def features(c: Column) -> dict[str, Column]:
    v, lead = c["value"], c["lead"]
    key = "|".join(KEY_WORDS)
    return {
        "keyed": F.rlike(lead, F.lit(rf"(?:{key})[\"']?[\x20]?[=:]?[\x20]?[\"']?$")),
        "assigned": F.rlike(lead, F.lit("[=:\"']$")),
        "known": F.rlike(v, F.lit("^AKIA[0-9A-Z]{16}$")),
        "hex": F.rlike(v, F.lit("^(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{12,}+$")),
        "number": F.rlike(v, F.lit("^[0-9+/_-]++$")),
        "mixed": F.rlike(v, F.lit("[A-Za-z]")) & F.rlike(v, F.lit("[0-9]")),
        "long": F.length(v) >= 12,
        "capital": F.rlike(v, F.lit("^[A-Z0-9]++$")),
    }


def votes(f: dict[str, Column]) -> dict[str, Column]:
    """The labelers: 1 private, 0 not, null abstains."""
    one, zero, none = F.lit(1), F.lit(0), F.lit(None).cast("int")
    return {
        "known": F.when(f["known"], one).otherwise(none),
        "form": F.when(f["hex"], one).when(f["number"], zero).otherwise(none),
        "gazetteer": F.when(f["keyed"], one).otherwise(zero),
        "context": F.when(f["assigned"], one).otherwise(zero),
        "mix": F.when(f["mixed"] & f["long"], one).when(~f["long"], zero).otherwise(none),
    }


def reliabilities(patterns: list[tuple[tuple, int]], rounds: int = ROUNDS) -> tuple[dict[tuple, float], list[tuple[float, float]]]:
    """Expectation-maximisation over (votes, count) rows: the probability of
    each vote pattern and, per labeler, how often it votes 1 on private and
    on other candidates (of the times it votes)."""
    prob = {v: (1 + sum(x == 1 for x in v)) / (2 + sum(x is not None for x in v)) for v, _ in patterns}
    rates: list[tuple[float, float]] = []
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = min(max((sum(prob[v] * n for v, n in patterns) + 1) / (total + 2), 1e-6), 1 - 1e-6)
        rates = []
        for i in range(len(patterns[0][0])):
            said = [(v[i], prob[v], n) for v, n in patterns if v[i] is not None]
            hit = (sum(p * n for x, p, n in said if x) + 1) / (sum(p * n for _, p, n in said) + 2)
            slip = (sum((1 - p) * n for x, p, n in said if x) + 1) / (sum((1 - p) * n for _, p, n in said) + 2)
            rates.append((hit, slip))
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for x, (hit, slip) in zip(v, rates):
                if x is not None:
                    odds += math.log(hit / slip) if x else math.log((1 - hit) / (1 - slip))
            prob[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return prob, rates


def span_classifier(staged: DataFrame):
    """A function candidate -> score column, or None without candidates."""
    c = staged.select(F.explode("candidates").alias("c"))
    f = features(F.col("c"))
    rows = c.select(*[f[k].alias(k) for k in FEATURES])
    seen = {k: F.col(k) for k in FEATURES}
    # One row per feature pattern (2^8 at most); votes are functions of them.
    said = votes(seen)
    counted = rows.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n")).select(*FEATURES, "n", *[said[k].alias(f"v_{k}") for k in LABELERS]).collect()
    if not counted:
        return None
    by_votes: dict[tuple, int] = {}
    for r in counted:
        v = tuple(r[f"v_{k}"] for k in LABELERS)
        by_votes[v] = by_votes.get(v, 0) + r["n"]
    prob, _ = reliabilities(sorted(by_votes.items(), key=str))
    train = []
    for r in counted:
        p, x = prob[tuple(r[f"v_{k}"] for k in LABELERS)], [float(r[k]) for k in FEATURES]
        train += [(x, 1.0, p * r["n"]), (x, 0.0, (1 - p) * r["n"])]
    soft = staged.sparkSession.createDataFrame(train, "x array<double>, label double, n double").filter("n > 0").coalesce(1)
    model = LogisticRegression(regParam=1e-3, weightCol="n", maxIter=50).fit(soft.select(array_to_vector("x").alias("features"), "label", "n"))
    weights, intercept = model.coefficients.toArray().tolist(), float(model.intercept)

    def score(c: Column) -> Column:
        of, total = features(c), F.lit(intercept)
        for k, w in zip(FEATURES, weights):
            total = total + F.when(of[k], F.lit(w)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    return score


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, one array of matches per base kind
    and ``secret``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    short = lambda a: F.transform(a, lambda m: F.struct(m["start"], m["end"]))
    staged = docs.select("doc_id", *[short(s).alias(k) for k, s in base_spans(text).items()], candidates(text).alias("candidates"))
    staged = cut_lineage(staged, "pii-candidates")
    score = span_classifier(staged)
    secret = F.filter("candidates", lambda c: score(c) >= threshold) if score else F.filter("candidates", lambda c: F.lit(False))
    return staged.select("doc_id", *KINDS, short(secret).alias("secret"))


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of all spans of the kinds, comma-joined."""
    def told(kind: str) -> Column:
        return F.transform(kind, lambda m: F.concat_ws(":", F.lit(kind), m["start"].cast("string"), m["end"].cast("string")))

    return F.array_join(F.concat(*map(told, kinds)), ",")
