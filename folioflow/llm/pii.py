"""Personal data by weak supervision, in DataFrame expressions only.

Patterns propose spans of five kinds: the strict (base) ones of the contract's four kinds, which always stay, and loose ones,
which are other spellings (an e-mail address spelt out, a defanged IPv4 or an IPv6 address, a card number with other
separators, a phone number without a plus sign) and credentials (kind ``secret``). Five labelers vote on every span, each
+1, 0 (no opinion) or -1:

* pattern: the strict pattern and its checks matched;
* gazetteer: a known top-level domain, a card issuer's leading digits, a calling or trunk code, a credential's prefix or length;
* context: a telling word among the 24 characters before (+1), or a misleading one (-1);
* shape: digits or letters as the kind has them, a card's checksum, a credential that mixes letters and digits;
* border: no letter, digit or underscore touches the span.

Expectation-maximisation (Dawid and Skene's model, a prior for each kind) estimates each labeler's reliability from the
counts of vote patterns, of which there are at most 5 x 3^5. Its posteriors are the targets of a logistic span classifier
that sees more than the votes: the kind, the gazetteer, context, shape and border votes, and the span's length, share of digits,
separators and the character before it, in steps. It is fitted to counts of such patterns, whose number is bounded by the
steps, whatever the input; its weights are a handful of literals. Loose spans stay if it gives them ``threshold`` at least.

Offsets are code points, end exclusive. Defined results: a null text is the empty text; a loose span that overlaps a strict
one, or an earlier kind's loose one, isn't proposed; repeated rows stay rows; an empty table gives an empty result; other columns pass through, and
``spans`` has underscores before its name where that is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, stored, table, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: The contract's patterns, made linear: possessive runs, and a start inside a run only where a match has just ended.
#: A card needs 13 digits at least, so shorter runs needn't be proposed.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[\[({] ?at ?[\])}] ?[a-z0-9-]++(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[a-z0-9-]++)++",
    "ip": r"(?i)(?<![0-9a-z.:])(?:[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}|(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?:[0-9a-f]{1,4}:){1,6}(?::[0-9a-f]{1,4}){1,6})(?![0-9a-z:])",
    "card": r"(?<![0-9._/])[0-9]{4}(?:[._/][0-9]{4}){2}[._/][0-9]{1,7}(?![0-9._/]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){2,4}(?![0-9A-Za-z.-])",
    "secret": r"(?i)(?<![a-z0-9])(?:(?:api[_-]?key|access[_-]?key|secret|token|password|passwd)[\"']? ?[:=] ?[\"']?[a-z0-9+/_=-]{8,}+|akia[0-9a-z]{16}(?![0-9a-z])|gh[pousr]_[a-z0-9]{36}(?![0-9a-z]))",
}
#: What a text must hold for a pattern to be worth trying.
HINTS = {"email": "@", "phone": "+", "ip": "."}
TLDS = ["com", "org", "net", "edu", "gov", "info", "io", "fr", "de", "es", "uk", "eu", "vn", "co"]
TELLING = {
    "email": r"(?i)(e-?mail|contact|write|correo|courriel)[^\n]*$",
    "ip": r"(?i)\b(ip|address|server|host)\b[^\n]*$",
    "card": r"(?i)(card|visa|credit|karte|carte|tarjeta)[^\n]*$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|contact)[^\n]*$",
    "secret": r"(?i)(aws|github|login|auth|credential|export)[^\n]*$",
}
MISLEADING = r"(?i)\b(version|isbn|order|invoice|ref|serial|no\.|id|page|section|date|example|sample)[ :#]*$"
LABELERS = ("pattern", "gazetteer", "context", "shape", "border")
THRESHOLD = 0.5
SPAN = "array<struct<kind:string,k:int,s:int,e:int,base:boolean,votes:array<int>,features:array<int>>>"
#: Steps of each further feature of a span: length, share of digits, separators, character before.
STEPS = (5, 4, 4, 3)


def _luhn(digits: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.contains(text, F.lit(HINTS[kind])), found).otherwise(F.array().cast("array<string>")) if kind in HINTS and pattern == BASE[kind] else found


def _matches(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<s,e,m>>: the matches with their offsets, from the gaps between them."""
    pairs = F.arrays_zip(F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length).alias("g"), found.alias("m"))
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]).otherwise(none)


def _votes(text: Column, kind: str, x: Column, base: bool) -> Column:
    m, before = x["m"], F.substring(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    say = lambda yes, no=None: F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)
    value = F.regexp_replace(m, r"(?i)^[a-z_-]+[\"']? ?[:=] ?[\"']?", "")
    known = {
        "email": F.array_contains(F.lit(TLDS), F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))),
        "ip": ~m.rlike(r"(^|[.\])])0[0-9]"),
        "card": digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6)"),
        "phone": m.rlike(r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})|^\(?0|^\(?[2-9][0-9]{2}\)?[ .-][2-9]"),
        "secret": m.rlike(r"(?i)^(akia|gh[pousr]_)") | value.rlike(r"(?i)^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|sk-.*|gh[pousr]_.*)$"),
    }[kind]
    usual = {
        "email": F.length(m) <= 254,
        "ip": F.length(m) <= 39,
        "card": (n >= 13) & (n <= 19) if base else F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(False),
        "phone": (n >= 9) & (n <= 15),
        "secret": value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 16),
    }[kind]
    touches = F.substring(before, -1, 1).rlike(r"[\p{L}\p{N}_]") | F.substring(text, x["e"] + 1, F.lit(1)).rlike(r"[\p{L}\p{N}_]")
    return F.array(F.lit(1 if base else 0), say(known), say(before.rlike(TELLING[kind]), before.rlike(MISLEADING)), say(usual, ~usual), F.when(touches, -1).otherwise(1))


def _features(text: Column, x: Column) -> Column:
    m = x["m"]
    n, digits = F.length(m), F.length(F.regexp_replace(m, "[^0-9]", ""))
    marks = F.length(F.regexp_replace(m, "[A-Za-z0-9]", ""))
    left = F.when(x["s"] > 0, F.substring(text, x["s"], F.lit(1))).otherwise(" ")
    side = F.when(left.rlike(r"[\p{L}\p{N}_]"), 2).when(left.rlike(r"\s"), 0).otherwise(1)
    return F.array(F.least(F.floor(n / 8), F.lit(4)).cast("int"), F.least(F.floor(4 * digits / n), F.lit(3)).cast("int"), F.least(marks, F.lit(3)).cast("int"), side.cast("int"))


def _apart(spans: str, taken: str) -> Column:
    return F.filter(spans, lambda x: ~F.exists(taken, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))


def propose(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """docs and all proposed spans with votes and features: the base ones first, then loose ones that overlap none before."""
    patterns = [(k, BASE[k], True) for k in BASE_KINDS] + [(k, p, False) for k, p in LOOSE.items()]
    names, whole = docs.columns, free("_t", docs.columns)
    found, matched, proposed = ([free(f"{n}{i}", names) for i in range(len(patterns))] for n in ("_f", "_m", "_s"))
    t = F.col(whole)
    rows = docs.withColumn(whole, text_of(F.col(text)))
    # one projection after another, so that each pattern runs once for a text
    rows = rows.withColumns({f: _found(t, k, p) for f, (k, p, _) in zip(found, patterns, strict=True)})
    rows = rows.withColumns({m: _matches(t, F.col(f), p) for m, f, (_, p, _) in zip(matched, found, patterns, strict=True)}).drop(*found)

    def spans(m: str, kind: str, base: bool) -> Column:
        valid = F.filter(m, lambda x: _valid(kind, x["m"])) if base or kind == "phone" else F.col(m)
        voted = F.transform(valid, lambda x: F.struct(F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"), _votes(t, kind, x, base).alias("votes"), _features(t, x).alias("features")))
        return F.when(F.size(m) > 0, voted.cast(SPAN)).otherwise(F.array().cast(SPAN))

    rows = rows.withColumns({p: spans(m, k, b) for p, m, (k, _, b) in zip(proposed, matched, patterns, strict=True)}).drop(*matched)
    got = F.concat(*[F.col(p) for p, x in zip(proposed, patterns, strict=True) if x[2]])
    for i, p in enumerate(p for p, x in zip(proposed, patterns, strict=True) if not x[2]):
        step = free(f"_a{i}", names)
        rows = rows.withColumn(step, got)
        got = F.concat(F.col(step), F.when(F.size(p) > 0, _apart(p, step)).otherwise(F.col(p)))
    return rows.select(*[F.col(f"`{c}`") for c in names], got.alias(into))


def reliabilities(patterns: list[tuple[tuple[str, tuple[int, ...]], int]], rounds: int = 50) -> tuple[dict, list[dict[int, tuple[float, float]]]]:
    """EM over counts of (kind, votes): the posterior of each pattern, and P(vote | false), P(vote | true) of each labeler.

    It starts from the share of positive votes; add-one smoothing keeps every probability inside (0, 1).
    """
    post = {p: min(0.95, max(0.05, 0.5 + sum(p[1]) / (2 * len(p[1])))) for p, _ in patterns}
    table: list[dict[int, tuple[float, float]]] = []
    for _ in range(rounds):
        table = []
        for j in range(len(LABELERS)):
            sums = {v: [1.0, 1.0] for v in (-1, 0, 1)}
            for p, n in patterns:
                sums[p[1][j]][0] += n * (1 - post[p])
                sums[p[1][j]][1] += n * post[p]
            totals = [sum(s[c] for s in sums.values()) for c in (0, 1)]
            table.append({v: (s[0] / totals[0], s[1] / totals[1]) for v, s in sums.items()})
        prior = {k: (1 + sum(n * post[p] for p, n in patterns if p[0] == k)) / (2 + sum(n for p, n in patterns if p[0] == k)) for k in KINDS}
        for p, _ in patterns:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]])) + sum(math.log(table[j][v][1] / table[j][v][0]) for j, v in enumerate(p[1]))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, table


def inputs(kind: str, votes: tuple[int, ...], features: tuple[int, ...]) -> list[int]:
    """What the classifier sees: one-hot kind and feature steps, and the votes but the strict pattern's."""
    out = [int(kind == k) for k in KINDS] + list(votes[1:])
    for f, steps in zip(features, STEPS, strict=True):
        out += [int(f == i) for i in range(1, steps)]
    return out


def span_classifier(counts: list, post: dict, rounds: int = 300, rate: float = 1.0, ridge: float = 1e-3) -> list[float]:
    """Logistic regression on the posteriors by gradient steps over counts of ((kind, votes, features), n): the weights of ``inputs``.

    Steps are per kind of equal weight, so that a kind with few spans is learnt too.
    """
    of_kind = dict.fromkeys(KINDS, 0)
    for (kind, _, _), n in counts:
        of_kind[kind] += n
    rows = [([i for i, v in enumerate(x) if v], [v for v in x if v], post[(c[0], c[1])], n / of_kind[c[0]]) for c, n in counts for x in [inputs(*c)]]
    w = [0.0] * len(inputs("", (0,) * len(LABELERS), (0,) * len(STEPS)))
    total = sum(r[3] for r in rows) or 1.0
    for _ in range(rounds):
        g = [ridge * x for x in w]
        for at, values, target, share in rows:
            z = sum(w[i] * v for i, v in zip(at, values, strict=True))
            d = share / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target)
            for i, v in zip(at, values, strict=True):
                g[i] += d * v
        w = [a - rate * b for a, b in zip(w, g, strict=True)]
    return w


def find(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the text, with spans: array of kind, s, e, base, votes, features, ordered by kind and start."""
    into = free("spans", docs.columns)
    rows = stored(propose(docs, text, into).drop(text))
    spans = rows.select(F.explode(into).alias("x"))
    # at most 5 x 3^5 vote patterns times the product of STEPS, whatever the input
    seen = spans.groupBy("x.kind", "x.votes", "x.features").count().collect()
    counts = sorted(((r["kind"], tuple(r["votes"]), tuple(r["features"])), r["count"]) for r in seen)
    votes: dict[tuple[str, tuple[int, ...]], int] = {}
    for (kind, v, _), n in counts:
        votes[kind, v] = votes.get((kind, v), 0) + n
    post, _ = reliabilities(sorted(votes.items()))
    w = span_classifier(counts, post)
    cut, at = math.log(threshold / (1 - threshold)), len(KINDS)

    def score(x: Column) -> Column:
        z = F.element_at(F.lit(w[:at]), x["k"] + 1)
        for j in range(1, len(LABELERS)):
            z = z + F.lit(w[at + j - 1]) * F.get(x["votes"], F.lit(j))
        base = at + len(LABELERS) - 1
        for j, steps in enumerate(STEPS):
            z = z + F.element_at(F.lit([0.0, *w[base : base + steps - 1]]), F.get(x["features"], F.lit(j)) + 1)
            base += steps - 1
        return z

    kept = F.filter(into, lambda x: x["base"] | (score(x) >= cut))
    by = lambda a, b: F.when(a["k"] != b["k"], a["k"] - b["k"]).when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["e"] - b["e"])
    return rows.withColumn(into, F.array_sort(kept, by))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE_KINDS]
    more = F.size("spans").cast("long").alias("n_spans")
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), more)
