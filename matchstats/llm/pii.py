"""Personal data by weak supervision (operator 5), DataFrame functions only.

Patterns propose spans: the four base patterns, whose matches that fail their
check stay proposals, and wider ones (mail addresses written out or spaced,
addresses with their dots hidden or of version 6, cards in other groups,
national, short and 00 phone forms, values assigned to a name).  Labelers vote
on each span, for, against, or not at all: its own check (digits, check sums,
variety), lists of known prefixes, endings and names (gazetteer), the words
before it (context) and what it touches (edges).  Spans with equal pattern,
votes and features are one row of a small table; on it expectation-maximisation
estimates every labeler's reliability by kind and every pattern's share of
right spans.  A logistic classifier is then trained on those probabilities,
over the span's pattern, size and share of digits beside its check, list and
context votes; every pattern weighs the same in it, however rare.  A span that
fails its own check is wrong by definition: it teaches the rates on wrong spans.  Base spans that
pass their check always stay; of the others, those stay that the classifier
accepts, that overlap no base span and lie within no longer span that stays.

Defined results: null and empty texts have no span; repeated rows get the same
result each; equal starts are ordered by kind; an empty table gives an empty
result and an untrained model; extra columns are ignored.  Patterns take each
character a bounded number of times (possessive loops, starts only where a run
begins), so long texts stay linear.  Only spans are shuffled, never texts; the
model sees at most ``MODEL_ROWS`` rows, whatever the corpus.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.common import text_key, written

#: Kinds in their order; fixed by the result's definition.  Added kinds follow.
KINDS = ["email", "ip", "card", "phone"]
ALL_KINDS = [*KINDS, "secret"]

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_DOT = r"(?:\.|\[\.\]|\(\.\)|\[dot\]|\(dot\))"
_APART = r"(?:[._/]|--| - |  )"
_SECRET = "[A-Za-z0-9+/_-]"
#: Candidates: name -> (kind, pattern, what a text must hold for a match).
#: ``\\G`` lets a match start where the last one ended inside a run.
PATTERNS = {
    "email": ("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@"),
    "ip": ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "digit"),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++", "digit"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "digit"),
    "email_written": ("email", rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\[at\]|\(at\)) ?{_LABEL}++(?: ?(?:\.|\[dot\]|\(dot\)) ?{_LABEL}++)++", "(at)"),
    "email_words": ("email", rf"(?<!{_LOCAL}){_LOCAL}++ at {_LABEL}++(?: dot {_LABEL}++)++", "dot"),
    "email_spaced": ("email", rf"(?<!{_LOCAL}){_LOCAL}++ ?@ ?{_LABEL}++(?: ?\. ?{_LABEL}++)++", "@"),
    "ip_hidden": ("ip", rf"(?<![0-9])[0-9]{{1,3}}+(?:{_DOT}[0-9]{{1,3}}+){{3}}(?![0-9])", "(.)"),
    "ip_long": ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", "assign"),
    "card_apart": ("card", rf"(?<![0-9])[0-9]{{4}}(?:{_APART}[0-9]{{4}}){{3}}(?![0-9])", "digit"),
    "phone_national": ("phone", r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])", "digit"),
    "phone_00": ("phone", r"(?<![0-9+.-])00[1-9][0-9]{0,2}(?:[ .-][0-9]{2,5}){2,4}(?![0-9.-])", "digit"),
    "phone_short": ("phone", r"(?<![0-9+.-])[0-9]{3}-[0-9]{4}(?![0-9.-])", "digit"),
    "assigned": ("secret", rf"(?<!{_SECRET})(?={_SECRET}{{16}})(?<=[:=] ?[\"']?){_SECRET}++", "assign"),
}
BASE = list(KINDS)

#: Gazetteers (plain values).
MAIL_ENDINGS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "us", "ca", "it", "nl"]
CALLING_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
                 "48", "49", "51", "52", "54", "55", "61", "64", "65", "81", "82", "86", "90", "91"]
CARD_PREFIXES = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
RESERVED_IP = r"^(?:0|10|127|22[4-9]|2[3-5][0-9])\."
#: Names whose assigned value is secret, before the sign and an opening quote.
SECRET_NAMES = r"(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer)[\"']? ?[:=] ?[\"']?$"
#: Words before a span that speak for and against each kind.
FOR = {"email": "mail|contact|write|reach", "ip": r"\bip\b|address|host|server|client",
       "card": "card|visa|master|amex|credit|pay", "phone": "phone|tel|call|mobile|fax|contact|number", "secret": "config|login|credential|export|header|auth|token|key"}
AGAINST = {"email": "example|regex", "ip": r"version|\bv$|release|section", "card": r"isbn|order|serial|\bid\b|part",
           "phone": r"isbn|serial|\bid\b|version|date", "secret": "sha|digest|checksum|hash|commit|example"}
#: Patterns too plain to be right without a word for them.
NEEDS_CONTEXT = ["phone_short"]
CONTEXT_CHARS = 40
LABELERS = ["check", "gazetteer", "context", "edges"]
#: Where estimation starts: a labeler's rates of voting 1 on right and on wrong
#: spans, and how many spans this counts for.
START = {"check": (0.95, 0.1), "gazetteer": (0.85, 0.4), "context": (0.7, 0.3), "edges": (0.9, 0.6)}
START_ROWS = 10
#: Features of the classifier and how many values each can take; with the
#: votes they bound the table that reaches the driver.
FEATURES = {"name": len(PATTERNS), "size": 7, "digits": 4, "check": 3, "gazetteer": 3, "context": 3}
MODEL_ROWS = len(PATTERNS) * 7 * 4 * 3 ** len(LABELERS)

EM_ROUNDS = 50
CLASSIFIER_ROUNDS = 400
ACCEPT = 0.5


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def step(total, i):
        v = F.ascii(F.substring(d, F.length(d) - i, F.lit(1))) - 48
        return total + F.when(i % 2 == 0, v).otherwise(F.when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), step) % 10 == 0


def _octets(c: Column) -> Column:
    def small(p):
        rest = F.regexp_replace(p, "^0+", "")
        return (F.length(rest) <= 3) & (F.when((rest == "") | (F.length(rest) > 3), F.lit(0)).otherwise(
            rest.cast("int")) <= 255)
    return F.forall(F.split(c, r"\."), small)


def base_check(name: Column, found: Column) -> Column:
    """Whether a match of a base pattern counts."""
    d = _digits(found)
    return (F.when(name == "email", True).when(name == "ip", _octets(found))
            .when(name == "card", F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))
            .when(name == "phone", F.length(d).between(10, 15)).otherwise(False))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, name, kind, start, end, found, before, after: a row per
    match, one set of them per distinct (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digit = text.rlike("[0-9]")

    def holds(*parts):
        found = F.lit(False)
        for p in parts:
            found = found | F.contains(text, F.lit(p))
        return found

    has = {"digit": digit, "@": holds("@"), "(at)": holds("at)", "at]"), "dot": holds(" dot "),
           "(.)": digit & holds("[.]", "(.)", "[dot]", "(dot)"), "assign": digit & holds(":", "=")}
    keyed = docs.select("doc_id", text_key(), text.alias("text"),
                        *[c.alias(f"has_{i}") for i, c in enumerate(has.values())])
    flags = {k: F.col(f"has_{i}") for i, k in enumerate(has)}
    per_name = []
    for name, (kind, pattern, needs) in PATTERNS.items():
        p = F.lit(pattern)
        found = F.when(flags[needs], F.regexp_extract_all("text", p, F.lit(0))).otherwise(F.array().cast("array<string>"))
        per_name.append(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), found.alias("found"),
                                 F.lit(pattern).alias("pattern")))
    matched = keyed.select("doc_id", "tkey", "text", F.explode(F.array(*per_name)).alias("m")).filter(
        F.size("m.found") > 0)
    # texts between the matches: their lengths place the matches
    gaps = F.split(F.col("text"), F.col("m.pattern"), F.lit(-1))
    rows = matched.withColumn("gaps", gaps).select(
        "doc_id", "tkey", "m.name", "m.kind",
        F.posexplode(F.transform(F.col("m.found"), lambda x, i: F.struct(
            x.alias("found"), F.length(F.get("gaps", i)).cast("long").alias("gap"),
            F.substring(F.get("gaps", i), F.greatest(F.length(F.get("gaps", i)) - F.lit(CONTEXT_CHARS - 1), F.lit(1)),
                        F.lit(CONTEXT_CHARS)).alias("before"),
            F.substring(F.get("gaps", i + 1), 1, 1).alias("after")))).alias("i", "f"))
    rows = rows.select("doc_id", "tkey", "name", "kind", "i", "f.found", "f.gap", "f.before", "f.after").dropDuplicates(
        ["doc_id", "tkey", "name", "i"])
    w = Window.partitionBy("doc_id", "tkey", "name").orderBy("i")
    end = F.sum(F.col("gap") + F.length("found")).over(w)
    return rows.withColumn("end", end).select(
        "doc_id", "tkey", "name", "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found", "before", "after")


def voted(spans: DataFrame) -> DataFrame:
    """Adds is_base, the labelers' votes (1, 0, or -1 for none) and features."""
    name, kind, found = F.col("name"), F.col("kind"), F.col("found")
    d = _digits(found)
    base = F.coalesce(base_check(name, found), F.lit(False))
    varied = found.rlike("[0-9]") & found.rlike("[A-Za-z]") & (F.array_size(F.array_distinct(F.split(found, ""))) >= 8)
    plain = F.regexp_replace(found, _DOT, ".")
    shaped = (F.when(name.isin(BASE), base.cast("int"))
              .when(name.isin(["email_written", "email_words", "email_spaced", "ip_long"]), 1)
              .when(name == "ip_hidden", _octets(plain).cast("int"))
              .when(name == "card_apart", _luhn(d).cast("int"))
              .when(name == "phone_national", (F.length(d) == 10).cast("int"))
              .when(name == "phone_00", F.length(d).between(10, 15).cast("int"))
              .when(name == "assigned", varied.cast("int")).otherwise(-1))
    ending = F.lower(F.regexp_extract(found, r"([A-Za-z]+)$", 1)).isin(MAIL_ENDINGS)
    code = F.lit(False)
    for c in CALLING_CODES:
        code = code | F.startswith(found, F.lit(f"+{c}")) | F.startswith(found, F.lit(f"00{c}"))
    before = F.lower(F.regexp_extract("before", r"[^\n]*\z", 0))  # of the span's own line
    known = (F.when(kind == "email", ending.cast("int")).when(name == "ip_long", -1)
             .when(kind == "ip", (~plain.rlike(RESERVED_IP)).cast("int"))
             .when(kind == "card", (d.rlike(CARD_PREFIXES) & F.length(d).between(13, 19)).cast("int"))
             .when(kind == "secret", before.rlike(SECRET_NAMES).cast("int"))
             .when(name.isin(["phone_national", "phone_short"]), -1).otherwise(code.cast("int")))
    says = F.lit(-1)
    for k in ALL_KINDS:
        says = F.when((kind == k) & before.rlike(AGAINST[k]), 0).when((kind == k) & before.rlike(FOR[k]), 1).otherwise(says)
    says = F.when(name.isin(NEEDS_CONTEXT) & (says == -1), 0).otherwise(says)
    # part of a longer word, number or path
    glued = before.rlike(r"[\p{L}0-9_/#.-]$") | F.coalesce(F.col("after"), F.lit("")).rlike(r"[\p{L}0-9_/#-]")
    digits = F.floor(F.lit(4) * F.length(d) / F.length(found)).cast("int")
    return spans.select(
        "*", base.alias("is_base"), shaped.cast("int").alias("check"), known.cast("int").alias("gazetteer"),
        says.cast("int").alias("context"), (~glued).cast("int").alias("edges"),
        F.least(F.floor(F.length(found) / 6), F.lit(6)).cast("int").alias("size"),
        F.least(digits, F.lit(3)).alias("digits"))


def reliabilities(counts: list[dict]) -> tuple[dict, dict]:
    """EM over rows (name, kind, votes, n).  Returns P(span is right | name,
    votes), and by kind each labeler's rates of voting 1 on right and on wrong
    spans, with every pattern's prior.  A row without a name is its kind's."""
    post, model = {}, {}
    labelers = [x for x in LABELERS if all(x in r for r in counts)]
    for kind in ALL_KINDS:
        merged: dict[tuple, int] = {}
        for r in counts:
            if r["kind"] == kind:
                key = r.get("name", kind), tuple(r[x] for x in labelers)
                merged[key] = merged.get(key, 0) + r["n"]
        prior = dict.fromkeys({name for name, _ in merged}, 0.5)
        start = [[START[x][side] for x in labelers] for side in (0, 1)]
        right, wrong = [list(x) for x in start]

        def probability(key, prior=prior, right=right, wrong=wrong):
            if key[1][0] == 0:  # fails its check: known to be wrong
                return 0.0
            a, b = math.log(prior[key[0]]), math.log(1 - prior[key[0]])
            for x, p, q in zip(key[1], right, wrong):
                if x >= 0:
                    a += math.log(p if x else 1 - p)
                    b += math.log(q if x else 1 - q)
            return 1 / (1 + math.exp(max(-700, min(700, b - a))))

        for _ in range(EM_ROUNDS if merged else 0):
            p = {key: probability(key) for key in merged}
            for name in prior:
                mine = [(p[key], n) for key, n in merged.items() if key[0] == name]
                prior[name] = min(0.99, max(0.01, (1 + sum(x * n for x, n in mine)) / (2 + sum(n for _, n in mine))))
            for j in range(len(labelers)):
                for rates, first, weight in ((right, start[0], p), (wrong, start[1], {key: 1 - x for key, x in p.items()})):
                    yes = START_ROWS * first[j] + sum(weight[key] * n for key, n in merged.items() if key[1][j] == 1)
                    no = START_ROWS * (1 - first[j]) + sum(weight[key] * n for key, n in merged.items() if key[1][j] == 0)
                    rates[j] = yes / (yes + no)
        model[kind] = (prior, right, wrong)
        for name in prior:
            for v in product((-1, 0, 1), repeat=len(labelers)):
                post[name, v] = probability((name, v))
    return post, model


def train_classifier(counts: list[dict], post: dict) -> dict[tuple, float]:
    """Logistic weights by gradient descent over rows of equal features;
    targets are the labelers' joint probabilities, and every pattern's rows
    weigh 1 together."""
    rows: dict[tuple, list[float]] = {}
    totals: dict[str, int] = {}
    for r in counts:
        got = rows.setdefault(tuple(r[f] for f in FEATURES), [0.0, 0.0])
        got[0] += r["n"]
        got[1] += r["n"] * post[r["name"], tuple(r[x] for x in LABELERS)]
        totals[r["name"]] = totals.get(r["name"], 0) + r["n"]
    table = [([("1",), *zip(FEATURES, key), *[("name", f, key[0], v) for f, v in zip(FEATURES, key) if f in LABELERS]],
              n / totals[key[0]] / len(totals), right / n) for key, (n, right) in sorted(rows.items())]
    weights: dict[tuple, float] = {}
    for _ in range(CLASSIFIER_ROUNDS if table else 0):
        slope: dict[tuple, float] = {}
        for names, share, target in table:
            z = sum(weights.get(x, 0.0) for x in names)
            g = (1 / (1 + math.exp(-max(-30, min(30, z)))) - target) * share
            for x in names:
                slope[x] = slope.get(x, 0.0) + g
        for x, g in slope.items():
            weights[x] = weights.get(x, 0.0) * 0.9999 - 4.0 * g
    return weights


def probability_column(weights: dict[tuple, float]) -> Column:
    z = F.lit(weights.get(("1",), 0.0))
    for key, w in weights.items():
        if len(key) == 2:
            z = z + F.when(F.col(key[0]) == key[1], F.lit(w)).otherwise(0.0)
        elif len(key) == 4:
            z = z + F.when((F.col(key[0]) == key[2]) & (F.col(key[1]) == key[3]), F.lit(w)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def accepted(scored: DataFrame) -> DataFrame:
    """doc_id, tkey, kind, o, start, end, is_base: base spans, and the other
    spans of the classifier that touch none of them and lie in no longer one.
    Running bounds in the order of the spans, so that a text with many spans
    stays linear."""
    order = F.array_position(F.array(*[F.lit(k) for k in ALL_KINDS]), F.col("kind")).cast("int")
    spans = scored.filter(F.col("is_base") | ((F.col("p") >= ACCEPT) & (F.col("check") != 0))).groupBy(
        "doc_id", "tkey", "kind", "start", "end").agg(F.max("is_base").alias("is_base"))
    spans = spans.select("*", order.alias("o"))
    by_start = Window.partitionBy("doc_id", "tkey").orderBy("start", F.col("end").desc(), "o")
    earlier = by_start.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("doc_id", "tkey").orderBy(F.col("start").desc(), F.col("end"), F.col("o").desc()).rowsBetween(
        Window.unboundedPreceding, -1)  # the same order, backwards
    base_end, base_start = (F.when(F.col("is_base"), F.col(c)) for c in ("end", "start"))
    touched = (F.coalesce(F.max(base_end).over(earlier) > F.col("start"), F.lit(False))
               | F.coalesce(F.min(base_start).over(later) < F.col("end"), F.lit(False)))
    free = spans.withColumn("touched", touched).filter(F.col("is_base") | ~F.col("touched"))
    within = F.coalesce(F.max(F.when(~F.col("is_base"), F.col("end"))).over(earlier) >= F.col("end"), F.lit(False))
    return free.withColumn("within", within).filter(F.col("is_base") | ~F.col("within")).drop("touched", "within")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans, n_secret, n_spans and tkey
    of every row."""
    marked = written(voted(candidates(docs)), "pii-spans")
    groups = ["name", "kind", *LABELERS, "size", "digits"]
    counts = [r.asDict() for r in marked.groupBy(*groups).agg(F.count("*").alias("n")).collect()]  # at most MODEL_ROWS
    post, _model = reliabilities(counts)
    scored = marked.withColumn("p", probability_column(train_classifier(counts, post)))
    span = F.struct("start", "o", "end", "kind", "is_base")
    per_doc = accepted(scored).groupBy("doc_id", "tkey").agg(F.array_sort(F.collect_list(span)).alias("spans"))

    def joined(a: Column) -> Column:
        return F.concat_ws(",", F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                     x["end"].cast("string"))))

    def number(which) -> Column:
        return F.array_size(F.filter("spans", which)).cast("long")

    def of(kind: str):
        return lambda x: (x["kind"] == kind) & x["is_base"]

    counted = {f"n_{k}": number(of(k)) for k in KINDS}
    counted |= {"n_secret": number(lambda x: x["kind"] == "secret"), "n_spans": F.array_size("spans").cast("long")}
    named = per_doc.select(
        F.col("doc_id").alias("d"), F.col("tkey").alias("t"), *[c.alias(f"c_{n}") for n, c in counted.items()],
        F.sha2(joined(F.filter("spans", lambda x: x["is_base"])), 256).alias("sha"), joined(F.col("spans")).alias("all"))
    rows = docs.select("doc_id", text_key())
    same = rows["doc_id"].eqNullSafe(named["d"]) & (rows["tkey"] == named["t"])
    none = F.sha2(F.lit(""), 256)
    numbers = [F.coalesce(f"c_{n}", F.lit(0).cast("long")).alias(n) for n in counted]
    return rows.join(named, same, "left").select(
        "doc_id", *numbers[:4], F.coalesce("sha", none).alias("base_sha256"), F.coalesce("all", F.lit("")).alias("spans"),
        *numbers[4:], "tkey")
