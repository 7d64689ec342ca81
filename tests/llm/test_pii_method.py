"""The spans that the weak supervision adds: planted forms, look-alikes, rules of the span list."""

import random

import pytest

SCHEMA = "doc_id long, text string, name string, spans string"


def luhn(rng, prefix="4", size=16, good=True):
    d = [int(c) for c in prefix] + [rng.randrange(10) for _ in range(size - 1 - len(prefix))]
    total = sum(c if i % 2 else sum(divmod(2 * c, 10)) for i, c in enumerate(reversed(d)))
    last = -total % 10
    return "".join(map(str, d)) + str(last if good else (last + 5) % 10)


def four(s, sep):
    return sep.join(s[i: i + 4] for i in range(0, 16, 4))


def planted(rng):
    """(kind, text before, span, text after) of personal data in added forms."""
    user, host = rng.choice(["ann.lee", "bo", "kit-77", "max_m"]), rng.choice(["site", "mail2", "post-box"])
    end = rng.choice(["com", "org", "net", "de"])
    n = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    ip = [str(rng.randrange(11, 200)) for _ in range(4)]
    hidden = rng.choice(["[.]", "(.)", "[dot]"])
    value = "".join(rng.choice("0123456789abcdef") for _ in range(32)) + "a1"
    return [("email", "mail ", f"{user}[at]{host}.{end}", " soon"), ("email", "or ", f"{user} (at) {host} (dot) {end}", ""),
            ("email", "write ", f"{user} at {host} dot {end}", ", yes"), ("email", "a ", f"{user} @ {host}.{end}", ""),
            ("ip", "from ", hidden.join(ip), " on"), ("ip", "host ", ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8)), " up"),
            ("card", "paid ", four(luhn(rng), rng.choice([".", "/", " - "])), " ok"),
            ("phone", "so ", f"({n(3)}) {n(3)}-{n(4)}", " now"), ("phone", "and ", f"0044 {n(3)} {n(4)} {n(3)}", " now"),
            ("phone", "call me on ", f"{n(3)}-{n(4)}", " today"),
            ("secret", rng.choice(['token = "', "password: ", "api_key='"]), value, '" end')]


def decoys(rng):
    n = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    value = "".join(rng.choice("0123456789abcdef") for _ in range(38)) + "a1"
    return [f"pages {n(3)}-{n(4)} of it", f"rows {luhn(rng, good=False)} of it", f"rows {four(luhn(rng, good=False), '.')} of it",
            "see you @ home . Then we go", "we met at noon dot then left", f"order {n(6)} and {n(2)}.{n(2)}", f"sha256: {value} ok",
            f"version 4{n(2)}[.]9{n(2)}[.]8{n(2)}[.]7{n(2)} ok", "note: aaaaaaaaaaaaaaaaaaaaaaaa ok", f"in 19{n(2)} or {n(3)} of them"]


def base(rng):
    return [("email", "", f"x{rng.randrange(99)}@site.com", ""), ("ip", "", f"{rng.randrange(11, 99)}.2.3.4", ""),
            ("card", "", luhn(rng), ""), ("phone", "", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", "")]


@pytest.fixture(scope="module")
def cases(spark):
    from matchstats.llm.pii import find_personal_data
    rng, rows, want = random.Random(11), [], {}
    for i in range(300):
        parts = rng.sample(planted(rng), 2) + [d for d in rng.sample(decoys(rng), 3)] + rng.sample(base(rng), 1)
        rng.shuffle(parts)
        text, spans, added = "Ünd so ", set(), set()
        for p in parts:
            if isinstance(p, tuple):
                kind, before, span, after = p
                at = len(text) + len(before)
                (spans if before == "" else added).add((kind, at, at + len(span)))
                text += before + span + after
            else:
                text += p
            text += " .. und\n"
        rows.append((i, text))
        want[i] = spans, added
    rows += [(300, None), (301, ""), (302, "no data " * 50)]
    out = find_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    got = {r.doc_id: {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)} for r in out}
    return dict(rows), want, got, {r.doc_id: r for r in out}


def test_base_spans_stay(cases):
    _, want, got, out = cases
    for i, (spans, _) in want.items():
        assert spans <= got[i]
        assert out[i].n_spans == len(got[i]) and out[i].n_secret == sum(k == "secret" for k, *_ in got[i])
    assert got[300] == got[301] == got[302] == set()


def test_added_spans_are_found(cases):
    rows, want, got, _ = cases
    true = {(i, *s) for i, (_, added) in want.items() for s in added}
    found = {(i, *s) for i, spans in got.items() for s in spans - want.get(i, (set(), 0))[0]}
    missed, wrong = sorted(true - found), sorted(found - true)
    show = [(k, rows[i][a: b]) for i, k, a, b in missed[:15]], [(k, rows[i][max(0, a - 12): b + 5]) for i, k, a, b in wrong[:15]]
    assert len(true & found) >= 0.9 * len(true), show
    assert len(true & found) >= 0.9 * len(found), show


def test_added_spans_touch_no_base_span(cases):
    _, want, got, _ = cases
    for i, (spans, _) in want.items():
        more = got[i] - spans
        assert not any(a < y and x < b for _, a, b in more for _, x, y in spans)
        assert not any((a, b) != (x, y) and x <= a and b <= y for _, a, b in more for _, x, y in more)


def test_overlaps_by_brute_force(spark):
    from matchstats.llm.pii import ALL_KINDS, accepted
    rng, rows = random.Random(2), []
    for i in range(300):
        a = rng.randrange(60)
        rows.append((i % 6, 0, rng.choice(ALL_KINDS), a, a + rng.randrange(1, 9), rng.random() < 0.2, rng.random(), 1 if rng.random() < 0.8 else 0))
    df = spark.createDataFrame(rows, "doc_id long, tkey long, kind string, start long, end long, is_base boolean, p double, check int")
    got = {(r.doc_id, r.kind, r.start, r.end, r.is_base) for r in accepted(df).collect()}
    want = set()
    for d in range(6):
        mine = {}
        for x, _, k, a, b, base_span, p, fine in rows:
            if x == d and (base_span or (p >= 0.5 and fine)):
                mine[k, a, b] = mine.get((k, a, b), False) or base_span
        base_spans = {s for s, yes in mine.items() if yes}
        free = [s for s, yes in mine.items() if not yes and not any(s[1] < y and x < s[2] for _, x, y in base_spans)]
        first = sorted(free, key=lambda s: (s[1], -s[2], ALL_KINDS.index(s[0])))
        kept = [s for j, s in enumerate(first) if not any(t[1] <= s[1] and t[2] >= s[2] for t in first[:j])]
        want |= {(d, *s, True) for s in base_spans} | {(d, *s, False) for s in kept}
    assert got == want


def test_table_for_the_driver_is_bounded():
    from matchstats.llm.pii import FEATURES, LABELERS, MODEL_ROWS, PATTERNS
    assert MODEL_ROWS == len(PATTERNS) * FEATURES["size"] * FEATURES["digits"] * 3 ** len(LABELERS) < 50_000
