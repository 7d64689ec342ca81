"""Licence notices: labels and scores against brute force, on whole, edited, cut and shuffled notices."""

import random
import re

import pytest

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def notice_rows():
    from matchstats.llm.license_scan import NOTICES, TEMPLATES
    rng, rows, whole = random.Random(4), [], {}
    fill = ["la", "une", "oder", "nicht", "sera", "the", "of", "to"]

    def put(ws):
        pad = [rng.choice(fill) for _ in range(rng.randrange(30))]
        rows.append((len(rows), " ".join(pad + list(ws) + pad[::-1])))

    for label, (_, text) in NOTICES.items():
        ws = text.split()
        whole[len(rows)] = label
        put([w.upper() + rng.choice(["", ",", ".", "\n"]) for w in ws])
        for edits in (1, 3, 8):
            e = list(ws)
            for _ in range(edits):
                i = rng.randrange(len(e))
                e[i: i + 1] = rng.choice([[], ["xx"], [e[i], "yy"]])
            put(e)
        put(ws[: len(ws) // 2]), put(ws[len(ws) // 2:]), put(rng.sample(ws, len(ws))), put(ws + ws)
    for ps in TEMPLATES.values():
        put(" gap ".join(ps).split()), put(ps[0].split()[:-1])
    put(("Licensed under CC BY-NC 4.0. " * 400).split())
    return [*rows, (900, None), (901, ""), (902, "   "), (902, "   ")], whole


def brute(text, idf):
    from matchstats.llm import license_scan as L
    w = ALNUM.findall((text or "").lower())

    def stands(p):
        p = p.split()
        return any(w[i: i + len(p)] == p for i in range(len(w) - len(p) + 1))

    labels, score = set(), 0.0
    for label, ps in [*L.TEMPLATES.items(), *((label, [p]) for label, p in L.BASE_PHRASES.items())]:
        weights = [sum(idf[x] for x in p.split()) for p in ps]
        e = sum(v for p, v in zip(ps, weights) if stands(p))
        labels |= {label} if all(map(stands, ps)) else set()
        score = max(score, e / sum(weights) * e / (e + L.HALF))
    for label, (p, t) in L.NOTICES.items():
        t, share = t.split(), 0.0
        total = sum(idf[x] for x in t)
        starts = sorted(i - at for at, x in L.notice_index(idf)[label] for i in range(len(w)) if w[i] == x)
        for i in range(len(starts) - L.AGREEING + 1):
            if starts[i + L.AGREEING - 1] - starts[i] <= L.SLACK:
                s = starts[i + L.AGREEING // 2]
                got = sum(idf[x] for j, x in enumerate(t) if x in w[max(0, s + j - L.SLACK): max(0, s + j + L.SLACK + 1)])
                share = max(share, got / total)
        if share >= L.LEAST_SHARE and stands(p):
            labels.add(label)
        e = share * total
        score = max(score, share * e / (e + L.HALF))
    return ",".join(sorted(labels)), score


@pytest.fixture(scope="module")
def scanned(spark):
    from matchstats.llm.license_scan import NOTICES, phrases, scan_licenses, word_idf
    rows, whole = notice_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    idf = word_idf(df, sorted({w for p in [*phrases(), *(t for _, t in NOTICES.values())] for w in p.split(" ")}))
    return rows, whole, idf, sorted((r.doc_id, r.labels, r.score) for r in scan_licenses(df).collect())


def test_notices_by_brute_force(scanned):
    rows, _, idf, got = scanned
    want = sorted((d, *brute(t, idf)) for d, t in rows)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want))


def test_whole_notices_are_named_and_score_by_length(scanned):
    rows, whole, _, got = scanned
    by_id = {d: (labels, score) for d, labels, score in got}
    assert all(label in by_id[d][0].split(",") and by_id[d][1] > 0.8 for d, label in whole.items())
    scores = {round(s, 6) for _, _, s in got}
    assert len(scores) > 20 and 0 <= min(scores) and max(scores) <= 1
    assert by_id[900] == by_id[901] == by_id[902] == ("", 0.0)


def test_edited_notices_keep_their_label(scanned):
    _, whole, _, got = scanned
    by_id = {d: labels.split(",") for d, labels, _ in got}
    one_edit = [label in by_id[d + 1] for d, label in whole.items()]
    assert sum(one_edit) >= 0.75 * len(one_edit)  # the edit may hit the mandatory phrase
