"""Operators against brute force on small tables: nulls, empty and long texts,
ties, repeated rows, clashing column names, empty tables."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, digest string, key int"


def low(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or "")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    ws = rng.choice(["stone", "river", "Light", "été", "water", "garden", "of", "the", "and", "mit", "number", "größe"], n)
    return " ".join(f"{w}{rng.integers(40)}" if rng.random() < 0.6 else w for w in ws)


def sample_rows():
    base, other = prose(1, 120), prose(2, 90)
    near = base.split(" ")
    near[60] = "changed"
    line = "this very line stands in many of the documents here"
    texts = [None, "", " \n\t ", "one", "one two", base, base, base.upper(), " ".join(near), other,
             f"{other}\n{line}\nshort line\n{line}", f"{prose(3, 70)}\n{line}", f"{prose(4, 70)}\n{line}s\n{line[:-1]}X",
             "Released under the MIT License. Apache License, Version 2.0 / cc by-nc CC BY NC",
             "mail a.b@c.de x@y.z%q@r.st 1.2.3.4 1.2.3.256 4111 1111 1111 1111 4111111111111112 +1 (555) 010-9999 +12",
             "x " * 3000 + "<|endoftext|> <s> end", prose(5, 2500), "K " + prose(6, 60),
             "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 W13 w14 tail " + prose(7, 30), "short ITEM here and more words",
             "a b c " * 60]
    rows = [(i, t, "en" if i % 3 else None, "s", None if t is None else len(t), "x", "y", 1) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, other, "de", "s", 1, "x", "y", 2), (None, None, "de", "s", 1, "x", "y", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(df, by=("doc_id",)):
    return df.toPandas().sort_values(list(by), na_position="first", kind="stable").reset_index(drop=True)


def rows_of(df, columns):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in df[columns].itertuples(index=False)), key=str)


def check(df, columns, one):
    """Rows equal what ``one`` gives for each document's text."""
    want = sorted(((r[0], *one(r[1])) for r in sample_rows()), key=str)
    assert rows_of(df.toPandas(), ["doc_id", *columns]) == want


def test_licenses(docs, none):
    from matchstats.llm.license_scan import BASE_PHRASES, scan_licenses

    def one(x):
        w = ALNUM.findall(low(x))
        at = [(i, label) for label, p in BASE_PHRASES.items() for i in range(len(w)) if w[i: i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        return (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in at})))

    out = scan_licenses(docs)
    check(out, ["n_words", "n_base", "first_word", "last_word", "base_labels"], one)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
               for r in out.collect())
    assert scan_licenses(none).count() == 0


def test_token_counts_and_cache(spark, docs, none, scratch):
    import sentencepiece
    from matchstats.llm.token_counts import count_tokens
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = count_tokens(docs, path, f"{scratch}/cache", limit=1000)
    check(out, ["n_bytes", "n_tokens", "over_limit"], lambda x: (
        len((x or "").encode()), len(sp.encode(x or "")), len(sp.encode(x or "")) > 1000))
    stored = spark.read.parquet(f"{scratch}/cache").count()
    assert stored == len({r[1] or "" for r in sample_rows()})
    count_tokens(docs, path, f"{scratch}/cache")
    assert spark.read.parquet(f"{scratch}/cache").count() == stored  # a second run encodes nothing
    assert count_tokens(none, path).count() == 0


def test_packing_round_trip(docs, none):
    from matchstats.llm.packing import pack
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = pack(docs, path).toPandas()
    ids = [(r[0], np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")) for r in sample_rows()]
    assert got.length.sum() == sum(len(x) for _, x in ids) and got.length.min() > 0
    by = {}
    for d, x in ids:
        by.setdefault((d, len(x)), []).append(x)
    for r in got.itertuples():
        d = None if pd.isna(r.doc_id) else int(r.doc_id)
        x = by[d, r.doc_tokens][0]
        assert zlib.crc32(x[r.start: r.start + r.length].tobytes()) == r.ids_crc32
    q = got.sort_values(["sequence_id", "offset"])
    assert (q.offset == q.groupby("sequence_id").length.cumsum() - q.length).all()
    total = got.groupby("sequence_id").length.sum()
    assert total.max() <= 1024 and sum(1024 - n for n in total if n & (n - 1)) == 0
    assert pack(none, path).count() == 0


def test_packer_without_long_documents():
    from matchstats.llm.packing import HarmonicPacker
    rng, p, n = np.random.default_rng(0), HarmonicPacker(first_sequence=5), 0
    for i in range(3000):
        size = int(rng.integers(1, 1025))
        n += size
        p.add(i, np.arange(size, dtype=np.uint32))
    p.finish()
    got = pd.DataFrame(p.rows, columns=["d", "start", "length", "crc", "tokens", "seq", "offset"])
    total = got.groupby("seq").length.sum()
    assert got.length.sum() == n and total.max() <= 1024
    assert all(t == 1024 or t & (t - 1) == 0 for t in total)
    whole = got.groupby("d").length.agg(["sum", "count"])
    assert (whole["count"] == 1).mean() > 0.5  # most documents stay whole


def test_personal_data(docs, none):
    from matchstats.llm.pii import find_personal_data
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
                "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else True,
                "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]

    def one(x):
        at = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(patterns.items())
                    for m in re.finditer(p, x or "") if good(k, m[0]))
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in at)
        return (*(sum(s[3] == k for s in at) for k in patterns), hashlib.sha256(joined.encode()).hexdigest())

    out = find_personal_data(docs)
    check(out, ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"], one)
    assert find_personal_data(none).count() == 0


def test_em_tells_reliable_labelers():
    from matchstats.llm.pii import reliabilities
    counts = [{"kind": "phone", "check": c, "gazetteer": g, "context": x, "n": n}
              for c, g, x, n in [(1, 1, 1, 80), (1, 1, -1, 200), (1, 0, -1, 5), (0, 0, 0, 60), (0, 0, -1, 90), (0, 1, -1, 20)]]
    post, model = reliabilities(counts)
    assert post["phone", (1, 1, 1)] > 0.95 and post["phone", (0, 0, 0)] < 0.05
    assert model["phone"][1][0] > 0.9 > 0.1 > model["phone"][2][0]


def edit_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def test_line_dedup(spark, docs, none):
    from matchstats.llm.line_dedup import dedup_lines
    lines = ["a quick test of the line join", "a quick test of the line joins", "a quick tesX of the line join",
             "quick test of the line join", "a quick test öf the line join", "an other line of many words here"]
    rng = np.random.default_rng(3)
    texts = ["\n".join(rng.choice(lines, 4)) + "\nfew words" for _ in range(12)] + ["", None, lines[5] + " ", "\n\n" + lines[5]]
    rows = [(i, t) for i, t in enumerate(texts)]
    seen, want = [], {}
    for i, t in rows:
        out, n, gone = [], 0, 0
        for s in (t or "").split("\n"):
            body = s.strip(" \t\n\x0b\x0c\r")
            if len(SPACE.findall(body)) >= 5:
                n += 1
                again = any(body == x or edit_one(body, x) for x in seen)
                seen.append(body)
                gone += again
                if again:
                    continue
            out.append(s)
        want[i] = (None if t is None else "\n".join(out), n, gone)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == want
    assert dedup_lines(docs).count() == len(sample_rows()) and dedup_lines(none).count() == 0


def test_line_dedup_bound_grows(spark):
    """Lines of 10, 19 to 23, 39 to 42 and 70 words with words put in, left out, replaced and moved."""
    from matchstats.llm.line_dedup import dedup_lines

    def within(a, b):
        a, b = sorted((a.split(), b.split()), key=len)
        bound = (len(a) >= 20) + (len(a) >= 40)
        if len(a) == len(b):
            return bound > 0 and sum(u != v for u, v in zip(a, b)) <= bound
        return bound > 0 and len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    rng, texts = np.random.default_rng(23), []
    vocabulary = [f"word{i}" for i in range(500)]
    for n in (10, 19, 20, 21, 22, 39, 40, 41, 70):
        root = list(rng.choice(vocabulary, n))
        for _ in range(25):
            words = list(root)
            for _ in range(int(rng.integers(0, 4))):
                i, act = int(rng.integers(len(words))), rng.integers(6)
                if act < 4:
                    words[i] = rng.choice(vocabulary)
                elif act == 4:
                    words.insert(i, rng.choice(vocabulary))
                else:
                    del words[i]
            texts.append(" ".join(words))
    rng.shuffle(texts)
    long = " ".join(rng.choice(vocabulary, 60))
    texts += [long, long.replace(" ", "x ", 1)[:-1] + "X", long.replace("word", "w\u00f6rd", 2)]  # letters in two words
    seen, want = [], {}
    for i, t in enumerate(texts):
        want[i] = int(any(t == x or edit_one(t, x) or within(t, x) for x in seen))
        seen.append(t)
    assert [want[len(texts) - k] for k in (3, 2, 1)] == [0, 1, 1]
    got = dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.n_dropped for r in got} == want


def test_line_dedup_one_character(spark):
    """Any character of lines round the word bounds replaced, put in or left out, spaces and letters."""
    from matchstats.llm.line_dedup import dedup_lines
    rng, texts = np.random.default_rng(29), []
    for n in (5, 18, 19, 20, 21, 22, 40, 45):
        for _ in range(3):
            root = " ".join("".join(rng.choice(list("abcde"), int(rng.integers(1, 5)))) for _ in range(n))
            texts.append(root)
            for i in rng.choice(np.arange(1, len(root) - 1), 8, replace=False):
                texts += [root[:i] + c + root[i + k:] for c in " xa\t" for k in (0, 1)] + [root[:i] + root[i + 1:]]
    order = rng.permutation(len(texts))
    seen, sure, got = [], {}, {}
    for d, i in enumerate(order):
        words = len(SPACE.findall(texts[i]))
        sure[d] = words >= 5 and any(texts[i] == x or edit_one(texts[i], x) for x in seen)
        seen += [texts[i]] if words >= 5 else []
    rows = [(d, texts[i]) for d, i in enumerate(order)]
    got = {r.doc_id: r.n_dropped for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[d] == 1 for d, s in sure.items() if s)  # every one-character copy goes, whatever finds it
    assert all(got[d] == s for d, s in sure.items() if len(SPACE.findall(rows[d][1])) < 20)


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80)])
def test_ngram_components(spark, docs, none, n, num):
    from matchstats.llm.ngram_join import ngram_components
    rng, rows = np.random.default_rng(n), [(r[0], r[1]) for r in sample_rows()]
    vocabulary = [f"v{i}" for i in range(400)]
    root = list(rng.choice(vocabulary, 200))
    for i in range(60):  # near copies round the limit, and chains of them
        words = list(root)
        for k in rng.choice(200, int(rng.integers(0, 6)), replace=False):
            words[k] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(words)))
        if i % 9 == 8:
            root = words
    sets = []
    for _, t in rows:
        w = SPACE.findall(low(t))
        sets.append(frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = up[i], up[j]
                up = [b if x == a else x for x in up]
    want = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if up[j] == up[i] and rows[j][0] is not None]
        want.append((d, len(sets[i]), min(ids, default=None) if sets[i] else d))
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n, num, 100).toPandas()
    assert rows_of(got, ["doc_id", "n_shingles", "component_id"]) == sorted(want, key=str)
    if n == 3:
        assert ngram_components(none, n, num, 100).count() == 0


def test_decontamination(spark, docs, none):
    from matchstats.llm.decontam import decontaminate
    long_item = " ".join(prose(5, 2500).split(" ")[500:560])
    items = [(1, long_item), (2, "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (10, "short item, here"), (3, None), (4, ""),
             (5, long_item + " and more"), (6, "x " * 13)]
    windows = {}
    for i, t in items:
        w = ALNUM.findall(low(t))
        for k in ([tuple(w)] if 0 < len(w) < 13 else [tuple(w[j: j + 13]) for j in range(len(w) - 12)]):
            windows.setdefault(k, set()).add(i)

    def one(x):
        w, hit, ids = ALNUM.findall(low(x)), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j: j + n]) in windows:
                    hit |= set(range(j, j + n))
                    ids |= windows[tuple(w[j: j + n])]
        joined = ",".join(sorted(map(str, ids)))
        return (len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))

    bench = spark.createDataFrame(items, "item_id long, text string")
    check(decontaminate(docs, bench), ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"], one)
    assert decontaminate(none, bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_quality(docs, none):
    from matchstats.llm.quality import quality_rules

    def one(x):
        w = SPACE.findall(x or "")
        t = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
        twice = {k for k in t if t.count(k) > 1} if len(t) < 3000 else {k for k, c in pd.Series(t).value_counts().items() if c > 1}
        inside = {j for i, k in enumerate(t) if k in twice for j in (i, i + 1, i + 2)}
        full = [s for s in (x or "").split("\n") if SPACE.search(s)]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x or ""), len(full) - len(set(full)), len(inside),
                len(w) < 50 or 100 * len(inside) > 50 * len(w))

    out = quality_rules(docs, public_tokenizers.path("piece_bpe_32k.model"))
    check(out, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], one)
    assert out.filter("base_failed and kept").count() == 0 and out.filter("kept").count() > 0
    assert quality_rules(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def brute_bands(rows):
    """Centre and deviation of each (lang, size, measure); rows: lang, size and the measures."""
    from matchstats.llm.quality import LEAST_SPREAD, NEAR, PRIOR_ROWS as K, RATES
    out = {}
    for c in RATES:
        def at(part):
            a, b, d = np.percentile(part[c].round(3), [25, 50, 75])
            return len(part), b, (d - a) / 1.349
        alone = {s: at(p) for s, p in rows.groupby("size")}
        every = {}
        for s, (n, *v) in alone.items():
            w = {z: alone[z][0] * NEAR ** abs(z - s) for z in alone if z != s} or {s: n}
            every[s] = [(n * v[i] + K * sum(w[z] * alone[z][i + 1] for z in w) / sum(w.values())) / (n + K) for i in (0, 1)]
        langs = {g: {s: at(q) for s, q in p.groupby("size")} for g, p in rows.groupby("lang")}
        n_lang = {g: sum(v[0] for v in p.values()) for g, p in langs.items()}
        total = {g: sum(n * (m - every[s][0]) for s, (n, m, _) in p.items()) for g, p in langs.items()}
        known = {g: n / (n + K) for g, n in n_lang.items()}
        between = sum(known[g] * (total[g] / n_lang[g]) ** 2 for g in langs) / sum(known.values())
        for g, p in langs.items():
            for s, (n, m, d) in p.items():
                w = {z: p[z][0] * NEAR ** abs(z - s) for z in p if z != s}
                offset = (sum(w[z] * (p[z][1] - every[z][0]) for z in w) + K * total[g] / (n_lang[g] + K)) / (sum(w.values()) + K)
                spread = (sum(w[z] * p[z][2] for z in w) + K * every[s][1]) / (sum(w.values()) + K)
                share = K / (n + K) * K / (sum(w.values()) + K) * K / (n_lang[g] + K)
                spread = max((n * d + K * spread) / (n + K), LEAST_SPREAD[c])
                out[g, s, c] = ((n * m + K * (every[s][0] + offset)) / (n + K), (spread**2 + between * share**2) ** 0.5)
    return out


def measured_rows():
    """Regular rows of two languages, a rare language and a rare length, each with an odd row."""
    rng, rows = np.random.default_rng(11), []

    def put(lang, n_tokens, chars, entropy):
        rows.append((len(rows), lang, 200, 0, n_tokens, chars + rng.normal(0, 0.02), abs(rng.normal(0.005, 0.002)), entropy + rng.normal(0, 0.05)))

    for i in range(300):
        put("en" if i % 3 else "de", int(rng.integers(128, 1024)), 3.0 if i % 3 else 2.8, 6.5)
    for _ in range(7):
        put(None, 300, 2.9, 6.5)
        put("en", 5000, 3.0, 6.6)
    odd = [len(rows) + i for i in range(4)]
    put("en", 300, 1.0, 6.5), put(None, 300, 0.5, 6.5), put("en", 5000, 1.5, 6.5), put("de", 90000, 2.8, 2.0)
    return rows, odd


def test_quality_bands(spark):
    from matchstats.llm.quality import RATES, WIDTH, judged
    rows, odd = measured_rows()
    ddl = "doc_id long, lang string, n_words long, n_repeat_words long, n_tokens long, " + ", ".join(f"{c} double" for c in RATES)
    for part in (rows, rows[::3], [rows[i] for i in odd]):
        got = {r.doc_id: r for r in judged(spark.createDataFrame(part, ddl)).collect()}
        x = pd.DataFrame(part, columns=["doc_id", "lang", "words", "repeats", "n_tokens", *RATES]).fillna({"lang": ""})
        x["size"] = [n.bit_length() for n in x.n_tokens]
        band = brute_bands(x)
        for r in x.itertuples():
            at = [(getattr(r, c), *band[r.lang, r.size, c]) for c in RATES]
            assert all(abs(m - got[r.doc_id][f"m_{c}"]) < 1e-5 and abs(s - got[r.doc_id][f"s_{c}"]) < 1e-5 for c, (_, m, s) in zip(RATES, at))
            assert got[r.doc_id].kept == all(abs(v - m) <= WIDTH * s for v, m, s in at)
    # classes of one to eight rows are judged too: the odd go, and only they
    kept = {r.doc_id: r.kept for r in judged(spark.createDataFrame(rows, ddl)).collect()}
    assert sorted(i for i, k in kept.items() if not k) == odd


def test_quality_band_width(spark):
    """Regular rows stay at the stated rate; rows at five deviations go, on either side and in any measure."""
    from matchstats.llm.quality import FALSE_REJECTION, RATES, judged
    n, spread = 20_000, {"chars_per_token": 0.1, "byte_share": 0.01, "entropy": 0.2}
    rng = np.random.default_rng(17)
    x = pd.DataFrame({c: 3 + s * rng.normal(size=n) for c, s in spread.items()})
    for i, (c, side) in enumerate((c, side) for c in RATES for side in (-1, 1)):
        x.loc[i] = 3.0
        x.loc[i, c] = 3 + side * 5 * spread[c]
    x.insert(0, "doc_id", range(n))
    d = spark.createDataFrame(x).selectExpr("*", "'en' AS lang", "200L AS n_words", "0L AS n_repeat_words", "300L AS n_tokens")
    gone = {r.doc_id for r in judged(d).filter("NOT kept").select("doc_id").collect()}
    assert gone >= set(range(6)) and len(gone) - 6 <= 4 * n * FALSE_REJECTION


def test_pipeline_stages_take_effect(spark, scratch):
    """run() and its stages against brute force: copies, near copies, null doc_ids and benchmark passages."""
    import corpus_pipeline
    from tokenizers import Tokenizer
    rng = np.random.default_rng(31)
    vocabulary = [f"{w}{i}" for w in ("stone", "river", "garden", "number") for i in range(60)]

    def text(n):
        return " ".join(rng.choice(vocabulary, n))

    passage, texts = text(40), [f"{text(150)}\n{text(30)}" for _ in range(30)]
    near = texts[3].split(" ")
    for k in (20, 60, 100):
        near[k] = "changed"
    texts += [texts[0], " ".join(near), f"{text(100)} {passage} {text(60)}", f"{text(150)}\n{texts[5].split(chr(10))[1]}",
              "too short to keep", "a b c " * 60]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [rows[7], (None, f"{text(150)}\n{text(30)}", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, text(20))], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")

    def quality(docs):
        def good(t):
            w = t.split()
            windows = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
            inside = {j for i, k in enumerate(windows) if windows.count(k) > 1 for j in (i, i + 1, i + 2)}
            return len(w) >= 50 and 100 * len(inside) <= 50 * len(w)
        return [r for r in docs if good(r[1])]

    def lines(docs):
        seen, fate, out = set(), {}, []
        for r in sorted(docs, key=lambda r: -1 if r[0] is None else r[0]):
            if r[:2] not in fate:
                kept = [s for s in r[1].split("\n") if s not in seen]
                seen |= set(r[1].split("\n"))
                fate[r[:2]] = "\n".join(kept)
            t = fate[r[:2]]
            out.append((r[0], t, *r[2:4], r[4] if t == r[1] else len(t)))
        return out

    def groups(docs):
        def shingles(t):
            w = t.split()
            return {tuple(w[i: i + 5]) for i in range(len(w) - 4)}
        out, taken = [], []
        for r in sorted(set(docs), key=lambda r: -1 if r[0] is None else r[0]):
            s = shingles(r[1])
            if not s or not any(100 * len(s & z) >= 80 * len(s | z) for z in taken):
                out.append(r)
            taken.append(s)
        return out

    def clean(docs):
        return [r for r in docs if passage not in r[1]]

    want, got = rows, spark.read.parquet(f"{scratch}/documents.parquet")
    for (name, stage), brute in zip(corpus_pipeline.STAGES, (quality, lines, groups, clean)):
        before, want = want, brute(want)
        got = spark.createDataFrame(stage(spark, got, scratch).collect(), schema)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str), name
        assert want != before, name  # each stage has something to do
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.run(spark, scratch).toPandas()
    sizes = sorted((str(r[0]), len(tok.encode(r[1], add_special_tokens=False).ids) + 1) for r in want)
    found = packed.fillna({"doc_id": -1}).groupby("doc_id").length.sum()
    assert sorted(("None" if d < 0 else str(int(d)), int(n)) for d, n in found.items()) == sizes


def test_toxicity(spark, none):
    from matchstats.llm.toxicity import toxicity
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(900):
        words, toxic = prose(1000 + i, 60).split(" "), int(i % 4 == 0)
        if toxic:
            for k in rng.choice(60, 3, replace=False):
                words[k] = rng.choice(["vile", "rotten", "nasty"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, toxic))
    rows += [(None, "", None), (5000, None, "de")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity(d, y).toPandas()
    assert len(out) == len(rows) and out.score.between(0, 1).all()
    held = out[out.held_out].merge(pd.DataFrame(labels, columns=["doc_id", "q", "toxic"]), on="doc_id")
    assert all(zlib.crc32(str(int(i)).encode()) % 4 == 2 for i in held.doc_id)
    assert ((held.predicted == 1) == (held.toxic == 1)).mean() > 0.95
    assert toxicity(none, y).count() == 0
    assert toxicity(d, y.limit(0)).filter("score <> 0").count() == 0


def test_warc_round_trip(spark, scratch):
    from matchstats.llm.warc import read_archive, write_archive
    rows = [(i, f"http://h/{i} é", t, 1) for i, t in enumerate(["<p>a</p>", None, "", "<p>a</p>", "long " * 9000, "ü\r\n\r\nWARC/1.1", "<p>a</p>"])]
    rows += [(100 + i, "u", f"page {i % 7} " * 200, 1) for i in range(60)] + [(None, None, "no id", 1), (10**15, "far", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    last = {}
    for i, _, t, _ in rows:
        if i is not None:
            last[t or ""] = max(i, last.get(t or "", -1))
    want = sorted(((i, len((t or "").encode()), base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode(),
                    "response" if last.get(t or "", i) == i else "revisit",
                    None if last.get(t or "", i) == i else last[t or ""]) for i, _, t, _ in rows), key=str)
    listings = []
    for k, parts in enumerate((2, 5)):  # the same files, whatever the partitions
        write_archive(pages.repartition(parts), f"{scratch}/w{k}", shard_bytes=20_000, file_bytes=3_000)
        got = read_archive(spark, f"{scratch}/w{k}").toPandas()
        assert rows_of(got, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]) == want
        listings.append(sorted(map(tuple, spark.read.parquet(f"{scratch}/w{k}/_manifest").select("final", "bytes", "crc32").collect())))
    assert listings[0] == listings[1] and len(listings[0]) > 3
    write_archive(pages.limit(0), f"{scratch}/none")
    assert read_archive(spark, f"{scratch}/none").count() == 0
