"""Ranked search, SentencePiece codec and vector codes against brute force or
the library: nulls, empty and long texts, ties, repeated rows, clashing column
names, empty tables."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm.test_operators import ALNUM, SCHEMA, low, prose, sample_rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


ITEM_SCHEMA = "item_id long, text string, score long, term string, row int"
ITEMS = [(1, prose(1, 30)), (2, "water STONE of the zzz"), (3, None), (4, ""), (5, "nothing-here qqq"), (None, "river the"),
         (2, "water STONE of the zzz"), (6, prose(5, 400)), (7, "x"), (8, "été Été größe"), (9, "the " * 50)]


def best_by_brute_force(texts, items, top):
    tf = [(d, Counter(ALNUM.findall(low(t)))) for d, t in texts]
    tf = [(d, c) for d, c in tf if c]
    total = sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in tf:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * len(tf)) // total
            s = sum(math.floor(1000 * math.log((2 * len(tf) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(ALNUM.findall(low(text))) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("top,segment,pairs,share", [(50, 1 << 19, 1 << 18, 1 / 64), (3, 1, 10, 1.0), (5, 40, 1, 0.5)])
def test_ranked_search(spark, docs, none, monkeypatch, top, segment, pairs, share):
    from matchstats.llm import ranked_search as R
    monkeypatch.setattr(R, "FIRST_RUN", 2 if top < 50 else R.FIRST_RUN)
    bench = spark.createDataFrame([(*i, 1, "x", 2) for i in ITEMS], ITEM_SCHEMA)
    out = R.ranked_search(docs, bench, top, segment, pairs, share)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == best_by_brute_force([(r[0], r[1]) for r in sample_rows()], ITEMS, top)
    if top == 50:
        assert R.ranked_search(none, bench).count() == 0
        assert R.ranked_search(docs, bench.limit(0)).count() == 0


def test_reads_stop_before_the_end():
    """Equal impacts at the k-th place all stay; with a high floor nothing is read to its end."""
    from matchstats.llm.ranked_search import resolved
    rng = np.random.default_rng(4)
    n, lists, full = 5000, [], np.zeros(5000, np.int64)
    for w in (700, 30, 30, 5):
        d = rng.choice(n, 3000, replace=False)
        s = np.sort(rng.integers(1, 40, len(d)))[::-1].astype(np.int64)
        full[d] += w * s
        lists.append((w, d, s))
    for floor in (1, int(np.sort(full)[-20]), int(full.max()) + 1):
        found, score = resolved(lists, n, 10, floor)
        need = max(floor, int(np.sort(full)[-10]))
        assert (full[found] == score).all()
        assert set(np.flatnonzero(full >= need)) <= set(found.tolist())
    assert len(found) == 0


def test_codec(spark, docs, none):
    import sentencepiece
    from matchstats.llm.sentencepiece_codec import codec_digests, decode_ids, encode_texts
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    extra = ["  a  b   ", "▁▁x ▁", "日本語 𠮷野家\x00\x01", " " * 70 + "end", "<s></s> <0x0A> <unk>\n\t\n", "é" * 500, "the" * 4000,
             "ﬁ ½ Å", "a" + " " * 17 + "b"]
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    texts = [(r[0], r[1]) for r in sample_rows()] + [(100 + i, t) for i, t in enumerate(extra)]

    def one(t):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(sp.decode(ids).encode()).hexdigest())

    got = sorted((tuple(r) for r in codec_digests(more, path).collect()), key=str)
    assert got == sorted(((d, *one(t)) for d, t in texts), key=str)
    ids = encode_texts(more, path)
    assert sorted((str(r[0]), r[1]) for r in ids.collect()) == sorted(
        (str(d), sp.encode(t or "", add_bos=True, add_eos=True)) for d, t in texts)
    assert sorted(map(str, (tuple(r) for r in decode_ids(ids, path).collect()))) == sorted(
        str((d, sp.decode(sp.encode(t or "")))) for d, t in texts)
    assert codec_digests(none, path).count() == encode_texts(none, path).count() == 0


def test_codec_on_random_texts_and_ids():
    import pyarrow as pa
    import sentencepiece
    from matchstats.llm.sentencepiece_codec import codec
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, c, rng = sentencepiece.SentencePieceProcessor(model_file=path), codec(path), np.random.default_rng(9)
    pool = [x[0].replace("▁", " ") for x in c.model["plain"]]
    texts = ["".join(rng.choice(pool, rng.integers(0, 12))) for _ in range(1500)]
    texts += ["".join(rng.choice(list("etaoinshr  \n▁éñ日\x00"), rng.integers(0, 60))) for _ in range(1500)]
    texts += ["".join([" " * int(rng.integers(0, 40)), "a"][int(i)] for i in rng.integers(0, 2, 6)) for _ in range(500)]
    ids, offsets = c.ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == sp.encode(texts)
    runs = [rng.choice([int(rng.integers(0, 32000)), *rng.integers(100, 259, 4).tolist()], rng.integers(0, 7)).tolist()
            for _ in range(2000)]
    flat = np.array([i for r in runs for i in r])
    got = c.decode(flat, np.cumsum([0, *map(len, runs)]))
    assert [x.decode() for x in got] == [sp.decode(r) for r in runs]


def test_prefix_table_of_an_uneven_model():
    """Tokens formed after one of a lower score, tied scores, tokens no text becomes, unknown characters."""
    from matchstats.llm.sentencepiece_codec import PrefixTable
    rng = np.random.default_rng(2)
    for _ in range(30):
        letters = "abc"
        tokens = {x: -100.0 - i for i, x in enumerate(letters)}
        while len(tokens) < 14:
            a, b = rng.choice(list(tokens), 2)
            if len(a + b) < 9:
                tokens.setdefault(str(a + b), float(rng.integers(-9, 0)))
        table = PrefixTable([(t, s, i + 256) for i, (t, s) in enumerate(tokens.items())], list(range(256)))
        monotone = not table.irregular and len(set(tokens.values())) == len(tokens)
        for _ in range(60):
            text = "".join(rng.choice(list("abc?é"), rng.integers(0, 25), p=[0.35, 0.35, 0.2, 0.05, 0.05]))
            want = [i for t in table.merged(text) for i in ([table.id_of[t]] if t in table.id_of else t.encode())]
            if monotone:
                assert table.encode(text) == want, (text, tokens)


VECTORS = "vec_id long, embedding array<float>, label int, part int, bounds string, s_label int"


def codes_by_brute_force(rows, parts, entries, rounds):
    """rows: (vec_id, ints, label) of the kept vectors."""
    first = {}
    for i, v, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, v)
    start = list(first.values())[:entries]
    w = len(start[0]) // parts
    cut = lambda v: [v[p * w: (p + 1) * w] for p in range(parts)]
    books = [list(x) for x in zip(*[cut(v) for v in start])]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((dist(x, c), e) for e, c in enumerate(books[p])) for p, x in enumerate(cut(v))] for _, v, _ in rows]

    for _ in range(rounds):
        got = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(rows[i][1])[p] for i, g in enumerate(got) if g[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assigned()
    errors = Counter()
    for (_, _, label), g in zip(rows, got):
        errors[label] += sum(d for d, _ in g)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g), errors[label], digest)
                   for (i, _, label), g in zip(rows, got)), key=str)


def vector_rows(n, d, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (20, d))
    rows = [(int(i), (centres[i % 20] + rng.normal(0, spread, d)).astype(np.float32).tolist(), int(i % 4) if i % 5 else None)
            for i in range(n)]
    bad = [list(rows[0][1]) for _ in range(3)]
    bad[0][1], bad[1][2], bad[2][0] = None, float("nan"), float("-inf")
    rows += [(n + 1, None, 1), (-5, bad[0], 1), (-6, bad[1], 2), (-7, bad[2], 2), rows[3], rows[3], (3, rows[4][1], 1),
             (None, rows[7][1], 0), (n + 2, [0.0] * d, 0), (n + 3, [0.0] * d, 0), (n + 4, [0.5] * (d + 8), 0)]
    return rows


@pytest.mark.parametrize("n,d,parts,entries,spread,salted", [
    (300, 32, 8, 16, 0.3, False), (300, 16, 4, 40, 0.02, True), (9, 16, 8, 16, 0.3, False), (200, 8, 8, 2, 0.5, False),
    (40, 8, 2, 1, 0.5, True)])
def test_vector_codes(spark, monkeypatch, n, d, parts, entries, spread, salted):
    from matchstats.llm import vector_codes as V
    if salted:
        monkeypatch.setattr(V, "BROADCAST_LABELS", 0)
    rows = vector_rows(n, d, n + d, spread)
    df = spark.createDataFrame([(*r, 1, "x", 9) for r in rows], VECTORS).repartition(3)
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    got = sorted((tuple(r) for r in V.coded(df, parts, entries).collect()), key=str)
    assert got == codes_by_brute_force(kept, parts, entries, 6)


def test_vector_codes_edges(spark):
    from matchstats.llm.vector_codes import coded
    df = spark.createDataFrame([(1, [0.5] * 8, 1), (2, None, 1)], "vec_id long, embedding array<float>, label int")
    out = coded(df.limit(0))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert [(r["code"], r["error"]) for r in coded(df).collect()] == [("00" * 8, 0)]
    assert coded(df.filter("vec_id = 2")).count() == 0
    with pytest.raises(ValueError):
        coded(spark.createDataFrame([(1, [0.5] * 9, 1)], df.schema))


def test_bounds_save_work():
    """After the first assignment most parts keep their entry without a distance."""
    from matchstats.llm.vector_codes import Bounds, assign
    rng = np.random.default_rng(0)
    book = rng.integers(-3000, 3000, (16, 8))
    x = book[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 8))
    s = Bounds(len(x), 4)
    assert (assign(x, book, s) == 5).all()
    new = book + rng.integers(-20, 20, book.shape)
    s.moved(np.sqrt(((new - book) ** 2).sum(axis=1)) * (1 + 1e-9))
    needed = assign(x, new, s)
    d = ((x[:, None] - new[None]) ** 2).sum(axis=2)
    assert (s.assigned == d.argmin(axis=1)).all() and (needed == 0).mean() > 0.9
