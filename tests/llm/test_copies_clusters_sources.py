"""Near copies by sketches, clusters by ball trees, divergence of sources: against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import balltree, divergence, minhash

ODD = ["", " ", None, "a", "one two three", "one two three four", "one two three four", "One\x0bTWO three four", "É Σ ΑΣ İ ﬁ 日本 🙂\x1c\x85x", "word " * 5000, "-" * 700, "x\x00y 1a2b"]


def clashing(df):
    """Further columns with names that the operators use themselves."""
    return df.withColumns({c: F.lit("x") for c in ("n", "node", "component", "term", "docs", "key", "cluster", "part", "h") if c not in df.columns})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingled(text, k=4):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_copies(seed=5):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = list(ODD)
    for n in (5, 9, 30, 51, 64, 66, 90, 300, 900):
        base = [r.choice(vocabulary) for _ in range(n)]
        for _ in range(9):
            t = list(base)
            for _ in range(r.randrange(2 + n // 45)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            rows.append(" ".join(t))
    rows += [" ".join([r.choice(vocabulary) for _ in range(r.randrange(20, 200))] + passage) for _ in range(40)]
    return rows


def components(sets):
    """Smallest id reachable; sets by id."""
    own = {i: i for i in sets}

    def top(i):
        while own[i] != i:
            i = own[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((top(a), top(b)))
            own[y] = x
    return {i: top(i) for i in sets}


def test_minhash(spark):
    rows = [(i + 10, t) for i, t in enumerate(near_copies())] + [(None, "one two three four"), (13, "one two three")]
    got = minhash.components(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    sets = defaultdict(list)
    for i, t in rows:
        sets[i].append(shingled(t))
    del sets[None]
    top = components(sets)
    want = Counter((i, len(shingled(t)), top.get(i), top.get(i) == i or i is None) for i, t in rows)
    assert len(top) - 60 < len(set(top.values())) < len(top) - 30
    assert Counter(map(tuple, got)) == want
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.components(none).collect() == []


def test_minhash_sketches():
    """Sets that are retained whole are decided exactly; of larger ones, none with a similarity of 0.8 goes; estimates are near."""
    r = np.random.default_rng(1)
    small, large = [], []
    for _ in range(300):
        n = int(r.integers(2, 65))
        small.append((n, int(r.integers(0, n + 1)), int(r.integers(0, 6))))
        n = int(r.integers(65, 2000))
        large.append((n, int(r.integers(0, n + 1)), int(r.integers(0, n // 8))))
    far_off = []
    for n, common, more in small + large:
        both = r.integers(0, (1 << 64) - 1, common, dtype=np.uint64)
        x = np.unique(np.concatenate([both, r.integers(0, (1 << 64) - 1, n - common, dtype=np.uint64)]))
        y = np.unique(np.concatenate([both, r.integers(0, (1 << 64) - 1, more + 1, dtype=np.uint64)]))
        pack = lambda s: (s[: minhash.KEPT] >> np.uint64(32)).astype("<u4").tobytes()
        ok, far = minhash.estimated(np.array([len(x)]), [pack(x)], np.array([len(y)]), [pack(y)])
        k = len(np.intersect1d(x, y))
        like = k / (len(x) + len(y) - k)
        if len(x) <= 64 and len(y) <= 64:
            assert ok[0] == (9 * k >= 4 * (len(x) + len(y))) and math.isclose(far[0], 1 - like)
        else:
            assert ok[0] or like < 0.8
            far_off.append(abs(1 - far[0] - like))
    assert np.mean(far_off) < 0.06
    assert minhash.estimated(np.array([70]), [None], np.array([70]), [b""])[0][0]
    none = np.zeros(minhash.simjoin.COUNTERS // 8, np.uint8)
    s = np.arange(64, dtype=np.uint64)
    assert [len(minhash.indexed(s[: min(n, 64)], n, none)) for n in (1, 4, 51, 52, 60, 64, 65, 900)] == [1, 1, 11, 29, 37, 41, 41, 41]


def means(rows, k=8, rounds=10, dim=64):
    """Integer k-means without any tree."""
    kept = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    z = [v for _, v in start[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(z))
    for _ in range(rounds):
        near = [nearest(v)[1] for _, v in kept]
        for j in range(len(z)):
            own = [v for (_, v), c in zip(kept, near, strict=True) if c == j]
            if own:
                z[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    fits = lambda d: d if d < 1 << 63 else None
    inertia = Counter()
    for _, j, d in out:
        inertia[j] += d
    if any(fits(d) is None for _, _, d in out):
        return Counter((i, j, fits(d), hashlib.sha256(",".join(map(str, z[j])).encode()).hexdigest()) for i, j, d in out)
    return Counter((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, z[j])).encode()).hexdigest()) for i, j, d in out)


def vectors(n=600, seed=2):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(12, 64))
    rows = [(i, (middle[i % 12] + 0.02 * r.normal(size=64)).astype("f4").tolist()) for i in range(n)]
    rows += [(n + i, middle[3].astype("f4").tolist()) for i in range(100)]  # copies
    return rows + [(None, rows[5][1]), (7, rows[9][1]), (7, rows[9][1]), (n + 900, [0.0] * 64), (n + 901, None), (n + 902, [1.0] * 63), (n + 903, [None] + [1.0] * 63), (n + 904, [float("nan")] * 64), (n + 905, [float("inf")] * 64)]


@pytest.mark.parametrize("more", [[], [(5000, [5000.25] * 64), (5001, [-7e4] + [0.5] * 63)]], ids=["small", "large"])
def test_clusters(spark, more):
    rows = vectors() + more
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(5)
    assert Counter(map(tuple, balltree.cluster(df).collect())) == means(rows)


def test_clusters_beyond_a_long_and_few_vectors(spark):
    rows = vectors(40)[:60] + [(99, [float(np.float32(3e30))] * 64), (98, [float(np.float32(-3e30))] + [0.0] * 63)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = balltree.cluster(df, rounds=2, k=2).collect()
    assert Counter((r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in got) == means(rows, k=2, rounds=2)
    assert {r["inertia"] for r in got} == {None}
    few = df.where("vec_id < 3")
    assert sorted(r["distance"] for r in balltree.cluster(few).collect()) == [0, 0, 0]
    assert balltree.cluster(df.where("vec_id < 0")).collect() == []


def test_ball_trees():
    """Balls hold their vectors; every vector goes to its nearest centroid, ties to the smaller number; whole balls do occur."""
    r = np.random.default_rng(4)
    for x in (np.rint(r.normal(size=(700, 64)) * 900), np.repeat(np.rint(r.normal(size=(9, 64)) * 900), 80, axis=0) + r.integers(0, 3, (720, 64)), np.zeros((50, 64))):
        order, nodes, sums, radii = balltree.build(x)
        own = x[order]
        assert sorted(order) == list(range(len(x)))
        for (s, e, left, right), total, far in zip(nodes, sums, radii, strict=True):
            assert (own[s:e].sum(axis=0) == total).all() and np.sqrt(((own[s:e] - total / (e - s)) ** 2).sum(axis=1)).max() <= far + 1e-9
            assert left < 0 or (nodes[left, 0], nodes[left, 1], nodes[right, 0], nodes[right, 1]) == (s, nodes[right, 0], nodes[left, 1], e)
        z = np.concatenate([x[:5], x[:2], x[3:6] + 1])  # with ties
        got, whole = np.full(len(x), -1), 0
        for s, e, c, node in balltree.filtered(own, nodes, sums, radii, z):
            assert (got[s:e] == -1).all() and (node < 0 or (nodes[node, :2] == (s, e)).all())
            got[s:e] = c
            whole += node >= 0
        assert (got == ((own[:, None, :] - z[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    order, nodes, sums, radii = balltree.build(np.repeat(np.rint(r.normal(size=(9, 64)) * 900), 80, axis=0))
    assert any(n >= 0 for *_, n in balltree.filtered(np.zeros((720, 64)), nodes, sums, radii, np.rint(r.normal(size=(8, 64)) * 900)))


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def divergences(rows, least):
    """By dictionaries."""
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        docs[lang].update(set(terms(text)))
        count[lang, source].update(terms(text))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= least]
        v = len(kept)
        share = lambda c, n: 1 + 10**9 * (c + 5) // (n + 5 * v)  # noqa: B023,E731
        n = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(count[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[u][t]) for t in kept), u.encode()) for u in sources if u != s]
            first = [(q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(first)[:50])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return Counter(out)


def test_divergence(spark, monkeypatch):
    r = random.Random(8)
    names = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "straße", "日本", "naïve", "o'clock", "x9y", "zz", "k", "ab", "AB"]
    rows = [(" ".join(r.choice(names[: r.randrange(4, 15)]) for _ in range(r.randrange(60))), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "s3", None, "ß", "z"])) for _ in range(240)]
    rows += [(t, "en", "s1") for t in ODD] + [(None, "xx", "empty"), ("", "xx", "other"), ("alpha " * 3, "yy", None), ("1 2 3", "en", "none"), (rows[0][0], rows[0][1], rows[0][2])]
    df = clashing(spark.createDataFrame(rows, "text string, lang string, source string"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    for least, block in ((30, 100_000), (2, 7), (10**6, 100_000)):
        monkeypatch.setattr(divergence, "BLOCK", block)
        assert Counter(map(tuple, divergence.audit(df, least).select(columns).collect())) == divergences(rows, least)
    assert divergence.audit(df.where("text = 'no'")).collect() == []


def test_divergence_tokens():
    """Terms over the borders of texts, slices of one digest, texts longer than a piece, shares beyond a long's products."""
    texts = [t or "" for t in ODD] + ["ends", "Starts\x7fa", "", "é", ""]
    raw = [t.encode() for t in texts]
    flat, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(t) for t in raw])
    low, starts, stops = divergence.tokens(flat, ends)
    assert [low[s:e].tobytes().decode() for s, e in zip(starts, stops, strict=True)] == [t for x in texts for t in terms(x)]
    for digest in (divergence.xxhash.xxh64_intdigest, lambda b: len(b) % 2):
        found, group = divergence.grouped(low, starts, stops, digest)
        assert [found[g].decode() for g in group] == [t for x in texts for t in terms(x)] and len(set(found)) == len(found)
    held, plain = divergence._Counts(), divergence._Counts()
    text = np.frombuffer(("Ab cd, " * 900_000 + "x" * 5_000_000 + " ab").encode(), np.uint8)
    divergence._of_long_text(held, text, held.source("l", "s"))
    divergence._of_texts(plain, text, np.array([len(text)]), np.array([plain.source("l", "s")]))
    rows = [sorted((r["term"] or "", r["n"], r["docs"]) for b in h.take(0, 0) for r in b.to_pylist()) for h in (held, plain)]
    assert rows[0] == rows[1] and rows[0][1] == ("ab", 900_001, 1)
    count, n = np.array([0, 1, 10**14, 8 * 10**15]), np.array([10**15, 7, 10**14, 9 * 10**15])
    assert divergence.shares(count, n, 3).tolist() == [1 + 10**9 * (c + 5) // (m + 15) for c, m in zip(count.tolist(), n.tolist(), strict=True)]


def test_a_task_gives_its_memory_back():
    """What a task held in many pieces, below one that stays."""
    import re
    from pathlib import Path

    from corpusmill.llm import common

    mb = lambda: int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024
    kept = []

    def task():
        held = [bytearray(b"x" * 60_000) for _ in range(4000)]
        kept.append(bytearray(b"y" * 60_000))
        yield mb()
        held.clear()
        yield mb()

    most, freed = common.ended(task())
    assert most - mb() > 200 and freed - mb() > 100
