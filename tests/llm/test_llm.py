import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusmill.llm import ann, bpe, chat, common, license, lm, media, mixing, queries, simjoin, tokenbin, toxicity

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", None, "a", "one two three four", "one two three four five six", "one two three four five six", "É Σ ΑΣ İ ﬁ 日本 🙂\x1c\x85x", "<|startoftext|> a <|endoftext|>", "I'LL don't ''s  \t\n x", "word " * 5000, "\\ </s>[INST] ok [/INST] <|im_end|>", "-" * 700]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, repeated rows, very long texts, clashing further columns."""
    rows = [(i, t, "n") for i, t in enumerate(ODD)] + [(None, "no id", None), (4, ODD[4], "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, n string").withColumn("start", F.lit(1)).withColumn("score", F.lit("x")).withColumn("source", F.col("n")).withColumn("key", F.lit(0))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < -1")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_bpe(odd, none):
    tok = Tokenizer.from_file(WORD_BPE)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in texts_of(odd):
        ids = tok.encode(t, add_special_tokens=False).ids
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False).encode())] += 1
    assert Counter(map(tuple, bpe.digests(odd, WORD_BPE).collect())) == want
    assert bpe.digests(none, WORD_BPE).count() == 0 and bpe.encode(odd, WORD_BPE).count() == odd.count()


def test_bpe_automaton_on_small_merge_lists():
    """Against applying the merges one after the other, for merge lists that are made so that both agree."""
    merges = [("a", "a"), ("aa", "a"), ("b", "a"), ("aa", "ba"), ("ba", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", *dict.fromkeys(x + y for x, y in merges)])}
    m = bpe.MergeAutomaton(vocab, merges)
    names = {i: t for t, i in vocab.items()}
    for n in range(1, 9):
        for w in map("".join, itertools.product("ab", repeat=n)):
            parts = list(w)
            for x, y in merges:
                out = []
                for p in parts:
                    if out and out[-1] == x and p == y:
                        out[-1] = x + y
                    else:
                        out.append(p)
                parts = out
            assert [names[i] for i in m.encode(w)] == parts


def test_toxicity(spark, odd, none):
    rows = [(i, ("the river runs far " * (1 + i % 5)) + ("you moron idiot" if i % 4 == 0 else "nice day"), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert all(got[i]["predicted"] == t and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, t in rows)
    assert toxicity.scored(odd, model).where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.scored(none, model).count() == 0 and toxicity.rejected_away(odd, model).count() == odd.count()
    assert toxicity.scored(odd, toxicity.fit(odd, docs.select("doc_id", "toxic").limit(0))).where("score = 0").count() == odd.count()
    rate, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(rate) > 0).all() and (np.diff(y) >= 0).all()


def test_trees_against_loops():
    """Trees are applied node by node; each round of boosting splits where an exhaustive search finds the largest gain."""
    r = np.random.default_rng(21)
    x = np.round(r.standard_normal((300, 4)), 1)
    y = (r.random(300) < 1 / (1 + np.exp(-2 * x[:, 1] + x[:, 2] ** 2))).astype(float)
    start, trees = toxicity.boost(x, y, rounds=5, depth=2)
    raw = np.full(300, start)
    for feature, cut, leaf in trees:
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        gain = {}
        for j in range(4):
            for c in np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])):
                left = x[:, j] <= c
                part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
                gain[j, c] = part(left) + part(~left)
        assert gain[feature[0], cut[0]] == pytest.approx(max(gain.values()))
        add = []
        for row in x:
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            add.append(leaf[node - len(feature)])
        assert np.allclose(toxicity.apply_tree((feature, cut, leaf), x), add)
        raw += add
    loss = lambda f: -(y * f - np.logaddexp(0, f)).mean()
    assert loss(raw) < loss(np.full(300, start)) - 0.05


def test_isotonic_against_all_intervals():
    """The fit at a place is the largest, over intervals that begin before it, of the least mean over those that end after it."""
    r = np.random.default_rng(22)
    for _ in range(20):
        raw = np.sort(r.standard_normal(30))
        y = (r.random(30) < 1 / (1 + np.exp(-raw))).astype(float)
        at, rate = toxicity.isotonic(raw, y)
        want = [max(min(y[a : b + 1].mean() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
        steps = sorted(set(np.round(want, 9)))
        sizes = [sum(abs(w - v) < 1e-6 for w in want) for v in steps]
        assert np.allclose(rate[1:-1], [(v * n + 1e-3) / (n + 2e-3) for v, n in zip(steps, sizes, strict=True)], atol=1e-6)
        assert (np.diff(at) > 0).all() and (np.diff(rate) > 0).all()


def test_toxicity_held_out(spark):
    """Documents of the fold that nothing was learnt from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, toxicity.fit(docs, labels)).where("held_out").collect()}
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in got)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in got}
    hit = [got[i]["predicted"] for i, t in toxic.items() if t == 1]
    wrong = [got[i]["predicted"] for i, t in toxic.items() if t == 0]
    assert len(hit) > 50 and sum(hit) >= 0.8 * len(hit) and sum(wrong) <= 0.01 * len(wrong)


def test_toxicity_nearness_in_long_texts():
    model = toxicity.Model(lexicon={b"=moron": 4.0})
    near = lambda t: model.features(t)[8]
    assert near("you x x x x " * 80 + "x " * 2000 + "moron x you") == 1 / 3  # beside the 81st 'you'
    assert near("moron x x " * 100) == 1 / 1000  # many hits, no second person
    r = random.Random(4)
    for _ in range(200):
        a, b = (sorted(r.sample(range(900), r.randrange(90))) for _ in "ab")
        assert toxicity.nearest(a, b) == min((abs(i - j) for i in a for j in b), default=999)


def test_toxicity_lexicon_is_whole(spark):
    """More common units than were once looked at, and more abusive words than were once kept."""
    plain = " ".join(hashlib.md5(str(i).encode()).hexdigest()[:8] for i in range(7000))
    bad = [f"zx{i}qu" for i in range(2000)]
    rows = [(i, plain + (" " + " ".join(bad) if i % 10 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic")).lexicon
    assert all(b"=" + w.encode() in lexicon for w in bad) and not any(b"=" + w.encode() in lexicon for w in plain.split())


def components(rows):
    sets = [set(simjoin.shingles(t).tolist()) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in itertools.combinations(zip((i for i, _ in rows), sets, strict=True), 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return Counter((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets, strict=True))


@pytest.mark.parametrize("small", [False, True])
def test_simjoin(spark, odd, none, small, monkeypatch):
    if small:  # every list is long and split, every shingle frequent, the grid has many tasks
        monkeypatch.setattr(simjoin, "SPLIT", 5)
        monkeypatch.setattr(simjoin, "LONG_LIST", 2)
        monkeypatch.setattr(simjoin, "FREQUENT", 2)
        monkeypatch.setattr(simjoin, "TASK_PAIRS", 5)
    r = random.Random(1)
    base = [[r.choice("abcdefghij") * r.randrange(1, 4) for _ in range(r.randrange(3, 90))] for _ in range(8)]
    rows = texts_of(odd)
    for w in base:
        for _ in range(14):
            c = list(w)
            for _ in range(r.randrange(4)):
                c[r.randrange(len(c))] = r.choice("xyz") * 3
            rows.append((100 + len(rows), " ".join(c)))
    got = simjoin.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == components(rows)
    assert simjoin.components(none).count() == 0


def test_signatures_bound_what_sets_share():
    r = np.random.default_rng(6)
    for n in (1, 5, 300, 700, 1500, 3000, 9000):
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: -max(1, n // 15)], r.integers(0, 2**63, n // 12 + 1).astype(np.uint64)]))
        z = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for b, near in ((x, True), (y, n > 20), (z, False)):
            ok, far = simjoin._far(np.array([len(x)]), [simjoin.signature(x)], np.array([len(b)]), [simjoin.signature(b)])
            both = len(np.intersect1d(x, b))
            assert far[0] * (len(x) + len(b)) <= len(x) + len(b) - 2 * both + 1e-3
            if 100 * both >= 80 * (len(x) + len(b) - both):
                assert ok[0]
            if near:
                assert ok[0]
        assert n < 5 or not ok[0]  # other sets of these sizes are ruled out


def test_derived_answers(spark):
    """What derivation decides agrees with the sets; what is far and near from a known neighbour is decided."""
    r = random.Random(8)
    sets = {i: set(r.sample(range(400), r.randrange(60, 90))) for i in range(4)}
    for i in range(4, 24):
        sets[i] = set(sets[i % 4]) ^ set(r.sample(range(400), r.randrange(5)))
    row = lambda i, j: (i, len(sets[i]), j, len(sets[j]))
    pairs = list(itertools.combinations(sets, 2))
    known = [p for p in pairs if p[0] < 4]
    answers = spark.createDataFrame([(*row(i, j), len(sets[i] & sets[j])) for i, j in known], "x long, nx int, y long, ny int, both int")
    rest = spark.createDataFrame([(*row(i, j), 0.5) for i, j in pairs if i >= 4], "x long, nx int, y long, ny int, far float")
    got = simjoin.derived(rest, answers).collect()
    assert len(got) == len(pairs) - len(known)
    for x in got:
        a, b = sets[x["x"]], sets[x["y"]]
        assert x["link"] is None or x["link"] == (100 * len(a & b) >= 80 * len(a | b))
    assert sum(x["link"] is not None for x in got) > len(got) / 2


def test_verified_holds_sets_of_one_side(spark):
    texts = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(30))) for i in range(12)] + [(3, "other words of the same id are another text")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = [(i, set(simjoin.shingles(t).tolist())) for i, t in texts]
    pairs = [(i, len(a), j, len(b), len(a & b)) for (i, a), (j, b) in itertools.permutations(sets, 2) if i != j]
    got = simjoin.verified(docs, spark.createDataFrame([p[:4] for p in pairs], "x long, nx int, y long, ny int").distinct())
    assert Counter(map(tuple, got.collect())) == Counter(set(pairs))


def test_connected_goes_on_from_stars(spark, monkeypatch):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "x long, y long")
    first = simjoin.connected(chain)
    assert sorted(map(tuple, first.collect())) == [(i, 0) for i in range(41)] + [(100, 100), (101, 100)]
    tables = []
    monkeypatch.setattr(simjoin, "written", lambda df, kind, f=simjoin.written: tables.append(kind) or f(df, kind))
    assert sorted(map(tuple, simjoin.connected(simjoin.stars(first)).collect())) == sorted(map(tuple, first.collect())) and tables == ["edges"]
    more = spark.createDataFrame([(40, 101)], "x long, y long")
    assert {tuple(r) for r in simjoin.connected(simjoin.stars(first).unionByName(more)).collect()} == {(i, 0) for i in [*range(41), 100, 101]}


def test_runs_over_batches():
    keys = [[1, 1], [1], [1, 2, 2, 3], [3], [4], [5, 5]]
    batches = (pa.RecordBatch.from_arrays([pa.array(k, pa.int64())], ["k"]) for k in keys)
    found = [(int(k), int(e - s)) for ks, ss, es, _ in simjoin.runs(batches, 1) for k, s, e in zip(ks, ss, es, strict=True)]
    assert found == [(1, 4), (2, 2), (3, 2), (4, 1), (5, 2)]


def test_simple8b():
    r = np.random.default_rng(2)
    for bits in (1, 2, 5, 9, 16, 31, 59, 60, 61, 63):
        for n in (0, 1, 2, 7, 61, 500):
            x = r.integers(0, 2**bits, n).astype(np.uint64)
            assert (tokenbin.decode(tokenbin.encode(x)) == x).all()
    mixed = np.array([0, 2**64 - 1, 5, 2**60 - 1, 2**60, 1] * 9, np.uint64)
    assert (tokenbin.decode(tokenbin.encode(mixed)) == mixed).all()
    assert len(tokenbin.encode(np.ones(120, np.uint64))) == 2


def test_token_files(odd, none):
    tok = Tokenizer.from_file(BYTE_BPE)
    got = sorted(map(tuple, tokenbin.round_trip(odd, BYTE_BPE).collect()), key=lambda x: x[1])
    assert [x[0] for x in got] == sorted((i for i, _ in texts_of(odd)), key=lambda i: -1 if i is None else i)
    assert [x[1] for x in got] == np.cumsum([0, *(x[2] for x in got[:-1])]).tolist()
    ids = lambda t: [*tok.encode(t, add_special_tokens=False).ids, 0]
    assert Counter((a, n, c) for a, _, n, c in got) == Counter((i, len(x := ids(t)), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in texts_of(odd))
    assert tokenbin.round_trip(none, BYTE_BPE).count() == 0


def test_chat(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"t{k} \\ </s>[INST] <|im_end|>\n") for k in range(100)] + [(2, 0, "assistant", None), (2, 0, "assistant", None), (None, None, None, "x"), (3, 0, "a\\n\nb<|im_end|>", "")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for conv in (1, 2, 3, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        want = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.marked(own)))
        assert tuple(got[conv])[1:] == want
    old = chat.Renderer(lambda turns: f"{len(turns)}|" + "".join(t for _, t in turns))
    assert [old.push("user", "a")[0], old.rewrites, old.push("user", "b")[1:], old.rewrites] == ["1|a", False, (0, 0), True]


def test_chat_late_rewrites(spark):
    def last_50(turns):
        return "".join(f"{r}: {t}\n" for r, t in turns[-50:])

    renderer = chat.Renderer(last_50)
    seen = [(renderer.push("user", f"t{k}"), renderer.rewrites)[1] for k in range(60)]
    assert seen == [False] * 50 + [True] * 10
    rows = spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(60)], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(rows, last_50).where("rewrites").count() == 10 and chat.format_turns(rows).where("rewrites").count() == 0


def test_mixing(spark, odd, none):
    r = random.Random(4)
    rows = [(i, "w " * r.randrange(200), r.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(3000)] + [(9000, "", "z"), (9001, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    by = {}
    for x in got:
        s = by.setdefault(x["source"], [0, 0, x["target"], x["source_size"]])
        s[0] += x["size"]
        s[1] += x["taken"]
        assert x["taken"] in (0, x["size"], 2 * x["size"])
    weights = dict(zip(sorted(filter(None, by)), itertools.cycle((5.0, 2.0, 1.0)))) | {None: (5.0, 2.0, 1.0)[len(set(by) - {None}) % 3]}
    left, want, capped = 1.5 * sum(s[0] for s in by.values()), {}, set()
    while True:
        rest = {k: left * w / sum(v for j, v in weights.items() if j not in capped) for k, w in weights.items() if k not in capped}
        over = {k for k, v in rest.items() if v > 2 * by[k][0]}
        if not over:
            want |= rest
            break
        for k in over:
            want[k] = 2.0 * by[k][0]
            left -= want[k]
        capped |= over
    for k, (size, taken, target, source_size) in by.items():
        assert size == source_size and target == pytest.approx(want[k]) and abs(taken - target) <= 200
    assert Counter(map(repr, got)) == Counter(map(repr, mixing.mix(docs.repartition(7)).collect()))
    shards = Counter(k for x in got for k in x["shards"])
    assert set(shards) == set(range(mixing.SHARDS)) and all(len(x["shards"]) == len(x["places"]) == x["copies"] for x in got)
    m = [tuple(r) for r in mixing.mixture(mixing.mix(docs)).collect()]
    assert Counter(k for k, *_ in m) == shards and Counter(i for _, _, i, _ in m) == Counter({x["doc_id"]: x["copies"] for x in got if x["copies"]})
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_mixing_quotas(spark):
    """Leaves add up exactly, shards are of one size, and the left half of a tree is a draw without replacement."""
    n = {"a": 700, "b": 200, None: 100, "d": 1}
    counts = spark.createDataFrame(list(n.items()), "source string, n long")
    for shards in (1, 2, 5, 8):
        got = mixing.quotas(counts, shards).collect()
        by_source, by_shard = Counter(), Counter()
        for r in got:
            by_source[r["source"]] += r["quota"]
            by_shard[r["shard"]] += r["quota"]
        assert by_source == n and set(by_shard) == set(range(shards)) and max(by_shard.values()) - min(by_shard.values()) <= 2
    one = {r["source"]: r["quota"] for r in mixing.quotas(counts, 2).where("shard = 0").collect()}
    for source, total in n.items():  # within six deviations of the hypergeometric distribution
        p, size = total / 1001, 500
        assert abs(one.get(source, 0) - size * p) <= 6 * math.sqrt(size * p * (1 - p) * (1001 - size) / 1000) + 1
    taken = spark.createDataFrame([("a", b, t) for b in range(30) for t in (1, 2)], "source string, block int, taking int")
    quota = spark.createDataFrame([("a", 0, 25), ("a", 1, 0), ("a", 2, 35)], "source string, shard int, quota long")
    dealt = mixing.drawn(taken, quota).collect()
    assert Counter(r["shard"] for r in dealt) == {0: 25, 2: 35} and len({(r["block"], r["taking"]) for r in dealt}) == 60
    assert any(len({r["shard"] for r in dealt if r["block"] == b}) == 2 for b in range(30))  # copies of a block may part


def test_mixing_against_a_loop(spark):
    """What is taken, and that rows get their copies whatever their ids are."""
    r = random.Random(9)
    rows = [(None if i % 7 == 0 else i // 2, f"t{i} " + "w " * r.randrange(40), r.choice(["a", "a", "b", None]), "x") for i in range(900)] + [(3, None, "a", "x"), (4, " ", "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").withColumn("row", F.lit(1)).withColumn("m", F.lit(2))
    mixed = mixing.mix(docs).collect()
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter(x["doc_id"] for x in got) == Counter({k: sum(x["copies"] for x in mixed if x["doc_id"] == k) for k in {x["doc_id"] for x in mixed}}) - Counter()
    words = Counter()
    for x in got:
        words[x["source"]] += len((x["text"] or "").split())
    for source in ("a", "b", None):
        own = [x for x in mixed if x["source"] == source]
        assert words[source] == sum(x["taken"] for x in own) and abs(words[source] - own[0]["target"]) <= 41
        blocks = {}
        for x in own:  # rows of an id are in one block: taken equally often, unless it is cut
            blocks.setdefault(x["doc_id"], set()).add(x["copies"] if x["size"] else None)
        assert sum(len(v - {None}) > 1 for v in blocks.values()) <= 2
    again = mixing.mixed_documents(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_license(odd, none):
    s = license.scanner()
    assert s.scan("x Released under the MIT license. apache license, version 2.0; CC BY-NC")[1] == [(2, "mit"), (6, "apache-2"), (11, "cc-by-nc")]
    for label, notice in license.NOTICES:
        assert label in {x[0] for x in s.scan("before " + notice + " after")[2]}
    assert not s.scan("the software is under a license and you may use the work")[2]
    words = s.automaton
    for k, (_, notice) in enumerate(license.NOTICES):  # every run of a notice is read by the automaton
        ids = [s.ids[w] for w in license.words_of(notice)]
        state = 0
        for i, c in enumerate(ids):
            state = words.next[state][c]
            assert (k, i) in words.ends[state]
    labels = {label: notice for label, notice in license.NOTICES}
    for label, notice in labels.items():  # whole texts, and with words left out, have their own label alone
        assert {x[0] for x in s.scan("some words " + notice)[2]} == {label}
        cut = license.words_of(notice)
        if len(cut) > 60:
            del cut[20:22], cut[40:44]
            assert {x[0] for x in s.scan(b" ".join(cut).decode())[2]} == {label}


FOREIGN = (
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("", "This work is licensed under the GNU General Public License, version 1."),
    ("", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version."),
    ("", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("", "Licensed under CC BY-NC-ND 4.0."),
    ("", "Redistribution and use in source and binary forms, with or without modification, are strictly forbidden"),
    ("", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("", "Permission to use this text is hereby granted, free of charge, to any person who asks for it in writing."),
)


@pytest.mark.parametrize(("label", "text"), FOREIGN)
def test_licences_next_to_the_known_ones(label, text):
    """Other versions and terms, and sentences that licences share, have no label of a neighbour, alone or in a long text."""
    s = license.scanner()
    for t in (text, "word " * 500 + text + " word" * 500, text.upper()):
        assert {x[0] for x in s.scan(t)[2]} == ({label} if label else set())


def license_base(text):
    """Words and the places of the phrases, by looking at every place."""
    words = [w for w in re.split("[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    found = [(i, label) for phrase, label in license.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def test_license_base_columns(spark, odd, none):
    r = random.Random(12)
    parts = ["under", "the", "mit", "license", "MIT", "Apache", "version", "2", "cc", "by", "nc", "CC-BY-NC", "é", "2.0", "x", "\n", "--", "İ"]
    rows = [(1000 + i, " ".join(r.choice(parts) for _ in range(r.randrange(40)))) for i in range(600)] + [(2000, ("under the mit license " * 3 + "w ") * 900), (2001, "under the mit license under the mit license"), (2002, None), (2002, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text")).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = license.scan(docs).collect()
    assert Counter((x["doc_id"], x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) for x in got) == Counter((i, *license_base(t)) for i, t in texts_of(docs))
    for x in got:
        assert set(x["base_labels"].split(",")) <= {*x["labels"].split(","), ""} and 0 <= x["score"] <= 1 and (x["score"] >= 0.5 or not x["n_base"])
        assert sorted({*x["base_labels"].split(","), *(s["label"] for s in x["spans"])} - {""}) == [y for y in x["labels"].split(",") if y]
    assert license.scan(odd).count() == odd.count() and license.scan(none).count() == 0


def test_matching_statistics(spark):
    """The runs that no word extends, against looking for every run of words in every notice."""
    s = license.Scanner((("a", "one two three four one two five"), ("b", "two five six two three four")), ())
    notices = [license.words_of(t) for _, t in (("a", "one two three four one two five"), ("b", "two five six two three four"))]
    inside = {tuple(n[i:j]) for n in notices for i in range(len(n)) for j in range(i + 1, len(n) + 1)}
    r = random.Random(13)
    for _ in range(400):
        words = [r.choice([b"one", b"two", b"three", b"four", b"five", b"six", b"no"]) for _ in range(r.randrange(30))]
        got = [(f, n) for f, n, _ in s.runs(words, [i for i, w in enumerate(words) if w in s.ids])]
        want, before = [], 0
        for i in range(len(words)):  # the longest run from i that ends later than those before
            n = max((n for n in range(1, len(words) - i + 1) if tuple(words[i : i + n]) in inside), default=0)
            if i + n > before and n >= license.MIN_RUN:
                want.append((i, n))
            before = max(before, i + n)
        assert got == want


def test_lm(odd, none, spark):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()] + [(100 + i, f"common words here {i} and there") for i in range(60)]
    got = Counter()
    for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), BYTE_BPE).collect():
        got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)] += 1
        assert r["score"] < 0
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = lambda t: t.encode().lower().split()
    counts = Counter(w for i, t in rows if not fold(i) for w in [*split(t), None])
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, fold(i), len(split(t)) + 1, sum(counts[w] > 0 for w in [*split(t), None]), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*split(t), None]), 6)) for i, t in rows)
    assert got == want
    assert lm.scores(none, BYTE_BPE).count() == 0


def exact(model):
    """The model in double precision."""
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.mask = model.mask.astype(np.float64)
    return model


def test_attention_gradient():
    """Against finite differences, for every kind of weight."""
    m = exact(lm.Attention(np.arange(1.0, 1000)))
    r = np.random.default_rng(1)
    ids, goal = r.integers(0, 999, (3, lm.WINDOW)), r.integers(0, 999, (3, lm.WINDOW))
    _, g, own = m.gradient(ids, goal)
    whole = np.zeros_like(m.p["e"])
    whole[own] = g["e"]
    for name, d in (g | {"e": whole}).items():
        at = np.argsort(-np.abs(d), axis=None)[[0, 1, 5, 20]]
        for i in at[at < d.size]:
            w, step = m.p[name].reshape(-1), 1e-5
            before, loss = w[i], []
            for x in (before + step, before - step):
                w[i] = x
                loss.append(m.gradient(ids, goal)[0])
            w[i] = before
            assert (loss[0] - loss[1]) / (2 * step) == pytest.approx(d.ravel()[i], rel=1e-4, abs=1e-9), name


def test_attention_windows_and_probabilities():
    m = lm.Attention(np.arange(1.0, 31))
    seq = [np.arange(40) % 7 for _ in range(20)]
    before = m.score(seq, 29).sum()
    m.train(seq, 29, steps=60)
    assert m.score(seq, 29).sum() > before * 0.5
    mixed = [np.arange(k) % 7 for k in (0, 1, 23, 24, 25, 40, 100)]
    together = m.score(mixed, 29)
    assert np.allclose(together, [m.score([t], 29)[0] for t in mixed], rtol=1e-4)
    y, cache = m.forward(np.zeros((1, lm.WINDOW), int))
    assert np.allclose(np.exp(y).sum(axis=2), 1, atol=1e-4)
    z = np.repeat(cache[-1][0, 5:6], 1024, axis=0)  # all pieces after one context add up to one
    assert np.exp(m.log_probabilities(np.repeat(y[0, 5:6], 1024, axis=0), z, np.arange(1024))).sum() == pytest.approx(1, abs=1e-3)
    # against one window after the other, id by id
    text = np.arange(60) * 7 % 29
    s, total = np.concatenate([[29], text, [29]]), 0.0
    for j in range(len(s) - 1):
        start = 0 if j < lm.WINDOW else lm.STRIDE * -(-(j - lm.WINDOW + 1) // lm.STRIDE)
        window = np.zeros((1, lm.WINDOW), int)
        window[0, : j - start + 1] = s[start : j + 1]
        y, cache = m.forward(window)
        total += m.log_probabilities(y[0, [j - start]], cache[-1][0, [j - start]], s[[j + 1]])[0]
    assert m.score([text], 29)[0] == pytest.approx(total / np.log(10), rel=1e-4)


def test_lm_pieces_and_context():
    tokens = lm.file_tokens(BYTE_BPE)
    tok = lm.Subwords(tokens)
    assert set(tokens) <= set(tok.pieces)
    r = random.Random(2)
    few = lm.Subwords([b" the", b" th", b"ing", b"in", b"ngs"])
    for own in (tok, few):  # longest match, one place after the other
        known = set(own.pieces)
        for _ in range(300):
            w, want = bytes(r.choice(b"thengis-\xc3\xa9") for _ in range(r.randrange(1, 12))), []
            rest = b" " + w
            while rest:
                k = max(k for k in range(1, len(rest) + 1) if rest[:k] in known)
                want.append(own.pieces.index(rest[:k]))
                rest = rest[k:]
            assert own([w]).tolist() == want
    m = lm.Attention(np.ones(50))
    seq = np.arange(1, 24) % 50
    other = np.append(49, seq[1:])
    y, z = (m.forward(np.append(0, s)[None])[0][0, -1] for s in (seq, other))
    assert len(seq) + 1 == lm.WINDOW and not np.array_equal(y, z)  # 22 places further back


def test_lm_spells_each_text_once(odd, monkeypatch):
    """Training, its start and the scores read one table of ids; it has what each text's own spelling has."""
    docs = common.documents(odd)
    pieces = lm.chosen_pieces(lm.word_counts(docs), BYTE_BPE)
    tok = lm.Subwords(pieces)
    table = lm.spelt(docs, pieces)
    want = Counter((i, len(w := t.encode().lower().split()) + 1, tok(w).astype("<i2").tobytes()) for i, t in texts_of(odd))
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in table.collect()) == want
    by_text, by_ids = lm.Attention(np.ones(tok.end + 1)), lm.Attention(np.ones(tok.end + 1))
    assert lm.learn(by_text, docs, pieces) == lm.learn(by_ids, table, pieces)
    assert all(np.array_equal(by_text.p[k], by_ids.p[k]) for k in by_text.p)
    made, spelt = [], lm.spelt
    monkeypatch.setattr(lm, "spelt", lambda *a: made.append(a) or spelt(*a))
    assert lm.scores(odd, BYTE_BPE).count() == odd.count() and len(made) == 1


def test_lm_gradient_and_score_are_those_of_the_plain_form():
    """Also where windows are more or fewer than a chunk, and where earlier calls left larger arrays."""
    m = exact(lm.Attention(np.arange(1.0, 1000)))
    r = np.random.default_rng(4)
    for n in (2 * lm.CHUNK + 3, 1):
        ids, goal = r.integers(0, 999, (n, lm.WINDOW)), r.integers(0, 999, (n, lm.WINDOW))
        y, cache = m.forward(ids)
        plain = m.log_probabilities(y.reshape(-1, lm.CLASSES), cache[-1].reshape(-1, lm.HIDDEN), goal.ravel())
        assert m.gradient(ids, goal)[0] == pytest.approx(-plain.mean(), rel=1e-10)
        ids[:, 0] = 999  # a text of WINDOW - 1 ids after the end is one window
        y, cache = m.forward(ids)
        goal = np.append(ids[:, 1:], np.full((n, 1), 999), axis=1)
        plain = m.log_probabilities(y.reshape(-1, lm.CLASSES), cache[-1].reshape(-1, lm.HIDDEN), goal.ravel()).reshape(n, -1).sum(1)
        assert np.allclose(m.score(list(ids[:, 1:]), 999), plain / np.log(10), rtol=1e-10)


def test_lm_learns_from_every_id(spark):
    rows = [(1, "some plain words " * 1500 + "late zebra quokka " * 40), (2, ""), (3, "short"), (4, "other words again " * 30), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pieces = lm.chosen_pieces(lm.word_counts(docs), BYTE_BPE)
    tok = lm.subwords(pieces)
    assert tok.end < lm.CLASSES * lm.MEMBERS and all(bytes([b]) in pieces for b in range(256))
    ids = [np.append(tok((t or "").encode().lower().split()), tok.end) for _, t in rows]
    assert lm.id_counts(lm.word_counts(docs), pieces, len(rows)).tolist() == np.bincount(np.concatenate(ids), minlength=tok.end + 1).tolist()
    for parts in (1, 3):
        model = lm.Attention(np.ones(tok.end + 1))
        before = model.p["e"].copy()
        assert lm.learn(model, docs.repartition(parts), pieces) == sum(map(len, ids))
        moved = (model.p["e"] != before).any(axis=1)
        assert moved[np.concatenate(ids)].all() and moved.sum() == len(np.unique(np.concatenate(ids)))
        assert all(np.isfinite(x).all() for x in model.p.values())
    windows = lm.start_windows(docs, pieces, sum(len((t or "").split()) + 1 for _, t in rows))
    assert windows.shape[1] == lm.WINDOW + 1 and set(np.concatenate(ids)) == set(np.unique(windows))


def test_lm_pass_gains_wherever_rows_lie(spark, monkeypatch):
    """Held-out texts gain by the pass itself, with one and with several workers a round; partitions change nothing."""
    docs = lm.documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    train, rest = docs.where(lm.fold(F.col("doc_id")) != lm.HELD_OUT).cache(), docs.where(lm.fold(F.col("doc_id")) == lm.HELD_OUT)
    words = lm.word_counts(train)
    n = words.agg(F.sum("n")).first()[0]
    pieces = lm.chosen_pieces(words, BYTE_BPE)
    tok = lm.subwords(pieces)
    start = lm.Attention(lm.id_counts(words, pieces, train.count()))
    start.fit(lm.start_windows(train, pieces, n), steps=300)
    texts = [tok(r["text"].encode().lower().split()) for r in rest.collect()]
    held = lambda m: sum(m.score(texts[i : i + 64], tok.end).sum() for i in range(0, len(texts), 64))
    for size in (lm.WORKER_WORDS, 30_000):
        monkeypatch.setattr(lm, "WORKER_WORDS", size)
        learnt = []
        for parts in (1, 64):
            model = lm.Attention(np.ones(tok.end + 1))
            model.p = {k: v.copy() for k, v in start.p.items()}
            lm.learn(model, train.repartition(parts), pieces, n)
            learnt.append(model)
        assert all(np.array_equal(learnt[0].p[k], learnt[1].p[k]) for k in start.p)
        assert held(learnt[0]) > held(start) * 0.999


def test_lm_beats_counts(spark):
    """On held-out documents, the model is better than its own ids' unigram counts by a quarter of their logarithms, and than
    their bigram counts (backed off to the unigram by the number of kinds that follow)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in lm.scores(docs, BYTE_BPE).collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    rows = [(i, t.encode().lower().split()) for i, t in texts_of(docs)]
    pieces = lm.chosen_pieces(lm.word_counts(docs.where(lm.fold(F.col("doc_id")) != lm.HELD_OUT)), BYTE_BPE)
    tok = lm.subwords(pieces)
    ids = {i: [tok.end, *tok(w).tolist(), tok.end] for i, w in rows}
    one, two = Counter(), Counter()
    for i, s in ids.items():
        if not fold(i):
            one.update(s[1:])
            two.update(zip(s, s[1:], strict=False))
    total, kinds, follow = sum(one.values()), Counter(a for a, _ in two), Counter()
    for (a, _), n in two.items():
        follow[a] += n
    p = lambda b: (one[b] + 1) / (total + 1024)
    pair = lambda a, b: (two[a, b] + kinds[a] * p(b)) / (follow[a] + kinds[a]) if follow[a] else p(b)
    held = [i for i in ids if fold(i)]
    unigram = sum(math.log10(p(b)) for i in held for b in ids[i][1:])
    bigram = sum(math.log10(pair(a, b)) for i in held for a, b in zip(ids[i], ids[i][1:], strict=False))
    model = sum(got[i]["score"] for i in held)
    assert model > 0.75 * unigram and model > bigram


def test_media(odd, none):
    got = {(r["doc_id"], r["n_bytes"]): r for r in media.digests(odd).collect()}
    for i, t in texts_of(odd):
        raw = t.encode()
        padded = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[i, len(raw)]
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(w := media.to_wave(padded)), hashlib.sha256(w).hexdigest())
    assert media.digests(none).count() == 0
    quiet, loud = bytes([128] * 8000), bytes([0, 255] * 0 + [int(128 + 100 * math.sin(i / 3)) for i in range(8000)])
    spans = media.features(quiet + loud + quiet)[1]
    assert len(spans) == 1 and abs(spans[0][0] - 1) < 0.1 and abs(spans[0][1] - 2) < 0.1
    assert media.tensors([np.zeros((media.POOLS, media.BANDS))]).type.shape == [media.POOLS, media.BANDS]


def test_document_of_a_block():
    r = np.random.default_rng(4)
    parts = [r.integers(0, 2 ** int(b), n).astype(np.uint64) for b, n in ((5, 40), (63, 9), (1, 0), (61, 30), (16, 300))]
    words = tokenbin.encode_many(parts)
    ends = np.cumsum([len(w) for w in words])
    offsets = (ends - [len(w) for w in words]).astype("<u8")
    block = {"offsets": offsets.tobytes(), "words": np.concatenate(words).tobytes()}
    assert (tokenbin.decode(np.concatenate(words), offsets) == np.concatenate(parts)).all()
    assert all((tokenbin.document(block, k) == p).all() for k, p in enumerate(parts))


def test_byte_encoder_on_odd_strings():
    """Both splitting patterns, the cache over its generations, and the byte symbols, against the library on whole texts."""
    r = random.Random(3)
    latin = "ab'sre vtm ld²½ªµ\x85\xa0\t\n\x1c\x1d\x7f\xad09_-é×"
    texts = ["".join(r.choice(a) for _ in range(r.randrange(25))) for a in (latin, latin + "日🙂İſ　\u2028") for _ in range(4000)]
    enc, tok = tokenbin.ByteEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    want = [np.asarray(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert enc(texts) == want
    enc.words, enc.old = {}, enc.words
    assert enc(texts) == want


def test_batches_of_a_task_are_in_the_systems_memory(spark):
    import pyarrow as pa

    def name(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"pool": [pa.default_memory_pool().backend_name]})

    assert {r.pool for r in common.map_arrow(spark.range(3), name, "pool string").collect()} == {"system"}


def test_byte_encoder_reads_many_words_in_one_call():
    enc, calls = tokenbin.ByteEncoder(BYTE_BPE), []
    model = enc.model
    want = [enc.word(f" w{i}xé") for i in range(1000)]
    enc.model = type("Counted", (), {"tokenize": lambda self, symbols: calls.append(1) or model.tokenize(symbols)})()
    assert enc([" ".join([""] + [f"w{i}xé" for i in range(1000)])]) == [b"".join(enc.encoded([w for i in range(1000) for w in enc.split(f" w{i}xé")]))]
    assert len(calls) < 50 and enc.encoded([f" w{i}xé" for i in range(1000)]) == want


def test_blocks_of_token_files_are_not_shuffled_to_their_starts(odd, spark, tmp_path):
    tokenbin.write(odd, BYTE_BPE, f"{tmp_path}/t")
    plan = tokenbin.read(spark, f"{tmp_path}/t")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan.split("== Physical Plan ==")[1] and "SortMergeJoin [shard" not in plan


def test_media_table(odd):
    """Blocks keep the tensor's type, and equal texts have equal values."""
    rows = [media.opened(bytes(r["block"])) for r in media.store(odd).collect()]
    assert sum(b.num_rows for b in rows) == odd.count()
    for b in rows:
        assert b.schema.field("tensor").type == pa.fixed_shape_tensor(pa.float32(), (media.POOLS, media.BANDS))
        for m, t, spans in zip(b.column(1).to_pylist(), b.column(2).to_numpy_ndarray(), b.column(3).to_pylist(), strict=True):
            tensor, found = media.features(media.from_wave(m))
            assert np.array_equal(t, tensor.astype(np.float32)) and [(s["start"], s["end"]) for s in spans] == found
    by = {}
    for r in media.digests(odd.repartition(3)).collect():
        by.setdefault(r["payload_sha256"], set()).add((r["feature"], r["media_sha256"]))
    assert all(len(v) == 1 for v in by.values())


def test_media_features_against_loops():
    """Resampling, filterbanks and the gate, one number after the other."""
    raw = bytes(np.random.default_rng(7).integers(60, 200, 4000, dtype=np.uint8)) + bytes([128] * 3000)
    x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    taps = media.LOWPASS.astype(float)
    n = -(-len(x) // 2)
    y = media.resampled(x.astype(np.float32))
    full = np.convolve(np.append(x, np.zeros(media.TAPS * 2)), taps)
    want = [full[2 * (i + media.TAPS // 2) + 1] for i in range(n - media.TAPS)]
    assert np.allclose(y[: n - media.TAPS], want, atol=1e-4)
    power = []
    for s in range(0, len(y) - media.FRAME + 1, media.HOP):
        f = np.fft.rfft(y[s : s + media.FRAME].astype(float) * media.WINDOW)
        power.append(np.abs(f) ** 2)
    power = np.array(power)
    mel = np.log10(np.maximum(power @ media.MEL.astype(float), 1e-8))
    cuts = np.linspace(0, len(mel), media.POOLS + 1).astype(int)
    tensor, spans = media.features(raw)
    assert np.allclose(tensor, [mel[a : max(b, a + 1)].mean(axis=0) for a, b in zip(cuts, cuts[1:], strict=False)], atol=1e-3)
    level = 10 * np.log10(np.maximum(power.sum(axis=1), 1e-8))
    level -= level.mean()
    on, state, second = [], False, media.HOP * media.DOWN / media.RATE
    for v in level:
        state = True if v > media.OPEN_DB else False if v < media.CLOSE_DB else state
        on.append(state)
    want = [(round(a * second, 3), round(b * second, 3)) for a, b in ((i, next((j for j in range(i, len(on)) if not on[j]), len(on))) for i in range(len(on)) if on[i] and (not i or not on[i - 1]))]
    assert spans == want and spans


def test_ann_recall_and_exactness(spark):
    """Thousands of vectors without clusters: the recall of the default, and equality of a recall of 1, copies and all."""
    r = np.random.default_rng(5)
    x = r.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1000:1400] = x[20]  # more copies than a shortlist
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = {}
    for q in range(0, 3000, 60):
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        want[q] = np.lexsort((np.arange(3000), -score))[:20].tolist()
    for recall in (ann.RECALL, 1.0):
        got = {}
        for row in ann.search(df, every=60, recall=recall).orderBy("query_id", "rank").collect():
            got.setdefault(row["query_id"], []).append(row["vec_id"])
        share = sum(len(set(got[q]) & set(w)) for q, w in want.items()) / (20 * len(want))
        assert share >= 0.9 and got[1020] == want[1020]
    assert got == want  # exact


def test_ann_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [0.0, 1.0])]
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in ann.search(spark.createDataFrame(order, "vec_id long, embedding array<double>")).orderBy("rank").collect()]
        assert got == [(0, 1, 1, 1.5), (0, 2, 2, 0.5)]  # the smaller vector asks, the better one answers


def test_ann(spark):
    r = np.random.default_rng(3)
    x = np.round(r.standard_normal((700, 8)), 2)
    x[100:300] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (720, [0.0] * 8), (740, [float("nan")] * 8), (760, [None] * 8), (780, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("list", F.lit(1))
    found = {}
    for q in ann.search(df).collect():
        found.setdefault(q["query_id"], []).append((q["rank"], q["vec_id"], q["score"]))
    hits = 0
    assert set(found) == set(range(0, 700, 20))
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21)) and [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        assert all(s == pytest.approx(float((x[v] * x[q]).sum())) for _, v, s in got)
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({g[1] for g in got} & set(np.lexsort((np.arange(700), -score))[:20].tolist()))
    assert hits / (20 * len(found)) >= 0.9
    assert ann.search(df.where("vec_id < 0")).count() == 0 and ann.search(df.where("vec_id = 0")).count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against what it is to do with what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.toxic_out(spark, docs, SF).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in texts_of(docs) if model.score([t])[0] < 0.5}
    one = corpus_pipeline.one_of_each_group(spark, clean, SF).cache()
    assert Counter(r["doc_id"] for r in one.collect()) == Counter({c for _, _, c in components(texts_of(clean))})
    mix = corpus_pipeline.mixed(spark, one, SF).cache()
    assert mix.columns == docs.columns and Counter(r["doc_id"] for r in mix.collect()) == Counter({r["doc_id"]: r["copies"] for r in mixing.mix(one).collect() if r["copies"]})
    assert corpus_pipeline.encoded(spark, mix, SF).count() == mix.count()
    assert len(corpus_pipeline.STAGES) == 4


def test_pipeline_edges(spark, odd, none, tmp_path):
    """Null and repeated ids, null texts, ties, clashing columns and empty tables go through all stages."""
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path)).cache()
            assert kept.columns == docs.columns
        assert corpus_pipeline.encoded(spark, kept, str(tmp_path)).count() == kept.count()
    one = corpus_pipeline.one_of_each_group(spark, odd, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in one]
    assert ids.count(None) == 1 and len(set(ids)) == len(ids)  # six and seven are equal, as are the rows of four
    assert Counter(ids) == Counter({c for i, _, c in components(texts_of(odd)) if i is not None}) + Counter([None])
    two = spark.createDataFrame([(5, "b words here", 1), (5, "a words here", 2), (5, None, 3)], "doc_id long, text string, k int")
    assert [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, two, str(tmp_path)).collect()] == [(5, "a words here", 2)]


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert json.loads(Path(WORD_BPE).read_text())["model"]["type"] == "BPE"
