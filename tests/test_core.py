import hashlib
import io
import itertools
import json
import os
import random
import re
import shutil
import subprocess
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusmill import queries as core
from corpusmill.functions import brackets, literals, render, rules
from corpusmill.operators import dialogue, neardup, records, report, sampling, schema, score, synthesis, teacher, validate
from corpusmill.plans import config, session
from corpusmill.sources import files, lines
from corpusmill.streaming import events, first, sink


def values(spark, column, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", column.alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


def balance(text):
    """The bracket rule, one character at a time."""
    stack, quote, skip = [], "", False
    for c in text:
        if skip:
            skip = False
        elif c == "\\":
            skip = True
        elif quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "([{":
            stack.append(c)
        elif c in ")]}" and (not stack or stack.pop() != "([{"[")]}".index(c)]):
            return False
    return not stack


def test_brackets(spark):
    r = random.Random(3)
    texts = ["".join(r.choice("([{}])'\"`\\ax\n") for _ in range(r.randrange(14))) for _ in range(500)]
    assert [x["passed"] for x in values(spark, validate.javascript(F.col("t")), texts)] == [balance(t) for t in texts]


def test_security(spark):
    real, sample = "password = 'zq81kk'", "example message: password = 'zq81kk'"
    got = values(spark, validate.security(F.col("t")), [real, sample, "a\nselect a from t where b = '' + x", "nothing", "\n\nsecret: 'q9'"])
    assert [(x["passed"], x["error_detail"], x["line_number"]) for x in got] == [(False, "Hardcoded password", 1), (True, None, None), (False, "Possible SQL injection", 2), (True, None, None), (False, "Hardcoded secret", 3)]


def test_xml_and_fhir(spark):
    assert [x["passed"] for x in values(spark, validate.xml(F.col("t")), ["<a/>", "<a></b>", "<a/>x", "<a/><b/>", "<a>&no;</a>", "x"])] == [True, False, False, False, False, False]
    assert [x["passed"] for x in values(spark, validate.fhir(F.col("t")), ['{"resourceType":"A"}', '{"resourceType":""}', "{}", "[1]", "{"])] == [True, False, False, False, False]


@pytest.mark.parametrize("kind,segments", list(validate.REQUIRED_SEGMENTS.items()))
def test_hl7(spark, kind, segments):
    head = f"MSH|^~\\&|A|B|C|D|2020||{kind}^X|1|P|2.3"
    texts = ["\n".join([head, *(f"{s}|1" for s in segments[1:] if s != gone)]) for gone in [None, *segments[1:]]]
    assert [x["passed"] for x in values(spark, validate.hl7(F.col("t")), texts)] == [True] + [False] * (len(segments) - 1)
    assert not values(spark, validate.hl7(F.col("t")), [texts[0].replace("\n", "\r")])[0]["passed"]


def test_leaders(spark):
    """Against all pairs in order."""
    r = random.Random(5)
    base = ["".join(r.choice("abcd ") for _ in range(150)) for _ in range(4)]
    texts = [t if r.random() < 0.2 else t[: (k := r.randrange(150))] + "x" + t[k + r.randrange(3) :] for t in base for _ in range(12)] + ["abc", "abc", "", ""]
    rows = [(i, ("p", "q")[i % 2], t) for i, t in enumerate(texts)]
    sets = [set(neardup.shingle_hashes(t).tolist()) for t in texts]
    gone = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        if i not in gone and j not in gone and rows[i][1] == rows[j][1] and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.9:
            gone.add(j)
    df = spark.createDataFrame(rows, "id long, domain string, text string")
    assert {x["id"] for x in neardup.leaders(df, "id", "domain", "text").collect()} == gone


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.9, 0.97, 1.0])
def test_segment_keys(threshold):
    """Sets whose similarity reaches the threshold share a key of the same class, whatever their sizes; others seldom do."""
    r = np.random.default_rng(3)
    met = others = 0
    top = (1 << 64) - 1
    for n in [*range(1, 40), *range(40, 1500, 37)]:
        common = r.integers(0, top, n, dtype=np.uint64)
        for more in {0, 1, 2, int(n * (1 / threshold - 1)), int(n * (1 / threshold - 1)) + 3, n}:
            for k in {0, more // 2, more}:
                x = np.unique(np.concatenate([common, r.integers(0, top, k, dtype=np.uint64)]))
                y = np.unique(np.concatenate([common, r.integers(0, top, more - k, dtype=np.uint64)]))
                shared = set(neardup.keys(x, threshold).tolist()) & set(neardup.keys(y, threshold).tolist()) - {0}
                assert shared or len(common) < threshold * len(np.union1d(x, y))
        met += bool(set(neardup.keys(x, threshold).tolist()) & set(neardup.keys(r.integers(0, top, len(x), dtype=np.uint64), threshold).tolist()) - {0})
        others += 1
    assert met <= {0.6: others, 0.8: 3}.get(threshold, 0)


def test_frequent_shingles_make_no_lists(spark):
    """A shingle in 3,000 distinct texts: hardly any two rows meet."""
    r = random.Random(3)
    rows = [(i, "p", "licensed under " + " ".join(f"{r.randrange(10**6)}" for _ in range(30))) for i in range(3000)] + [(5000, "p", None), (None, "p", "x")]
    rows += [(6000, "p", rows[7][2] + "."), (6001, "q", rows[7][2] + ".")]
    join = neardup._Join(spark.createDataFrame(rows, "id long, domain string, text string"), "id", "domain", "text", 0.9)
    entries, longest = join.met()
    assert longest < 40 and join.candidates(entries).count() < 1500  # of 4.5 million pairs
    assert [tuple(x) for x in neardup._leaders(join).collect()] == [(6000,)]


def test_leader_index(spark, tmp_path):
    """Batches one after the other, with one of them added twice and an index that is opened again, against one run."""
    r = random.Random(9)
    base = ["".join(r.choice("abcdefg ") for _ in range(300)) for _ in range(8)]
    rows = [(i, r.choice(["p", None]), t if r.random() < 0.2 else t[: (k := r.randrange(300))] + "x" + t[k + r.randrange(3) :]) for i, t in enumerate(base * 12)] + [(200, "p", None), (201, "p", " "), (202, "p", "ab"), (203, "p", "ab"), (None, "p", base[0])]
    df = spark.createDataFrame(rows, "id long, domain string, text string").withColumns({"h": F.lit(1), "c": F.lit("x"), "batch": F.lit(9)})
    want = {x["id"] for x in neardup.leaders(df, "id", "domain", "text").collect()}
    parts = [df.where("id is null or id < 30"), df.where("id between 30 and 50"), df.where("id > 1000"), df.where("id > 50")]
    got = []
    for k, part in enumerate(parts):
        index = neardup.LeaderIndex(spark, str(tmp_path), buckets=3)
        index.add(part, "id", "domain", "text", k)  # as if it had failed after its last write
        got += [x["id"] for x in index.add(part, "id", "domain", "text", k).collect()]
    assert sorted(got) == sorted(want) and len(want) > 20
    assert spark.table(index.sets).count() == len({i for i, *_ in rows if i is not None} - want - {200, 201})
    with pytest.raises(ValueError):
        index.add(parts[0], "id", "domain", "text", 0)
    prints = neardup._prints(neardup._rows(parts[3], "id", "domain", "text"), 0.9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.pairs(prints, 9)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(h#") == 1  # the new rows alone


def test_dialogue(spark):
    texts = ["x\nUSER: a\nmore\nassistant: b\nUSER: c", "ASSISTANT: a\nUSER: b", "USER: a", "USER:\nASSISTANT: b", "USER: a\nASSISTANT: b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: [(t["role"], t["content"]) for t in r["turns"]] for r in dialogue.parse(df, "id", "t").collect()}
    assert got == {0: [("user", "a\nmore"), ("assistant", "b")], 4: [("user", "a"), ("assistant", "b")]}


def test_render(spark):
    row = spark.range(1).select(render.single_turn(F.lit("i"), F.lit("x"), F.lit("o"), F.lit("c"), "chatml", "s").alias("a"), render.user_prompt(render.single_turn(F.lit(" q "), F.lit(""), F.lit("o"))).alias("b"), render.split_cot(F.lit("<think>a</think> b ")).alias("c")).first()
    assert row["a"] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\ni\n\nx<|im_end|>\n<|im_start|>assistant\n<think>\nc\n</think>\n\no<|im_end|>"
    assert row["b"] == "q" and tuple(row["c"]) == ("a", "b")


def test_scores_and_pairs(spark):
    texts = ["a" * n for n in (49, 50, 100, 101, 500, 501)]
    assert values(spark, F.round(score.quality(F.col("t"), F.lit(True)), 4), texts) == [0.3, 0.5, 0.5, 0.65, 0.65, 0.75]
    assert values(spark, score.reward(F.col("t")), ["", "plain", "f(x)", "f(x", "<a/>", '{"resourceType":"A"}']) == [0.0, 0.5, 0.25, 0.0, 0.25, 0.5]
    p = spark.createDataFrame([(1, " q", " x "), (2, "q", "y"), (3, " ", "z")], "o int, instruction string, output string")
    f = spark.createDataFrame([(1, "q ", " bad "), (2, "q", "worse"), (3, "r", "no")], "o int, instruction string, output string")
    assert sorted(map(tuple, score.preference_pairs(p, f, "o").collect())) == [("q", " x ", "bad"), ("q", " x ", "worse")]
    c = spark.createDataFrame([("a", i, s, f"{i}") for i, s in enumerate((1.0, 2.0, 2.0, 1.0))] + [("b", 0, 1.0, "0")], "p string, i int, s double, o string")
    assert [tuple(r)[:3] for r in score.best_of(c, "p", "i", "s", "o").collect()] == [("a", "1", "3")]


def test_sampling(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"] for r in sampling.exact_fraction(df, "k", 0.2).collect()}
    assert len(a) == 200 and a == {r["k"] for r in sampling.exact_fraction(df.repartition(7), "k", 0.2).collect()}
    assert sampling.cycled(spark.range(3), "id", 8).count() == 8
    plan = spark.createDataFrame([("a",), ("b",)], "prompt string")
    seen = sampling.synthesize(plan, "prompt", lambda p: p * 3 if p == "a" else "", least=2).collect()
    assert [tuple(r) for r in seen] == [("a", "aaa")]


def test_files(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"instruction": 1, "other": 2}\n\n[1,2]\n{broken\n{"instruction": null}\n')
    rows = files.read_jsonl(spark, str(p), "instruction string").collect()
    assert sorted(r["state"] for r in rows) == ["blank", "malformed", "malformed", "ok", "ok"]
    (tmp_path / "docs/one").mkdir(parents=True)
    (tmp_path / "docs/one/a.md").write_text("some text that is long enough")
    (tmp_path / "docs/one/b.html").write_text("<p>shown text that is long</p><script>hidden</script>")
    (tmp_path / "docs/one/c.json").write_text('{"openapi":"3","info":{"title":"T","version":"1"},"paths":{"/a":{"get":{"summary":"s","parameters":[{"name":"p"}],"description":"d"}}}}')
    got = {r["path"].rsplit("/", 1)[-1]: (r["domain"], r["text"]) for r in files.read_docs(spark, str(tmp_path / "docs")).collect()}
    assert got == {"a.md": ("one", "some text that is long enough"), "b.html": ("one", "shown text that is long"), "c.json": ("one", "API: T (v1)\n\n  GET /a — s (params: p)\n    d")}
    assert len(files.scan_repos(spark, str(tmp_path / "docs"), ["*.md"]).collect()) == 1


def test_records(spark):
    t = [("a", "x"), ("b", "X "), ("c", None), ("d", None)]
    df = spark.createDataFrame(t, "k string, t string")
    assert {r["k"] for r in records.exact_dedup(df, "t", "k").collect()} == {"a", "c", "d"}
    assert values(spark, rules.fill_template(F.lit("{a} {b} {c}"), {"a": ("1",), "b": ("2",)}, F.col("i")), ["x"]) == ["1 2 {c}"]


def test_config(tmp_path):
    good = {"cleaning": {"similarity_threshold": "0.8", "odd": 1}, "validation": {}, "synthesis": {"primary_model": "m"}, "scraping": {}}
    c = config.from_dict(good)
    assert c.cleaning.similarity_threshold == 0.8
    config.save(c, tmp_path / "c.yaml")
    assert config.load(tmp_path / "c.yaml") == c
    for section in good:
        with pytest.raises(config.ConfigError, match=section):
            config.from_dict({k: v for k, v in good.items() if k != section})
    with pytest.raises(config.ConfigError, match="primary_model"):
        config.from_dict(good | {"synthesis": {}})


def test_stream(spark, tmp_path):
    from corpusmill.streaming import events

    spark.createDataFrame([("f(", "x"), ("ok()", "x")], "output string, domain string").write.parquet(str(tmp_path / "in"))
    seen = []
    s = events.validated(events.read_parquet_stream(spark, str(tmp_path / "in"), "output string, domain string"))
    events.run_available(s, str(tmp_path / "cp"), lambda df, _: seen.extend(r["validation"]["passed"] for r in df.collect())).awaitTermination()
    assert sorted(seen) == [False, True]


def test_xml_wf_reads_all_documents(spark, tmp_path):
    texts = ["<a><b/></a>", "<a>" + "<b/>" * 3000 + "</c>", "plain", "", None, " <x>y</x>"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"]: r["passed"] for r in entry.queries()["xml_wf"](spark, str(tmp_path)).collect()}
    assert got == {4: True, 5: False, 6: False, -1: True, -2: False, -3: False, -4: False, -5: False, -6: True}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",), ("corpusmill/llm/__pycache__/x.pyc",)])
def test_entry_without_the_llm_folder(tmp_path, left):
    """The other queries register in a copy of the repository without that folder, whatever was left beside it."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "corpusmill", tmp_path / "corpusmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    for name in left:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("from corpusmill.llm import bpe\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [k for k in e.queries() if k[:2] == 'op' and k[2:3].isdigit() or k == 'pipeline'])"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert said.stdout.split()[2:] == ["[]"] and int(said.stdout.split()[0]) == len(core.QUERIES), said.stderr


def test_bracket_places(spark):
    r = random.Random(11)
    texts = ["".join(r.choice("([{}])'\"`\\ax\n") for _ in range(r.randrange(18))) for _ in range(800)] + ["a\n)", "\\", "'(", "({\n]"]

    def place(text):
        stack, quote, skip = [], "", False
        for i, c in enumerate(text):
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif quote:
                quote = "" if c == quote else quote
            elif c in "'\"`":
                quote = c
            elif c in "([{":
                stack.append(c)
            elif c in ")]}" and (not stack or stack.pop() != "([{"[")]}".index(c)]):
                return i
        return -1

    assert [validate.first_unmatched(t) for t in texts] == [place(t) for t in texts]
    got = values(spark, validate.javascript(F.col("t")), texts)
    for t, x in zip(texts, got, strict=True):
        at = place(t)
        if at >= 0:
            assert x["error_detail"] == f"Unmatched '{t[at]}' at position {at}" and x["line_number"] == t[:at].count("\n") + 1
        else:
            assert x["passed"] == balance(t) and x["line_number"] is None


def test_brackets_merge_in_any_grouping(spark, monkeypatch):
    """Long and deep texts, whose stretches are folded and merged, against a stack; spans of 1, 3 and 32 brackets."""
    r = random.Random(5)

    def nested(n):
        out, stack = [], []
        for _ in range(n):
            if stack and r.random() < 0.48:
                out.append(")]}"["([{".index(stack.pop())])
            else:
                stack.append(r.choice("([{"))
                out.append(stack[-1] + r.choice(["", "\n", " x '(' "]))
        return "".join(out + [")]}"["([{".index(c)] for c in reversed(stack)])

    whole = [nested(r.randrange(1, 700)) for _ in range(60)]
    texts = whole + [t[:k] + r.choice(")]}") + t[k:] for t in whole for k in [r.randrange(len(t))]] + [t[: len(t) // 2] for t in whole] + ["(" * 5000 + ")" * 5000, "[" * 4999 + "\n)"]
    for span in (1, 3, 32):
        monkeypatch.setattr(brackets, "SPAN", span)
        got = values(spark, validate.javascript(F.col("t")), texts)
        assert [x["passed"] for x in got] == [balance(t) for t in texts]
        for t, x in zip(texts, got, strict=True):
            at = validate.first_unmatched(t)
            assert x["line_number"] == (None if at < 0 else t[:at].count("\n") + 1)
            assert at < 0 or x["error_detail"].endswith(f"'{t[at]}' at position {at}")
    assert values(spark, validate.javascript(F.col("t")), [None])[0]["passed"]


def test_validated_agrees_with_example(spark):
    texts = ["", "  ", "f(", "f(x)", "a\n)", "<a/>", "<a></b>", "<!DOCTYPE a><a/>", "<a><![CDATA[<!DOCTYPE x>]]></a>", '<!DOCTYPE a [<!ENTITY b "c">]><a>&b;</a>', '{"resourceType":"A"}', '{"a":1}', "MSH|^~\\&|A", "password = 'zq81kk'", None]
    rows = spark.createDataFrame([(i, t, d) for i, t in enumerate(texts) for d in ("hl7v2", "math", None)], "i int, t string, d string")
    both = validate.validated(rows, "t", "d").withColumn("one", validate.example(F.col("t"), F.col("d"))).collect()
    assert all(r["_r"] == r["one"] for r in both)
    passed = {r["t"]: r["_r"]["passed"] for r in both if r["d"] is None}
    assert passed["<!DOCTYPE a><a/>"] and passed["<a><![CDATA[<!DOCTYPE x>]]></a>"] and not passed[texts[9]] and not passed[None]
    ok, bad = validate.split(validate.validated(rows, "t", "d"), "_r")
    assert ok.columns == rows.columns and ok.count() + bad.count() == rows.count()
    total = validate.report(validate.validated(rows.where("false"), "t", "d"), "_r").first()
    assert tuple(total)[:3] == (0, 0, 0)


def test_similar_pairs_settled_first(spark, monkeypatch):
    """Groups of near copies with long lists, against all pairs in order."""
    monkeypatch.setattr(neardup, "LONG_LIST", 4)
    r = random.Random(6)
    base = ["".join(r.choice("abcdefg ") for _ in range(200)) for _ in range(3)]
    rows = [(i, None if i % 3 == 0 else "p", t if r.random() < 0.2 else t[: (k := r.randrange(200))] + "x" + t[k + 1 :]) for i, t in enumerate(base * 14)] + [(90, "p", None), (91, "p", " "), (92, "p", "ab"), (93, "p", "ab")]
    sets = {i: set(neardup.shingle_hashes(t).tolist()) for i, _, t in rows}
    gone, pairs = set(), set()
    for (i, d, _), (j, e, _) in itertools.combinations(rows, 2):
        if d == e and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.9:
            pairs.add((i, j))
            if i not in gone and j not in gone:
                gone.add(j)
    df = spark.createDataFrame(rows, "id long, domain string, text string")
    assert {tuple(x) for x in neardup.similar_pairs(df, "id", "domain", "text").collect()} == pairs
    assert {x["id"] for x in neardup.leaders(df, "id", "domain", "text").collect()} == gone and gone
    assert neardup.leaders(df.where("id < 0"), "id", "domain", "text").count() == 0


def test_orders_and_quotas(spark):
    df = spark.range(500).withColumnRenamed("id", "k").withColumn("g", F.when(F.col("k") % 50 == 0, "b").when(F.col("k") < 480, "a"))
    order = sorted(range(500), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    for n in (0, 1, 77, 500, 900):
        assert {x["k"] for x in sampling.first_in_order(df, "k", n).collect()} == set(order[:n])
    got = sampling.stratified(df, "k", "g", {"a": 30, "b": 100}).collect()
    own = {g: [k for k in order if (("b" if k % 50 == 0 else "a") if k < 480 or k % 50 == 0 else None) == g] for g in "ab"}
    assert {g: {x["k"] for x in got if x["g"] == g} for g in "ab"} == {"a": set(own["a"][:30]), "b": set(own["b"])}
    assert [x["k"] for x in sampling.numbered(df, "k").orderBy("place").collect()] == order == [x["k"] for x in sampling.shuffled(df, "k").collect()]
    for n in (3, 500, 1203):
        copies = Counter(x["k"] for x in sampling.cycled(df, "k", n).collect())
        assert sum(copies.values()) == n and copies == Counter({k: n // 500 + (i < n % 500) for i, k in enumerate(order)})
    assert sampling.cycled(df.where("k < 0"), "k", 5).count() == 0
    keys = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    assert {x["x"]: x["quota"] for x in sampling.balanced(keys, 8, "x").collect()} == {None: 3, "a": 3, "b": 2}


def test_sources_in_order(spark, tmp_path):
    for name, lines in (("b", ['{"k":1}', "", '{"k":2}']), ("a", ['{"k":3}', "[1]"])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    with pytest.warns(UserWarning, match="no file"):
        rows = files.read_jsonl(spark, [f"{tmp_path}/b.jsonl", f"{tmp_path}/none.jsonl", f"{tmp_path}/a.jsonl"], "k int")
    assert [(x["state"], x["record"] and x["record"]["k"]) for x in rows.orderBy(*files.INPUT_ORDER).collect()] == [("ok", 1), ("blank", None), ("ok", 2), ("ok", 3), ("malformed", None)]
    assert [x["file_ord"] for x in rows.orderBy(*files.INPUT_ORDER).collect()] == [0, 0, 0, 1, 1]
    globbed = files.read_jsonl(spark, f"{tmp_path}/*.jsonl", "k int").where("state = 'ok'").orderBy(*files.INPUT_ORDER).collect()
    assert [x["record"]["k"] for x in globbed] == [3, 1, 2]
    with pytest.warns(UserWarning, match="no file"):
        assert files.read_jsonl(spark, f"{tmp_path}/none", "k int").count() == 0
    out = spark.createDataFrame([(1, None)], "a int, b string")
    files.write_jsonl(out, f"{tmp_path}/x")
    files.write_jsonl(out, f"{tmp_path}/y", nulls=True)
    assert [x["value"] for x in spark.read.text(f"{tmp_path}/x").collect()] == ['{"a":1}'] and [x["value"] for x in spark.read.text(f"{tmp_path}/y").collect()] == ['{"a":1,"b":null}']
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/x.pdf").write_bytes(b"%PDF-1.4 damaged")
    (tmp_path / "d/e/y.txt").write_text("a text that is long enough")
    assert [x["path"].rsplit("/", 1)[-1] for x in files.read_docs(spark, f"{tmp_path}/d").collect()] == ["y.txt"]


def test_repositories(spark, tmp_path):
    for name, text in (("one/a.py", "x = 1  # some code here"), ("one/b.py", "y = 2  # some code here"), ("one/.git/c.py", "z = 3  # some code here"), ("two/a.py", "my secret key: 12345678901"), ("two/b.js", "var a = 1; // some code here"), ("two/short.py", "x")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    with pytest.warns(UserWarning, match="left out"):
        got = files.scan_repos(spark, str(tmp_path), ["*.py", "[a-b].js"], private=["SECRET key", "(open"]).collect()
    assert sorted(x["path"].rsplit("/", 2)[-2] + "/" + x["path"].rsplit("/", 1)[-1] for x in got) == ["one/a.py", "one/b.py", "two/b.js"]
    assert len(files.scan_repos(spark, str(tmp_path), ["*.py"], per_repo=1, private=["secret"]).collect()) == 1
    assert all(x["instruction"].startswith("Explain this ") for x in got)


def test_conversations_from_json(spark):
    lines = ['{"turns":[{"role":"user","content":"a"},{"role":"assistant","content":null}]}', '{"turns":[{"role":"user","content":"a"}]}', '{"turns":[{"role":"user"},{"role":"assistant","content":"b"}]}', '{"turns":["x","y"]}', '{"turns":3}', "{", '{"turns":[{"role":"user","content":1},{"role":"user","content":"b","more":2}]}']
    got = values(spark, records.conversation_from_json(F.col("t")), lines)
    assert [g and [(t["role"], t["content"]) for t in g] for g in got] == [[("user", "a"), ("assistant", "")], None, None, None, None, None, [("user", "1"), ("user", "b")]]
    turns = F.from_json("t", "array<struct<role:string,content:string>>")
    conv = ['[{"role":"user","content":"a"},{"role":"user","content":"B"},{"role":"assistant","content":" "}]', "[]", None]
    assert values(spark, records.last_content(turns), conv) == ["B", "", ""]
    assert values(spark, records.conversation_empty(turns), conv)[:2] == [False, True]
    assert values(spark, records.conversation_attributed(turns, ["a\nb"]), conv)[:2] == [True, False]


def test_dialogue_edges(spark):
    texts = ["USER: a\nASSISTANT: b\nUSER:", "USER: a\nASSISTANT:\nUSER: c", "user: a\n assistant: b \n\nmore\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: [(t["role"], t["content"]) for t in r["turns"]] for r in dialogue.parse(df, "id", "t").collect()}
    assert got == {0: [("user", "a"), ("assistant", "b")], 2: [("user", "a"), ("assistant", "b\n\nmore")]}


def test_synthesis(spark):
    calls = {"n": 0}

    def flaky(prompt):
        calls["n"] += 1
        if calls["n"] % 2:
            raise OSError
        return f"<think>t</think> {prompt.rpartition(': ')[2]} "

    plan = spark.createDataFrame([(1, "ask"), (2, "tell")], "k int, instruction string").coalesce(1)
    assert [(x["output"], x["cot_trace"], x["version"]) for x in synthesis.answers(plan, flaky).orderBy("k").collect()] == [("ask", "t", "synthetic-v1"), ("tell", "t", "synthetic-v1")]
    assert synthesis.answers(plan, lambda p: "x" * 100, least=100).count() == 0 and synthesis.answers(plan, lambda p: "x" * 101, least=100).count() == 2
    shape = "k int, domain string, scenario_type string, description string, outline array<struct<role:string,summary:string>>"
    scenes = spark.createDataFrame([(1, "d", "fix", "a bug", [("user", "asks"), ("assistant", "helps")]), (2, "d", "fix", "none", [("user", "asks")])], shape)

    def talk(prompt):
        return "USER: hi\nASSISTANT: hello\nUSER: bye" if "  ASSISTANT: helps" in prompt else "nothing"

    got = synthesis.conversations(scenes, "k", talk).collect()
    assert [(x["k"], x["scenario_type"], len(x["turns"]), x["version"]) for x in got] == [(1, "fix", 2, "conversation-v1")]
    kinds = [("a", "x", 30, ["{p} one", "{p} two"], {"p": ("1", "2")}), ("b", "y", 30, ["{n"], {"n": ("int", 1, 2)})]
    rows = synthesis.prompt_plan(spark, kinds, 50, existing=10).collect()
    assert len(rows) == 40 and {x["prompt"] for x in rows} <= {"1 one", "2 one", "1 two", "2 two", "{n"}
    assert synthesis.prompt_plan(spark, kinds, 5, existing=10).count() == 0


def test_numbers_and_variations(spark):
    rules_ = {"a": ("int", 3, 5), "b": ("choice", (10, 20)), "c": ("decimal", 0.5, 1.5, 2), "d": ("sorted", 4, 1, 9)}
    got = [x.split("|") for x in values(spark, rules.fill_numbers("{a}|{a}|{b}|{c}|{d}", rules_, F.col("i")), ["x"] * 200)]
    assert all(p[0] == p[1] and p[0] in "345" and p[2] in ("10", "20") and 0.5 <= float(p[3]) <= 1.5 and len(p[3]) == 4 for p in got)
    assert all((n := [int(x) for x in p[4].split(", ")]) == sorted(n) and len(n) == 4 for p in got) and len({p[0] for p in got}) == 3
    assert values(spark, rules.variations(F.col("t")), ["Who?", "Say it.", None])[:2] == [["Who?", "Say, who?", "I wonder, who?", "Quick question: who?", "Please who"], ["Say it.", "Please say it"]]


def test_windows_and_first_seen(spark, tmp_path):
    from corpusmill.streaming import events

    spark.createDataFrame([("A ", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("b", "2024-01-01 00:30:00")], "t string, at string").selectExpr("t", "cast(at as timestamp) as at").coalesce(1).write.parquet(f"{tmp_path}/in")
    seen = []
    s = events.first_seen(events.read_parquet_stream(spark, f"{tmp_path}/in", "t string, at timestamp"), "t", "at")
    events.run_available(s, f"{tmp_path}/cp", lambda df, _: seen.extend(r["t"].strip().lower() for r in df.collect())).awaitTermination()
    assert sorted(seen) == ["a", "b"]


def test_context_pack_and_crossed(spark):
    r = random.Random(14)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, "", "x" * r.randrange(1, 9), "long " * 5])) for i in range(400)] + [(900, "c", ""), (901, "d", "y")]
    want = {}
    for domain in ("a", "b", "c", "d", None):
        taken, parts = 0, []
        for _, d, t in rows:
            if d == domain and taken < 60:
                parts.append((t or "")[:7])
                taken += len(parts[-1])
        want[domain] = ("\n---\n".join(parts), len(parts))
    df = spark.createDataFrame(rows, "o int, d string, t string")
    assert {x["d"]: (x["context"], x["n_parts"]) for x in files.context_pack(df.repartition(5), "d", "o", "t", 7, 60).collect()} == want
    assert files.context_pack(df.where("o < 0"), "d", "o", "t").count() == 0
    names = spark.createDataFrame([("p",), (None,)], "n string")
    assert sorted((x["o"], x["n"] or "") for x in sampling.crossed(df.where("o < 2").select("o"), names, "n").collect()) == [(0, ""), (0, "p"), (1, ""), (1, "p")]
    with pytest.raises(ValueError):
        sampling.crossed(df, df, "o", most=5)
    assert [(x["sample"], x["temperature"]) for x in synthesis.samples(names.limit(1), 3).collect()] == [(0, 0.3), (1, 0.35), (2, 0.4)]


def breaks(v, s, root=None, depth=8):
    """Whether a JSON value breaks a schema, by a plain interpreter."""
    root = s if root is None else root
    if isinstance(s, bool):
        return not s
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    kinds = {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and v == int(v)}
    same = lambda a, b: json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True) or (not isinstance(a, bool) and not isinstance(b, bool) and isinstance(a, (int, float)) and a == b)
    again = lambda x, t: breaks(x, t, root, depth)
    if "$ref" in s and depth:
        at = root
        for part in s["$ref"][2:].split("/"):
            at = at[part]
        if breaks(v, at, root, depth - 1):
            return True
    tests = {
        "type": lambda k: not any(kinds[x] for x in ([k] if isinstance(k, str) else k)), "enum": lambda k: not any(same(v, x) for x in k), "const": lambda k: not same(v, k),
        "minLength": lambda k: kinds["string"] and len(v) < k, "maxLength": lambda k: kinds["string"] and len(v) > k, "pattern": lambda k: kinds["string"] and not re.search(k, v),
        "minimum": lambda k: number and v < k, "maximum": lambda k: number and v > k, "exclusiveMinimum": lambda k: number and v <= k, "exclusiveMaximum": lambda k: number and v >= k,
        "minItems": lambda k: kinds["array"] and len(v) < k, "maxItems": lambda k: kinds["array"] and len(v) > k, "items": lambda k: kinds["array"] and any(again(x, k) for x in v),
        "uniqueItems": lambda k: kinds["array"] and k and any(same(a, b) for a, b in itertools.combinations(v, 2)), "required": lambda k: kinds["object"] and any(x not in v for x in k),
        "minProperties": lambda k: kinds["object"] and len(v) < k, "maxProperties": lambda k: kinds["object"] and len(v) > k, "properties": lambda k: kinds["object"] and any(x in v and again(v[x], t) for x, t in k.items()),
        "additionalProperties": lambda k: kinds["object"] and any(again(x, k) for n, x in v.items() if n not in s.get("properties", {})),
        "allOf": lambda k: any(again(v, t) for t in k), "anyOf": lambda k: all(again(v, t) for t in k), "oneOf": lambda k: sum(not again(v, t) for t in k) != 1, "not": lambda k: not again(v, k),
    }
    return any(tests[k](x) for k, x in s.items() if k in tests)


SCHEMAS = [
    *({"type": k} for k in ("object", "array", "string", "boolean", "null", "number", "integer")), {"type": ["string", "integer"]}, {"enum": [1, "a", None, [1, 2], {"a": 1}]}, {"const": 2}, {"const": "2"},
    {"minLength": 2}, {"maxLength": 2}, {"pattern": "^a.c"}, {"minimum": 2}, {"maximum": 2}, {"exclusiveMinimum": 2}, {"exclusiveMaximum": 2.5}, {"minItems": 2}, {"maxItems": 1}, {"items": {"type": "integer"}}, {"uniqueItems": True},
    {"required": ["a", "b"]}, {"minProperties": 2}, {"maxProperties": 1}, {"properties": {"a": {"type": "integer"}, "b": {"items": {"required": ["a"]}}}}, {"additionalProperties": False, "properties": {"a": True}}, {"additionalProperties": {"type": "string"}}, {"properties": {"a": False}},
    {"allOf": [{"type": "object"}, {"required": ["a"]}]}, {"anyOf": [{"minimum": 3}, {"type": "string"}]}, {"oneOf": [{"type": "integer"}, {"minimum": 2}]}, {"not": {"required": ["a"]}}, True, False, {},
    {"$ref": "#/definitions/tree", "definitions": {"tree": {"type": "object", "properties": {"a": {"type": ["integer", "array"]}, "b": {"items": {"$ref": "#/definitions/tree"}}}}}},
]
VALUES = [None, True, False, 0, 1, 2, 2.0, 2.5, 3, -1, 10**12, "", "a", "2", "abc", "xabc", "\U0001f642\U0001f642", [], [1], [1, 2], [1, 1.0], [1, "1", None], [{"a": 1}, {"a": 1}], [{"b": 1, "a": 2}, {"a": 2, "b": 1}], {}, {"a": 1}, {"a": "1"}, {"b": "x"}, {"a": 1, "b": [{"a": 1}, {}]}, {"a": 1, "b": [1]}, {"a": None}, {"c": 3}, {"a": [], "b": [{"a": 1, "b": [{"a": "deep"}]}]}, {"k": {"a": 1}}]


def test_schemas(spark):
    """Each keyword against a plain interpreter, with values that fit and values that don't."""
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(VALUES)] + [(-1, None), (-2, "{no json")], "i int, t string").withColumn("v", F.try_parse_json("t"))
    for at in range(0, len(SCHEMAS), 9):
        part = SCHEMAS[at : at + 9]
        for r in df.select("i", *[schema.fits(F.col("v"), s).alias(f"s{k}") for k, s in enumerate(part)]).collect():
            want = [None] * len(part) if r["i"] < 0 else [not breaks(VALUES[r["i"]], s) for s in part]
            assert list(r)[1:] == want, (r["i"], [s for s, a, b in zip(part, list(r)[1:], want, strict=True) if a != b])
    got = {r["i"]: r["e"] for r in df.select("i", schema.error(F.col("v"), SCHEMAS[25]).alias("e")).collect()}
    assert got[VALUES.index({"a": "1"})] == "$.a: type" and got[VALUES.index({"a": 1, "b": [{"a": 1}, {}]})] == "$.b[*]: required a" and got[-1] is None
    with pytest.raises(ValueError):
        schema.error(F.lit(None).cast("variant"), {"$ref": "http://elsewhere"})


def test_fhir_schemas_and_empty_containers(spark):
    rules = {"Patient": {"required": ["id"], "properties": {"id": {"type": "string"}}}}
    texts = ['{"resourceType":"Patient","id":"1"}', '{"resourceType":"Patient","id":1}', '{"resourceType":"Patient"}', '{"resourceType":"Other"}', '{"resourceType":[]}', '{"resourceType":{}}', '{"resourceType":["x"]}', '{"resourceType":null}', '{"resourceType":0.0}', None]
    got = values(spark, validate.fhir(F.col("t"), rules), texts)
    assert [x["passed"] for x in got] == [True, False, False, True, False, False, True, False, False, False]
    assert got[2]["error_detail"] == "Schema: $: required id" and got[2]["error_type"] == "structure"
    assert [x for x in values(spark, validate.content_type(F.col("t")), texts[:9])] == ["fhir", "fhir", "fhir", "fhir", "json", "json", "fhir", "json", "json"]


def test_rows_without_a_key_are_sampled(spark):
    """None is lost, reruns agree, and such rows aren't gathered in one place of the order."""
    rows = [(None if i % 2 else i, f"t{i % 40}", {"m": 1}) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t string, m map<string,int>")
    assert sampling.exact_fraction(df, "k", 0.75).count() == 150 and sampling.cycled(df, "k", 1010).count() == 1010
    place = {(r["k"], r["t"], r["place"]) for r in sampling.numbered(df, "k").collect()}
    assert sorted(p for *_, p in place) == list(range(1, 201)) and 20 < sum(k is None for k, _, p in place if p <= 100) < 80
    assert sampling.shuffled(df, "k").count() == 200
    part = df.select("k", "t", F.lit("s").alias("s"))
    again = [sorted(map(str, sampling.stratified(x, "k", "s", {"s": 70}).collect())) for x in (part, part.repartition(7))]
    assert again[0] == again[1] and len(again[0]) == 70


def test_files_of_other_encodings(spark, tmp_path):
    (tmp_path / "r/one").mkdir(parents=True)
    (tmp_path / "r/one/a.md").write_bytes("caf\u00e9 in a text that is long".encode("latin-1"))
    (tmp_path / "r/one/b.png").write_bytes(bytes(range(256)))
    (tmp_path / "r/one/c.md").write_bytes(b"\x00\xff\xfe binary that is long enough \xe2\x82")
    got = {r["path"].rsplit("/", 1)[-1]: r["text"] for r in files.read_docs(spark, f"{tmp_path}/r").collect()}
    assert set(got) == {"a.md", "c.md"} and got["a.md"] == "caf\ufffd in a text that is long"
    assert files.scan_repos(spark, f"{tmp_path}/r", ["*.md"]).count() == 2


def test_cap_comes_before_size(spark, tmp_path):
    """The first files by path count towards the cap, too large or not."""
    (tmp_path / "one").mkdir()
    for name, size in (("a", 900), ("b", 900), ("c", 50), ("d", 50)):
        (tmp_path / f"one/{name}.py").write_text("x" * size)
    assert files.scan_repos(spark, str(tmp_path), ["*.py"], per_repo=2, largest=100).count() == 0
    assert files.scan_repos(spark, str(tmp_path), ["*.py"], per_repo=3, largest=100).count() == 1


def test_batches_are_held_once(spark, tmp_path, monkeypatch):
    """A stream that fails between a batch's rows and its mark, and is started again; batches written again by hand."""
    (tmp_path / "in").mkdir()
    spark.range(10).write.mode("append").parquet(f"{tmp_path}/in")
    schema_ = spark.range(1).schema
    batches = sink.BatchSink(spark, f"{tmp_path}/out")
    assert batches.read(schema_).count() == 0 and batches.whole() == []

    def run():
        stream = spark.readStream.schema(schema_).parquet(f"{tmp_path}/in")
        events.run_available(stream, f"{tmp_path}/state", batches.write).awaitTermination()

    with monkeypatch.context() as m:
        m.setattr(sink.BatchSink, "_mark", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run()
    assert batches.read(schema_).count() == 0 and list((tmp_path / "out").glob("batch-*"))  # rows are there, nobody sees them
    run()
    spark.range(10, 25).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert sorted(x.id for x in batches.read(schema_).collect()) == list(range(25)) and batches.whole() == [0, 1]
    assert batches.write(spark.range(99), 1) is False and batches.write(spark.range(25, 26), 2) is True
    assert batches.read(schema_).count() == 26
    with pytest.raises(Exception, match="(?i)exist"):
        batches._mark(2)


def one_by_one(text, pairs):
    for a, b in pairs:
        text = text.replace(a, b) if a else text
    return text


def test_many_rules_by_one_automaton(spark):
    """Random rules that overlap, hold and make each other, repeat, or are empty, against one pass a rule."""
    r = random.Random(8)
    for _ in range(3000):
        letters = r.choice(["ab", "abcdefghij", "aé字😀"])
        pairs = [("".join(r.choices(letters, k=r.choice([0, 1, 1, 2, 2, 3, 4]))), "".join(r.choices(letters + "XY", k=r.randrange(4)))) for _ in range(r.choice([1, 2, 3, 6, 60]))]
        text = "".join(r.choices(letters + " ", k=r.randrange(60)))
        assert literals.OrderedRules(pairs)(text) == one_by_one(text, pairs)
    apart = literals.OrderedRules([("one", "1"), ("six", "2"), ("zz", "?")])
    assert not any(apart.after) and not any(apart.near) and apart("onesix zzz six") == "12 ?z 2"  # the way in one go
    texts = ["", None, "the of and", "in that thing " * 4000, "nothing of that kind", "S E -e"]
    assert values(spark, literals.replaced(F.col("t"), core._MANY), texts) == [t and one_by_one(t, core._MANY) for t in texts]
    assert values(spark, literals.replaced(F.col("t"), []), texts) == texts
    same = spark.createDataFrame([("x",)] * 3, "t string").select(literals.replaced(F.col("t"), [("x", "y")]).alias("v"))
    assert [x.v for x in same.collect()] == ["y"] * 3 and same.where("false").count() == 0


def test_groups_of_literals(spark):
    groups = {"a": ("he", "she"), "b": ("hers", "é"), "none": (), "always": ("", "x")}
    texts = ["ushers", "hé", "", None, "s h e", "x" * 100_000 + "she"]
    want = [None if t is None else tuple(any(x in t for x in xs) for xs in groups.values()) for t in texts]
    assert [None if x["a"] is None else tuple(x) for x in values(spark, literals.occurring(F.col("t"), groups), texts)] == want


def test_calls_at_once(spark, tmp_path):
    """Eight calls under way, results in order, and as many calls as different prompts of a key."""
    plan = spark.range(48).selectExpr("id AS k", "concat('p', id) AS prompt").unionByName(spark.sql("SELECT 0L AS k, 'p0' AS prompt UNION ALL SELECT 0L, 'other' UNION ALL SELECT NULL, 'p0' UNION ALL SELECT NULL, 'p0' UNION ALL SELECT 9L, NULL"))

    def slow(prompt):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(prompt + "\n")
        time.sleep(0.1)
        return prompt.upper()

    took = []
    for at_once in (1, 8):
        began = time.time()
        got = teacher.ask(plan, "k", "prompt", slow, f"{tmp_path}/log{at_once}", at_once=at_once, buckets=1).collect()
        took.append(time.time() - began)
        assert Counter((x.k, x.response) for x in got) == Counter([(k, f"P{k}") for k in range(48)] + [(0, "P0"), (0, "OTHER"), (None, "P0"), (None, "P0")])
    assert took[1] < took[0] / 3
    calls = Counter(Path(f"{tmp_path}/calls").read_text().split())
    assert calls.pop("p0") == 4 and set(calls.values()) == {2}  # two runs; the null key asks for itself
    kept = teacher.logged(spark, f"{tmp_path}/log8")
    assert kept.count() == 50 and kept.where("key IS NULL").count() == 1 and teacher.logged(spark, f"{tmp_path}/no").count() == 0
    assert teacher.ask(plan, "k", "prompt", lambda p: 1 / 0, f"{tmp_path}/log8", buckets=1).count() == 52  # nobody is asked again
    assert teacher.ask(plan.where("false"), "k", "prompt", slow, f"{tmp_path}/none").count() == 0


def test_late_and_failing_teachers(spark, tmp_path):
    began = time.time()
    late = teacher.patient(lambda p: time.sleep(30) or "x", timeout=0.1, retries=1, wait=0)
    assert late("p") == "" and time.time() - began < 5
    tries = iter([OSError, None, "", "yes"])

    def fails(prompt):
        x = next(tries)
        if x is OSError:
            raise x
        return x

    assert teacher.patient(fails, timeout=5, retries=3, wait=0)("p") == "yes"
    plan = spark.createDataFrame([(1, "a"), (2, "b")], "k int, instruction string")
    assert synthesis.answers(plan, lambda p: "" if p.endswith("a") else "<think>t</think>z", key="k", log=f"{tmp_path}/log").count() == 1
    again = synthesis.answers(plan, lambda p: "new" if p.endswith("a") else 1 / 0, key="k", log=f"{tmp_path}/log").orderBy("k").collect()
    assert [(x.k, x.output, x.cot_trace) for x in again] == [(1, "new", None), (2, "z", "t")]  # empty answers aren't logged
    with pytest.raises(ValueError, match="key"):
        synthesis.answers(plan, str, log="x")


def test_a_killed_task_asks_no_logged_call_again(spark, tmp_path):
    plan = spark.range(60).selectExpr("id AS k", "concat('p', id) AS prompt")

    def dies(prompt):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(prompt + "\n")
        if len(Path(f"{tmp_path}/calls").read_text().split()) == 40 and not Path(f"{tmp_path}/dead").exists():
            Path(f"{tmp_path}/dead").touch()
            os._exit(1)
        return prompt.upper()

    ask = lambda: teacher.ask(plan, "k", "prompt", dies, f"{tmp_path}/log", at_once=2, every=4, buckets=1)
    with pytest.raises(Exception, match="(?i)worker|crash|EOF"):
        ask().collect()
    kept = {x.key for x in teacher.logged(spark, f"{tmp_path}/log").collect()}
    asked = Path(f"{tmp_path}/calls").read_text().split()
    assert 20 <= len(kept) < 40
    assert Counter(x.response for x in ask().collect()) == Counter(f"P{k}" for k in range(60))
    assert not {f"p{k}" for k in kept} & set(Path(f"{tmp_path}/calls").read_text().split()[len(asked) :])


def test_lines_of_ranges():
    """Random bytes, cut and read in all sizes, against a split of the whole."""
    r = random.Random(5)
    for _ in range(800):
        raw = bytes(r.choices(b"ab\n\n\r\xe9", k=r.randrange(40)))
        want, at = [], 0
        for k, line in enumerate(parts := raw.split(b"\n")):
            if line or k < len(parts) - 1:
                want.append((at, line.removesuffix(b"\r")))
            at += len(line) + 1
        for size, read in itertools.product((1, 3, 7, 100), (1, 2, 5, 64)):
            assert [x for s in range(0, len(raw), size) for x in lines.lines_of(io.BytesIO(raw), s, min(s + size, len(raw)), read)] == want


def test_lines_by_ranges(spark, tmp_path):
    """The same rows from one range a file and from very many; other encodings, binary, empty and hidden files, long lines."""
    (tmp_path / "in/b").mkdir(parents=True)
    (tmp_path / "in/a.jsonl").write_bytes(b'{"k": 1, "t": "x"}\r\n\n  \n[1]\n{"k": 2\n{"k": 3, "t": "caf\xe9"}\n{"k": 4, "z": 0}')
    (tmp_path / "in/b/long.jsonl").write_text(json.dumps({"k": 5, "t": "é" * 300_000}) + "\n" + json.dumps({"k": 6}) + "\n")
    (tmp_path / "in/binary").write_bytes(bytes(range(256)) * 3)
    (tmp_path / "in/empty.jsonl").touch()
    (tmp_path / "in/.hidden").write_text("x\n")
    seen = []
    for size in (1 << 20, 50_000, 17):
        where = [str(tmp_path / "in/a.jsonl"), str(tmp_path / "in")] if size > 17 else [str(tmp_path / "in/a.jsonl")] * 2
        rows = lines.read_jsonl(spark, where, "k int, t string", size)
        seen.append([tuple(x) for x in rows.where("file LIKE '%a.jsonl'").orderBy("file_ord", "file", "place").select("file_ord", "place", "raw", "state", "record").collect()])
    assert seen[0] == seen[1] == seen[2] and [x[3] for x in seen[0][:7]] == ["ok", "blank", "blank", "malformed", "malformed", "ok", "ok"]
    assert seen[0][5][4] == (3, "caf\ufffd") and seen[0][0][1:3] == (0, '{"k": 1, "t": "x"}')
    rest = lines.read_lines(spark, str(tmp_path / "in"), 50_000)
    long_ = rest.where("file LIKE '%long.jsonl'").orderBy("place").collect()
    assert [json.loads(x.value) for x in long_] == [{"k": 5, "t": "é" * 300_000}, {"k": 6}]
    assert rest.where("file LIKE '%binary'").count() == 4 and rest.where("file LIKE '%hidden' OR file LIKE '%empty%'").count() == 0
    with pytest.warns(UserWarning, match="no file"):
        assert lines.read_jsonl(spark, f"{tmp_path}/no", "k int").count() == 0
    with pytest.raises(Exception, match="rangeBytes"):
        lines.read_lines(spark, str(tmp_path / "in"), 0).count()


def test_first_seen_by_state(spark, tmp_path):
    """Pieces of a table, one run of the stream each, against one pass over the whole; nulls, copies within and across pieces."""
    texts = [(1, "a"), (2, "b"), (3, " A "), (4, None), (5, "c"), (None, "z"), (6, "c"), (7, "b"), (8, ""), (9, " "), (10, "d"), (10, "d")]
    docs = spark.createDataFrame(texts, "k long, t string")
    other, got = first.stateful(spark), []
    for piece in ((1, 2, 3, 4), (5, 6, 7), (8, 9, 10)):
        docs.where(F.col("k").isin(*piece) | F.col("k").isNull()).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rows = first.first_ids(events.read_parquet_stream(other, f"{tmp_path}/in", docs.schema), "t", "k")
        events.run_available(rows, f"{tmp_path}/state", lambda df, _: got.append([x.id for x in df.collect()])).awaitTermination()
    assert [sorted(x) for x in got if x] == [[1, 2], [5], [8, 10]]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != first.STORE  # the caller's session is as it was


def test_few_rows_of_a_group_by_one_shuffle(spark, monkeypatch):
    """The same rows as by hash buckets, ranks limited before the only shuffle; null and unknown values, null keys, empty tables."""
    rows = [(None if i % 9 == 0 else i, None if i % 7 == 0 else "ab"[i % 2], i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, g string, v int").repartition(6)
    quotas = {"a": 40, "b": 3, "c": 5}
    few = sampling.stratified(df, "k", "g", quotas)
    got = sorted(r["v"] for r in few.collect())
    first = [sorted(r["v"] for r in sampling.first_in_order(df, "k", n).collect()) for n in (0, 1, 200, 600, 700)]
    assert [len(x) for x in first] == [0, 1, 200, 600, 600] and len(got) == 43
    plan = sampling.stratified(df, "k", "g", quotas)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan and "Join" not in plan
    assert sampling.stratified(df.where("false"), "k", "g", quotas).count() == 0 and sampling.stratified(df, "k", "g", {}).count() == 0
    nulls = sampling.first_few(df, "k", {None: 8}, "g").collect()
    assert len(nulls) == 8 and all(r["g"] is None for r in nulls)
    monkeypatch.setattr(sampling, "FEW", -1)
    assert sorted(r["v"] for r in sampling.stratified(df, "k", "g", quotas).collect()) == got
    assert [sorted(r["v"] for r in sampling.first_in_order(df, "k", n).collect()) for n in (0, 1, 200, 600, 700)] == first


def test_metrics_of_several_groupings(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 3), (None, None, 4)], "a string, b string, v int").cache()
    sets = {"all": (), "a": ("a",), "both": ("a", "b")}
    got = report.by_sets(df, sets, {"n": F.count("*"), "s": F.sum("v")})
    rows = Counter((r["level"], r["a"], r["b"], r["n"], r["s"]) for r in got.collect())
    assert rows == Counter({("all", None, None, 4, 10): 1, ("a", "a", None, 2, 3): 1, ("a", None, None, 2, 7): 1, ("both", "a", "x", 1, 1): 1, ("both", "a", "y", 1, 2): 1, ("both", None, "x", 1, 3): 1, ("both", None, None, 1, 4): 1})
    plan = report.by_sets(df, sets, {"n": F.count("*")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("InMemoryTableScan") == 1
    assert [r["level"] for r in report.by_sets(df.where("false"), sets, {"n": F.count("*")}).collect()] in ([], ["all"])
    with pytest.raises(ValueError):
        report.by_sets(df, {"x": ("a", "b"), "y": ("b", "a")}, {"n": F.count("*")})


def test_counted_while_written(spark, tmp_path):
    texts = ["f(x)", "f(", "", "password = 'zq81kk'", None, "a]"]
    df = spark.createDataFrame([(i, t, d) for i, t in enumerate(texts) for d in ("x", "math")], "i int, t string, d string").repartition(5)
    done = validate.validated(df, "t", "d")
    counts = validate.written(done, "_r", f"{tmp_path}/out")
    whole = validate.report(done, "_r").first()
    assert counts == {"total": whole["total"], "passed": whole["passed"], "failed": whole["failed"], "errors_by_category": whole["errors_by_category"]}
    back = spark.read.parquet(f"{tmp_path}/out").withColumn("passed", F.col("passed").cast("boolean"))
    assert back.where("not passed").where("_validation_error is not null").count() == counts["failed"] > 0
    assert back.where("passed").where("_validation_error is null").count() == counts["passed"] > 0
    assert validate.written(done.where("false"), "_r", f"{tmp_path}/none") == {"total": 0, "passed": 0, "failed": 0, "errors_by_category": {}}


def test_functions_for_sql(spark):
    session.register(spark)
    texts = ["USER: a\nb\nASSISTANT: c\nUSER: d", "x\nuser: a\nassistant:\u00a0b ", "ASSISTANT: a\nUSER: b", "USER: \nASSISTANT: b", "USER: a", "", None, "no marks", "USER: a\nASSISTANT: b\n\n c \nUSER: d\nASSISTANT: e"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = spark.sql("SELECT i, t.* FROM {df}, LATERAL dialogue_turns(text) t", df=df).collect()
    want = [(r["i"], k, t["role"], t["content"]) for r in dialogue.parse(df, "i", "text").collect() for k, t in enumerate(r["turns"], 1)]
    assert sorted(map(tuple, rows)) == sorted(want) and want
    checks = spark.sql("SELECT unmatched_bracket(t) AS b, xml_error(t) AS x, leaks_to_log(t) AS l FROM VALUES ('a)'), ('<a/>'), ('print(patient.ssn)'), (CAST(NULL AS STRING)) v(t)").collect()
    assert [r["b"] for r in checks] == [1, -1, -1, None] and [r["x"] is None for r in checks] == [False, True, False, True]
    assert [r["l"] for r in checks] == [False, False, True, None]


def test_html_references_without_semicolons_stay(spark):
    """As the SQL has it; those with one are read."""
    texts = ["<title>a &amp; b&amp</title><p>&lt;i&gt; &quot;q&quot; &#39;&quot", "<p>x &am</p>&<p>&ampx; AT&T &lt", "<b>&copy; &copy</b><script>if (a &amp&& b) x</script>&nosuch;"]
    assert values(spark, files.html_blocks(F.col("t")), texts) == ["a & b&amp\n<i> \"q\" '&quot", "x &am\n&\n&ampx; AT&T &lt", "© &copy\n&nosuch;"]


def test_keys_do_not_grow_with_texts(tmp_path, spark):
    """Of large sets a bounded number of segments have keys, none of them of few shingles, and similar sets still share some;
    the index has texts instead of sets."""
    r = np.random.default_rng(5)
    top = (1 << 64) - 1
    for n in (2000, 4700, 20000, 60000):
        common = r.integers(0, top, n, dtype=np.uint64)
        for _ in range(20):
            x, y = (np.unique(np.concatenate([common, r.integers(0, top, n // 18, dtype=np.uint64)])) for _ in "xy")
            a, b = neardup.keys(x, 0.9), neardup.keys(y, 0.9)
            assert len(a) <= 2 * (neardup.MANY + 1) and len((set(a.tolist()) & set(b.tolist())) - {0}) > 5
    at = neardup.classes(0.9)[0].index(max(k for k in neardup.classes(0.9)[0] if k <= 2000))
    few = neardup.keys(np.arange(2000, dtype=np.uint64) << np.uint64(20), 0.9)  # all in the first segment
    assert neardup.classes(0.9)[3][at][1] >= 4 and (few != 0).sum() <= 2
    index = neardup.LeaderIndex(spark, str(tmp_path), buckets=2)
    index.add(spark.createDataFrame([(1, "p", "abcdefgh" * 900)], "id long, domain string, text string"), "id", "domain", "text", 0)
    assert spark.table(index.sets).columns == ["id", "dom", "c", "sign", "text", "batch"] and spark.table(index.keys).count() <= 2 * neardup.MANY


def test_cleaning_shuffles_no_signatures_and_no_text_again(spark, monkeypatch):
    """What stays is df's rows without the leaders' losses, with all columns; tables of prints are joined in their buckets."""
    r = random.Random(4)
    base = ["".join(r.choice("abcdefg ") for _ in range(300)) for _ in range(6)]
    rows = [(i, r.choice(["p", "q", None]), t if r.random() < 0.2 else t[: (k := r.randrange(300))] + "x" + t[k + r.randrange(3) :], float(i)) for i, t in enumerate(base * 9)] + [(200, "p", None, 1.0), (201, "p", " ", None), (None, "p", base[0], 2.0), (None, None, base[0], 2.0)]
    df = spark.createDataFrame(rows, "k long, domain string, t string, more double").select("more", "t", "k", "domain")
    gone = {x["k"] for x in neardup.leaders(df, "k", "domain", "t").collect()}
    plans, stored = [], neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, kind: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, kind) if kind == "open" else stored(df, kind))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = neardup.kept(df, "k", "domain", "t").where(F.coalesce(F.length("t"), F.lit(0)) >= 0)
        plans.append(kept._jdf.queryExecution().executedPlan().toString())
        got = kept.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert gone and kept.columns == df.columns
    assert sorted(map(str, got)) == sorted(str(x) for x in df.collect() if x["k"] not in gone)
    assert len(plans) == 2 and all("prints_" in x for x in plans)
    assert plans[0].count("Exchange hashpartitioning") == 5  # two of entries by key, then pairs: distinct, by i, by j
    assert not re.search(r"Exchange hashpartitioning\(id#", plans[1])


def test_first_seen_takes_rows_of_a_content_as_they_are():
    """No data frame is made for each content: of rows, the smallest id, once."""
    from pyspark.sql import Row

    class Value:
        held = None
        exists = lambda self: self.held is not None
        update = lambda self, x: setattr(self, "held", x)

    p = first._First("bigint")
    p.first = Value()
    assert [tuple(x) for x in p.handleInputRows(("a",), iter([Row(h="a", id=7), Row(h="a", id=3)]), None)] == [("a", 3)]
    assert p.first.held == (3,) and not list(p.handleInputRows(("a",), iter([Row(h="a", id=1)]), None))
