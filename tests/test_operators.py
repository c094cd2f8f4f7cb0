"""Order-dependent operators against sequential replays, and edge cases."""

import hashlib
import json
import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import backends, chunking, dag, dedup, infer, mix, pages, quality, records, retrieval, validate
from granary.plans import resources


def replay_waterfall(rows):
    seen, out = set(), {}
    for pos, layer, instruction, output in sorted(rows):
        n = max(1, len(f"{instruction} {output}") // 4)
        if n < 8:
            out[pos] = "too_few_tokens"
        elif n > 2048:
            out[pos] = "too_many_tokens"
        elif (layer, output) in seen:
            out[pos] = "duplicate"
        else:
            seen.add((layer, output))
            out[pos] = "short_instruction" if len(instruction) < 5 else "non_ascii" if not instruction.isascii() else "kept"
    return out


def test_waterfall_equals_replay(spark):
    rng = random.Random(1)
    outputs = ["x" * 40, "y" * 60, "z" * 9000, "s", "w" * 33]
    rows = [(i, rng.choice("ab"), rng.choice(["Write it", "no", "Schreib größer", "Explain this"]), rng.choice(outputs) + rng.choice(["", "q"])) for i in range(400)]
    df = spark.createDataFrame(rows, "pos BIGINT, layer STRING, instruction STRING, output STRING").repartition(7)
    got = {r["pos"]: r["reason"] for r in quality.waterfall(df).collect()}
    want = replay_waterfall(rows)
    assert got == want and set(want.values()) == {"too_few_tokens", "too_many_tokens", "duplicate", "short_instruction", "non_ascii", "kept"}


def test_bad_first_copy_suppresses_later_ones(spark):
    rows = [(1, "a", "no", "o" * 40), (2, "a", "A good task", "o" * 40), (3, "b", "A good task", "o" * 40)]
    got = [r["reason"] for r in quality.waterfall(spark.createDataFrame(rows, "pos BIGINT, layer STRING, instruction STRING, output STRING")).orderBy("pos").collect()]
    assert got == ["short_instruction", "duplicate", "kept"]


def test_waterfall_nulls_and_empty(spark):
    schema = "pos BIGINT, layer STRING, instruction STRING, output STRING"
    assert quality.waterfall(spark.createDataFrame([], schema)).count() == 0
    assert quality.waterfall(spark.createDataFrame([(1, None, None, None)], schema)).first()["reason"] == "too_few_tokens"


def test_instruction_defects(spark):
    code = "alpha beta gamma delta epsilon zeta eta theta"
    cases = [(None, "empty"), ("  ", "empty"), ("abcd", "short"), ("Sorry, no", "refusal"), ("I cannot", "refusal"), ("Well, I cannot say", None), ("alpha beta gamma delta epsilon zeta eta theta", "echo"), ("alpha beta gamma delta epsilon zeta", None)]
    df = spark.createDataFrame([(i, t, code) for i, (t, _) in enumerate(cases)], "i INT, t STRING, c STRING")
    assert [r[0] for r in df.select(quality.instruction_defect(F.col("t"), F.col("c")), "i").orderBy("i").collect()] == [w for _, w in cases]
    few = spark.createDataFrame([("a b c d e", "a b c d e")], "t STRING, c STRING")
    assert few.select(quality.instruction_defect(F.col("t"), F.col("c"))).first()[0] is None  # five words are too few for an echo


def test_first_wins_with_a_hot_key(spark):
    df = spark.range(3000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"))
    got = {r["k"]: r["pos"] for r in dedup.first_wins(df, ["k"], "pos").collect()}
    want = {}
    for i in range(3000):
        want.setdefault(-1 if i % 3 == 0 else i % 50, i)
    assert got == want


@pytest.fixture(params=[200_000, 40])
def few(request, monkeypatch):
    """All rows at once in one task a group, and rounds over ranges until few remain."""
    monkeypatch.setattr(mix, "FEW_ROWS", request.param)
    monkeypatch.setattr(mix, "RANGE_ROWS", 20)


def replay_fill(rows, budget):
    taken, left = [], budget
    for o, i, t in sorted(rows):
        if t <= left:
            taken.append(i)
            left -= t
    return sorted(taken)


def test_greedy_fill_equals_replay(spark, few):
    rng = random.Random(4)
    rows = [(g, i, rng.choice([1, 5, 40, 300, 900])) for i, g in enumerate(rng.choice("ab") for _ in range(300))]
    df = spark.createDataFrame(rows, "g STRING, i BIGINT, t BIGINT")
    got = mix.greedy_budget(df, 2000, "g", "i", "t").collect()
    for g in "ab":
        mine = [(hashlib.md5(f"42:{i}".encode()).hexdigest(), i, t) for gg, i, t in rows if gg == g]
        assert sorted(r["id"] for r in got if r["g"] == g) == replay_fill(mine, 2000)


def test_greedy_fill_of_odd_rows(spark, few):
    rows = [(None, i, 7) for i in range(90)] + [("a", 100 + i, None if i % 2 else -1) for i in range(9)] + [("b", 200 + i, 10) for i in range(60)] + [("c", 300, 5000)]
    got = mix.greedy_budget(spark.createDataFrame(rows, "g STRING, i BIGINT, t BIGINT"), 100, "g", "i", "t").collect()
    assert {g: sum(r["t"] for r in got if r["g"] == g) for g in {r["g"] for r in got}} == {None: 98, "b": 100}


def test_greedy_fill_of_nothing(spark):
    assert mix.greedy_budget(spark.createDataFrame([], "g STRING, i BIGINT, t BIGINT"), 10, "g", "i", "t").count() == 0


YAML_CASES = [
    ("", []),
    ("one: line", ["one: line"]),
    ("a: 1\nb: 2\nc: 3\n", ["a: 1\nb: 2\nc: 3"]),
    ("a:\n  x: 1\n  y: 2\nb: 1\nc:\n  - p\n  - q", ["a:\n  x: 1\n  y: 2", "b: 1\nc:\n  - p\n  - q"]),
    ("a: 1\nb:\n  - p\n  - q\nz: 9", ["a: 1\nb:\n  - p\n  - q", "z: 9"]),
    ("# note\n---\nkey.with-dots: v\n  k: 1\n  l: 2", ["# note\n---\nkey.with-dots: v\n  k: 1\n  l: 2"]),
    ("a:\n  b: 1\n  c: 2\n---\nd:\n  e: 1\n  f: 2", ["a:\n  b: 1\n  c: 2\n---", "d:\n  e: 1\n  f: 2"]),
    ("\tt: 1\n x: 2\nplain", ["\tt: 1\n x: 2\nplain"]),
    ("a: 1\r\nb:\r\n  c: 1\r\n  d: 2\r\n", ["a: 1\nb:\n  c: 1\n  d: 2"]),
    ("\n\n", ["\n"]),
    ("big:\n" + "  - row\n" * 450, ["big:" + "\n  - row" * 199, "\n".join(["  - row"] * 200), "\n".join(["  - row"] * 51)]),
    ("big:\n" + "  - row\n" * 200 + "k: 1\n", ["big:" + "\n  - row" * 199, "  - row\nk: 1"]),
]


def test_yaml_chunks(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(YAML_CASES)] + [(99, None, "x")], "i INT, t STRING, text STRING")
    got = {}
    for r in chunking.yaml_chunks(df, "i", "t").orderBy("i", "chunk").collect():
        got.setdefault(r["i"], []).append(r["text"])
        assert r["n_lines"] == r["text"].count("\n") + 1 and r["chunk"] == len(got[r["i"]]) - 1
    for i, (_, want) in enumerate(YAML_CASES):
        assert got.get(i, []) == want, i


def test_yaml_chunks_of_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a:\n  b: 1\n  c: 2"), (1, "x:\n  y: 1\n  z: 2")], "i INT, t STRING")
    assert sorted(r["text"] for r in chunking.yaml_chunks(df, "i", "t").collect()) == ["a:\n  b: 1\n  c: 2", "x:\n  y: 1\n  z: 2"]


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 64), st.integers(0, 65536), st.integers(0, 24576), st.booleans())
def test_plans_grow_with_the_machine(threads, ram, vram, gpu):
    def workers(ram, vram):
        m = resources.Resources(resources.Cpu(threads), resources.Ram(ram, ram), resources.Gpu(gpu, gpu, vram, vram))
        plan = resources.plan_workers(m, "/nowhere")
        return sum(w.n_parallel for w in plan if w.kind == "gpu"), sum(w.kind == "cpu" for w in plan)

    a, b = workers(ram, vram), workers(ram + 4096, vram + 4096)
    assert b[0] >= a[0] and b[1] >= a[1] and a[0] <= 12


def test_plan_values():
    m = resources.Resources(resources.Cpu(16), resources.Ram(32000, 20000), resources.Gpu(True, True, 4096, 0))
    plan = resources.plan_workers(m, "/nowhere")
    assert [w.kind for w in plan] == ["gpu"] + ["cpu"] * 6 and plan[0].n_parallel == 12
    assert [w.kind for w in resources.plan_workers(m, "/nowhere", max_cpu_workers=0)] == ["gpu"]
    assert resources.plan_workers(m, "/nowhere", max_vram_mb=1500)[0].n_parallel == 2
    rates = iter([1.0, 2.0, 2.0])
    assert sum(w.kind == "cpu" for w in resources.calibrate(m, "/nowhere", lambda p: next(rates))) == 1


def test_completions_resume_and_retry(spark):
    jobs = spark.createDataFrame([(0, "do a", 8, 0.1, None, []), (1, "FAIL", None, None, 0.5, None), (2, None, 4, 0.2, None, ["task"])], "_idx BIGINT, prompt STRING, max_tokens INT, temperature DOUBLE, top_p DOUBLE, stop ARRAY<STRING>")
    got = {r["_idx"]: r for r in infer.run_completions(jobs).collect()}
    assert got[0]["_text"].startswith("Write code for task") and got[1]["_text"] is None and got[1]["_len"] == 0 and got[2]["_text"] == "Write code for"
    done = spark.createDataFrame([(0, "cpu0"), (1, "lost")], "_idx BIGINT, _worker STRING")
    assert sorted(r["_idx"] for r in infer.run_completions(jobs, done=done).collect()) == [1, 2]


def test_retries_are_bounded():
    class Flaky:
        calls = 0

        def complete(self, requests):
            self.calls += 1
            return [None if r["p"] > self.calls else "ok" for r in requests]

    f = Flaky()
    assert infer.complete_with_retries(f, [{"p": 0}, {"p": 2}, {"p": 99}], 3, 3) == ["ok", "ok", None] and f.calls == 3
    assert infer.fit_prompt("x" * 100_000, 1536, 128)[-5:] == "xxxxx" and len(infer.fit_prompt("x" * 100_000, 1536, 128)) == 6 * 1392


def test_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    assert [r["pos"] for r in infer.numbered(df, "k").orderBy("k").collect()] == list(range(1000))


def test_chat_rows(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "Human", " "), (1, 2, "gpt", " a "), (1, 3, "human", "q\n"), (2, 0, "user", "x"), (3, None, "user", None)]
    df = spark.createDataFrame(rows, "c INT, n INT, role STRING, t STRING")
    assert [tuple(r) for r in records.chat_pairs(df, "c", "n", "role", "t").collect()] == [(1, "q", "a")]
    nested = spark.createDataFrame([(1, json.dumps([{"from": "human", "value": ""}, {"role": "human", "content": " q "}, {"from": "gpt", "value": "a"}])), (2, "{bad"), (3, None)], "c INT, j STRING")
    assert [tuple(r) for r in records.chat_pairs_nested(nested, "j", ("c",)).collect()] == [(1, "q", "a")]


def test_mapping_drops_blank_rows(spark):
    df = spark.createDataFrame([(1, " a\n", "b", "", "x"), (2, "\t", "b", None, "y"), (3, None, None, None, None)], "k INT, i STRING, o STRING, c STRING, metadata STRING")
    got = records.map_rows(df, "i", "o", "c", keep=("k",), layer="doc", category=F.col("metadata")).collect()
    assert [(r["k"], r["instruction"], r["input"], r["metadata"]["category"]) for r in got] == [(1, "a", "", "x")]


def test_source_spans():
    py = "import os\n\n@deco\ndef f(a):\n    x = 1\n    return x\n\nclass A:\n    def g(self):\n        a = 1\n        return a\n"
    assert [x[:3] for x in chunking.python_spans(py)] == [("decorated", 3, 6), ("func", 4, 6), ("class", 8, 11), ("func", 9, 11)]
    assert chunking.python_spans("def (") == []
    c = '#define X {\nstatic int f(int a)\n{\n  char *s = "}";\n  /* } */ return a;\n}\nstruct p {\n  int a;\n};\nint g(void);\n'
    assert [x[:3] for x in chunking.c_spans(c)] == [("func", 2, 6), ("decl", 7, 9), ("decl", 10, 10)]
    js = "class A {\n  m(x) {\n    return `}`;\n  }\n}\nfunction f() {\n  g((y) => {\n    h(y);\n  });\n}\n"
    assert [x[:3] for x in chunking.javascript_spans(js)] == [("class", 1, 5), ("method", 2, 4), ("func", 6, 10), ("arrow", 7, 9)]
    css = ".a {\n  color: red;\n}\n@media (x) {\n  .b {\n    top: 0;\n  }\n}\n@font-face { a: b }\n"
    assert [x[:3] for x in chunking.css_spans(css)] == [("rule", 1, 3), ("media", 4, 8), ("rule", 5, 7)]
    html = "<main>\n<p>x\n<section>\n<b>y</b>\n</section>\n</main>\n<nav>"
    assert [x[:3] for x in chunking.html_spans(html)] == [("semantic", 1, 6), ("semantic", 3, 5)]


def test_source_chunks_bounds(spark):
    f = lambda n: "def f():\n" + "    x = 1\n" * (n - 1)
    rows = [("r", "python", f"{n}.py", f(n)) for n in (2, 3, 200, 201)] + [("r", "cobol", "x", "y"), ("r", "python", "n.py", None)]
    df = spark.createDataFrame(rows, "repo STRING, language STRING, file_path STRING, text STRING")
    got = {r["file_path"]: r for r in chunking.source_chunks(df).collect()}
    assert sorted(got) == ["200.py", "3.py"] and got["3.py"]["name"] == "f" and got["3.py"]["signature"] == "def f():"


def test_config_chunks(spark):
    rows = [("a/deploy.yaml", "kind: Pod\nmetadata:\n  name: web\nspec:\n  x: 1\n"), ("docker-compose.yml", "services:\n  db:\n    image: x\n"), ("makefile", "all:\n\techo\nclean:\n\trm x\n"), ("Makefile", "a:\n b\n c\n"), ("x.service", "[Unit]\na=b\nc=d\n"), ("s.tf", "a\nb"), ("long.conf", "line of text here\n" * 1200), ("blank.yaml", " \n")]
    got = [tuple(r) for r in chunking.config_chunks(spark.createDataFrame(rows, "path STRING, text STRING")).orderBy("path", "chunk", "part").collect()]
    tasks = {p: i for p, _, _, i, _ in got}
    assert tasks["docker-compose.yml"] == "Write the docker-compose service definition for `db` as shown."
    assert tasks["makefile"] == "Write the Makefile target(s) for: all, clean." and tasks["Makefile"].startswith("Provide the DevOps")
    assert tasks["x.service"] == "Write the systemd service unit defined in x.service." and "s.tf" not in tasks and "blank.yaml" not in tasks
    assert sum(p == "long.conf" for p, *_ in got) == 6


def test_pages(spark):
    c = "<h1>strlen</h1><code class='t-cpp'>size_t strlen(const char*)</code><p>Gives the <b>length</b>.<script>x()</script><div class='example'><pre>strlen(\"a\")</pre></div>"
    assert pages.c_reference("u", c)[0][1].startswith("size_t strlen(const char*)\n\nGives thelength.") and pages.c_reference("u", "<p>x</p>") == []
    py = "<dl><dt class='sig py'>os.<b>walk</b>(top)<a>¶</a></dt><dd>" + "d" * 1200 + "</dd><dt class='sig'>os.sep</dt></dl><dt class='sig'>os.x()</dt>"
    got = pages.python_reference("os", py)
    assert [g[2] for g in got] == ["os. walk", "os.x"] and len(got[0][1]) == len("os. walk (top)") + 2 + 1000 and got[1][1] == "os.x()"
    assert pages.web_reference("css/gap", "<p>no main")[0] == ("What is the MDN reference for gap?", "no main", "gap")
    df = spark.createDataFrame([("k", "<main><h1>T</h1><p>a<p>b</main>"), ("n", None)], "key STRING, html STRING")
    assert [tuple(r)[2] for r in pages.page_records(df, "web", "key").collect()] == ["ab"]


def test_validation(spark):
    schema = "instruction STRING, output STRING, layer STRING, language STRING, token_count BIGINT"
    good = [(f"task {i}", f"out {i}", "code", "python", 10) for i in range(120)]
    report = validate.validation_report(spark.createDataFrame(good, schema), ["python"])
    assert validate.passes(report) and {r["name"]: r["ok"] for r in report.collect()}["share_code"] is False
    assert not validate.passes(validate.validation_report(spark.createDataFrame(good + [(None, "x", None, None, None)], schema), ["python"]))
    assert not validate.passes(validate.validation_report(spark.createDataFrame([], schema), ["python"]))
    lines = spark.createDataFrame([(1, '{"instruction": "a", "output": "b"}'), (2, "{bad"), (3, " "), (4, '{"instruction": "a"}')], "line_no INT, value STRING")
    assert [tuple(r) for r in validate.structure_errors(lines).collect()] == [(2, "bad JSON"), (4, "no output")]


def test_plans_of_nodes(spark):
    nodes = spark.createDataFrame([("q", "N01", []), ("q", "N02", ["N01"]), ("q", "N03", ["N02"]), ("e", f"N{1:02d}", ["N05"]), ("e", "bad", ["bad"])], "query_id STRING, id STRING, dependencies ARRAY<STRING>")
    assert sorted(tuple(r) for r in dag.plan_errors(nodes).collect()) == [("e", "N01", "missing_dependency"), ("e", "bad", "bad_id"), ("e", "bad", "self_dependency")]
    many = spark.createDataFrame([("m", f"N{i:02d}", []) for i in range(25)], nodes.schema)
    assert [r["error"] for r in dag.plan_errors(many).collect()] == ["too_many_nodes"]
    state = spark.createDataFrame([("q", "N01", "DONE"), ("q", "N02", "PENDING")], "query_id STRING, node_id STRING, status STRING")
    assert [r["id"] for r in dag.ready_nodes(nodes.where("query_id = 'q'"), state).collect()] == ["N02"]
    splits = spark.createDataFrame([("a", "N01", 1, 3), ("b", "N01", 1, 2)], "query_id STRING, node_id STRING, depth INT, children INT")
    assert [r["query_id"] for r in dag.explosions(splits).collect()] == ["a"]
    s = spark.createDataFrame([("q", "a", 1, 2000), ("q", "b", 2, 1000), ("q", "c", 3, 100)], "query_id STRING, section STRING, priority INT, tokens INT")
    assert sorted(r["section"] for r in dag.fit_context(s).collect()) == ["a", "b"]


def test_pressure(spark):
    rows = [(float(t), 90.0 if 10 <= t <= 18 else 10.0, 4000 if t != 30 else 500) for t in range(40)]
    got = [tuple(r)[1:] for r in dag.pressure_spans(spark.createDataFrame(rows, "t DOUBLE, cpu_pct DOUBLE, ram_avail_mb BIGINT")).collect()]
    assert sorted(got) == [(10.0, 18.0, "cpu"), (30.0, 30.0, "ram")]


def test_retrieval_bits(spark):
    q = spark.createDataFrame([(1,), (2,), (3,), (4,)], "query_id INT")
    one = lambda i, **k: spark.createDataFrame([(i, "a", 0.9)], "query_id INT, answer STRING, score DOUBLE")
    got = {r["query_id"]: r["way"] for r in retrieval.route(q, one(1), one(2), one(3), 0.5).collect()}
    assert got == {1: "cache", 2: "sparse", 3: "dense", 4: "online"}
    e = spark.createDataFrame([(1, "s1", "The port is open", 0.9), (1, "s2", "It rains", 0.1)], "query_id INT, source STRING, sentence STRING, score DOUBLE")
    assert retrieval.brief(e).first()["brief"] == "[1] The port is open (s1)\n[2] It rains (s2)"
    claims = spark.createDataFrame([(7, 1, "port open"), (8, 2, "x")], "claim_id INT, query_id INT, claim STRING")
    assert {r["claim_id"]: r["grounded"] for r in retrieval.grounded(claims, e).collect()} == {7: True, 8: False}


def test_nearest_equals_brute_force(spark, monkeypatch):
    """More queries than a block holds, ties, and vectors without a cosine."""
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 7)
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(60)] + [(60, [0.0] * 3), (61, None), (62, [1.0, None, 1.0]), (63, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = retrieval.nearest(df, df.where("vec_id % 5 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 4)
    usable = {i: v for i, v in rows[:60] if any(v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = {(q, i, k + 1) for q in usable if q % 5 == 0 for k, (_, i) in enumerate(sorted((-round(dot(usable[q], v) / (dot(v, v) ** 0.5 * dot(usable[q], usable[q]) ** 0.5), 6), i) for i, v in usable.items() if i != q)[:4])}
    assert {(r["query_id"], r["id"], r["rank"]) for r in got.collect()} == want


def test_bm25_equals_brute_force(spark, monkeypatch):
    """More queries than a block holds, whole documents as queries, a term in all of them, and texts without terms."""
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 7)
    rng = random.Random(3)
    texts = {i: " ".join(["the", *(f"w{int(rng.paretovariate(0.7)) % 50}" for _ in range(rng.randint(1, 30)))]) for i in range(60)} | {60: "", 61: None, 62: "é ñ"}
    df = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = retrieval.bm25(df, df.where("doc_id % 5 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), 4)
    split = {i: (t or "").split() if i < 60 else [] for i, t in texts.items()}
    mean = sum(map(len, split.values())) / len(split)
    n_with = {w: sum(w in t for t in split.values()) for t in split.values() for w in t}
    want = set()
    for q in range(0, 60, 5):
        part = lambda w, t: math.log(1 + (len(split) - n_with[w] + 0.5) / (n_with[w] + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / mean))
        best = sorted((-round(sum(part(w, t) for w in set(split[q]) & set(t)), 6), i) for i, t in split.items() if set(split[q]) & set(t))[:4]
        want |= {(q, i, round(-s, 5), k + 1) for k, (s, i) in enumerate(best)}
    assert {(r["query_id"], r["id"], round(r["score"], 5), r["rank"]) for r in got.collect()} == want


def test_bm25_search_takes_every_stated_query(spark, tmp_path):
    from granary.plans import catalogue

    spark.range(500).select(F.col("id").alias("doc_id"), F.format_string("common word%d", F.col("id") % 7).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["query_id"], r["rank"]) for r in catalogue.queries()["q_bm25_search"](spark, str(tmp_path)).collect()}
    assert got == {(q, k) for q in range(0, 500, 100) for k in range(1, 11)}


def test_cosine_search_takes_every_stated_query(spark, data):
    from granary.plans import catalogue

    got = {r["query_id"] for r in catalogue.queries()["q_cosine_search"](spark, data).collect()}
    assert got == {0, 100, 200, 300, 400}


def test_stats_and_budget(spark):
    df = spark.createDataFrame([("code", "c", 100), ("alignment", None, 10)], "layer STRING, language STRING, token_count BIGINT")
    row = mix.stats_document(df).first()
    assert row["total_examples"] == 2 and row["layer_counts"] == {"alignment": 1, "code": 1} and row["language_counts"] == {"c": 1, "unknown": 1}
    assert mix.alignment_budget(df, 0.5).first()[0] == 90 and mix.alignment_budget(df.limit(0), 0.5).first()[0] == 0
    assert mix.mean_tokens(df).first()[0] == 55 and mix.mean_tokens(df.limit(0)).first()[0] == 0


def test_sampler_is_reproducible():
    b = backends.NgramBackend()
    r = lambda p, **k: {"prompt": p, "max_tokens": 40, "temperature": 0.9, "top_p": 0.95, "stop": [], "seed": 3} | k
    one, two, none = b.complete([r("alpha"), r("beta"), r("")])
    assert b.complete([r("beta")]) == [two] and one != two and none is None
    assert len(backends.pieces(one)) <= 41 and b.complete([r("alpha", seed=4)]) != [one]
    assert b.complete([r("x", temperature=0.0), r("x", temperature=0.0, seed=9)])[0] == b.complete([r("x", temperature=0.0)])[0]
    assert "".join(backends.pieces("a  b, c_d\n e'f  ")) == "a  b, c_d\n e'f  "


def test_prompts_are_fitted_by_tokens():
    text = " ".join(f"w{i}" for i in range(1000))
    fitted = infer.fit_prompt(text, 200, 84, backends.pieces)
    assert len(backends.pieces(fitted)) == 100 and text.endswith(fitted)
    assert infer.fit_prompt("short", 200, 84, backends.pieces) == "short"


def test_a_server_completes():
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if "FAIL" in body["prompt"]:
                self.send_error(500)
                return
            out = json.dumps({"choices": [{"text": f"{body['prompt']}:{body['max_tokens']}"}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    b = backends.HttpBackend(f"http://127.0.0.1:{server.server_port}/")
    r = lambda p: {"prompt": p, "max_tokens": 5, "temperature": 0.1, "top_p": 0.9, "stop": []}
    assert b.complete([r("a"), r("FAIL"), r("b")]) == ["a:5", None, "b:5"]
    server.shutdown()


def test_three_prompts_in_one_batch(spark):
    jobs = spark.createDataFrame([(i, f"Say what {n} does.", 20, 0.2, None, ["\n"]) for i, n in enumerate(("add", "sub", "mul"))], records.JOB).coalesce(1)
    got = infer.run_completions(jobs, backends.NgramBackend, infer.WorkerSpec("cpu", "cpu0", n_parallel=3)).orderBy("_idx").collect()
    assert [r["_idx"] for r in got] == [0, 1, 2] and all(r["_text"] and "\n" not in r["_text"] and r["_len"] == len(r["_text"]) for r in got)


def test_a_process_builds_its_backend_once(spark):
    class Counted(backends.EchoBackend):
        def __init__(self):
            import os
            import uuid

            self.name = f"{os.getpid()}-{uuid.uuid4().hex}"

    jobs = spark.range(40).select(F.col("id").alias("_idx"), F.lit("p").alias("prompt"), F.lit(5).alias("max_tokens"), F.lit(0.1).alias("temperature"), F.lit(None).cast("double").alias("top_p"), F.lit(None).cast("array<string>").alias("stop"))
    workers = [r["_worker"] for r in infer.run_completions(jobs, Counted, partitions=20).collect()]
    assert len(set(workers)) == len({w.split("-")[0] for w in workers})


def test_runs_resume_from_log_and_output(spark, tmp_path):
    jobs = spark.createDataFrame([(i, f"p{i}", 4, 0.1, None, []) for i in range(6)], records.JOB)
    old = lambda i, t, w="old": (i, 4, 0.1, None, w, t, len(t or ""))
    spark.createDataFrame([old(0, "from log"), old(1, "log too"), old(9, "no job"), old(-1, "no job"), old(5, "x", "lost")], infer.RESULT).write.parquet(str(tmp_path / "partial"))
    spark.createDataFrame([old(1, "from output"), old(2, None)], infer.RESULT).write.parquet(str(tmp_path / "results"))
    stats = infer.run_to_folder(spark, jobs, str(tmp_path))
    got = {r["_idx"]: r["_text"] for r in spark.read.parquet(str(tmp_path / "results")).collect()}
    assert sorted(got) == list(range(6)) and got[0] == "from log" and got[1] == "from output" and got[2] is None and got[5].startswith("Write code")
    assert stats["jobs"] == 6 and stats["resumed"] == 3 and stats["failed"] == 1 and not (tmp_path / "partial").exists()
    again = infer.run_to_folder(spark, jobs, str(tmp_path))
    assert again["resumed"] == 6 and again["plan"][0]["kind"] == "cpu"


def test_expansion_goes_on_until_its_target(spark):
    args = (spark, ["p1", "p2"], ["c", "css"], {"p1": "hint"})
    echo = infer.expand_in_rounds(*args, 100).collect()  # the same answers again: it stops after a round without progress
    assert len(echo) == 4
    sampled = infer.expand_in_rounds(*args, 11, backends.NgramBackend).collect()
    assert len(sampled) == 11 and len({r["good"] for r in sampled}) == 11 and max(r["pos"] for r in sampled) >= 8
    known = spark.createDataFrame([(r["good"],) for r in echo[:2]], "good STRING")
    assert len(infer.expand_in_rounds(*args, 100, known=known).collect()) == 2


def test_mixes_of_workers_are_compared(spark, tmp_path):
    jobs = spark.createDataFrame([(i, f"p{i}", 4, 0.1, None, []) for i in range(4)], records.JOB)
    got = resources.compare_mixes(spark, jobs, {"one": infer.WorkerSpec("cpu", "a"), "two": infer.WorkerSpec("cpu", "b", n_threads=2)}, str(tmp_path), backends.EchoBackend)
    assert {r["name"] for r in got} == {"one", "two"} and all(r["jobs"] == 4 and r["ok_pct"] == 100.0 for r in got)


def test_a_planned_run(spark, tmp_path):
    jobs = spark.createDataFrame([(i, f"p{i}", 4, 0.1, None, []) for i in range(5)], records.JOB)
    machine = resources.Resources(resources.Cpu(8, 4), resources.Ram(16_000, 12_000))
    stats = resources.run_planned(spark, jobs, str(tmp_path), backends.EchoBackend, machine=machine, sample=2)
    assert stats["jobs"] == stats["ok"] == 5 and 1 <= len(stats["plan"]) <= 2 and (tmp_path / "plan.json").exists()
    none = resources.run_planned(spark, jobs.limit(0), str(tmp_path / "none"), backends.EchoBackend, machine=resources.Resources())
    assert none["jobs"] == 0 and len(none["plan"]) == 1


def test_empty_tables(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    assert retrieval.top_sentences(none("doc_id BIGINT, text STRING")).count() == 0
    assert infer.merged_results(none(infer.RESULT), none(infer.RESULT), 5).count() == 0
    assert dag.compiled_context(none("query_id STRING, section STRING, age INT, tokens INT")).count() == 0
    assert dag.node_states(none("event_id BIGINT, query_id STRING, node_id STRING, event_type STRING, created_at STRING")).count() == 0
    assert validate.enough_files(none("repo STRING, path STRING")).count() == 0
    assert chunking.yaml_chunks(none("i INT, t STRING"), "i", "t").count() == 0
    assert quality.ranked_report(none("layer STRING, reason STRING, n BIGINT, tokens BIGINT")).count() == 0


def test_contexts_and_states(spark):
    pieces = [("q", "node", 0, 400), ("q", "summaries", 0, 300), ("q", "summaries", 1, 300), ("q", "summaries", 2, 300), ("q", "brief", 0, 200), ("q", "topology", 0, 100), ("q", "odd", 0, 50)]
    df = spark.createDataFrame(pieces, "query_id STRING, section STRING, age INT, tokens INT")
    got = {(r["section"], r["age"]): r["cut"] for r in dag.compiled_context(df).collect()}
    assert got == {("node", 0): 350, ("summaries", 0): 300, ("summaries", 1): 300, ("summaries", 2): 50, ("brief", 0): 200, ("topology", 0): 100}
    tight = {(r["section"], r["age"]) for r in dag.compiled_context(df, 1100).collect()}
    assert tight == {("node", 0), ("topology", 0), ("brief", 0)}
    assert sum(dag.SECTIONS.values()) + 442 == dag.CONTEXT_TOKENS and len(dag.EVENT_TYPES) == 22 and len(dag.METRICS) == 15
    ev = [(1, "q", "N01", "node.ready", "a"), (2, "q", "N01", "node.attempt.start", "b"), (3, "q", "N01", "sandbox.exit", "c"), (4, "q", "N02", "sandbox.start", "a"), (5, "q", "N02", "nope", "b")]
    events = spark.createDataFrame(ev, "event_id BIGINT, query_id STRING, node_id STRING, event_type STRING, created_at STRING")
    assert {r["node_id"]: (r["status"], r["attempt"]) for r in dag.node_states(events).collect()} == {"N01": ("RUNNING", 1), "N02": ("PENDING", 0)}
    assert [tuple(r) for r in dag.unknown_events(events).collect()] == [("nope", 1)]
    assert {*dag.TRANSITIONS} <= {*dag.EVENT_TYPES} and {*dag.TRANSITIONS.values()} <= {*dag.STATES}


def test_sentences(spark):
    text = "Alpha beta. Gamma alpha! Delta?\n\n  \nEpsilon zeta eta"
    df = spark.createDataFrame([(1, text), (2, "alpha alpha"), (3, None), (4, "  ")], "doc_id BIGINT, text STRING")
    got = [tuple(r)[:3] for r in retrieval.top_sentences(df, 2).orderBy("id", "place").collect()]
    assert [r for r in got if r[0] == 2] == [(2, 0, "alpha alpha")] and len([r for r in got if r[0] == 1]) == 2 and {r[0] for r in got} == {1, 2}


def test_sentences_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"the w{i % 5} of w{i}. And the w{i % 3}.") for i in range(60)], "doc_id BIGINT, text STRING")
    whole = sorted(map(tuple, retrieval.top_sentences(df).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_TERMS", 0)
    assert sorted(map(tuple, retrieval.top_sentences(df).collect())) == whole


def test_the_report_carries_no_text(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    rows = spark.createDataFrame([(1, "a", "Write a thing", "o" * 50)], "pos BIGINT, layer STRING, instruction STRING, output STRING").repartition(2)
    plan = quality.drop_report(quality.waterfall(rows))._jdf.queryExecution().optimizedPlan().toString()
    met = next(x for x in plan[plan.index("Join") :].split("\n") if "Project [" in x)
    assert "_said#" in met and not re.search(r"(?:\[|, )(?:instruction|output)#\d+L?(?:,|\])", met)


def test_alignment_expansion(spark):
    combos = mix.combinations(spark, ["p1", "p2"], ["c", "css"], 10)
    got = infer.expand_alignment(combos, {"p1": "hint"}, target=3).collect()
    assert combos.count() == 24 and len(got) == 3 and all(r["good"] and r["bad"] for r in got)


def test_fixes_are_made_from_the_whole_code(spark):
    """Long codes that differ only behind 2,000 characters, in their last or in their first line get fixes of their own."""
    body = "x = 1\n" * 3000
    codes = [body + "a()", body + "b()", "c()\n" + body + "a()", body[:3000] + "d()\n" + body[3000:] + "a()"]
    code = spark.createDataFrame([(i, "python", "", c) for i, c in enumerate(codes)], "pos BIGINT, language STRING, instruction STRING, output STRING")
    known = spark.range(0).select(F.lit("").alias("output"))
    got = infer.expand_from_code(code, known, {"p1": "hint"}).collect()
    assert {r["input"] for r in got} == set(codes) and len({r["output"] for r in got}) == 4
    prompt = code.select(infer.good_code_prompt(F.col("language"), F.lit("hint"), F.col("output"))).first()[0]
    assert codes[0] in prompt and "keeps the rule: hint" in infer.fit_prompt(prompt, 1536, 128)


def test_align_code_takes_the_whole_budget(spark, tmp_path):
    from granary.plans import catalogue

    spark.range(5000).select(F.col("id").alias("chunk_id"), F.lit("python").alias("language"), F.lit("f").alias("name"), F.format_string("def f%d(): pass", F.col("id")).alias("code")).write.parquet(f"{tmp_path}/code_chunks_raw.parquet")
    spark.createDataFrame([("a text",)], "text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalogue.queries()["q_align_code"](spark, str(tmp_path)).count() == 4000


@pytest.mark.parametrize("path,ok", [("a/b.py", True), ("a/b.PY", False), ("vendor/b.py", False), ("a/.py", False)])
def test_source_file_rule(spark, path, ok):
    df = spark.createDataFrame([(path, 10)], "p STRING, n INT")
    assert df.select(quality.source_file_ok(F.col("p"), F.col("n"), [".py"], ["vendor"])).first()[0] is ok


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "Write a thing", "o" * 50, 1, 2, 3)], "pos BIGINT, layer STRING, instruction STRING, output STRING, reason INT, n INT, token_count INT")
    assert quality.waterfall(df).first()["reason"] == "kept"
    assert X.strip(F.lit("x")) is not None
