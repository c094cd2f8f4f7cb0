"""Sources, sinks, streams and the pipeline, on folders of their own."""

import json
import time

import pytest
from pyspark.sql import functions as F

from granary import session
from granary.operators import infer, records
from granary.plans import pipeline, resources
from granary.session import fresh_path, local_mount, materialize, shared_dir
from granary.sources import files, paged, repositories, seeds
from granary.streaming import streams


def test_jsonl(spark, tmp_path):
    p = str(tmp_path / "x")
    rows = seeds.alignment_seeds(spark)
    n = rows.count()
    assert files.write_jsonl(rows, p) == n and files.read_jsonl(spark, p).count() == n
    assert files.read_jsonl(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "e").write_text("")
    with pytest.raises(files.EmptyInput):
        files.read_jsonl(spark, str(tmp_path / "e"))
    with pytest.raises(ValueError):
        files.read_jsonl(spark, p, most_bytes=1)
    (tmp_path / "b").write_text('{"instruction": "a"}\n\n{bad\n')
    assert [r["line"] for r in files.bad_lines(spark, str(tmp_path / "b")).collect()] == ["{bad"]
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "b")).collect()
    assert files.finished(spark, p, n) and not files.finished(spark, p, n + 1) and not files.finished(spark, str(tmp_path / "none"), 1)


def test_tree(spark, tmp_path):
    (tmp_path / "r/src").mkdir(parents=True)
    (tmp_path / "r/src/a.py").write_bytes(b"x = 1\ny = '\xff'")
    got = files.read_tree(spark, str(tmp_path)).collect()
    assert [(r["path"], r["n_lines"]) for r in got] == [("r/src/a.py", 2)] and "\ufffd" in got[0]["text"]
    (tmp_path / "r/node_modules").mkdir()
    (tmp_path / "r/node_modules/b c.py").write_text("y = 2\n")
    hidden = tmp_path / "r/node_modules/b c.py"
    assert [r["path"] for r in files.read_tree(spark, str(tmp_path)).collect()] == ["r/node_modules/b c.py", "r/src/a.py"]
    hidden.chmod(0)  # what isn't wanted isn't opened
    assert [r["path"] for r in files.read_tree(spark, str(tmp_path), keep=lambda p: ~F.contains(p, F.lit("node_modules"))).collect()] == ["r/src/a.py"]
    hidden.chmod(0o644)
    assert {r["path"] for r in files.list_tree(spark, str(tmp_path)).collect()} == {"r/node_modules/b c.py", "r/src/a.py"}


def test_metrics(spark, tmp_path):
    (tmp_path / "m.csv").write_text("t,cpu_pct,cpu_logical,ram_used_mb,ram_avail_mb,gpu_util_pct,gpu_vram_used_mb,gpu_vram_free_mb,gpu_power_w,gpu_temp_c\n1,50,8,1,2,,,,,\n2,60.5,8,1,2,30,,,,\n")
    r = files.metric_averages(files.read_metrics(spark, str(tmp_path / "m.csv"))).first()
    assert (r["avg_gpu"], r["avg_cpu"]) == (30.0, 55.2)


def test_metrics_are_written(spark, tmp_path):
    p = str(tmp_path / "d/m.csv")
    files.write_metrics([{"t": 1.0, "cpu_pct": 50.0, "cpu_logical": 8, "gpu_util_pct": None, "other": 1}, {"t": 2.0, "cpu_pct": 70.0}], p)
    got = files.read_metrics(spark, p)
    assert got.count() == 2 and files.metric_averages(got).first() == (0.0, 60.0)
    with resources.Monitor(0.05, p):
        time.sleep(0.3)
    assert files.read_metrics(spark, p).where("ram_avail_mb > 0").count() >= 2


def test_gpu_is_asked():
    machine = resources.probe(lambda command: "8192, 6000, 2192, 35, [N/A], 60\n", backend=True)
    assert machine.gpu == resources.Gpu(True, True, 8192, 6000) and machine.cpu.logical >= 1 and machine.ram.total_mb > 0
    assert resources.gpu_numbers(lambda command: "8192, 6000, 2192, 35, [N/A], 60\n")["gpu_power_w"] is None
    assert resources.gpu_numbers(lambda command: 1 / 0) == {} and not resources.probe(lambda command: "").gpu.present


def test_clones(tmp_path):
    calls = []

    def git(*arguments):
        calls.append(arguments)
        if "bad" in arguments[-2]:
            raise OSError("no network")

    (tmp_path / "old/.git").mkdir(parents=True)
    got = repositories.clone_all([("new", "u/new"), ("old", "u/old"), ("bad", "u/bad")], str(tmp_path), git)
    assert got["new"] == "cloned" and got["old"] == "updated" and got["bad"].startswith("failed") and calls[0][:3] == ("clone", "--depth", "1") and "--ff-only" in calls[1]


def test_pages_are_cached(tmp_path):
    waits = []
    get = lambda url: 1 / 0 if "gone" in url else "oops" if "odd" in url else f"<html>{url}</html>"
    urls = ["https://x.example/a", "https://x.example/odd", "https://x.example/gone", "https://x.example/b", "https://x.example/a"]
    assert paged.fetch_into(urls, str(tmp_path), get, waits.append) == (2, ["https://x.example/odd", "https://x.example/gone"]) and len(waits) == 3
    assert paged.fetch_into(urls[:1], str(tmp_path), get, waits.append) == (0, []) and (tmp_path / "https___x_example_a.html").exists()


def test_seeds(spark):
    assert (seeds.alignment_seeds(spark).count(), seeds.operations_seeds(spark).count(), seeds.paper_rows(spark).count()) == (11, 20, 2)
    assert seeds.repositories(spark).count() == 9 and {r["family"] for r in seeds.reference_pages(spark).collect()} == {"c", "python", "web"}


def test_pages_are_tried_again():
    waits, calls = [], []

    def get(offset, length):
        calls.append(offset)
        if len(calls) == 1:
            raise paged.TooManyRequests
        if len(calls) == 2:
            return {"not": "rows"}
        return [1, 2]

    assert paged.fetch_page(get, 0, 100, waits.append) == [1, 2] and waits == [5.0, 4.0]
    with pytest.raises(paged.LostPage):
        paged.fetch_page(lambda o, n: 1 / 0, 0, 1, lambda s: None)


def test_paged_source(spark):
    paged.register(spark)
    df = spark.read.format("pages").option("module", "granary.sources.paged").option("function", "sample_page").option("rows", "250").load()
    assert df.count() == 250 and json.loads(df.where("row_idx = 120").first()["row"]) == {"n": 120}
    few = spark.read.format("pages").option("module", "granary.sources.paged").option("function", "sample_page").option("rows", "250").option("most", "130").load()
    assert sorted(r["row_idx"] for r in few.collect()) == list(range(130))


def test_source_rows(spark):
    df = spark.createDataFrame([(i, f"t{i % 7}") for i in range(20)], "k INT, t STRING")
    got = paged.source_rows(df, lambda d: d.select("k", F.col("t").alias("output")), "k", 4).collect()
    assert sorted(r["k"] for r in got) == [0, 1, 2, 3]


def test_source_rows_of_several_sources(spark):
    df = spark.createDataFrame([(i, ["a", "b", None][i % 3], f"t{i // 3 % 4}") for i in range(30)], "k INT, s STRING, t STRING")
    mapped = lambda d: d.select("k", "s", F.col("t").alias("output"))
    assert sorted(r["k"] for r in paged.source_rows(df, mapped, "k", source="s").collect()) == list(range(12))
    assert sorted(r["k"] for r in paged.source_rows(df, mapped, "k", 2, "s").collect()) == list(range(6))


def test_every_source_gives_rows(spark, data):
    from granary.plans import catalogue

    docs = spark.read.parquet(f"{data}/documents.parquet").where("topic IS NOT NULL AND text IS NOT NULL")
    got = catalogue.queries()["q_source_rows_all"](spark, data)
    assert {r["source"] for r in got.collect()} == {r["source"] for r in docs.select("source").distinct().collect()}


def test_page_cache(spark):
    a = spark.createDataFrame([("https://x.example/a",), ("https://x.example/b",)], "url STRING")
    cache = spark.createDataFrame([("https___x_example_a", "<html>A</html>"), ("https___x_example_b", "oops")], "name STRING, html STRING")
    assert [r["url"] for r in paged.uncached(a, cache).collect()] == ["https://x.example/b"]
    assert paged.cached_pages(a, cache).count() == 2


def test_materialize(spark):
    df = materialize(spark.range(5), "t")
    assert df.count() == 5 and shared_dir(spark) in df.inputFiles()[0].replace("file:///", "file:///") and fresh_path(spark, "a") != fresh_path(spark, "a")


def test_local_mount(spark):
    assert local_mount(spark, "file:///a/b") == "/a/b" and local_mount(spark, "/a/b") in ("/a/b", None)


def test_stream_equals_batch(spark, data, tmp_path):
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    src = tmp_path / "events"
    spark.read.parquet(f"{data}/events.parquet").orderBy("ts").coalesce(1).write.parquet(str(src))
    out = str(tmp_path / "out")
    streams.drain(streams.tumbling(spark.readStream.schema(schema).parquet(str(src))), out, str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.read.parquet(out).select("window_start", "event_type", "n").collect()}
    want = {tuple(r) for r in streams.tumbling(spark.read.parquet(str(src))).select("window_start", "event_type", "n").collect()}
    assert got <= want and len(want) - len(got) <= 10 and got  # the last windows stay open behind the watermark


def test_results_resume(spark, tmp_path):
    jobs = spark.createDataFrame([(i, f"p{i}", 4, 0.1, None, []) for i in range(6)], records.JOB)
    src, out, cp = (str(tmp_path / x) for x in ("jobs", "out", "cp"))
    jobs.where("_idx < 3").write.parquet(src)
    streams.resumable_results(spark, src, records.JOB, out, cp, infer.run_completions).awaitTermination()
    jobs.where("_idx >= 3").write.mode("append").parquet(src)
    streams.resumable_results(spark, src, records.JOB, out, cp, infer.run_completions).awaitTermination()
    assert sorted(r["_idx"] for r in spark.read.parquet(out).collect()) == list(range(6))


def test_arrivals_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), (None, 3)], "t STRING, s INT").select("t", F.timestamp_seconds("s").alias("at")).write.parquet(str(tmp_path / "s"))
    streams.drain(streams.arrivals_once(spark.readStream.schema("t STRING, at TIMESTAMP").parquet(str(tmp_path / "s")), "t", "at"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Context:
        master = "spark://h:7077"

    class Session:
        conf = spark.conf
        sparkContext = Context()

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            shared_dir(Session())


def test_tables_are_removed(spark):
    df = materialize(spark.range(5), "t")
    path = df._granary_path
    session.discard(df)
    assert not session.exists(spark, path)


def test_pipeline(spark, tmp_path):
    src = tmp_path / "repos/demo/src"
    src.mkdir(parents=True)
    for i in range(60):
        (src / f"m{i}.py").write_text(f"def task_{i}(a):\n    b = a + {i}\n    c = b * {i}\n    return c\n\n\nclass K{i}:\n    x = {i}\n    y = x\n    z = 'a long enough line {i}'\n")
    config = tmp_path / "config/demo/k8s"
    config.mkdir(parents=True)
    (config / "web.yaml").write_text("kind: Pod\nmetadata:\n  name: web\nspec:\n  containers: []\n  restartPolicy: Always\n")
    (tmp_path / "pages/web").mkdir(parents=True)
    (tmp_path / "pages/web/p.json").write_text(json.dumps({"key": "css/gap", "html": "<main><h1>gap</h1><p>The gap property sets the space between rows and columns.</p></main>"}) + "\n")
    (tmp_path / "hub/code").mkdir(parents=True)
    (tmp_path / "hub/code/c.json").write_text(json.dumps({"instruction": "Write a function that adds one to a number", "output": "def add_one(n):\n    return n + 1", "language": "python"}) + "\n")
    (tmp_path / "hub/chats").mkdir(parents=True)
    (tmp_path / "hub/chats/c.json").write_text(json.dumps({"conversations": json.dumps([{"from": "human", "value": "How do I list services?"}, {"from": "gpt", "value": "Use the command systemctl list-units and read its table."}])}) + "\n")
    assert pipeline.main(["--data", str(tmp_path), "--phase", "nope"], spark) == 1
    assert pipeline.main(["--data", str(tmp_path), "--align", "40", "--backend", "ngram", "--monitor", str(tmp_path / "load.csv"), "--hub", "doc=granary.sources.paged:sample_instructions:30"], spark) == 0
    assert (tmp_path / "load.csv").exists() and json.loads((tmp_path / "runs/instruct/plan.json").read_text())["jobs"] == 120
    assert pipeline.main(["--data", str(tmp_path), "--phase", "align-code,filter,mix,validate"], spark) == 0
    assert files.read_jsonl(spark, str(tmp_path / "layers/alignment_code")).count() > 100
    assert pipeline.main(["--data", str(tmp_path), "--phase", "chunk,mix", "--resume"], spark) == 0
    stats = json.loads((tmp_path / "stats.json").read_text())
    assert stats["total_examples"] == files.read_jsonl(spark, str(tmp_path / "train")).count() >= 100 and stats["layer_counts"]["code"] > 100 and stats["layer_counts"]["doc"] == 31
    assert {"hub:chats", "hub:rows", "web_reference"} <= {r["s"] for r in files.read_jsonl(spark, str(tmp_path / "train")).select("metadata.source").withColumnRenamed("source", "s").distinct().collect()}
