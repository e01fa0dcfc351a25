"""Dumps in byte ranges, batches, shards, the event log, samples and case folding: queries against SQL and odd cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import _folds, clean_entity, compact_name, folded
from tessera.operators.batches import numbered, requests, slug_batches
from tessera.operators.samples import failure_samples
from tessera.plans import work_queries
from tessera.plans.events import EventLog, durations
from tessera.plans.shards import MENTION_ROWS, ManifestChanged, Shards, mentions
from tessera.sources import captures, sections
from tests.test_mart import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(work_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(work_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(work_queries.SQL[name]).df())


def whole_file(text):
    """What one reader of the whole file finds."""
    out, inside = [], False
    for line in text.split("\n"):
        if line.strip() == '"products": [':
            inside = True
        elif inside and line.strip() == '"posts": [':
            break
        elif inside and line.strip().rstrip(",") not in ("", "[", "]", "{", "}"):
            out.append(json.loads(line.strip().removesuffix(",")))
    return out


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_one_dump_is_read_in_many_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    lines = lambda n: [f'    {{"id": {i}, "slug": "S{rng.randrange(40)}", "name": "é{"x" * rng.randrange(60)}"}},' for i in range(n)]
    dumps = {
        "a.json": ["{", '  "posts": [', *lines(30), "  ],", '  "products": [', *lines(400), "  ],", '  "posts": [', *lines(200), "  ],", '  "products": [', *lines(9), "}"],
        "b.json": ["{", '  "products": [', *lines(100), "", "  ]", "}"],
        "c.json": ["{", '  "posts": [', *lines(50), "}"],
        "d.json": [""],
    }
    for name, some in dumps.items():
        (tmp_path / name).write_text("\n".join(some))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = sections.section_objects(spark, str(tmp_path), "products", "posts", "id long, slug string, name string")
        rows = [(r["file"].rpartition("/")[2], r["r"].asDict()) for r in got.orderBy("file", "start", "number").collect()]
        if size == 1000:
            assert sections.placed_lines(spark, f"{tmp_path}/a.json").rdd.getNumPartitions() > 20
            wanted = spark.createDataFrame([("s1",), ("s2",), ("none",)], "slug string")
            last = {r["slug"]: r["r"]["id"] for r in sections.selected_objects(got.where(F.col("file").endswith("a.json")), wanted).collect()}
            assert last == {s: [x for x in whole_file("\n".join(dumps["a.json"])) if x["slug"].lower() == s][-1]["id"] for s in ("s1", "s2")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == [(name, x) for name, some in dumps.items() for x in whole_file("\n".join(some))]


def test_malformed_lines_are_marked(spark, tmp_path):
    (tmp_path / "d.json").write_text('"products": [\n{"id": 1},\n{"id": ,\n]\n"posts": [\n')
    got = sections.section_objects(spark, f"{tmp_path}/d.json", "products", "posts", "id long").collect()
    assert sorted((r["r"]["id"] or 0, r["malformed"]) for r in got) == [(0, True), (1, False)]
    assert captures.sectioned_json(spark, f"{tmp_path}/d.json", "products", "posts", "id long").columns == ["id"]


FIELD = "{id slug name tagline description websiteUrl categories{name} meta{description}}"


def asked(slugs, limit):
    text = "query ProductSlugBatch{" + " ".join(f"p{i}:product(slug:{json.dumps(s, ensure_ascii=False)}){FIELD}" for i, s in enumerate(slugs)) + "}"
    if len(text.encode()) <= limit:
        return [(slugs, text)]
    half = len(slugs) // 2
    assert half
    return asked(slugs[:half], limit) + asked(slugs[half:], limit)


@pytest.mark.parametrize("limit", [24_000, 4_000, 700])
def test_batches_equal_halving(spark, limit):
    rng = random.Random(limit)
    slugs = sorted({"".join(rng.choice('abcé-"\\') for _ in range(rng.choice([3, 9, 60, 150]))) for _ in range(330)}, key=str.encode)
    rows = spark.createDataFrame([(s,) for s in [*slugs, *slugs[:20], None]], "slug string").repartition(7)
    batches = slug_batches(rows, "slug", limit=limit)
    got = [(r["slugs"], r["text"]) for r in requests(batches).orderBy("batch", "part").collect()]
    want = [x for at in range(0, len(slugs), 100) for x in asked(slugs[at : at + 100], limit)]
    assert got == want and all(len(text.encode()) <= limit for _, text in got)
    assert {r["size"] for r in batches.collect()} == {len(text.encode()) for _, text in got}
    assert limit == 24_000 or max(r["part"] for r in batches.collect()) > 0


def test_a_slug_beyond_the_limit(spark):
    with pytest.raises(Exception, match="exceeds the limit"):
        slug_batches(spark.createDataFrame([("x" * 900,), ("y",)], "slug string"), "slug", limit=500).collect()
    assert slug_batches(spark.createDataFrame([], "slug string"), "slug").count() == 0


def test_positions(spark):
    rows = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(5)
    got = [(r["k"], r["position"]) for r in numbered(rows, "k").collect()]
    assert sorted(got) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got))]


def products(spark, n=40):
    return spark.createDataFrame([(f"s{i}", "Alpha" if i % 2 else None, None, f"Alpha Beta beta Gamma{i}" if i % 5 else None) for i in range(n)], "slug string, name string, tagline string, description string")


def model(text):
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+"), F.lit(0))
    return F.transform(words, lambda w, i: F.struct(w.alias("text"), F.lit("Word").alias("label"), (F.length(w) / 10).cast("float").alias("score"), i.alias("start"), (i + 1).alias("end")))


def test_shards_resume(spark, tmp_path):
    told, calls = [], []

    def work(rows):
        calls.append(1)
        return mentions(rows, model, "words", "description")

    shards = Shards(spark, f"{tmp_path}/s", {"model": "words", "threshold": 0.5}, 6)
    assert shards.run(products(spark), "slug", work, wave=4, done=lambda some, left: told.append((some, left))) == {"written": 6, "skipped": 0}
    assert told == [([0, 1, 2, 3], 2), ([4, 5], 0)] and len(calls) == 2
    rows = sorted((r["slug"], r["entity_text"]) for r in shards.read(MENTION_ROWS).collect())
    want = sorted((f"s{i}", t) for i in range(40) if i % 5 for t in (["Beta", f"Gamma{i}"] if i % 2 else ["Alpha", "Beta", f"Gamma{i}"]))
    assert rows == want  # neither the product's own name nor the catalogue's, a word once
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file()}
    assert shards.run(products(spark), "slug", work) == {"written": 0, "skipped": 6} and len(calls) == 2
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file()} == files  # nothing is written
    with pytest.raises(ManifestChanged, match="threshold"):
        Shards(spark, f"{tmp_path}/s", {"model": "words", "threshold": 0.6}, 6).run(products(spark), "slug", work)
    with pytest.raises(ManifestChanged, match="shards"):
        Shards(spark, f"{tmp_path}/s", {"model": "words", "threshold": 0.5}, 7).run(products(spark), "slug", work)


def test_a_stopped_run_goes_on(spark, tmp_path):
    shards = Shards(spark, f"{tmp_path}/s", {"model": "words"}, 4)

    def stops(rows):
        broken = F.when(F.col("shard") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("description"))
        return mentions(rows.withColumn("description", broken), model, "words", "description")

    with pytest.raises(Exception, match="lost"):
        shards.run(products(spark), "slug", stops, wave=2)
    assert shards.finished() == {0, 1} and not list((tmp_path / "s").glob("_tmp*"))
    assert shards.run(products(spark), "slug", lambda rows: mentions(rows, model, "words", "description"), wave=2) == {"written": 2, "skipped": 2}
    assert shards.read(MENTION_ROWS).select("slug").distinct().count() == 32
    empty = Shards(spark, f"{tmp_path}/e", {}, 3)
    assert empty.run(products(spark).limit(0), "slug", lambda rows: mentions(rows, model, "words", "x")) == {"written": 3, "skipped": 0}
    assert empty.finished() == {0, 1, 2} and empty.read(MENTION_ROWS).count() == 0


def test_event_log(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log", "r1")
    with log.step("good") as step:
        assert step.watch(spark.range(10), rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1)).where("id < 3").count() == 3
        step.count(files=2)
        step.progress(done=1)
    with pytest.raises(ValueError), log.step("bad") as step:
        step.count(files=1)
        raise ValueError("no")
    EventLog(spark, f"{tmp_path}/log", "r2").emit("note")
    rows = log.events().orderBy("timestamp").collect()
    assert [(r["run"], r["event"], r["name"]) for r in rows] == [("r1", "step_started", "good"), ("r1", "progress", "good"), ("r1", "step_finished", "good"), ("r1", "step_started", "bad"), ("r1", "step_failed", "bad"), ("r2", "note", None)]
    ended = {r["name"]: r for r in durations(log.events()).collect()}
    assert ended["good"]["counters"] == {"rows": 10, "odd": 5, "files": 2} and ended["bad"]["counters"] == {"files": 1} and ended["good"]["elapsed_seconds"] > 0
    assert rows[4]["error"] == "ValueError: no"


def test_streams_are_logged(spark, tmp_path):
    spark.range(6).write.json(f"{tmp_path}/in")
    log = EventLog(spark, f"{tmp_path}/log")
    listener = log.listener()
    spark.streams.addListener(listener)
    try:
        query = spark.readStream.schema("id long").json(f"{tmp_path}/in").writeStream.format("parquet").queryName("ids").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination(60)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
    rows = log.events().collect()
    assert {r["event"] for r in rows} >= {"stream_started", "stream_progress"} and sum(r["counters"].get("rows", 0) for r in rows) == 6


def test_samples_do_not_depend_on_dealing(spark):
    rows = spark.createDataFrame([("a" if i % 3 else "b", f"s/{i}é!", i % 2, None if i % 7 == 0 else f"é{i}" * 40) for i in range(300)] + [("c", None, 1, "x"), ("c", None, 1, "x")], "kind string, slug string, attempt int, body string")
    got = [sorted((r["kind"], r["file_name"], bytes(r["body"])) for r in failure_samples(rows.repartition(n), "kind", "slug", "attempt", "body", 4, 21).collect()) for n in (1, 5, 13)]
    assert got[0] == got[1] == got[2] and [k for k, _, _ in got[0] if k != "c"] == ["a"] * 4 + ["b"] * 4
    assert all(len(b) <= 21 and (n is None or ("/" not in n and "!" not in n and n.endswith(".html"))) for _, n, b in got[0])
    assert failure_samples(rows.limit(0), "kind", "slug", "attempt", "body").count() == 0


def test_folding_equals_unicode(spark):
    every = [chr(c) for c in range(1, 0x2FFFF) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c)]
    words = ["Straße", "ſchön", "İzmir", "ΟΔΟΣ ΣΑΣ", "Σ", "aΣ b", "ﬃ", "", "plain", "ÀÉ", "ẞ", "ıI", "Ꭰ ꭰ"]
    texts = words + [f"x{c}y" for c in every]
    got = [r["f"] for r in spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string").select("i", folded(F.col("t")).alias("f")).orderBy("i").collect()]
    wrong = [(t, g) for t, g in zip(texts, got, strict=False) if g != t.casefold()]
    assert not wrong and got[-1] is None
    row = spark.createDataFrame([("Große_Ärzte-ſoftware",)], "t string").select(clean_entity(F.col("t")).alias("c"), compact_name(F.col("t")).alias("k")).first()
    assert tuple(row) == ("grosse ärzte software", "grosserztesoftware")


def test_folding_looks_up_what_changes_and_not_every_character(spark):
    texts = ["", None, "plain\ntext", "ẞ" * 3, "aß\nͅς𐐀Ꭰꭰﬁﬄ", "".join(map(chr, (*range(0x20, 0x600), *range(0x1E00, 0x2000), *range(0xFB00, 0xFB18)))).replace("Σ", "σ")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    assert [r["f"] for r in rows.select("i", folded(F.col("t")).alias("f")).orderBy("i").collect()] == [t and t.casefold() for t in texts]
    pieces = rows.where("i = 2").select(F.regexp_extract_all("t", F.lit(_folds()[1]), F.lit(0)).alias("p")).first()["p"]
    assert pieces == ["plain\ntext"]


def test_a_large_table_has_more_dumps(spark, sf_dir, monkeypatch):
    whole = sorted(map(tuple, work_queries.dump_section(spark, sf_dir).collect()))
    monkeypatch.setattr(work_queries, "DUMP", 200)
    wide = work_queries.dump_section(spark, sf_dir)
    assert sorted(map(tuple, wide.collect())) == whole
    kinds = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderstatus", "o_orderkey DIV 200").distinct().count()
    assert len(wide.inputFiles()) > 3 and len({f for f in wide.inputFiles() if "o_orderstatus=" in f}) == kinds


def test_a_large_shard_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(20000).selectExpr("CAST(id AS STRING) AS k", "sha2(CAST(id AS STRING), 512) AS t").repartition(8)
        shards = Shards(spark, str(tmp_path / "s"), {"a": 1}, 2)
        assert shards.run(rows, "k", lambda some: some) == {"written": 2, "skipped": 0}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert all(len(list((tmp_path / "s" / "parts" / f"shard={n}").glob("*.parquet"))) > 1 for n in (0, 1))
    assert sorted(r["k"] for r in shards.read("k string, t string").collect()) == sorted(map(str, range(20000)))
