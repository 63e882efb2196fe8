import json

import pytest
from pyspark.sql import functions as F

from loomcurate import cli, schemas
from loomcurate.plans import phases
from loomcurate.providers import Offline, Provider
from loomcurate.settings import Settings
from loomcurate.sources import tables, web
from loomcurate.streaming import incremental

OPML = """<opml><body><outline title="group"><outline text="A" xmlUrl="http://feeds/a" htmlUrl="http://a"/><outline title="B" xmlUrl="http://feeds/b"/></outline>
<outline xmlUrl="http://feeds/broken"/><outline text="no feed"/></body></opml>"""
PAGE = "<html><head><title>{t}</title></head><body><p>" + "word " * 320 + "{t}</p></body></html>"
FEEDS = {
    "http://feeds/a": """<rss><channel><item><title>One</title><link>HTTP://x/1/?utm=1</link><pubDate>Mon, 06 Jan 2020 10:00:00 GMT</pubDate><category>c1</category></item>
<item><title>No link</title></item><item><link>http://x/2</link></item><item><title>old</title><link>http://x/old</link><pubDate>Mon, 06 Jan 2010 10:00:00 GMT</pubDate></item></channel></rss>""",
    "http://feeds/b": """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Again</title><link href="http://x/1"/><updated>2020-02-01T00:00:00Z</updated></entry>
<entry><title>Short</title><link href="http://x/short"/></entry><entry><title>Gone</title><link href="http://x/gone"/></entry></feed>""",
    "http://feeds/broken": "<rss><channel><item><title>kept</title><link>http://x/kept</link></item><item",
}


def fetcher():
    feeds, page = FEEDS, PAGE  # a closure: workers do not import the tests

    def fetch(url):
        if url in feeds:
            return 200, feeds[url]
        if url.endswith("gone"):
            return 404, ""
        return 200, "<p>too short</p>" if url.endswith("short") else page.format(t=url)

    return fetch


@pytest.fixture
def project(spark, tmp_path):
    settings = Settings(data_dir=str(tmp_path / "data"), request_delay_seconds=0.0, composition_total=40)
    return phases.Project(spark, settings, fetch=fetcher())


def test_whole_run_and_resume(spark, project, tmp_path):
    (tmp_path / "feeds.opml").write_text(OPML)
    feeds = web.feeds_of(spark, str(tmp_path / "feeds.opml"))
    assert [(r["name"], r["feed_url"]) for r in feeds.orderBy("position").collect()] == [("A", "http://feeds/a"), ("B", "http://feeds/b"), ("Unknown", "http://feeds/broken")]
    start = F.to_timestamp(F.lit("2019-01-01"))
    project.extract(feeds, start)
    posts = {r["url"]: r for r in project.table("posts").collect()}
    assert set(posts) == {"http://x/1", "http://x/2", "http://x/kept"}
    assert posts["http://x/1"]["source_blog"] == "A" and posts["http://x/1"]["title"] == "http://x/1" and posts["http://x/1"]["word_count"] >= 300
    sizes = {}
    for _ in range(2):  # the second time round nothing is added
        project.extract(feeds, start)
        project.phase1()
        project.phase2()
        project.phase3()
        project.phase4()
        now = {n: project.table(n).count() for n in project.FOLDERS}
        assert not sizes or sizes == now
        sizes = now
    assert sizes["annotations"] == 3 and sizes["questions"] == 24 and sizes["multi_questions"] == 3 and sizes["responses"] == 24 and sizes["multi_responses"] == 3
    assert sizes["scores"] == 24 and 0 < sizes["filtered"] <= 24
    multi = project.table("multi_responses").first()["turns"]
    assert len(multi) == 3 and all(t["response"] for t in multi)
    report = project.phase5().first()
    assert report["total_examples"] == sizes["filtered"] and report["passed"] is False
    project.export()
    meta = json.loads("".join(p.read_text() for p in (tmp_path / "data/export/meta").glob("part*")))
    lines = tables.read_training(spark, project.path("export/training"))
    assert meta["total_examples"] == lines.count() and sum(meta["complexity_distribution"].values()) == meta["total_examples"]
    assert project.stats().where("kind = 'complexity'").agg(F.sum("n")).first()[0] == meta["total_examples"]


def test_judge_off_accepts_all(spark):
    rows = spark.createDataFrame([("1", "q", "a", 60, 0.1)], "id string, question string, response string, token_count int, max_sim double")
    got = phases.judge(rows, spark.createDataFrame([], "question_id string"), Settings(use_judge=False)).first()
    assert got["accepted"] and got["llm_judge_score"] == 0.0 and got["passed_brand_check"]


def test_skip_is_stored_then_dropped(spark):
    rows = [("1", "SKIP"), ("2", "caching"), ("3", "unknown_thing")]
    annotations = schemas.ANNOTATIONS.checked(spark.createDataFrame([(i, p, None, [], None, None, "l", "u") for i, p in rows], schemas.ANNOTATIONS.schema))
    questions, multi = phases.generate_questions(annotations, spark.createDataFrame([], "source_annotation_id string"), Settings())
    assert {r["source_annotation_id"] for r in questions.collect()} == {"2"} and multi.count() == 1


def test_grounding_defaults(spark):
    q = spark.createDataFrame([("1", "a"), ("2", "none")], "id string, source_annotation_id string")
    a = spark.createDataFrame([("a", "caching", [], ["t"], ["f"], "l")], "post_id string, primary_primitive string, constraints array<string>, tradeoffs array<string>, failure_modes array<string>, domain_independent_lesson string")
    got = {r["id"]: r for r in phases.grounded(q, a).collect()}
    assert (got["1"]["g_primitive"], got["1"]["g_constraints"], got["1"]["g_tradeoffs"]) == ("caching", "none specified", "t")
    assert (got["2"]["g_primitive"], got["2"]["g_constraints"], got["2"]["g_lesson"]) == ("unknown", "none", "none")


def test_multi_turn_metadata_is_optional(spark):
    kept = spark.createDataFrame([], schemas.FILTERED.schema)
    responses = spark.createDataFrame([("m", [("u", "c", "r")])], schemas.MULTI_RESPONSES.schema)
    questions = spark.createDataFrame([("m", "a", "caching", "iot", ["u"], "multi_turn", 0)], schemas.MULTI_QUESTIONS.schema)
    assert tuple(phases.examples(kept, responses).select("primitive", "domain", "quality_score").first()) == ("", "", 0.0)
    assert tuple(phases.examples(kept, responses, questions).select("primitive", "domain").first()) == ("caching", "iot")


def test_tables(spark, tmp_path):
    assert tables.read(spark, str(tmp_path / "none"), schemas.RESPONSES).count() == 0
    assert tables.count_lines(spark, str(tmp_path / "none")) == 0 and tables.load_processed_ids(spark, str(tmp_path / "none")).count() == 0
    f = tmp_path / "r.jsonl"
    f.write_text('{"question_id":"1","chain_of_thought":"c","response":"é"}\n\n{"question_id":"2","chain_of_thought":"c","response":"r"}\n')
    assert tables.read(spark, str(f), schemas.RESPONSES).count() == 2 and tables.count_lines(spark, str(f)) == 2
    assert {r["question_id"] for r in tables.load_processed_ids(spark, str(f), "question_id").collect()} == {"1", "2"}
    for bad in ("{", '{"question_id":"1","response":"r"}'):
        f.write_text(bad + "\n")
        with pytest.raises(Exception):  # noqa: B017
            tables.read(spark, str(f), schemas.RESPONSES).collect()


def test_embedding_cache_encodes_only_new_texts(spark, tmp_path):
    path = str(tmp_path / "cache")
    encode = lambda t: F.array(F.char_length(t).cast("float"))
    first = spark.createDataFrame([("a", "x"), ("b", "xx")], "id string, t string")
    assert tables.embeddings(spark, first, "id", "t", encode, path).count() == 2
    second = spark.createDataFrame([("a", "x"), ("b", "changed")], "id string, t string")
    fixed = lambda t: F.array(F.lit(-1.0).cast("float"))
    got = {r["id"]: r["embedding"][0] for r in tables.embeddings(spark, second, "id", "t", fixed, path).collect()}
    assert got == {"a": 1.0, "b": -1.0}


def test_provider_retries():
    class Flaky(Provider):
        n = 0

        def chat(self, messages, temperature, max_tokens):
            self.n += 1
            if self.n < 3:
                raise OSError
            return "not json" if self.n == 3 else "{}"

    p = Flaky("m", least_wait=0.0)
    assert p.complete_json("", "x") == "{}" and p.n == 4 and p.usage.failed_calls == 0
    assert Offline("o", attempts=1).batch([("", "a"), ("", "b")])[0].startswith("a: ")


def test_stream_appends_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    row = {"name": "n", "feed_url": "u1"}
    (source / "1.json").write_text(json.dumps(row) + "\n")
    phase = lambda rows: rows.select("feed_url", "name")
    for i in range(2):
        incremental.run(spark, str(source), schemas.FEEDS, "feed_url", phase, target, "feed_url", str(tmp_path / f"check{i}")).awaitTermination()
        (source / "2.json").write_text(json.dumps(row) + "\n" + json.dumps(row | {"feed_url": "u2"}) + "\n")
    assert sorted(r["feed_url"] for r in spark.read.json(target).collect()) == ["u1", "u2"]


def test_cli(spark, tmp_path, capsys):
    assert cli.main(["--data-dir", str(tmp_path), "generate", "phase1"], spark) == 0
    assert cli.main(["--data-dir", str(tmp_path), "stats"], spark) == 0
    assert "no export yet" in capsys.readouterr().out


def counted(path):
    """A factory of providers that write a line for every call to a file, so calls of all workers can be counted."""

    class Counted(Offline):
        def chat(self, messages, temperature, max_tokens):
            with open(path, "a") as f:
                f.write(json.dumps([messages[0]["content"] if messages[0]["role"] == "system" else "", messages[-1]["content"]]) + "\n")
            return super().chat(messages, temperature, max_tokens)

    return lambda: Counted("offline", attempts=1)


def annotation(i, lesson="l"):
    return (f"a{i}", "caching", [], ["c"], ["t"], ["f"], f"{lesson} {i}", f"http://x/{i}")


def test_each_prompt_is_paid_for_once(spark, tmp_path):
    calls = str(tmp_path / "calls")
    project = phases.Project(spark, Settings(data_dir=str(tmp_path / "data")), factory=counted(calls))
    tables.append(spark.createDataFrame([annotation(i) for i in range(12)], schemas.ANNOTATIONS.schema), project.path("annotations"))
    project.phase2()
    said = [json.loads(line) for line in open(calls)]
    prompts = [p for _, p in said]
    assert sum(p.startswith("TASK questions") for p in prompts) == 12 and len(prompts) == len(set(prompts)) == 24
    assert all(system == phases.JSON_ONLY for system, _ in said)
    first = {r["turns"][0] for r in project.table("multi_questions").collect()}
    assert first <= {r["question"] for r in project.table("questions").collect()}
    used = tables.read(spark, project.path("usage"), schemas.USAGE).first()
    assert (used["phase"], used["calls"], used["failed_calls"]) == ("phase2", 24, 0) and used["prompt_tokens"] > 0 and used["completion_tokens"] > 0


def test_the_last_append_wins(spark, tmp_path):
    project = phases.Project(spark, Settings(data_dir=str(tmp_path / "data"), use_judge=False, min_tokens=1))
    questions = spark.createDataFrame([("q1", "a1", "caching", "iot", "How?", "tradeoff", 0)], schemas.QUESTIONS.schema)
    tables.append(questions, project.path("questions"))
    for lesson in ("zzz", "aaa", "mmm"):
        tables.append(spark.createDataFrame([annotation(1, lesson)], schemas.ANNOTATIONS.schema), project.path("annotations"))
    for text in ("zzz first", "bbb second", "aaa last"):
        tables.append(spark.createDataFrame([("q1", "c", text)], schemas.RESPONSES.schema), project.path("responses"))
    grounded = phases.grounded(project.table("questions"), project.table("annotations", ordered=True).repartition(3)).first()
    assert grounded["g_lesson"] == "mmm 1"
    project.phase4()
    assert project.table("filtered").first()["response"]["response"] == "aaa last"
    plain = tmp_path / "plain.jsonl"  # rows that another tool wrote: the last line wins
    plain.write_text("".join(json.dumps({"question_id": "q1", "chain_of_thought": "c", "response": r}) + "\n" for r in ("z", "b", "a")))
    assert phases.pairs(questions, tables.read(spark, str(plain), schemas.RESPONSES, ordered=True)).first()["response"] == "a"


def test_phase4_on_the_command_line_rejects_near_duplicates(spark, tmp_path):
    data = tmp_path / "data"
    texts = {"q1": "How would you shard a very large table of orders by customer?", "q2": "How would you shard a very large table of orders by customers?", "q3": "Design an audit log for payments."}
    rows = [(q, "a", "sharding", "iot", t, "tradeoff", 0) for q, t in texts.items()]
    tables.append(spark.createDataFrame(rows, schemas.QUESTIONS.schema), str(tmp_path / "asked"))
    tables.append(spark.createDataFrame([(q, "c", f"{t} " + "word " * 60) for q, t in texts.items()], schemas.RESPONSES.schema), str(tmp_path / "answered"))
    (tmp_path / "s.json").write_text(json.dumps({"use_judge": False}))
    common = ["--settings", str(tmp_path / "s.json"), "--data-dir", str(data)]
    for _ in range(2):  # the second time from the cache
        cli.main([*common, "generate", "phase4", "--questions", str(tmp_path / "asked"), "--responses", str(tmp_path / "answered"), "--output", str(tmp_path / "kept")], spark)
        assert [r["question"]["id"] for r in tables.read(spark, str(tmp_path / "kept"), schemas.FILTERED).collect()] == ["q3"]
    assert spark.read.parquet(str(data / "embeddings")).count() == 3
    sent = []
    cli.main([*common, "export", "--input", str(tmp_path / "kept"), "--output", str(tmp_path / "set"), "--push-to-hub", "--hub-repo", "me/set"], spark, lambda rows, name: sent.append((rows.count(), name)))
    assert sent == [(1, "me/set")] and tables.read_training(spark, str(tmp_path / "set")).count() == 1


def test_blank_analysis_has_a_stand_in(spark):
    class Quiet(Offline):
        def chat(self, messages, temperature, max_tokens):
            return "" if messages[-1]["content"].startswith("TASK analysis") else messages[0]["content"][:20] + messages[-1]["content"]

    questions = spark.createDataFrame([("q1", "a1", "caching", "iot", "How?", "tradeoff", 0)], schemas.QUESTIONS.schema)
    annotations = spark.createDataFrame([annotation(1)], schemas.ANNOTATIONS.schema)
    got = phases.answer(questions, annotations, spark.createDataFrame([], "question_id string"), Settings(), lambda: Quiet("offline", attempts=1)).first()
    assert f"Analysis: {phases.NO_ANALYSIS}" in got["response"] and got["response"].startswith(phases.PROMPTS["persona"][:20]) and got["chain_of_thought"] == ""


def test_http_provider(monkeypatch):
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from threading import Thread

    from loomcurate.providers import make

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((json.loads(self.rfile.read(int(self.headers["Content-Length"]))), self.headers.get("Authorization")))
            body = json.dumps({"choices": [{"message": {"content": "said"}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("SOME_KEY", "secret")
    settings = Settings(provider="http", endpoint=f"http://127.0.0.1:{server.server_port}/chat", key_variable="SOME_KEY", teacher="t", reasoning_models=["r"])
    assert make(settings).complete("sys", "user", 0.3, 99) == "said" and make(settings, "r").complete("sys", "user", 0.3, 99) == "said"
    server.shutdown()
    (plain, key), (reasoning, _) = seen
    assert key == "Bearer secret" and plain["model"] == "t" and plain["max_tokens"] == 99 and plain["temperature"] == 0.3 and plain["messages"][0] == {"role": "system", "content": "sys"}
    assert reasoning["max_completion_tokens"] == 99 and "temperature" not in reasoning
    with pytest.raises(ValueError):
        make(Settings(provider="other"))


def test_dimension_data_and_prompts_from_files(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"primitives": {"c": [{"name": "p1", "description": "d1", "priority": True}, {"name": "p2"}]}, "domains": ["x", "y"]}))
    (tmp_path / "b.txt").write_text("Acme\n\n  Foo Bar \n")
    (tmp_path / "annotate.txt").write_text("TASK annotate\n{primitives}|{content}")
    settings = Settings(taxonomy_file=str(tmp_path / "t.json"), brands_file=str(tmp_path / "b.txt"), prompt_files={"annotate": str(tmp_path / "annotate.txt")})
    assert settings.taxonomy().names() == ["p1", "p2"] and settings.taxonomy().priority() == ["p1"] and settings.taxonomy().domain_names == ["x", "y"]
    assert settings.brands() == ["acme", "foo bar"]
    row = spark.createDataFrame([("body text",)], "markdown string")
    assert row.select(phases.annotation_prompt(F.col("markdown"), settings)).first()[0] == "TASK annotate\np1, p2|body text"


def test_length_gate_by_vocabulary(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from loomcurate.functions.tokens import bpe_token_count

    path = public_tokenizers.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    texts = ["", "plain words", "d'été <|endoftext|> 12345", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(bpe_token_count(F.col("t"), path)).collect()]
    assert got == [None if t is None else len(known.encode(t, add_special_tokens=False).ids) for t in texts]


def test_opml_by_address_and_extraction_counters(spark, project):
    project.fetch = lambda url, inner=fetcher(): (200, OPML) if url.endswith("opml") else inner(url)
    feeds = web.feeds_of(spark, "http://x/list.opml", project.fetch)
    assert feeds.count() == 3
    counted = project.extract(feeds).first()
    assert counted["extracted"] == project.table("posts").count() == 4 and counted["skipped"] == 1
