"""The phases of the curation pipeline, as plans over stage tables.

Each resumes: rows whose result is stored are left out by an anti-join placed before the calls. Results are written
once, by Spark's committers, before anything reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import encoders, schemas
from ..functions import chat
from ..functions import text as tx
from ..operators import balance, coverage, gates, keyed, similarity, stats
from ..functions.tokens import bpe_token_count
from ..providers import Meter, Provider, ask, make, parsed
from ..settings import Settings
from ..sources import tables, web

# Prompts, in our own words; the first line names the task.
ANNOTATE = (
    "TASK annotate\nRead the post. Choose the one pattern of this list that it is mainly about, or SKIP if it is not about systems: {primitives}.\n"
    "Give also up to three further patterns, the constraints, the tradeoffs, the failure modes and a lesson that holds in any domain. Answer in JSON.\n\n{content}"
)
QUESTIONS = (
    "TASK questions\nPattern: {primitive} ({primitive_description})\nLesson: {domain_independent_lesson}\nConstraints: {constraints}\n"
    "Write questions that need this pattern in other domains, with numbers and without company names: one on the pattern, {design_count} full designs, "
    "one across domains, one on tradeoffs, one on a failure. Answer in JSON.\nCount: {count}\nDomains: {domains}\n"
)
TURNS = "TASK turns\nPattern: {primitive}\nDomain: {domain}\nAn interview opens with: {initial_question}\nWrite the follow-up questions. Answer in JSON."
SOURCE = "Pattern: {primitive}\nConstraints: {constraints}\nTradeoffs: {tradeoffs}\nFailure modes: {failure_modes}\nLesson: {lesson}\n"
ANALYSIS = "TASK analysis\nThink the question through, from the source.\n\n" + SOURCE + "\nQuestion: {question}"
ANSWER = "TASK answer\nAnswer the question in full, from the source and the analysis.\n\n" + SOURCE + "\nAnalysis: {analysis}\n\nQuestion: {question}"
JUDGE = "TASK judge\nScore the answer from 1 to 5. Answer in JSON.\nQuestion: {question}\n\nAnswer: {response}"

JSON_ONLY = "You answer with one JSON object and nothing around it."
ANALYST = "You write the reasoning behind an answer for a training set. Use only what the source says, and say how the pattern follows from it."
#: Stands for an analysis that came back blank.
NO_ANALYSIS = "No analysis available."
#: Prompts by the name under which ``Settings.prompt_files`` replaces them.
PROMPTS = {
    "annotate": ANNOTATE, "questions": QUESTIONS, "turns": TURNS, "analysis": ANALYSIS, "answer": ANSWER, "judge": JUDGE, "json": JSON_ONLY, "analyst": ANALYST, "persona": chat.PERSONA,
}

Factory = Callable[[], Provider]


def _prompt(settings: Settings, name: str) -> str:
    return settings.prompt(name, PROMPTS[name])


def _factory(settings: Settings, factory: Factory | None, model: str | None = None) -> Factory:
    return factory or (lambda: make(settings, model))


def fetched(feeds: DataFrame, stored_posts: DataFrame, settings: Settings, start: Column | None = None, limit: int | None = None, fetch=web.http_fetch) -> DataFrame:
    """Pages of the feeds' new posts: discovered, not yet stored, the first ``limit``."""
    found = web.discover(feeds, start, fetch, settings.feed_concurrency)
    new = keyed.first_rows(keyed.remaining(found, "id", stored_posts, "id"), limit, "feed_position", "entry_position")
    return web.fetch_pages(new, fetch, settings.concurrency, settings.request_delay_seconds)


def extract(feeds: DataFrame, stored_posts: DataFrame, settings: Settings, start: Column | None = None, limit: int | None = None, fetch=web.http_fetch, crawled_at: Column | None = None) -> DataFrame:
    """New posts of the feeds: discovered, not yet stored, the first ``limit``, fetched and extracted."""
    pages = fetched(feeds, stored_posts, settings, start, limit, fetch)
    return web.extract_posts(pages, settings.min_words, F.current_timestamp() if crawled_at is None else crawled_at)


def annotation_prompt(content: Column, settings: Settings) -> Column:
    return tx.fill(F.lit(_prompt(settings, "annotate")), {"primitives": F.lit(", ".join(settings.taxonomy().names())), "content": tx.truncate_words(content, settings.truncate_words)})


def annotate(posts: DataFrame, done: DataFrame, settings: Settings, factory: Factory | None = None) -> DataFrame:
    """Phase 1: an annotation for each post without one. SKIP annotations are kept here."""
    rows = keyed.remaining(posts, "id", done, "post_id").select("id", "url", annotation_prompt(F.col("markdown"), settings).alias("prompt"))
    system, heat = _prompt(settings, "json"), settings.temperatures["annotate"]
    asked = ask(rows, lambda p, r: p.complete_json(system, r["prompt"], heat), "reply", _factory(settings, factory), settings.concurrency)
    rows = parsed(asked, "reply", schemas.ANNOTATION_REPLY, "a").where("a.primary_primitive is not null and a.domain_independent_lesson is not null")
    return schemas.ANNOTATIONS.checked(rows.select(F.col("id").alias("post_id"), "a.*", F.col("url").alias("source_url")))


def question_prompt(settings: Settings) -> Column:
    """Over a row with primary_primitive, description, domains."""
    count = settings.questions_per_annotation
    return tx.fill(
        F.lit(_prompt(settings, "questions")),
        {
            "primitive": F.col("primary_primitive"), "primitive_description": F.col("description"), "domain_independent_lesson": F.col("domain_independent_lesson"),
            "constraints": tx.joined(F.col("constraints")), "count": F.lit(str(count)), "design_count": F.lit(str(max(1, count - 4))), "domains": F.array_join("domains", ", "),
        },
    )


def generate_questions(annotations: DataFrame, done: DataFrame, settings: Settings, factory: Factory | None = None, keep=None) -> tuple[DataFrame, DataFrame]:
    """Phase 2: questions, and a multi-turn conversation for each annotation, from annotations without questions.

    Both are built from the same replies. ``keep``: DataFrame -> DataFrame writes the replies and reads them, so each question
    prompt is paid for once; without it each of the two results asks for itself.
    """
    spark, known = annotations.sparkSession, settings.taxonomy()
    rows = keyed.in_taxonomy(keyed.remaining(annotations, "post_id", done, "source_annotation_id"), "primary_primitive", known.names())
    rows = keyed.with_description(rows, "primary_primitive", known.primitives(spark), "description")
    rows = keyed.seeded_sample(rows, "post_id", known.domain_names, settings.domains_per_annotation, settings.seed, "domains")
    rows = rows.select("post_id", F.col("primary_primitive").alias("primitive"), "domains", question_prompt(settings).alias("prompt"))
    make_provider, heat, system = _factory(settings, factory), settings.temperatures["questions"], _prompt(settings, "json")
    asked = ask(rows, lambda p, r: p.complete_json(system, r["prompt"], heat), "reply", make_provider, settings.concurrency)
    replies = parsed(asked, "reply", schemas.QUESTIONS_REPLY, "q")
    replies = keep(replies.select("post_id", "primitive", "q")) if keep else replies
    each = replies.select("post_id", "primitive", F.posexplode("q.questions").alias("i", "q"))
    questions = each.select(
        tx.question_id(F.col("post_id"), F.col("i"), F.col("q.question")).alias("id"), F.col("post_id").alias("source_annotation_id"), "primitive",
        F.col("q.domain").alias("domain"), F.col("q.question").alias("question"), F.col("q.complexity").alias("complexity"), F.lit(0).alias("evol_generation"),
    )
    first = replies.where(F.size("q.questions") > 0).select("post_id", "primitive", F.col("q.questions")[0]["domain"].alias("domain"), F.col("q.questions")[0]["question"].alias("question"))
    first = first.withColumn("prompt", tx.fill(F.lit(_prompt(settings, "turns")), {"primitive": F.col("primitive"), "domain": F.col("domain"), "initial_question": F.col("question")}))
    followed = parsed(ask(first, lambda p, r: p.complete_json(system, r["prompt"], heat), "reply", make_provider, settings.concurrency), "reply", schemas.TURNS_REPLY, "t")
    multi = followed.select(
        tx.multi_turn_id(F.col("post_id")).alias("id"), F.col("post_id").alias("source_annotation_id"), "primitive", "domain",
        F.concat(F.array("question"), F.coalesce("t.turns", F.array().cast("array<string>"))).alias("turns"), F.lit("multi_turn").alias("complexity"), F.lit(0).alias("evol_generation"),
    )
    return questions, multi


def _last(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key that was appended last (``tables.read(ordered=True)``); of rows without an order, the greatest row."""
    order = [c for c in schemas.ORDER.schema.names if c in rows.columns]
    return keyed.last_wins(rows, F.col(key), *(order or rows.columns))


def grounded(questions: DataFrame, annotations: DataFrame) -> DataFrame:
    """``questions`` with the grounding texts of their annotation (the last of equals).

    Without an annotation the pattern is ``unknown`` and the rest ``none``; an empty list is ``none specified``.
    """
    last = _last(annotations, "post_id")
    lists = [tx.joined(F.col(c), "none specified").alias(f"g_{c}") for c in ("constraints", "tradeoffs", "failure_modes")]
    known = last.select(F.col("post_id").alias("_post"), F.col("primary_primitive").alias("g_primitive"), *lists, F.col("domain_independent_lesson").alias("g_lesson"))
    rows = questions.join(known, F.col("source_annotation_id") == F.col("_post"), "left").drop("_post")
    for c in ("g_constraints", "g_tradeoffs", "g_failure_modes", "g_lesson"):
        rows = rows.withColumn(c, F.coalesce(c, F.lit("none")))
    return rows.withColumn("g_primitive", F.coalesce("g_primitive", F.lit("unknown")))


def _slots() -> dict[str, Column]:
    return {"primitive": F.col("g_primitive"), "constraints": F.col("g_constraints"), "tradeoffs": F.col("g_tradeoffs"), "failure_modes": F.col("g_failure_modes"), "lesson": F.col("g_lesson")}


def answer(questions: DataFrame, annotations: DataFrame, done: DataFrame, settings: Settings, factory: Factory | None = None) -> DataFrame:
    """Phase 3: an analysis, then an answer that builds on it; pairs blank in both go."""
    rows = grounded(keyed.remaining(questions, "id", done, "question_id"), annotations)
    rows = rows.withColumn("prompt", tx.fill(F.lit(_prompt(settings, "analysis")), _slots() | {"question": F.col("question")}))
    make_provider, heat, analyst, persona = _factory(settings, factory), settings.temperatures, _prompt(settings, "analyst"), _prompt(settings, "persona")
    rows = ask(rows, lambda p, r: p.complete(analyst, r["prompt"], heat["analysis"], 2048), "analysis", make_provider, settings.concurrency)
    analysis = F.when(F.col("analysis") == "", NO_ANALYSIS).otherwise(F.col("analysis"))
    rows = rows.withColumn("prompt", tx.fill(F.lit(_prompt(settings, "answer")), _slots() | {"analysis": analysis, "question": F.col("question")}))
    rows = ask(rows, lambda p, r: p.complete(persona, r["prompt"], heat["answer"], 4096), "answer", make_provider, settings.concurrency)
    rows = gates.drop_blank_pairs(rows, "analysis", "answer")
    return rows.select(F.col("id").alias("question_id"), F.col("analysis").alias("chain_of_thought"), F.col("answer").alias("response"))


def answer_turns(multi: DataFrame, annotations: DataFrame, done: DataFrame, settings: Settings, factory: Factory | None = None) -> DataFrame:
    """Phase 3 for conversations: turn by turn, the answers so far in the history.

    A turn's ``previous discussion`` is the user question before it.
    """
    import json

    rows = grounded(keyed.remaining(multi, "id", done, "question_id"), annotations)
    rows = rows.withColumn("system", chat.grounding_summary(F.col("g_primitive"), F.col("g_constraints"), F.col("g_lesson"))).select("id", "turns", "system")
    heat = settings.temperatures

    def converse(provider: Provider, row: dict) -> str:
        history, out, before = [{"role": "system", "content": row["system"]}], [], "none"
        for question in row["turns"]:
            history.append({"role": "user", "content": question})
            analysis = provider.complete(row["system"], f"TASK analysis\nPrevious discussion: {before}\nQuestion: {question}", heat["analysis"], 4096)
            reply = provider.turns(history, heat["answer"], 8192)
            history.append({"role": "assistant", "content": reply})
            out.append({"user": question, "chain_of_thought": analysis, "response": reply})
            before = question
        return json.dumps(out)

    asked = ask(rows, converse, "reply", _factory(settings, factory), settings.concurrency)
    kind = schemas.MULTI_RESPONSES.schema["turns"].dataType
    return asked.select(F.col("id").alias("question_id"), F.from_json("reply", kind).alias("turns"))


def pairs(questions: DataFrame, responses: DataFrame) -> DataFrame:
    """Answered questions with their last response."""
    last = _last(responses, "question_id").drop(*schemas.ORDER.schema.names)
    return questions.join(last, F.col("id") == F.col("question_id"))


def prefilter(questions: DataFrame, responses: DataFrame, settings: Settings, encode=None, cache: str | None = None) -> DataFrame:
    """Answered questions with all gate flags.

    ``encode``: text -> array<float>, for the near-duplicate gate; ``cache``: a folder where embeddings are kept by id and text.
    """
    rows, near = pairs(questions, responses), None
    if encode and cache:
        near = similarity.max_similarity(tables.embeddings(rows.sparkSession, rows, "id", "question", encode, cache), "id", "embedding")
    elif encode:
        near = similarity.max_similarity(rows.select("id", encode(F.col("question")).alias("v")), "id", "v")
    tokens = bpe_token_count(F.col("response"), settings.vocabulary) if settings.vocabulary else None
    return gates.flags(rows, "id", "question", "response", near, settings, settings.brands(), settings.allowed_leads, tokens)


def judge(candidates: DataFrame, done: DataFrame, settings: Settings, factory: Factory | None = None) -> DataFrame:
    """Scores of the candidates not yet judged; with the judge off all are accepted with score 0."""
    base = [F.col("id").alias("question_id"), F.lit(True).alias("passed_brand_check"), "token_count", F.lit(False).alias("is_duplicate"), F.col("max_sim").alias("nearest_neighbor_sim")]
    rows = keyed.remaining(candidates, "id", done, "question_id")
    if not settings.use_judge:
        return rows.select(*base, F.lit(0.0).alias("llm_judge_score"), F.lit(True).alias("accepted"))
    system, heat = _prompt(settings, "json"), settings.temperatures["judge"]
    rows = rows.withColumn("prompt", tx.fill(F.lit(_prompt(settings, "judge")), {"question": F.col("question"), "response": F.col("response")}))
    asked = ask(rows, lambda p, r: p.complete_json(system, r["prompt"], heat), "reply", _factory(settings, factory, settings.judge_model), settings.concurrency)
    scored = parsed(asked, "reply", schemas.JUDGE_REPLY, "j").where("j.overall_score is not null")
    return scored.select(*base, F.col("j.overall_score").alias("llm_judge_score"), gates.accepted(F.col("j.overall_score"), settings).alias("accepted"))


def filtered(questions: DataFrame, responses: DataFrame, scores: DataFrame) -> DataFrame:
    """question, response, quality_score of accepted pairs."""
    kept = scores.where("accepted").select(F.col("question_id").alias("_id"), F.col("llm_judge_score").alias("quality_score"))
    rows = pairs(questions, responses).join(kept, F.col("id") == F.col("_id"))
    return rows.select(F.struct(*questions.columns).alias("question"), F.struct("question_id", "chain_of_thought", "response").alias("response"), "quality_score")


def examples(kept: DataFrame, multi_responses: DataFrame | None = None, multi_questions: DataFrame | None = None) -> DataFrame:
    """Training examples of single and multi-turn data.

    Multi-turn examples have no primitive, domain or score unless ``multi_questions`` is given to look them up.
    """
    q = F.col("question")
    single = kept.select(
        q["id"].alias("id"), chat.single_turn(q["question"], F.col("response.chain_of_thought"), F.col("response.response")).alias("messages"),
        q["primitive"].alias("primitive"), q["domain"].alias("domain"), q["complexity"].alias("complexity"), "quality_score",
    )
    if multi_responses is None:
        return single
    rows = multi_responses.withColumn("primitive", F.lit("")).withColumn("domain", F.lit(""))
    if multi_questions is not None:
        known = multi_questions.select(F.col("id").alias("_id"), F.col("primitive").alias("_p"), F.col("domain").alias("_d"))
        rows = multi_responses.join(known, F.col("question_id") == F.col("_id"), "left").withColumns({"primitive": F.coalesce("_p", F.lit("")), "domain": F.coalesce("_d", F.lit(""))})
    many = rows.select(F.col("question_id").alias("id"), chat.multi_turn(F.col("turns")).alias("messages"), "primitive", "domain", F.lit("multi_turn").alias("complexity"), F.lit(0.0).alias("quality_score"))
    return single.unionByName(many)


def export(pool: DataFrame, settings: Settings) -> DataFrame:
    """The balanced set, in class order."""
    wanted = settings.targets()
    return balance.balanced(pool, balance.targets(pool.sparkSession, wanted), max(wanted.values()), settings.seed)


def coverage_report(kept: DataFrame, settings: Settings) -> DataFrame:
    spark, known = kept.sparkSession, settings.taxonomy()
    rows, names = kept.select("question.primitive", "question.domain"), known.primitives(spark)
    return coverage.report(rows, names, known.domains(spark), names.where("top10"), settings)


class Project:
    """Stage tables under a data folder, and the commands that fill them."""

    FOLDERS = {
        "posts": ("posts", schemas.POSTS), "annotations": ("annotations", schemas.ANNOTATIONS), "questions": ("questions/single", schemas.QUESTIONS),
        "multi_questions": ("questions/multi", schemas.MULTI_QUESTIONS), "responses": ("responses/single", schemas.RESPONSES),
        "multi_responses": ("responses/multi", schemas.MULTI_RESPONSES), "scores": ("scores", schemas.SCORES), "filtered": ("filtered", schemas.FILTERED),
    }

    def __init__(self, spark: SparkSession, settings: Settings, factory: Factory | None = None, encode=None, fetch=web.http_fetch):
        self.spark, self.settings, self.fetch = spark, settings, fetch
        self.encode = encode or encoders.make(settings.encoder)
        self.paths: dict[str, str] = {}
        self.meter = Meter(spark)
        self.factory = self.meter.metered(factory or (lambda: make(settings)))
        self.judges = self.meter.metered(factory or (lambda: make(settings, settings.judge_model)))

    def path(self, name: str) -> str:
        """Where a table is: the place given for it in ``paths``, or its own folder."""
        return self.paths.get(name) or self.settings.path(self.FOLDERS[name][0] if name in self.FOLDERS else name)

    def table(self, name: str, ordered: bool = False) -> DataFrame:
        return tables.read(self.spark, self.path(name), self.FOLDERS[name][1], ordered)

    def spent(self, phase: str) -> None:
        """A row of usage for the calls of a phase."""
        row = (phase, self.settings.teacher, *self.meter.taken())
        tables.append(self.spark.createDataFrame([row], schemas.USAGE.schema), self.path("usage"))

    def extract(self, feeds: DataFrame, start: Column | None = None, limit: int | None = None) -> DataFrame:
        """Appends the new posts; returns one row of how many pages were extracted and skipped."""
        pages = tables.kept(fetched(feeds, self.table("posts"), self.settings, start, limit, self.fetch), self.path("posts_fetched"))
        posts = web.extract_posts(pages, self.settings.min_words, F.current_timestamp())
        tables.append(posts, self.path("posts"))
        long_enough = tx.word_count(tx.html_text(F.col("html"))) >= self.settings.min_words
        return stats.extraction_counters(pages, F.coalesce(long_enough, F.lit(False)))

    def phase1(self) -> None:
        tables.append(annotate(self.table("posts"), self.table("annotations"), self.settings, self.factory), self.path("annotations"))
        self.spent("phase1")

    def phase2(self) -> None:
        """Conversations are written before questions: questions mark an annotation as done."""
        keep = lambda rows: tables.kept(rows, self.path("question_replies"))
        questions, multi = generate_questions(self.table("annotations"), self.table("questions"), self.settings, self.factory, keep)
        fresh_multi = keyed.remaining(multi, "id", self.table("multi_questions"), "id")
        tables.append(fresh_multi, self.path("multi_questions"))
        tables.append(questions, self.path("questions"))
        self.spent("phase2")

    def phase3(self) -> None:
        annotations = self.table("annotations", ordered=True)
        tables.append(answer(self.table("questions"), annotations, self.table("responses"), self.settings, self.factory), self.path("responses"))
        tables.append(answer_turns(self.table("multi_questions"), annotations, self.table("multi_responses"), self.settings, self.factory), self.path("multi_responses"))
        self.spent("phase3")

    def phase4(self) -> None:
        """Scores first, then the pairs they accept, rebuilt from the scores, so a broken run loses none."""
        questions, responses = self.table("questions"), self.table("responses", ordered=True)
        flagged = prefilter(questions, responses, self.settings, self.encode, self.path("embeddings"))
        tables.append(judge(flagged.where(gates.passes()), self.table("scores"), self.settings, self.judges), self.path("scores"))
        self.spent("phase4")
        tables.write(filtered(questions, responses, self.table("scores")), self.path("filtered"))

    def phase5(self) -> DataFrame:
        report = coverage_report(self.table("filtered"), self.settings)
        tables.write_document(report.select(F.to_json(F.struct(*report.columns)).alias("value")), self.path("reports/coverage"))
        return report

    def coverage_table(self) -> DataFrame:
        """The matrix for display: a row per primitive, a column per domain found, and the total."""
        rows = self.table("filtered").select("question.primitive", "question.domain")
        known = self.settings.taxonomy().domain_names  # questions draw their domains from it
        return coverage.pivot(rows, known, total="Total")

    def export(self, publisher=None, repository: str | None = None) -> DataFrame:
        chosen = export(examples(self.table("filtered"), self.table("multi_responses")), self.settings)
        chosen.select("id", "messages", "primitive", "domain", "complexity", "quality_score", "position", "place").write.mode("overwrite").parquet(self.path("export/examples"))
        chosen = self.spark.read.parquet(self.path("export/examples"))
        tables.write_training(chosen.orderBy("position", "place"), self.path("export/training"))
        tables.write_document(stats.sidecar_json(chosen), self.path("export/meta"))
        tables.publish(chosen, publisher, repository)
        return chosen

    def stats(self) -> DataFrame | None:
        """The sidecar's distributions as rows (kind, value, n); None without a sidecar."""
        meta = tables.read_sidecar(self.spark, self.path("export/meta"))
        if meta is None:
            return None
        kinds = ("complexity", "primitive", "domain")
        parts = [meta.select(F.lit(k).alias("kind"), F.explode(f"{k}_distribution").alias("value", "n")) for k in kinds]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("kind", F.desc("n"), "value")
