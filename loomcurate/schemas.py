"""Schemas of the stage tables. ``required`` fields must be there and not null; absent lists become empty."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    ddl: str
    required: tuple[str, ...] = ()
    defaults: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def checked(self, rows: DataFrame) -> DataFrame:
        """``rows`` with defaults filled in; reading a row without a required field fails."""
        for name, sql in self.defaults:
            rows = rows.withColumn(name, F.coalesce(F.col(name), F.expr(sql)))
        for name in self.required:
            missing = F.raise_error(F.lit(f"required field {name} is missing")).cast(self.schema[name].dataType)
            rows = rows.withColumn(name, F.coalesce(F.col(name), missing))
        return rows


#: Columns that ``tables.append`` adds: when a row was appended (microseconds), and its place in that append.
ORDER = Table("batch long, position long")
_NO_TEXTS = "cast(array() as array<string>)"
FEEDS = Table("name string, feed_url string, site_url string", ("name", "feed_url"))
DISCOVERED = Table("url string, title string, source_blog string, date string, categories array<string>", ("url", "title", "source_blog"))
POSTS = Table(
    "id string, url string, title string, author string, date string, source_blog string, categories array<string>, markdown string, word_count int, crawled_at string",
    ("id", "url", "title", "source_blog", "markdown", "word_count", "crawled_at"),
    (("categories", _NO_TEXTS),),
)
ANNOTATIONS = Table(
    "post_id string, primary_primitive string, secondary_primitives array<string>, constraints array<string>, tradeoffs array<string>, failure_modes array<string>, domain_independent_lesson string, source_url string",
    ("post_id", "primary_primitive", "domain_independent_lesson", "source_url"),
    tuple((c, _NO_TEXTS) for c in ("secondary_primitives", "constraints", "tradeoffs", "failure_modes")),
)
QUESTIONS = Table(
    "id string, source_annotation_id string, primitive string, domain string, question string, complexity string, evol_generation int",
    ("id", "source_annotation_id", "primitive", "domain", "question", "complexity"),
    (("evol_generation", "0"),),
)
MULTI_QUESTIONS = Table(
    "id string, source_annotation_id string, primitive string, domain string, turns array<string>, complexity string, evol_generation int",
    ("id", "source_annotation_id", "primitive", "domain", "turns"),
    (("complexity", "'multi_turn'"), ("evol_generation", "0")),
)
RESPONSES = Table("question_id string, chain_of_thought string, response string", ("question_id", "chain_of_thought", "response"))
MULTI_RESPONSES = Table("question_id string, turns array<struct<user:string,chain_of_thought:string,response:string>>", ("question_id", "turns"))
SCORES = Table(
    "question_id string, passed_brand_check boolean, token_count int, is_duplicate boolean, nearest_neighbor_sim double, llm_judge_score double, accepted boolean",
    ("question_id", "passed_brand_check", "token_count", "is_duplicate", "nearest_neighbor_sim", "llm_judge_score", "accepted"),
)
FILTERED = Table(f"question struct<{', '.join(f.replace(' ', ':', 1) for f in QUESTIONS.ddl.split(', '))}>, response struct<question_id:string,chain_of_thought:string,response:string>, quality_score double", ("question", "response", "quality_score"))
MESSAGES = "array<struct<role:string,content:string,channel:string>>"
EXAMPLES = Table(f"messages {MESSAGES}, primitive string, domain string, complexity string, quality_score double", ("messages",))
USAGE = Table("phase string, model string, prompt_tokens long, completion_tokens long, calls long, failed_calls long")

# Payloads of model calls.
ANNOTATION_REPLY = "primary_primitive string, secondary_primitives array<string>, constraints array<string>, tradeoffs array<string>, failure_modes array<string>, domain_independent_lesson string"
QUESTIONS_REPLY = "questions array<struct<domain:string,question:string,complexity:string>>"
TURNS_REPLY = "turns array<string>"
JUDGE_REPLY = "technical_accuracy double, completeness double, structure double, actionability double, primitive_coverage double, brand_leak boolean, leads_with_pattern boolean, overall_score double, reasoning string"
