"""Settings of the curation pipeline, with the values in force as defaults, and the layout of its folders."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from . import taxonomy
from .taxonomy import ALLOWED_LEADS, BRANDS, COMPOSITION


@dataclass(frozen=True)
class Settings:
    data_dir: str = "data"
    min_words: int = 300
    truncate_words: int = 4000
    excerpt_words: int = 2000
    request_delay_seconds: float = 1.5
    concurrency: int = 10
    feed_concurrency: int = 20
    fetch_timeout_seconds: float = 20.0
    domains_per_annotation: int = 5
    questions_per_annotation: int = 8
    min_tokens: int = 50
    near_duplicate: float = 0.94
    judge_threshold: float = 3.5
    use_judge: bool = True
    composition_total: int = 5000
    composition: dict = field(default_factory=lambda: dict(COMPOSITION))
    min_domains: int = 4
    min_priority_examples: int = 50
    max_domain_share: float = 0.25
    seed: int = 42
    #: ``offline`` or ``http``: a chat endpoint, its key in the environment variable that ``key_variable`` names.
    provider: str = "offline"
    endpoint: str = ""
    key_variable: str = "MODEL_API_KEY"
    reasoning_models: list = field(default_factory=list)
    teacher: str = "offline"
    judge: str = ""
    #: Encoder of the near-duplicate gate: ``offline``, or empty for none (the gate then passes everything).
    encoder: str = "offline"
    #: A vocabulary file: the length gate then counts its tokens instead of pre-tokens.
    vocabulary: str = ""
    #: Files in place of the built-in dimension data and prompts: a JSON taxonomy, a list of terms by line, texts by name.
    taxonomy_file: str = ""
    brands_file: str = ""
    allowed_leads: list = field(default_factory=lambda: list(ALLOWED_LEADS))
    prompt_files: dict = field(default_factory=dict)
    #: Sampling temperatures of the model calls.
    temperatures: dict = field(default_factory=lambda: {"annotate": 0.2, "questions": 0.8, "analysis": 0.3, "answer": 0.5, "judge": 0.1})

    def targets(self) -> dict[str, int]:
        """Examples wanted of each class, cut to whole numbers."""
        return {name: int(self.composition_total * share) for name, share in self.composition.items()}

    def path(self, *parts: str) -> str:
        """A place under the data folder; Spark's writers create what is missing."""
        return "/".join([self.data_dir.rstrip("/"), *parts])

    @property
    def judge_model(self) -> str:
        return self.judge or self.teacher

    def taxonomy(self) -> taxonomy.Taxonomy:
        return taxonomy.read(self.taxonomy_file) if self.taxonomy_file else taxonomy.Taxonomy()

    def brands(self) -> list[str]:
        """Terms that answers must not name, lower case, blank lines skipped."""
        if not self.brands_file:
            return BRANDS
        with open(self.brands_file, encoding="utf-8") as f:
            return [line.strip().lower() for line in f if line.strip()]

    def prompt(self, name: str, default: str) -> str:
        """The text of a named prompt, from its file if one is set."""
        if name not in self.prompt_files:
            return default
        with open(self.prompt_files[name], encoding="utf-8") as f:
            return f.read()


def load(path: str | None = None, **changes) -> Settings:
    """Defaults, then a JSON file's values, then ``changes``; unknown names are an error."""
    found: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    found |= changes
    unknown = set(found) - {f.name for f in fields(Settings)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**found)
