"""Language models behind one interface, and how partitions call them.

A provider is made once per partition and asked by a few threads. Failures are retried inside the provider, never by Spark
alone, and a call that still fails drops its row. Stages that call a provider are written before they are used again.
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import taxonomy
from .runtime import ready
from .settings import Settings


@dataclass
class Usage:
    prompt_tokens: int = 0
    completion_tokens: int = 0
    calls: int = 0
    failed_calls: int = 0


@dataclass
class Provider:
    """A model: ``chat(messages, temperature, max_tokens) -> text``, with retries."""

    model: str
    attempts: int = 5
    least_wait: float = 2.0
    most_wait: float = 60.0
    usage: Usage = field(default_factory=Usage)
    lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)

    def chat(self, messages: list[dict], temperature: float, max_tokens: int) -> str:
        raise NotImplementedError

    def _again(self, ask: Callable):
        for attempt in range(self.attempts):
            try:
                return ask()
            except Exception:
                if attempt + 1 == self.attempts:
                    with self.lock:
                        self.usage.failed_calls += 1
                    raise
                time.sleep(min(self.most_wait, self.least_wait * 2**attempt))

    def complete(self, system: str, user: str, temperature: float = 0.5, max_tokens: int = 4096) -> str:
        return self.turns([{"role": "system", "content": system}, {"role": "user", "content": user}], temperature, max_tokens)

    def complete_json(self, system: str, user: str, temperature: float = 0.2, max_tokens: int = 4096) -> str:
        """JSON text; a reply that is not JSON is asked for again."""

        def ask():
            reply = self._count(self.chat([{"role": "system", "content": system}, {"role": "user", "content": user}], temperature, max_tokens), user)
            json.loads(reply)
            return reply

        return self._again(ask)

    def turns(self, messages: list[dict], temperature: float = 0.5, max_tokens: int = 4096) -> str:
        """A reply to a conversation; of several system messages the last counts."""
        system = [m for m in messages if m["role"] == "system"][-1:]
        rest = [m for m in messages if m["role"] != "system"]
        return self._again(lambda: self._count(self.chat(system + rest, temperature, max_tokens), "".join(m["content"] for m in rest)))

    def batch(self, asks: list[tuple[str, str]], threads: int = 10) -> list[str | None]:
        """Replies in order, None for calls that failed."""

        def one(ask):
            try:
                return self.complete(*ask)
            except Exception:
                return None

        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(one, asks))

    def _count(self, reply: str, prompt: str) -> str:
        with self.lock:
            self.usage.calls += 1
            self.usage.prompt_tokens += len(prompt.split())
            self.usage.completion_tokens += len(reply.split())
        return reply


class Offline(Provider):
    """Deterministic replies derived from a hash of the prompt; the prompt's slots tell what is asked for."""

    def chat(self, messages, temperature, max_tokens):
        user = messages[-1]["content"]
        digest = hashlib.sha256(user.encode()).hexdigest()
        names = taxonomy.primitive_names()
        kind = user.partition("\n")[0]
        if kind == "TASK annotate":
            primary = names[int(digest[:8], 16) % len(names)]
            return json.dumps({"primary_primitive": primary, "secondary_primitives": [names[int(digest[8:16], 16) % len(names)]], "constraints": [f"constraint {digest[:6]}"], "tradeoffs": [f"tradeoff {digest[6:12]}"], "failure_modes": [f"failure {digest[12:18]}"], "domain_independent_lesson": f"lesson {digest[:12]}"})
        if kind == "TASK questions":
            places = user.rpartition("Domains: ")[2].partition("\n")[0].split(", ")
            classes = list(taxonomy.COMPOSITION)[:5]
            n = int(user.rpartition("Count: ")[2].partition("\n")[0])
            return json.dumps({"questions": [{"domain": places[i % len(places)], "question": f"How would you build {digest[8 * i % 57 :][:8]} for {places[i % len(places)]}?", "complexity": classes[i % 5]} for i in range(n)]})
        if kind == "TASK turns":
            return json.dumps({"turns": [f"And what of part {digest[:6]}-{i}?" for i in range(2)]})
        if kind == "TASK judge":
            score = round(3 + int(digest[:4], 16) % 200 / 100, 2)
            return json.dumps({x: score for x in ("technical_accuracy", "completeness", "structure", "actionability", "primitive_coverage", "overall_score")} | {"brand_leak": False, "leads_with_pattern": True, "reasoning": "offline"})
        return f"{kind.lower()}: " + " ".join(digest[i % 56 : i % 56 + 8] for i in range(60))


class Http(Provider):
    """A chat endpoint spoken to over HTTP; ``send(payload) -> reply text`` is injected. Reasoning models take no temperature."""

    def __init__(self, model: str, send: Callable[[dict], str], reasoning: bool = False, **options):
        super().__init__(model, **options)
        self.send, self.reasoning = send, reasoning

    def chat(self, messages, temperature, max_tokens):
        sizes = {"max_completion_tokens": max_tokens} if self.reasoning else {"max_tokens": max_tokens, "temperature": temperature}
        return self.send({"model": self.model, "messages": messages, **sizes})


def post_json(endpoint: str, key: str | None, timeout: float = 120.0) -> Callable[[dict], str]:
    """A ``send`` for ``Http``: posts the payload as JSON and takes the first choice's message of the answer."""

    def send(payload: dict) -> str:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        request = urllib.request.Request(endpoint, json.dumps(payload).encode(), headers)
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]

    return send


def make(settings: Settings, model: str | None = None) -> Provider:
    """The provider that the settings name: ``offline`` needs nothing, ``http`` an endpoint. Made where it is used, so a key
    is read from the worker's environment and is in no plan."""
    name = model or settings.teacher
    if settings.provider == "offline":
        return Offline(name, attempts=1)
    if settings.provider == "http" and settings.endpoint:
        return Http(name, post_json(settings.endpoint, os.environ.get(settings.key_variable)), name in settings.reasoning_models)
    raise ValueError(f"no provider {settings.provider}; give an endpoint, or pass a factory that makes one")


class Meter:
    """Sums the usage of all providers of a run over all workers. Calls of tasks that Spark runs again count again: they were paid for."""

    FIELDS = ("prompt_tokens", "completion_tokens", "calls", "failed_calls")

    def __init__(self, spark: SparkSession):
        self.sums = {f: spark.sparkContext.accumulator(0) for f in self.FIELDS}
        self.before = (0,) * len(self.FIELDS)

    def metered(self, factory: Callable[[], Provider]) -> Callable[[], Provider]:
        sums = self.sums

        def made() -> Provider:
            provider = factory()
            provider.usage = _Metered(sums)
            return provider

        return made

    def taken(self) -> tuple[int, ...]:
        """What was used since the last time."""
        now = tuple(self.sums[f].value for f in self.FIELDS)
        spent = tuple(a - b for a, b in zip(now, self.before, strict=True))
        self.before = now
        return spent


class _Metered(Usage):
    """Usage whose changes also go to accumulators."""

    def __init__(self, sums: dict):
        object.__setattr__(self, "_sums", sums)
        super().__init__()

    def __setattr__(self, name: str, value: int) -> None:
        change = value - getattr(self, name, 0)
        super().__setattr__(name, value)
        if change:
            self._sums[name].add(change)


def ask_batch(rows: DataFrame, system: str, prompt: str, into: str, factory: Callable[[], Provider], threads: int = 10) -> DataFrame:
    """``rows`` with the reply to ``prompt`` in ``into``, by ``Provider.batch``; null where the call failed."""
    ready(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for part in parts:
            replies = provider.batch([(system, p) for p in part[prompt]], threads)
            yield part.assign(**{into: pd.Series(replies, index=part.index, dtype=object)})

    return rows.mapInPandas(run, f"{schema}, `{into}` string")


def ask(rows: DataFrame, call: Callable[[Provider, dict], str | None], into: str, factory: Callable[[], Provider], threads: int = 10) -> DataFrame:
    """``rows`` with the reply in ``into``; rows whose call failed or gave None go."""
    ready(rows.sparkSession)
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()

        def one(row: dict) -> str | None:
            try:
                return call(provider, row)
            except Exception:  # the row is left for the next run
                return None

        with ThreadPoolExecutor(threads) as pool:
            for part in parts:
                replies = list(pool.map(one, part.to_dict("records")))
                part = part.assign(**{into: pd.Series(replies, index=part.index, dtype=object)})
                yield part[part[into].notna()][[*names, into]]

    return rows.mapInPandas(run, f"{schema}, `{into}` string")


def parsed(rows: DataFrame, reply: str, schema: str, into: str) -> DataFrame:
    """``rows`` with the JSON reply as a struct; replies of another shape go."""
    return rows.withColumn(into, F.from_json(reply, schema)).where(F.col(into).isNotNull()).drop(reply)
