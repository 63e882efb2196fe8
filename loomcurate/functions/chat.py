"""Chat messages as arrays of (role, content, channel)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERSONA = (
    "You answer questions on how to build software systems. Start from what the question states, show the arithmetic behind every size you "
    "name, and pick the plainest design that carries it. Say which facts would change your choice. Name no company or product."
)


def message(role: str, content: Column, channel: str | None = None) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(channel).cast("string").alias("channel"))


def single_turn(question: Column, analysis: Column, answer: Column, persona: str = PERSONA) -> Column:
    """developer, user, assistant's analysis, assistant's final answer."""
    return F.array(
        message("developer", F.lit(persona)), message("user", question), message("assistant", analysis, "analysis"), message("assistant", answer, "final")
    )


def multi_turn(turns: Column, persona: str = PERSONA) -> Column:
    """developer, then three messages for each (user, chain_of_thought, response)."""
    each = F.transform(
        turns,
        lambda t: F.array(message("user", t["user"]), message("assistant", t["chain_of_thought"], "analysis"), message("assistant", t["response"], "final")),
    )
    return F.concat(F.array(message("developer", F.lit(persona))), F.flatten(each))


def render(messages: Column) -> Column:
    """Messages as one text, by our own template: ``<|start|>role(<|channel|>channel)<|message|>content<|end|>``."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit("<|start|>"), m["role"], F.coalesce(F.concat(F.lit("<|channel|>"), m["channel"]), F.lit("")), F.lit("<|message|>"), m["content"], F.lit("<|end|>")
            ),
        ),
        "",
    )


def response_mask(messages: Column) -> Column:
    """Messages with ``train``: true for the assistant's final answers only."""
    return F.transform(
        messages,
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["channel"].alias("channel"), F.coalesce((m["role"] == "assistant") & (m["channel"] == "final"), F.lit(False)).alias("train")),
    )


def to_json(messages: Column) -> Column:
    """JSON of the messages without null fields."""
    return F.to_json(messages)


def grounding_summary(primitive: Column, constraints: Column, lesson: Column, persona: str = PERSONA) -> Column:
    """System text of a multi-turn answer: the persona and three labelled lines."""
    lines = F.concat_ws("\n", F.concat(F.lit("Primary primitive: "), primitive), F.concat(F.lit("Constraints: "), constraints), F.concat(F.lit("Key lesson: "), lesson))
    return F.concat(F.lit(persona + "\n\n"), lines)
