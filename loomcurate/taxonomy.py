"""Dimension data of the curation pipeline, as small relations."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The taxonomy of primitives, by category: (name, description, priority).
PRIMITIVES = {
    "compute": [
        ("horizontal_scaling", "Handle more load by adding machines", True),
        ("vertical_scaling", "Handle more load per machine", False),
        ("compute_storage_separation", "Scale compute and storage independently", False),
        ("gpu_accelerator_pools", "Specialized high-compute workloads", False),
        ("serverless_faas", "Bursty unpredictable workloads with functions as a service", False),
        ("worker_pools_job_queues", "Async processing at scale with backpressure", False),
        ("edge_computing", "Processing data closer to the source to reduce latency", False),
        ("connection_pooling", "Reuse expensive connections to databases and services", False),
    ],
    "data": [
        ("sharding", "Dataset exceeds single-node capacity", True),
        ("replication", "Availability and read scaling", True),
        ("caching", "Reduce latency and backend load", True),
        ("cdn_edge_caching", "Reduce latency for geographically distributed users", False),
        ("event_sourcing", "Audit trail, temporal queries, replay", False),
        ("change_data_capture", "Keep derived stores in sync", False),
        ("cqrs", "Separate read and write models for different optimization", False),
        ("schema_evolution", "Safely evolve data schemas without downtime", False),
        ("data_partitioning", "Distribute data across nodes by key, range, or hash", False),
    ],
    "communication": [
        ("message_queues", "Decouple producers and consumers", True),
        ("pub_sub", "Fan-out to multiple consumers", False),
        ("stream_processing", "Real-time transformations on event streams", False),
        ("rpc_service_mesh", "Synchronous inter-service communication", False),
        ("websockets_sse", "Real-time client push", False),
        ("api_gateway", "Single entry point for routing, auth, and rate limiting across microservices", False),
        ("service_discovery", "Dynamic lookup of service instances in distributed systems", False),
    ],
    "reliability": [
        ("circuit_breaker", "Prevent cascade failures", True),
        ("rate_limiting", "Protect services from overload", True),
        ("bulkhead", "Isolate failures", False),
        ("retry_with_backoff", "Handle transient failures with exponential backoff and jitter", False),
        ("idempotency", "Safe retries for non-idempotent operations", False),
        ("consensus", "Agreement in distributed systems via Raft, Paxos, leader election", False),
        ("backpressure", "Flow control to prevent overwhelming downstream services", False),
        ("graceful_degradation", "Maintain partial functionality when components fail", False),
        ("saga_pattern", "Manage distributed transactions via compensating actions", False),
    ],
    "deployment": [
        ("feature_flags", "Toggle features without deployments for gradual rollout and experimentation", False),
        ("blue_green_deployment", "Zero-downtime deployments by switching between identical environments", False),
        ("canary_deployment", "Gradual rollout to a subset of users to detect issues early", False),
        ("zero_downtime_migration", "Migrate databases or services without user-facing downtime", False),
    ],
    "observability": [
        ("distributed_tracing", "Debug cross-service requests", False),
        ("structured_logging", "Searchable aggregatable logs", False),
        ("metrics_alerting", "Detect and respond to issues with RED/USE methods and SLOs", False),
    ],
    "cross_cutting": [
        ("load_balancing", "Distribute traffic across servers (L4/L7, consistent hashing)", True),
        ("event_driven_architecture", "Loosely coupled systems communicating through events", True),
        ("sidecar_proxy", "Attach auxiliary functionality to services without code changes", False),
    ],
}

# The domains.
DOMAINS = [
    "ecommerce", "social_media", "messaging", "streaming_media", "fintech", "gaming", "iot", "ml_platform", "healthcare",
    "logistics", "collaborative_editing", "developer_tools", "marketplace", "autonomous_systems", "education",
]

# Brand terms that an answer must not name, in the order in which they are reported.
BRANDS = [
    "netflix", "uber", "airbnb", "facebook", "meta", "google", "amazon", "twitter", "stripe", "discord", "spotify", "slack",
    "pinterest", "dropbox", "linkedin", "shopify", "figma", "doordash", "lyft", "etsy", "grab", "cloudflare", "github",
    "stackoverflow", "stack overflow",
]

# Phrases after which naming a brand is an example and allowed.
ALLOWED_LEADS = ["popular implementations include", "options like", "such as", "examples include", "tools like"]

# The classes of examples and their share of the final set.
COMPOSITION = {"single_primitive": 0.30, "full_system": 0.25, "cross_domain": 0.20, "tradeoff": 0.10, "failure": 0.10, "multi_turn": 0.05}

#: What an annotation of an unsuitable post names as its primitive.
SKIP = "SKIP"


@dataclass(frozen=True)
class Taxonomy:
    """The primitives by category, each (name, description, priority), and the domains in force."""

    categories: dict = field(default_factory=lambda: PRIMITIVES)
    domain_names: list = field(default_factory=lambda: DOMAINS)

    def primitives(self, spark: SparkSession) -> DataFrame:
        """position, category, name, description, top10: a row per primitive."""
        flat = [(c, *p) for c, ps in self.categories.items() for p in ps]
        return spark.createDataFrame([(i, *p) for i, p in enumerate(flat)], "position int, category string, name string, description string, top10 boolean")

    def domains(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.domain_names)), "position int, name string")

    def names(self) -> list[str]:
        return [p[0] for ps in self.categories.values() for p in ps]

    def priority(self) -> list[str]:
        return [p[0] for ps in self.categories.values() for p in ps if p[2]]


def read(path: str) -> Taxonomy:
    """A JSON file with ``primitives`` ({category: [{name, description, priority}]}) and ``domains``; absent parts keep their defaults."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    given = {c: [(p["name"], p.get("description", p["name"]), bool(p.get("priority"))) for p in ps] for c, ps in found.get("primitives", {}).items()}
    return Taxonomy(given or PRIMITIVES, found.get("domains") or DOMAINS)


def brand_terms(spark: SparkSession, terms: list[str] = BRANDS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(terms)), "position int, term string")


def primitives(spark: SparkSession) -> DataFrame:
    return Taxonomy().primitives(spark)


def domains(spark: SparkSession) -> DataFrame:
    return Taxonomy().domains(spark)


def primitive_names() -> list[str]:
    return Taxonomy().names()


def priority_names() -> list[str]:
    return Taxonomy().priority()
