"""Business plans: the operators put to work on the benchmark tables."""

from __future__ import annotations

from importlib import import_module

DOMAINS = ("epidemic", "occupancy", "insurance", "tickets", "stock", "corpus", "encoding", "retrieval", "park", "payloads")


def all_queries() -> dict:
    found: dict = {}
    for domain in DOMAINS:
        found.update(import_module(f"tidemill.plans.{domain}").QUERIES)
    return found
