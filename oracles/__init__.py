"""Independent SQL for the registered queries, used only to check results."""

from __future__ import annotations

from importlib import import_module

DOMAINS = ("epidemic", "occupancy", "insurance", "tickets", "stock", "corpus", "encoding", "retrieval", "park", "payloads")


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for domain in DOMAINS:
        found.update(import_module(f"oracles.{domain}").ORACLES)
    return found
