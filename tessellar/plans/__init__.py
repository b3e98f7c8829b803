"""The registered queries and, where SQL can express them, their oracles."""

from __future__ import annotations


def _modules():
    from tessellar.plans import crawl_queries, io_queries, problem_queries, report_queries, text_queries, tool_queries

    return [problem_queries, crawl_queries, tool_queries, report_queries, text_queries, io_queries]


def all_queries() -> dict:
    out: dict = {}
    for m in _modules():
        out |= m.QUERIES
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _modules():
        out |= m.ORACLES
    return out
