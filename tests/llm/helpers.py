"""Plain versions of the operators, and a small table with the awkward cases."""

from __future__ import annotations

import re
from collections.abc import Iterable

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(sf: str, name: str, columns: str = "*") -> list[tuple]:
    return duckdb.sql(f"select {columns} from read_parquet('{sf}/{name}.parquet')").fetchall()


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a long text, ties and repeated rows."""
    plain = "the quick brown fox jumps over the lazy dog and runs away from it "
    return [
        (1, plain * 12, "en", "a", 5),
        (2, plain * 12, "en", "a", 5),
        (2, plain * 12, "en", "a", 5),
        (3, None, "en", "b", None),
        (4, "", None, "b", 0),
        (5, " \t\n ", "de", None, 4),
        (None, "alone", "de", None, 5),
        (None, None, None, None, None),
        (6, "Ünïcode ✓ 漢字 text\x0bwith\x0codd\rspace", "fr", "a", 1),
        (7, (plain + "x") * 3000, "en", "c", 1),
        (8, "a" * 70_000, "es", "a", 70_000),
        (9, "ab " * 400, "es", "c", 1200),
    ]


def groups_of(links: Iterable[tuple], nodes: Iterable) -> dict:
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}
