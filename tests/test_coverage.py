"""COVERAGE.md names only code and queries that exist, and every query."""

import importlib
import re
from pathlib import Path

from verification.queries import QUERIES

TEXT = (Path(__file__).resolve().parent.parent / "COVERAGE.md").read_text()
ROWS = [line.split("|")[1:4] for line in TEXT.splitlines() if line.startswith("| ") and not line.startswith("| ID")]


def test_code_exists():
    for _, code, _ in ROWS:
        for path in re.findall(r"`([\w.]+)`", code):
            parts = path.split(".")
            if path in ("orderBy", "limit"):
                continue
            try:
                importlib.import_module(f"roadflux.{path}")
            except ImportError:
                module = importlib.import_module("roadflux." + ".".join(parts[:-1]))
                assert hasattr(module, parts[-1]), path


def test_queries_exist_and_are_listed():
    named = {q for *_, queries in ROWS for q in re.findall(r"`(\w+)`", queries)}
    assert named == set(QUERIES)
