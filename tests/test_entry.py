"""The entry file works without the optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["ahocorasick", "tiktoken", "xxhash", "zstandard", "public_tokenizers", "corpus_pipeline", "vitalgauge.llm"])
def test_a_missing_library_removes_the_text_operators_only(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    names = done.stdout.split()
    assert "adoption_scorecard_mobile" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
