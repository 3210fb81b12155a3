"""The entry module with and without the subpackage for training documents."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(block: str) -> list[str]:
    code = f"import sys\n{block}\nimport __spark_entry__ as e\nprint(*e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True, timeout=120).stdout.split()


def test_without_the_subpackage():
    own = names("sys.modules['tidelog.llm'] = None; sys.modules['corpus_pipeline'] = None")
    assert len(own) > 40 and all(n.startswith("q") for n in own)
    assert names("sys.modules['tidelog.llm.queries'] = None") == own
    assert names("sys.modules['corpus_pipeline'] = None")[: len(own)] == own


def test_nothing_imports_the_subpackage():
    for at in (ROOT / "tidelog").rglob("*.py"):
        if "llm" not in at.relative_to(ROOT).parts:
            assert "llm" not in at.read_text(), at
