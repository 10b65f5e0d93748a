"""The library works without its subpackage for training data."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_llm():
    for p in (ROOT / "textloom").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "textloom.llm" not in p.read_text()


def test_entry_without_llm(tmp_path):
    for name in ("textloom", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    hide = "import sys; sys.modules['textloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'quote_containment' in e.queries() and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", hide], cwd=tmp_path, check=True, timeout=120)
