"""The library stands without the corpus subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_queries_without_the_subpackage(tmp_path):
    for name in ("cuelark", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'srt_cues' in q and set(o) <= set(q) and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    for keep in (True, False):  # corpus_pipeline.py may go too
        if not keep:
            (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
        subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)
