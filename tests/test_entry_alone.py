"""The driver's contract without the text operators: the warehouse's queries must not need them."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def _copy(target, without=(), broken=None):
    for name in ("paystrata", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if name in without or not os.path.exists(source):
            continue
        skip = shutil.ignore_patterns("__pycache__", *[os.path.basename(w) for w in without])
        shutil.copytree(source, target / name, ignore=skip) if os.path.isdir(source) else shutil.copy(source, target / name)
    if broken:
        (target / broken).write_text("import a_module_that_is_not_there\n")
    return subprocess.run([sys.executable, "-c", LIST], cwd=target, capture_output=True, text=True, timeout=120)


def test_without_operators_or_pipeline(tmp_path):
    from paystrata.plans.queries import QUERIES
    for k, without in enumerate((["llm"], ["llm", "corpus_pipeline.py"], ["corpus_pipeline.py"])):
        (tmp_path / str(k)).mkdir()
        found = _copy(tmp_path / str(k), without)
        assert found.returncode == 0, found.stderr
        names = set(found.stdout.split("\n")[0].split())
        assert set(QUERIES) <= names and "pipeline" not in names
        assert any(n.startswith("op1_") for n in names) == ("llm" not in without and os.path.exists(f"{ROOT}/paystrata/llm"))


def test_a_fault_elsewhere_is_not_swallowed(tmp_path):
    found = _copy(tmp_path, broken="paystrata/plans/queries.py")
    assert found.returncode != 0 and "a_module_that_is_not_there" in found.stderr
