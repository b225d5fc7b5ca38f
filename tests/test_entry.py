import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/registrylake", tmp_path / "registrylake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    n, m = map(int, said.stdout.split())
    assert n == m > 50, said.stderr


def test_nothing_else_imports_the_training_subpackage():
    for folder, _, names in os.walk(f"{ROOT}/registrylake"):
        if "llm" not in folder.split(os.sep):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "registrylake.llm" not in f.read()


def test_flagship(spark):
    import __spark_entry__ as entry

    if os.path.isdir("/root/testdata/sf0.001"):
        assert set(entry.entry(spark).columns) == {"o_orderkey", "definition_hash", "change"}
