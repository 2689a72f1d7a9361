"""The entry without the training-data package: its queries are simply absent."""
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PARTS = ("revspark", "__spark_entry__.py", "corpus_pipeline.py")


def keys(folder):
    code = "import __spark_entry__ as E; print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": folder})
    return [set(line.split()) for line in out.stdout.splitlines()]


def test_entry_without_the_package(tmp_dir):
    for name in PARTS:
        if name == "revspark":
            shutil.copytree(f"{ROOT}/revspark", f"{tmp_dir}/revspark",
                            ignore=lambda folder, names: {"llm", "__pycache__"} & set(names))
        elif os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_dir)
    found, oracles = keys(tmp_dir)
    assert "pipeline" not in found and not any(k.startswith("op") and k[2:3].isdigit() for k in found)
    assert "split_standard" in found and oracles <= found


def test_missing_requirement_is_not_hidden(tmp_dir):
    os.makedirs(f"{tmp_dir}/revspark/llm")
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_dir)
    for name, text in (("revspark/__init__.py", ""), ("revspark/llm/__init__.py", ""),
                       ("revspark/llm/queries.py", "import a_module_that_is_not_there\n")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    code = "import __spark_entry__ as E; E._llm()"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": tmp_dir})
    assert run.returncode and "a_module_that_is_not_there" in run.stderr
