"""The driver's contract where the training-text part or its tokenizer files are missing."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()))"


@pytest.fixture
def copy(tmp_path):
    target = tmp_path / "copy"
    shutil.copytree(ROOT / "ebbline", target / "ebbline", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, target / name)
    return target


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_training_text_part(copy, pipeline):
    for folder in [copy / "ebbline/llm"]:
        if folder.exists():
            shutil.rmtree(folder)
    if not pipeline and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    done = run(copy, COUNT)
    assert done.returncode == 0, done.stderr
    queries, oracles, extra = done.stdout.split()
    assert int(queries) > 100 and int(oracles) > 100 and extra == "False"


def test_without_tokenizer_files(copy):
    done = run(copy, "import sys; sys.modules['public_tokenizers'] = None; " + COUNT)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[2] == "False"


def test_faults_inside_the_part_are_not_hidden(copy):
    if not (copy / "ebbline/llm/queries.py").exists():
        pytest.skip("the training-text part is not here")
    with open(copy / "ebbline/llm/queries.py", "a") as file:
        file.write("\nfrom ebbline.llm import a_module_that_is_not_there\n")
    done = run(copy, COUNT)
    assert done.returncode != 0 and "a_module_that_is_not_there" in done.stderr
