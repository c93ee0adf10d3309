"""The query names are there whatever the part on text needs and lacks."""

import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/tests/", 1)[0]
SCRIPT = """
import sys
sys.modules[{package!r}] = None
import __spark_entry__
names = set(__spark_entry__.queries())
assert names == set(__spark_entry__.oracle_sql()) and len(names) > 45, names
assert not [n for n in names if n.startswith("op") or n == "pipeline"]
"""


@pytest.mark.parametrize("package", ["tiktoken", "tokenizers", "public_tokenizers", "corpus_pipeline"])
def test_without_a_package_of_the_part_on_text(package):
    run = [sys.executable, "-c", SCRIPT.format(package=package)]
    subprocess.run(run, check=True, cwd=ROOT)


def test_an_own_module_that_is_missing_is_no_secret():
    script = SCRIPT.format(package="tillflow.plans.b2b")
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=ROOT, capture_output=True
    )
    assert done.returncode and b"tillflow.plans" in done.stderr
