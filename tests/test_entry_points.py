"""The entry points without the packages that only the optional operators need."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

MISSING = """
import re, sys
for name in ("tiktoken", "xxhash", "tokenizers", "public_tokenizers"):
    sys.modules[name] = None
import __spark_entry__ as entry_points
names = set(entry_points.queries())
assert "executive_summary" in names and names == set(entry_points.oracle_sql())
assert not [n for n in names if re.match(r"op\\d+_|pipeline", n)]
print("ok")
"""


def test_the_rest_loads_without_packages_of_the_optional_operators():
    done = subprocess.run([sys.executable, "-c", MISSING], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "ok", done.stderr


def test_nothing_else_imports_the_optional_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "cestero")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as file:
                    assert not re.search(r"cestero[. ]+(import )?llm", file.read()), name
