import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

#: Hides a package from imports, then asks the entry for its queries.
HIDDEN = """
import sys, warnings
from importlib.abc import MetaPathFinder
class Hide(MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {hidden!r} or name == {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith("op") for q in e.queries()))
"""


def counts(hidden):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    return done.returncode, [int(x) for x in done.stdout.split()], done.stderr


def test_queries_stay_when_the_training_operators_or_their_libraries_are_missing():
    for hidden in ("lakegauge.llm", "corpus_pipeline", "public_tokenizers", "ahocorasick"):
        code, (queries, with_sql, training), _ = counts(hidden)
        assert code == 0 and queries > 100 and with_sql > 100 and training == 0, hidden


def test_other_faults_of_an_import_are_not_hidden():
    code, _, said = counts("lakegauge.sources")
    assert code and "lakegauge.sources" in said
