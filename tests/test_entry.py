import subprocess
import sys

HIDING = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"no {{name}}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), sorted(set(entry.queries()) - set(entry.QUERIES)))
"""


def queries_without(name):
    made = subprocess.run(
        [sys.executable, "-c", HIDING.format(name=name)], capture_output=True, text=True, check=True, cwd="."
    )
    return made.stdout.split(" ", 1)


def test_entry_without_the_text_side_or_its_libraries():
    """The sales queries are there whatever the text operators lack."""
    for name in ("saleslane.llm", "corpus_pipeline", "xxhash", "public_tokenizers"):
        number, others = queries_without(name)
        assert int(number) >= 49 and others.strip() == "[]", name
