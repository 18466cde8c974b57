"""What the operators bring to the driver, and why it is bounded."""

import re
from pathlib import Path

LLM = Path(__file__).resolve().parents[2] / "pricelens" / "llm"

# Module -> collects, each with its bound.
COLLECTS = {
    "importance.py": ["one sum per bucket", "one count per sort partition"],
    "langid.py": ["languages", "400 documents a language, in expectation"],
    "licenses.py": ["the templates' distinct words"],
    "mixing.py": ["domains"],
    "sharding.py": ["probes"],
    "token_store.py": ["write tasks"],
    "toxicity.py": ["FEATURES", "two classes", "POSITIVES + UNLABELLED rows of feature numbers, in expectation"],
}


def test_every_collect_is_listed_with_its_bound():
    found = {p.name: len(re.findall(r"\.(?:collect|toLocalIterator)\(\)", p.read_text())) for p in LLM.glob("*.py")}
    assert {k: n for k, n in found.items() if n} == {k: len(v) for k, v in COLLECTS.items()}


def test_no_whole_table_reaches_the_driver():
    text = "\n".join(p.read_text() for p in LLM.glob("*.py"))
    assert not re.search(r"\.toPandas\(|localCheckpoint|\.crossJoin\(", text)
