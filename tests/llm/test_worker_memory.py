"""Workers outlive their tasks, so each task of the pipeline's stages gives its memory back."""

import re
from pathlib import Path

import pytest

from vigil.llm import arrow_text

STAGES = ("toxicity", "near_copies", "suffix_dedup", "packing")


@pytest.mark.parametrize("name", STAGES)
def test_every_python_step_gives_memory_back(name):
    source = (Path(arrow_text.__file__).parent / f"{name}.py").read_text()
    assert re.search(r"mapInArrow\(", source) and not re.search(r"mapInArrow\((?!\s*frugal\()", source)


def test_memory_is_given_back_when_the_rows_are_out_or_no_more_are_wanted(monkeypatch):
    given = []
    monkeypatch.setattr(arrow_text, "give_back", lambda: given.append(1))
    task = arrow_text.frugal(lambda batches: (b + 1 for b in batches))
    assert list(task(iter([1, 2]))) == [2, 3] and len(given) == 1
    rows = task(iter([1, 2]))
    assert next(rows) == 2
    rows.close()
    assert len(given) == 2
