"""Personal data beyond the base rules, on patterns and lines that the trees have not seen."""

import time

import numpy as np
import pytest

from lakeops.llm import pii
from tests.llm.personal_lines import FALSE, TRUE


@pytest.fixture(scope="module")
def model():
    return pii.train()


def test_the_other_family_of_patterns(model):
    x, y = pii.labelled(3000, seed=91, family=1)
    chosen = model.trees.predict(x) >= np.array(model.thresholds)[x[:, 0].astype(int)]
    assert y[chosen].mean() >= 0.97 and chosen[y == 1].mean() >= 0.9


def test_lines_written_by_hand(model):
    missed = []
    for text, value in TRUE:
        start = text.index(value)
        covered = {i for a, b, _ in model.spans(text)[1] for i in range(a, b)}
        if not all(i in covered for i in range(start, start + len(value)) if text[i].isalnum()):
            missed.append(text)
    assert len(TRUE) >= 40 and len(missed) <= 0.1 * len(TRUE), missed
    wrong = [t for t in FALSE if model.added(t, pii.base_spans(t))]
    assert len(wrong) <= 0.1 * len(FALSE), wrong


def test_lines_do_not_depend_on_what_follows(model):
    for text, value in TRUE:
        start = text.index(value)
        here = [s for s in model.spans(text)[1] if s[0] < start + len(value)]
        after = [s for s in model.spans(text + "\n.\nthe token: of (at) 7 call")[1] if s[0] < start + len(value)]
        assert here == after, text


def test_names_of_any_length(model):
    name = "of_the_" * 2000 + "secret" + "_of_the_cluster" * 2000
    text = f"der {name} = f81d4fae7dec of"
    at = text.index("f81d")
    assert (at, at + 12, "secret") in model.spans(text)[1]


def test_no_generator_is_switched_off(model):
    assert len(model.thresholds) == len(pii.GENERATORS) and all(0.5 <= t <= 1 for t in model.thresholds)


def test_proposing_takes_linear_time():
    for unit in ("a=", "token=token=", "password", "password ", "password is ", "secret_:", "x(at)", "x at ", "x(at)y.", "x at y dot ", "1 ", "(1)", "card no ", "CARD 1 ", "passport", "account # ", "GB12 ", " = ", '"token"'):
        took = []
        for n in (20_000, 160_000):
            start = time.process_time()
            pii.candidates_of(unit * (n // len(unit)))
            took.append(time.process_time() - start)
        assert took[1] < 20 * took[0] + 0.5, unit
    for text in ("token" + " " * 200_000, "account" + " " * 200_000 + "x", "token=" + "'" * 200_000, "a" * 200_000 + "(at)"):
        pii.candidates_of(text)
