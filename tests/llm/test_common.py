import random

import pytest

from wardline.llm import common


@pytest.mark.parametrize("most", [1, 2, 5, 100])
def test_slices_are_the_text_and_cut_no_word(most):
    rng = random.Random(most)
    for _ in range(100):
        text = "".join(rng.choice("ab  \n\té　") for _ in range(rng.randint(0, 40)))
        parts = list(common.slices(text, most))
        assert "".join(parts) == text and all(parts)
        assert all(part[-1] in " \n\t" and len(part) >= most for part in parts[:-1])
        assert [word for part in parts for word in part.split()] == text.split()
    assert list(common.slices(None)) == []


def test_lines_are_the_full_ones():
    assert list(common.lines("a\n\n b \r\n\nc")) == ["a", " b \r", "c"] and list(common.lines(None)) == []
