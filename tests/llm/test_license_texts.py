"""Whole licenses: accepted to the last word, with any holder, and not when wording is cut or changed."""

import random
import re

import pytest

from termspark.llm import licenses
from termspark.llm.common import words_of

WHOLE = [label for label in licenses.TEMPLATES if label.endswith(("-text", "-header", "-later", "-4.0-notice"))]
SCANNER = licenses.Scanner()


def filled(template, optional):
    """A text of the template with names in it, with or without its optional regions."""
    text = re.sub(r"<<var;match=(\d+)\.\.(\d+)>>", lambda m: " ".join(["Acme", "Labs,", "Inc"][: int(m[2])]), template)
    gone = r"\1" if optional else " "
    return re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", gone, text)


def labels(text):
    return SCANNER.scan(words_of(text.encode()))[2]


@pytest.mark.parametrize("label", WHOLE)
@pytest.mark.parametrize("optional", [True, False])
def test_whole(label, optional):
    text = filled(licenses.TEMPLATES[label], optional)
    assert label in labels(f"Copyright 2020 Acme. {text}. More text"), label
    words = text.split()
    if not optional:
        assert label not in labels(" ".join(words[:-1]))
        pick = random.Random(3)
        plain = [i for i, w in enumerate(words) if w not in ("Acme", "Labs,", "Inc")]
        for at in pick.sample(plain[1:], min(12, len(plain) - 1)):
            assert label not in labels(" ".join([*words[:at], "elsewise", *words[at + 1 :]])), (label, words[at])


def test_no_other_label():
    three = filled(licenses.TEMPLATES["bsd-3-clause-text"], True)
    assert labels(three) == {"bsd-3-clause-text"}
    assert labels(filled(licenses.TEMPLATES["bsd-2-clause-text"], True)) == {"bsd-2-clause-text"}
    assert labels("not the GNU General Public License version 3") == set()
    assert labels(filled(licenses.TEMPLATES["lgpl-3.0-or-later"], True)) == {"lgpl-3.0-or-later"}
    assert labels("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License") == {"cc-by-sa-4.0-notice"}


def test_first_sentence_is_no_license():
    assert labels(" ".join(licenses.TEMPLATES["mit-text"].split()[:60])) == set()
