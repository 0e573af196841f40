"""License scan: phrases, and templates with optional and replaceable regions.

A template is a license notice, or a whole license, in markup: plain words must stand as they are, ``<<beginOptional>>`` to
``<<endOptional>>`` may be left out, and ``<<var;match=a..b>>`` stands for a to b words of any kind.
Each template is compiled to an automaton over words, run from every place where it can begin; a text
is accepted where all of its mandatory wording matches exactly, word for word.

Phrases are the base: every place where a phrase's words stand consecutively is counted. Everything is
done batch by batch over whole texts; only texts with all words of a phrase, or all mandatory words of
a template, are looked at place by place.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import map_rows, struct, texts_of, words_of

# --- fixed values: base phrases and their labels ---
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# --- end of fixed values ---

# Notices by label. The label of a template that says more than a phrase is more precise than it.
TEMPLATES = {
    "gpl-notice": (
        "<<beginOptional>>this <<var;match=1..4>> is<<endOptional>> licensed under <<beginOptional>>the terms of"
        "<<endOptional>> the gnu general public license <<beginOptional>>version <<var;match=1..2>><<endOptional>>"
        "<<beginOptional>>or <<beginOptional>>at your option<<endOptional>> any later version<<endOptional>>"
    ),
    "gpl-3.0": "under <<beginOptional>>the terms of<<endOptional>> the gnu general public license"
    " <<beginOptional>>as published by the free software foundation<<endOptional>>"
    " <<beginOptional>>either<<endOptional>> version 3",
    "gpl-2.0": "under <<beginOptional>>the terms of<<endOptional>> the gnu general public license"
    " <<beginOptional>>as published by the free software foundation<<endOptional>>"
    " <<beginOptional>>either<<endOptional>> version 2",
    "mit-notice": (
        "<<beginOptional>>this <<var;match=1..4>> is<<endOptional>> <<beginOptional>>released<<endOptional>>"
        "<<beginOptional>>licensed<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> the mit license"
    ),
    "apache-2.0": (
        "licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0 "
        "<<beginOptional>>the license<<endOptional>>"
    ),
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>>"
    " cc by 4 0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>>"
    " cc by nc 4 0",
    "all-rights-reserved": "copyright <<beginOptional>>c<<endOptional>> <<var;match=1..8>> all rights reserved",
}

# --- fixed values: wording of published licenses, names of holders as replaceable regions ---
_MIT_WARRANTY = (
    " the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement in no event shall"
    " <<var;match=1..20>> be liable for any claim damages or other liability whether in an action of contract tort or"
    " otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions the above copyright notice"
    " and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all"
    " copies or substantial portions of the software"
)
_ISC = (
    "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with"
    " or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all"
    " copies the software is provided as is and <<var;match=1..20>> disclaims all warranties with regard to this"
    " software including all implied warranties of merchantability and fitness in no event shall <<var;match=1..20>> be"
    " liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of"
    " use data or profits whether in an action of contract negligence or other tortious action arising out of or in"
    " connection with the use or performance of this software"
)
_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above"
    " copyright notice this list of conditions and the following disclaimer <<beginOptional>>2<<endOptional>>"
    " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution"
)
_BSD_NAMES = (
    " <<beginOptional>>3<<endOptional>> neither the name of <<var;match=1..20>> nor the names of"
    " <<beginOptional>>its<<endOptional>> contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission"
)
_BSD_WARRANTY = (
    " this software is provided by <<var;match=1..20>> as is and any express or implied warranties including but not"
    " limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no"
    " event shall <<var;match=1..20>> be liable for any direct indirect incidental special exemplary or consequential"
    " damages including but not limited to procurement of substitute goods or services loss of use data or profits or"
    " business interruption however caused and on any theory of liability whether in contract strict liability or tort"
    " including negligence or otherwise arising in any way out of the use of this software even if advised of the"
    " possibility of such damage"
)
_APACHE_HEADER = (
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
    " license you may obtain a copy of the license at <<var;match=1..1>> www apache org licenses license 2 0"
    " <<beginOptional>>txt<<endOptional>> unless required by applicable law or agreed to in writing software distributed"
    " under the license is distributed on an as is basis without warranties or conditions of any kind either express or"
    " implied see the license for the specific language governing permissions and limitations under the license"
)
_GNU_HEADER = (
    "is free software you can redistribute it and or modify it under the terms of the gnu {name}"
    " general public license as published by the free software foundation either version {version} of the license or at"
    " your option any later version <<var;match=1..5>> is distributed in the hope that it will be useful but without any"
    " warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu"
    " {name} general public license for more details"
)
_UNLICENSE = (
    "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use"
    " compile sell or distribute this software either in source code form or as a compiled binary for any purpose"
    " commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors"
    " of this software dedicate any and all copyright interest in the software to the public domain we make this"
    " dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this"
    " dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software"
    " under copyright law"
)
_CC_NOTICE = (
    "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons {terms}"
    " <<beginOptional>>cc {short}<<endOptional>> 4 0 international <<beginOptional>>public<<endOptional>> license"
)
_CC_TERMS = {
    "by": "attribution",
    "by-sa": "attribution sharealike",
    "by-nd": "attribution noderivatives",
    "by-nc": "attribution noncommercial",
    "by-nc-sa": "attribution noncommercial sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
}
_GNU = {
    "gpl-2.0-or-later": ("", "2"),
    "gpl-3.0-or-later": ("", "3"),
    "lgpl-2.1-or-later": ("lesser", "2 1"),
    "lgpl-3.0-or-later": ("lesser", "3"),
}
# --- end of fixed values ---

# Whole licenses and headers: all of their wording, to the end.
TEMPLATES |= {
    "mit-text": _MIT + _MIT_WARRANTY,
    "isc-text": _ISC,
    "bsd-2-clause-text": _BSD_CONDITIONS + _BSD_WARRANTY,
    "bsd-3-clause-text": _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY,
    "unlicense-text": _UNLICENSE + _MIT_WARRANTY,
    "apache-2.0-header": _APACHE_HEADER,
}
TEMPLATES |= {label: _GNU_HEADER.format(name=name, version=version) for label, (name, version) in _GNU.items()}
TEMPLATES |= {
    f"cc-{short}-4.0-notice": _CC_NOTICE.format(terms=terms, short=short.replace("-", " "))
    for short, terms in _CC_TERMS.items()
}

MARKUP = re.compile(r"<<(beginOptional|endOptional|var;match=(\d+)\.\.(\d+))>>|([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
_ANY = b"\0any"


@dataclass
class Automaton:
    """Word automaton: ``moves[state]`` has (word, next state); ``skips[state]`` moves without a word."""

    moves: list[list[tuple[bytes, int]]] = field(default_factory=lambda: [[]])
    skips: list[list[int]] = field(default_factory=lambda: [[]])
    final: int = 0
    mandatory: set[bytes] = field(default_factory=set)
    first: set[bytes] = field(default_factory=set)

    def _new(self) -> int:
        self.moves.append([])
        self.skips.append([])
        return len(self.moves) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for follower in self.skips[todo.pop()]:
                if follower not in states:
                    states.add(follower)
                    todo.append(follower)
        return states

    @classmethod
    def of(cls, template: str) -> Automaton:
        """Compile a template; a replaceable region of a to b words is b moves, of which b - a can be left out."""
        made, at, opened = cls(), 0, []
        for mark, low, high, word in MARKUP.findall(template):
            if word:
                following = made._new()
                made.moves[at].append((word.lower().encode(), following))
                if not opened:
                    made.mandatory.add(word.lower().encode())
                at = following
            elif mark == "beginOptional":
                opened.append(at)
            elif mark == "endOptional":
                following = made._new()
                made.skips[at].append(following)
                made.skips[opened.pop()].append(following)
                at = following
            else:
                end = made._new()
                for n in range(int(high)):
                    following = made._new()
                    made.moves[at].append((_ANY, following))
                    if n >= int(low):
                        made.skips[at].append(end)
                    at = following
                made.skips[at].append(end)
                at = end
        if opened or not made.mandatory:
            raise ValueError(f"template without an end of its regions, or without mandatory words: {template!r}")
        made.final = at
        made.first = {w for s in made._closed({0}) for w, _ in made.moves[s]}
        return made

    def accepts_from(self, words: list[bytes], start: int) -> bool:
        """Whether the template matches some words from ``start`` on."""
        states = self._closed({0})
        for word in islice(words, start, None):
            if self.final in states:
                return True
            states = self._closed({n for s in states for w, n in self.moves[s] if w == word or w == _ANY})
            if not states:
                return False
        return self.final in states


class Scanner:
    """All phrases and templates, compiled."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [([w.encode() for w in phrase.split()], label) for phrase, label in phrases.items()]
        self.templates = [(label, Automaton.of(text)) for label, text in templates.items()]

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], int]:
        """Starts of base places, base labels, template labels, and words of the longest mandatory wording met."""
        present = set(words)
        starts, base, more, best = [], set(), set(), 0
        phrases = [p for p in self.phrases if present.issuperset(p[0])]
        templates = [t for t in self.templates if t[1].mandatory <= present]
        if not phrases and not templates:
            return starts, base, more, best
        wanted = {p[0][0] for p in phrases}.union(*[a.first for _, a in templates])
        places: dict[bytes, list[int]] = {}
        for place, word in enumerate(words):
            if word in wanted or _ANY in wanted:
                places.setdefault(word, []).append(place)
        for phrase, label in phrases:
            for place in places.get(phrase[0], ()):
                if words[place : place + len(phrase)] == phrase:
                    starts.append(place)
                    base.add(label)
        for label, automaton in templates:
            begins = automaton.first if _ANY not in automaton.first else places
            if any(automaton.accepts_from(words, p) for w in begins for p in places.get(w, ())):
                more.add(label)
                best = max(best, len(automaton.mandatory))
        return starts, base, more, best


def scan_licenses(
    docs: DataFrame, keep: list[str], phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES
) -> DataFrame:
    """The licenses named in each row of ``docs(text)``, with ``_row`` of the columns in ``keep``.

    Columns: n_words, n_base (places of base phrases), first_word and last_word (smallest and largest
    start of those, NULL without any), base_labels, labels (with those of matching templates; both
    sorted, distinct, comma-joined) and score: 0 without a label, 0.5 with base phrases only, and from
    there to 1 with the number of mandatory words of the longest template that matches. A NULL or
    empty text has no words. Repeated rows stay.
    """

    def start():
        scanner = Scanner(phrases, templates)

        def work(batch: pa.RecordBatch) -> dict:
            rows = []
            for text in texts_of(batch["text"]):
                words = words_of(text)
                starts, base, more, best = scanner.scan(words)
                score = 0.5 + 0.5 * best / (best + 4) if base or more else 0.0
                ends = (min(starts), max(starts)) if starts else (None, None)
                rows.append((len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(base | more)), score))
            return dict(zip(out.names, map(list, zip(*rows))))

        return work

    out = struct(
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double"
    )
    return map_rows(docs, {"text": "binary"}, out, start, keep)


def license_report(docs: DataFrame) -> DataFrame:
    """``scan_licenses`` with doc_id, for ``docs(doc_id, text)``."""
    found = scan_licenses(docs, ["doc_id"])
    return found.select(F.col("_row.doc_id").alias("doc_id"), *[c for c in found.columns if c != "_row"])
