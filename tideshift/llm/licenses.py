"""License scans: phrases, and templates with optional and replaceable regions compiled to token automata.

A template is text with the marks ``<<beginOptional>>``, ``<<endOptional>>`` and ``<<var;name="..";original="..";
match="..">>``. Its words become the edges of an automaton; an optional region can be passed by, and a replaceable one
takes one of the wordings its ``match`` lists with "|", or up to N words for ``.{0,N}`` and ``.{1,N}``. A template is
found where words of a text, one after the other, lead from its start to its end: all mandatory wording is there exactly.
Words are compared in lower case (A-Z); what stands between words does not count, as in the matching guidelines for
license templates.

Phrases are found at all places where their words follow each other. The score is the share of a text's words that
belong to a found phrase or template. A missing text is empty: no words, no labels, score 0. Texts of any length are
read whole, and rows that repeat are read each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideshift.llm.common import map_texts, utf8, with_fields

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARK = re.compile(r"<<(beginOptional|endOptional|var;.*?)>>", re.S)
MATCH = re.compile(r'match="(.*?)"', re.S)
ANY = None  # an edge that takes every word

MIT_NOTICE = """
<<beginOptional>>MIT License<<endOptional>> <<beginOptional>>Copyright <<var;name="holder";original="";match=".{1,20}">><<endOptional>>
Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="what";original="this software
and associated documentation files";match="this software and associated documentation files|this software">> (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name="holders";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{0,20}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
BSD_MARK = '<<var;name="mark";original="1.";match=".{0,2}">>'
BSD_START = f"""
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: {BSD_MARK} Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. {BSD_MARK} Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_ADVERTISING = f"""
{BSD_MARK} All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by <<var;name="organization";original="the organization";match=".{{1,20}}">>
"""
BSD_NAMES = f"""
{BSD_MARK} Neither the name of <<var;name="organization";original="the copyright holder";match=".{{1,20}}">> nor the names of
<<var;name="its";original="its";match="its|their">> contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY <<var;name="by";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{1,20}">> "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";original="THE COPYRIGHT HOLDER OR CONTRIBUTORS";match=".{1,20}">>
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
WORK = '<<var;name="work";original="work";match="work|program|software|library|file|project|document">>'
GRANT = '<<var;name="grant";original="licensed";match="licensed|released|distributed|published|available">>'
TERMS = "<<beginOptional>>the terms of<<endOptional>>"
# Templates by label: notices as they stand in files and pages, and the full texts of MIT and the BSD licenses.
TEMPLATES = {
    "mit": [MIT_NOTICE, f"{GRANT} under {TERMS} the <<beginOptional>>Expat<<endOptional>> MIT License"],
    "apache-2": [
        f"{GRANT} under {TERMS} the Apache License<<beginOptional>>,<<endOptional>> Version 2<<beginOptional>>.0<<endOptional>>"
    ],
    "gpl-3": [
        f"<<beginOptional>>This {WORK} is<<endOptional>> {GRANT} under {TERMS} the GNU General Public License, version 3"
        " <<beginOptional>>or <<var;name=\"later\";original=\"later\";match=\"later|any later version\">><<endOptional>>"
    ],
    "gpl-2": [
        f"<<beginOptional>>This {WORK} is<<endOptional>> {GRANT} under {TERMS} the GNU General Public License, version 2"
        " <<beginOptional>>or <<var;name=\"later\";original=\"later\";match=\"later|any later version\">><<endOptional>>"
    ],
    "cc-by-nc": [
        f'{GRANT} under <<var;name="article";original="";match=".{{0,4}}">> CC BY-NC <<beginOptional>><<var;name="version";'
        'original="4.0";match="1.0|2.0|2.5|3.0|4.0">><<endOptional>>'
    ],
    "cc-by": [
        f'{GRANT} under <<var;name="article";original="";match=".{{0,4}}">> CC BY <<var;name="version";original="4.0";match="1.0|2.0|2.5|3.0|4.0">>'
    ],
    "bsd-2": [BSD_START + BSD_END],
    "bsd-3": [BSD_START + BSD_NAMES + BSD_END],
    "bsd-4": [BSD_START + BSD_ADVERTISING + BSD_NAMES + BSD_END],
}
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def words_of(text: str | bytes) -> list[bytes]:
    return WORD.findall((text.encode() if isinstance(text, str) else text).lower())


@dataclass
class Automaton:
    """States with edges over words, and edges that are passed without one; state 0 starts, ``end`` accepts."""

    edges: list[dict] = field(default_factory=lambda: [{}])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    end: int = 0

    def state(self) -> int:
        self.edges.append({})
        self.free.append([])
        return len(self.edges) - 1

    def follow(self, at: int, words: Sequence) -> int:
        for word in words:
            new = self.state()
            self.edges[at].setdefault(word, []).append(new)
            at = new
        return at

    def closure(self, state: int) -> tuple[int, ...]:
        """The states reached from one without a word, itself included."""
        found, todo = {state}, [state]
        while todo:
            for new in self.free[todo.pop()]:
                if new not in found:
                    found.add(new)
                    todo.append(new)
        return tuple(sorted(found))


def compile_template(text: str) -> Automaton:
    made = Automaton()
    at, opened, place = 0, [], 0
    for mark in [*MARK.finditer(text), None]:
        at = made.follow(at, words_of(text[place : mark.start() if mark else len(text)]))
        if not mark:
            break
        place, kind = mark.end(), mark.group(1)
        if kind == "beginOptional":
            opened.append(at)
        elif kind == "endOptional":
            if not opened:
                raise ValueError("endOptional without beginOptional")
            new = made.state()
            made.free[at].append(new)
            made.free[opened.pop()].append(new)
            at = new
        else:
            at = _replaceable(made, at, MATCH.search(kind))
    if opened:
        raise ValueError("beginOptional without endOptional")
    made.end = at
    if made.end in made.closure(0):
        raise ValueError("the template has no mandatory wording")
    return made


def _replaceable(made: Automaton, at: int, found) -> int:
    if not found:
        raise ValueError("a replaceable region needs a match")
    new = made.state()
    wild = re.fullmatch(r"\.\{(\d+),(\d+)\}", found.group(1))
    if wild:
        least, most = map(int, wild.groups())
        for k in range(most + 1):
            if k >= least:
                made.free[at].append(new)
            if k < most:
                at = made.follow(at, [ANY])
    else:
        for wording in found.group(1).split("|"):
            made.free[made.follow(at, words_of(wording))].append(new)
    return new


def mandatory_word(automaton: Automaton) -> bytes:
    """The longest word that no accepted wording lacks."""
    words = {w for e in automaton.edges for w in e if w is not ANY}

    def accepts_without(word: bytes) -> bool:
        seen, todo = set(), list(automaton.closure(0))
        while todo:
            s = todo.pop()
            if s == automaton.end:
                return True
            if s not in seen:
                seen.add(s)
                for w, targets in automaton.edges[s].items():
                    if w != word:
                        todo += [c for t in targets for c in automaton.closure(t)]
        return False

    needed = [w for w in sorted(words) if not accepts_without(w)]
    if not needed:
        raise ValueError("the template has no mandatory wording")
    return max(needed, key=len)


class Matcher:
    """A compiled template: leftmost longest matches over a list of words, in one pass."""

    def __init__(self, text: str):
        automaton = compile_template(text)
        self.needed = mandatory_word(automaton)
        self.end, self.edges = automaton.end, automaton.edges
        self.closures = [automaton.closure(s) for s in range(len(automaton.edges))]

    def find(self, words: Sequence[bytes]) -> list[tuple[int, int]]:
        """Spans of words; of those that overlap, the one that starts first and then the longest."""
        best: dict[int, int] = {}
        active: dict[int, int] = {}  # state -> where its match starts; the earliest start is kept
        for i, word in enumerate(words):
            for s in self.closures[0]:
                active.setdefault(s, i)
            after: dict[int, int] = {}
            for s, start in active.items():
                edges = self.edges[s]
                for target in (*edges.get(word, ()), *edges.get(ANY, ())):
                    for c in self.closures[target]:
                        if start < after.get(c, len(words)):
                            after[c] = start
            active = after
            if self.end in active:
                best[active[self.end]] = i + 1
        spans, last = [], 0
        for start, stop in sorted(best.items()):
            if start >= last:
                spans.append((start, stop))
                last = stop
        return spans


class Phrases:
    """Places of fixed runs of words."""

    def __init__(self, phrases: dict[str, str]):
        self.words = {label: words_of(p) for label, p in phrases.items()}
        self.needed = {label: max(w, key=len) for label, w in self.words.items()}

    def find(self, words: Sequence[bytes], present: set[bytes]) -> list[tuple[str, int, int]]:
        found = []
        for label, run in self.words.items():
            if all(w in present for w in run):
                at = -1
                while True:
                    try:
                        at = words.index(run[0], at + 1)
                    except ValueError:
                        break
                    if words[at : at + len(run)] == run:
                        found.append((label, at, at + len(run)))
        return found


FIELDS = [
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
    ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("spans", T.StringType()),
]


def scan(
    df: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, Sequence[str]] = TEMPLATES,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The kept columns with the words, places and labels of each text, its score, and the found templates.

    ``spans`` lists label, first word and word after the last of each template found, as "mit:12:16 ...". A kept
    column with the name of a made one is replaced.
    """
    schema = with_fields(df, keep, FIELDS)
    names = [n for n, _ in FIELDS]
    inputs = list(dict.fromkeys([*[f.name for f in schema.fields if f.name not in names], text]))

    def work():
        base = Phrases(phrases)
        matchers = [(label, Matcher(t)) for label, ts in templates.items() for t in ts]
        kind = np.zeros(256, bool)
        kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
        needed = sorted({*base.needed.values(), *[m.needed for _, m in matchers]})

        def read(raw: bytes) -> tuple:
            """Labels and spans of one text that holds a needed word."""
            words = WORD.findall(raw)
            present = set(words)
            places = base.find(words, present)
            spans = [(label, *s) for label, m in matchers if m.needed in present for s in m.find(words)]
            covered = np.zeros(len(words), bool)
            for _, start, stop in [*places, *spans]:
                covered[start:stop] = True
            starts = [s for _, s, _ in places]
            own = {label for label, _, _ in places}
            return (
                len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
                ",".join(sorted(own | {label for label, _, _ in spans})), float(covered.sum() / max(len(words), 1)),
                " ".join(f"{label}:{a}:{b}" for label, a, b in sorted(spans, key=lambda s: s[1:])),
            )

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = utf8(batch.column(text))
            inside = kind[data]
            first = np.zeros(len(data) + 1, bool)
            first[offsets[:-1]] = True
            starts = inside & (first[:-1] | ~np.concatenate([[False], inside[:-1]])) if len(data) else inside
            upto = np.concatenate([[0], np.cumsum(starts)])
            counts = np.diff(upto[offsets])
            lowered, bounds = data.tobytes().lower(), offsets.tolist()
            rows = []
            for a, b in zip(bounds, bounds[1:]):
                raw = lowered[a:b]
                rows.append(read(raw) if any(w in raw for w in needed) else (0, None, None, "", "", 0.0, ""))
            made = {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names[1:], ARROW[1:]))}
            made["n_words"] = pa.array(counts, pa.int64())
            return pa.RecordBatch.from_arrays(
                [made[f.name] if f.name in made else batch.column(f.name) for f in schema.fields], names=schema.names
            )

        return step

    return map_texts(df.select(*inputs), work, schema, text)


ARROW = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.string()]
