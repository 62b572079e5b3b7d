"""Licence scans by template-markup matching.

A template is wording with two kinds of marked regions, as in the SPDX licence list:

    <<beginOptional>> ... <<endOptional>>                       may be there as a whole, or not; may be nested
    <<var;name="holder";original="the authors";match="...">>    replaceable text

``match`` lists alternatives, separated by ``|``; each is a sequence of words, in which ``.{m,n}`` stands for m to n
words of any kind. All other wording is mandatory.

A template is compiled to an automaton over words whose states are bits of one number. Each must have mandatory words
outside all regions; the longest run of them is looked for in the whole text at once, and only where it stands does the
automaton run, to the right and, mirrored, to the left. A text is accepted where all mandatory wording stands word for
word, with nothing between but optional and replaceable text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.frames import by_slices, documents, utf8

#: A-Z become small; ASCII characters that are neither letters nor digits become blanks; all else stays.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: A replaceable region must end: the largest number of words an alternative may stand for.
LONGEST = 1000


def words(text: str | bytes) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(_WORDS).split()


# A template is a list of nodes: a word (bytes), Any, Maybe or Either.
class Any(tuple):
    """(least, most) words of any kind."""


class Maybe(tuple):
    """Nodes that may be missing as a whole."""


class Either(tuple):
    """Lists of nodes, one of which must be there."""


_MARK = re.compile(r"<<(.*?)>>", re.S)
_GAP = re.compile(r"\.\{(\d+),(\d+)\}")
_MATCH = re.compile(r';match="([^"]*)"\s*$')


def parse(markup: str) -> list:
    """The template's nodes. Unknown or unbalanced marks, and regions without a bound, are errors."""
    open_: list[list] = [[]]
    at = 0
    for mark in [*_MARK.finditer(markup), None]:
        open_[-1] += words(markup[at:mark.start() if mark else None])
        if mark is None:
            break
        at, name = mark.end(), mark.group(1).strip()
        if name == "beginOptional":
            open_.append([])
        elif name == "endOptional" and len(open_) > 1:
            inner = open_.pop()
            if inner:
                open_[-1].append(Maybe(inner))
        elif name.startswith("var;") and _MATCH.search(name):
            open_[-1].append(Either(_alternative(a) for a in _MATCH.search(name).group(1).split("|")))
        else:
            raise ValueError(f"not a template mark here: <<{name}>>")
    if len(open_) > 1:
        raise ValueError("beginOptional without endOptional")
    return open_[0]


def _alternative(text: str) -> tuple:
    nodes, at = [], 0
    for gap in _GAP.finditer(text):
        least, most = int(gap.group(1)), int(gap.group(2))
        if not least <= most <= LONGEST:
            raise ValueError(f"{gap.group()} must stand for at most {LONGEST} words")
        nodes += [*words(text[at:gap.start()]), Any((least, most))]
        at = gap.end()
    return *nodes, *words(text[at:])


def mirrored(nodes: Sequence) -> list:
    def turn(node):
        if isinstance(node, Maybe):
            return Maybe(mirrored(node))
        if isinstance(node, Either):
            return Either(tuple(mirrored(a)) for a in node)
        return node
    return [turn(n) for n in reversed(nodes)]


class Automaton:
    """Accepts the word sequences of ``nodes``. Bit i says that the words so far may lead to place i."""

    def __init__(self, nodes: Sequence):
        self.size = 0
        self.on: dict[bytes, int] = {}  # places a word moves on from
        self.any = 0  # places that any word moves on from
        self.jumps: list[tuple[int, int]] = []  # from any of these places, to one after them, without a word
        self._add(nodes)
        self.jumps.sort(key=lambda jump: jump[1])
        self.end = 1 << self.size

    def _add(self, nodes: Sequence) -> None:
        for node in nodes:
            first = self.size
            if isinstance(node, bytes):
                self.on[node] = self.on.get(node, 0) | 1 << first
                self.size += 1
            elif isinstance(node, Any):
                least, most = node
                self.any |= (1 << first + most) - (1 << first)
                self.size += most
                self.jumps.append(((1 << self.size) - (1 << first + least), self.size))
            elif isinstance(node, Maybe):
                self._add(node)
                self.jumps.append((1 << first, self.size))
            else:
                ends = 0
                for i, alternative in enumerate(node):
                    if i:
                        self.size += 1  # no word moves on from where the alternative before ended
                        self.jumps.append((1 << first, self.size))
                    self._add(alternative)
                    ends |= 1 << self.size
                self.size += 1
                self.jumps.append((ends, self.size))

    def _closed(self, state: int) -> int:
        for places, to in self.jumps:
            if state & places:
                state |= 1 << to
        return state

    def longest(self, sequence: Iterator[bytes]) -> int | None:
        """How many words the longest accepted beginning of ``sequence`` has; None if none is accepted."""
        state, n = self._closed(1), 0
        best = 0 if state & self.end else None
        for word in sequence:
            state = self._closed((state & (self.any | self.on.get(word, 0))) << 1)
            if not state:
                break
            n += 1
            if state & self.end:
                best = n
        return best


class Template:
    """A compiled template: the wording to look for, and the automata to both sides of it."""

    def __init__(self, label: str, markup: str):
        self.label, self.nodes = label, parse(markup)
        runs, at = [(0, 0)], 0
        for i, node in enumerate([*self.nodes, None]):
            if not isinstance(node, bytes):
                runs.append((at, i))
                at = i + 1
        first, last = max(runs, key=lambda r: r[1] - r[0])
        if first == last:
            raise ValueError(f"template {label} has no mandatory wording outside its regions")
        self.anchor = self.nodes[first:last]
        self.right, self.left = Automaton(self.nodes[last:]), Automaton(mirrored(self.nodes[:first]))

    def places(self, text: Text) -> Iterator[tuple[int, int]]:
        """(first word, words) of each accepted place, as long as it can be."""
        for at in text.places(self.anchor):
            end = at + len(self.anchor)
            after = self.right.longest(text.words[i] for i in range(end, len(text.words)))
            before = None if after is None else self.left.longest(text.words[i] for i in range(at - 1, -1, -1))
            if before is not None:
                yield at - before, before + len(self.anchor) + after


class Text:
    """A text as words, and as one string in which runs of them can be looked for."""

    def __init__(self, raw: bytes):
        self.words = words(raw)
        self.joined = b" %b " % b" ".join(self.words)

    def places(self, run: Sequence[bytes]) -> Iterator[int]:
        """The first words of all places where ``run`` stands."""
        wanted = b" %b " % b" ".join(run)
        at, word, counted = self.joined.find(wanted), 0, 0
        while at >= 0:
            word += self.joined.count(b" ", counted, at)
            counted = at
            yield word
            at = self.joined.find(wanted, at + 1)


@cache
def compiled(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    return [Template(*t) for t in templates]


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]], phrases: Mapping[str, str]) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of all phrases), first_word and last_word (their smallest and
    largest start, or null), base_labels (of the phrases), labels (of phrases and templates), score, and places (label,
    start and length, in words, of each text that a template accepts).

    ``templates`` are (label, markup), ``phrases`` phrase to label. Labels are distinct, in the order of their code points and joined by
    commas. score is 1 where a template accepts some part of the text, 0.5 where a licence is only named, else 0. A-Z count as small
    letters; words are runs of ASCII letters and digits and of all other characters beyond ASCII.

    Whole texts are scanned, very long ones too. Null and empty texts have no words, no labels and a score of 0. Repeated rows
    and rows without a doc_id are scanned like any other; phrases may overlap, and each place counts. Other columns, whatever their
    names, play no part. An empty table gives an empty result.
    """
    wording = tuple(map(tuple, templates))
    compiled(wording)  # an unsound template is an error here, not in a task
    named = [(tuple(words(p)), label) for p, label in phrases.items()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_scanned(raw, compiled(wording), named) for raw in utf8(batch.column(1))]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _PLACES]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], _NAMES)
    return documents(docs).mapInArrow(by_slices(work, 512, 1), """doc_id long, n_words long, n_base long, first_word long, last_word long,
        base_labels string, labels string, score double, places array<struct<label: string, start: long, length: long>>""")


def _scanned(raw: bytes, templates: list[Template], named: list[tuple[tuple, str]]) -> tuple:
    text = Text(raw)
    base = [(at, label) for phrase, label in named for at in text.places(phrase)]
    places = [{"label": t.label, "start": at, "length": n} for t in templates for at, n in t.places(text)]
    own = {label for _, label in base}
    both = own | {p["label"] for p in places}
    starts = [at for at, _ in base]
    return (len(text.words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
            ",".join(sorted(both)), 1.0 if places else 0.5 if base else 0.0, places)


def pattern(nodes: Sequence) -> str:
    """The template as a regular expression over words that are each followed by a blank, for engines that have those."""
    out = ""
    for node in nodes:
        if isinstance(node, bytes):
            out += f"{node.decode()} "
        elif isinstance(node, Any):
            out += "(?:[^ ]+ ){%d,%d}" % node
        elif isinstance(node, Maybe):
            out += f"(?:{pattern(node)})?"
        else:
            out += f"(?:{'|'.join(map(pattern, node))})"
    return out
