"""License scans (operator 2): a generalised suffix automaton of licence tokens.

The automaton holds every run of words of every template, with the places where it ends.  A text
streams through it word by word, which gives its matching statistics: how long the longest run of
words is that ends here and occurs in a template.  Maximal matches of ``min_match`` words or more
are chained, per template, in the order of text and template; a chain's share of the template's
words is its coverage, and a template covered to ``min_cover`` gives its label and a text span.

Words outside the templates' vocabulary end every match, and almost all words are outside; numpy
finds the stretches of vocabulary words, and only those go through the automaton.  Texts are
streamed where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map

#: A-Z to a-z; ASCII digits, letters and all bytes of other characters stay; anything else ends a word.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


@dataclass
class State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    ends: dict[int, list[int]] = field(default_factory=dict)  # template -> last words' positions


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.states = [State(0)]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, word in enumerate(sequence):
                last = self._extend(last, word)
                self.states[last].ends.setdefault(number, []).append(position)
        for state in sorted(self.states[1:], key=lambda s: -s.length):  # a suffix ends wherever its extensions do
            if state.link > 0:
                up = self.states[state.link].ends
                for number, positions in state.ends.items():
                    up[number] = sorted({*up.get(number, ()), *positions})

    def _clone(self, parent: int, word: int, old: int) -> int:
        source, new = self.states[old], len(self.states)
        self.states.append(State(self.states[parent].length + 1, source.link, dict(source.next)))
        while parent >= 0 and self.states[parent].next.get(word) == old:
            self.states[parent].next[word] = new
            parent = self.states[parent].link
        source.link = new
        return new

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        if (known := states[last].next.get(word)) is not None:
            return known if states[known].length == states[last].length + 1 else self._clone(last, word, known)
        new, at = len(states), last
        states.append(State(states[last].length + 1))
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at < 0:
            states[new].link = 0
        else:
            old = states[at].next[word]
            states[new].link = old if states[old].length == states[at].length + 1 else self._clone(at, word, old)
        return new

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(length of the longest match that ends here, its state) for each word."""
        state = length = 0
        states = self.states
        for word in words:
            while state and word not in states[state].next:
                state = states[state].link
                length = states[state].length
            if word in states[state].next:
                state = states[state].next[word]
                length += 1
            yield length, state


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], min_match: int, max_gap: int, min_cover: float) -> None:
        self.labels = [label for label, _ in templates]
        sequences = [words_of(text.encode()) for _, text in templates]
        self.vocabulary: dict[bytes, int] = {}
        number = lambda ws: [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton([number(s) for s in sequences])
        self.phrases = [(number(words_of(p.encode())), label) for p, label in phrases.items()]
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.shortest = min([min_match, *(len(p) for p, _ in self.phrases)])

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Long enough runs of vocabulary words, [first, end)."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        first, end = edges[::2], edges[1::2]
        enough = end - first >= self.shortest
        yield from zip(first[enough].tolist(), end[enough].tolist(), strict=True)

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int32, count=len(words))
        places, base, matches = [], set(), []
        for first, end in self.stretches(ids):
            run = ids[first:end].tolist()
            for phrase, label in self.phrases:
                n = len(phrase)
                found = [first + k for k in range(len(run) - n + 1) if run[k : k + n] == phrase]
                places += found
                base |= {label} if found else set()
            before, state = 0, 0
            for k, (length, now) in enumerate([*self.automaton.statistics(run), (0, 0)]):
                if length <= before and before >= self.min_match:  # the match that ended one word earlier was maximal
                    matches.append((first + k - before, before, state))
                before, state = length, now
        spans = self.chain(matches)
        score = max([s["cover"] for s in spans] + [1.0] * bool(base), default=0.0)
        labels = base | {s["label"] for s in spans if s["cover"] >= self.min_cover}
        return {
            "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score, "spans": [s for s in spans if s["cover"] >= self.min_cover],
        }

    def chain(self, matches: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of matches (text start, words, state), in text order, as covered template spans."""
        open_: dict[int, list] = {}  # template -> [text start, text end, template end, covered words]
        done = []

        def close(template: int) -> None:
            a, b, _, covered = open_.pop(template)
            done.append({"label": self.labels[template], "template": template, "first_word": a, "end_word": b, "cover": covered / self.sizes[template]})

        for start, length, state in matches:
            for template, ends in self.automaton.states[state].ends.items():
                at = open_.get(template)
                if at and start - at[1] <= self.max_gap:
                    # the least template place after the chain; matches may overlap the chain's last words
                    overlap = max(0, at[1] - start)
                    after = [e for e in ends if e - length + 1 >= at[2] - overlap]
                    if after and length > overlap:
                        at[1], at[2], at[3] = start + length, after[0] + 1, at[3] + length - overlap
                        continue
                if at:
                    close(template)
                open_[template] = [start, start + length, ends[0] + 1, length]
        for template in list(open_):
            close(template)
        return sorted(done, key=lambda s: (s["first_word"], s["template"]))


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, template: int, first_word: long, end_word: long, cover: double>>"
)


def scan_licences(
    docs: DataFrame,
    templates: list[tuple[str, str]],
    phrases: dict[str, str],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_match: int = 4,
    max_gap: int = 8,
    min_cover: float = 0.7,
) -> DataFrame:
    """One row (id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) a document.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.  The base rule
    finds the places where a phrase's words stand consecutively; its labels always stay.  ``labels``
    adds those of covered templates, ``spans`` has their text and coverage, ``score`` is the best
    coverage of any template (1 with a base place, 0 without a match).  No label: the empty string.
    Null texts count as empty; repeated rows give repeated results; null ids pass; other columns are
    not read; an empty table gives no rows.
    """
    made: list[Scanner] = []

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        if not made:
            made.append(Scanner(templates, phrases, min_match, max_gap, min_cover))
        for batch in batches:
            found = [made[0].scan(t or b"") for t in batch["text"]]
            yield {"id": batch["id"]} | {k: [f[k] for f in found] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return arrow_map(read, rows, f"id long, {RESULT}")
