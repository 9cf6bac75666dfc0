import random
import re
from collections import Counter

from quire.llm.licence_scan import Automaton, Scanner, scan_licences, words_of
from quire.llm.licences import PHRASES, TEMPLATES

from .cases import SCHEMA, frame, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def base(text):
    ws, places, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_words():
    for text in ["A-b_c9 É1 x\x7fy\u0080z 日本,語", "", "__"]:
        assert [w.decode() for w in words_of(text.encode())] == words(text)


def test_matching_statistics_equal_the_naive_ones():
    r = random.Random(4)
    for _ in range(30):
        seqs = [[r.randint(1, 3) for _ in range(r.randint(1, 12))] for _ in range(4)]
        auto = Automaton(seqs)
        text = [r.randint(1, 4) for _ in range(40)]
        for j, (length, state) in enumerate(auto.statistics(text)):
            inside = lambda n: {(t, e) for t, s in enumerate(seqs) for e in range(n - 1, len(s)) if s[e - n + 1 : e + 1] == text[j - n + 1 : j + 1]}
            best = max(n for n in range(j + 2) if n == 0 or inside(n))
            assert length == best
            if length:
                assert {(t, e) for t, es in auto.states[state].ends.items() for e in es} == inside(length)


def test_base_columns_and_added_labels(spark):
    extra = [
        (900, "x under the MIT license. Apache License, Version 2.0! cc by nc; cc-by-nc under the mit license", "r", "o", 0, 0),
        (901, "before " + TEMPLATES[1][1].replace("redistribute", "share") + " after", "r", "o", 0, 0),
        (902, "the of this is to and or under terms software version 3 license public general gnu", "r", "o", 0, 0),
        (903, "under the mit\nlicense and words " * 500, "r", "o", 0, 0),
    ]
    docs = frame(spark).unionByName(spark.createDataFrame(extra, SCHEMA))
    out = scan_licences(docs, TEMPLATES, PHRASES).collect()
    got = Counter((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out)
    assert got == Counter((r[0], *base(r[1])) for r in rows() + extra)
    by = {r.id: r for r in out}
    assert by[901].labels == "gpl-3" and 0.9 < by[901].score < 1 and by[901].n_base == 0
    assert by[900].labels == "apache-2,cc-by-nc,mit" and by[902].labels == "" and by[902].score < 0.7
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in out)
    assert by[903].n_base == 500


def test_every_template_covers_itself():
    scanner = Scanner(TEMPLATES, PHRASES, 4, 8, 0.7)
    for number, (label, text) in enumerate(TEMPLATES):
        found = scanner.scan(f"some words {text} more of them".encode())
        assert label in found["labels"].split(",")
        assert any(s["template"] == number and s["cover"] == 1 and s["first_word"] == 2 for s in found["spans"])


def test_empty(spark):
    assert scan_licences(spark.createDataFrame([], SCHEMA), TEMPLATES, PHRASES).count() == 0
