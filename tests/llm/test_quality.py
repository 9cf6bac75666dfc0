import re
from collections import Counter, defaultdict

from quire.llm.quality import quality_rules, repeated_words, without_lines

from .cases import SCHEMA, frame, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(found, max_texts, host=lambda r: r[3]):
    holders = defaultdict(lambda: defaultdict(set))
    key = lambda line: " ".join(WORD.findall(line.translate(FOLD)))
    for r in found:
        for line in (r[1] or "").split("\n"):
            if key(line):
                holders[(host(r), key(line))][r[1]].add(r[0])
    out = []
    for r in found:
        text = r[1] or ""
        words, lines = WORD.findall(text), text.split("\n")
        wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        n = Counter(wins)
        covered = {i + k for i, w in enumerate(wins) if n[w] > 1 for k in range(8)}
        dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
        bad = []
        for line in lines:
            h = holders.get((host(r), key(line)), {})
            ids = [i for s in h.values() for i in s if i is not None]
            if len(h) > max_texts and r[0] != min(ids, default=None):
                bad.append(line)
        left = len(words) - sum(len(WORD.findall(x)) for x in bad)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        out.append((r[0], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, left, not failed and 100 * left >= 10 * len(words), "\n".join(x for x in lines if x not in bad)))
    return out


def test_matches_brute_force(spark):
    for max_texts in (2, 10):
        want = brute(rows(), max_texts)
        got = quality_rules(frame(spark), host_col="id", max_texts=max_texts)
        columns = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_left", "kept"]
        assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(w[:9] for w in want)
        texts = Counter((r.doc_id, r.text) for r in without_lines(frame(spark), got, host_col="id").collect())
        assert texts == Counter((w[0], w[9]) for w in want if w[8])


def test_boilerplate_goes_and_copies_stay(spark):
    body = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(30)]
    found = [(i, f"Share this  page\n{body[i]}", "r", "h", 0, 0) for i in range(30)]
    found += [(100 + i, body[0] + "\nlast line of the copied text", "r", "h", 0, 0) for i in range(40)]
    found += [(200 + i, "share THIS page\n" + " ".join(["tick"] * 3) + f" {i}", "r", "h", 0, 0) for i in range(3)]
    found += [(300, f"Share this page\n{body[3]}", "r", "elsewhere", 0, 0), (301, None, "r", None, 0, 0)]
    judged = quality_rules(spark.createDataFrame(found, SCHEMA), host_col="id")
    out = {r.id: r for r in judged.collect()}
    assert all(out[i].kept and out[i].n_left == 30 for i in range(1, 30)) and out[0].n_left == 33
    assert all(out[100 + i].kept for i in range(40))
    assert out[300].n_left == out[300].n_words and not out[301].kept


def test_depleted_documents_go_but_one_of_a_family_stays(spark):
    lines = [" ".join(f"w{i}x{k}" for k in range(10)) for i in range(4)]
    found = [(i, "\n".join(lines) + f"\nx{i}", "r", "h", 0, 0) for i in range(15)]
    out = {r.id: r.kept for r in quality_rules(spark.createDataFrame(found, SCHEMA), host_col="id").collect()}
    assert out == {i: i == 0 for i in range(15)}


def test_repeated_words():
    assert repeated_words(b"a b c d e f g h".split()) == 0
    assert repeated_words(b"a b c d e f g h x a b c d e f g h".split()) == 16
    assert repeated_words([b"a"] * 9) == 9


def test_empty(spark):
    assert quality_rules(spark.createDataFrame([], SCHEMA), host_col="row").count() == 0
