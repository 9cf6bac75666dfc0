from collections import Counter, defaultdict

from quire.llm.line_dedup import BLANK, dedup_lines

from .cases import SCHEMA, frame, rows

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(found):
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANK).translate(FOLD)
    for i, text, *_ in found:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text, *_ in found:
        lines = (text or "").split("\n")
        gone = [len(k := key(x)) >= 20 and len(holders[k]) >= 3 and i != max(h for h in holders[k] if h is not None) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return Counter(out)


def test_matches_brute_force_for_any_batching(spark):
    found = rows()
    for batches, fanout in ((1, 2), (4, 2), (5, 3)):
        out = dedup_lines(frame(spark), batches=batches, fanout=fanout)
        got = Counter((r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, r.line_dedup.text) for r in out.collect())
        assert got == brute(found)
        assert any(d for _, _, d, _ in got)
    assert out.columns == ["doc_id", "text", "row", "id", "th", "n", "line_dedup"]


def test_many_lines_in_one_text(spark):
    line = "one line of more than twenty characters"
    found = [(i, "\n".join([line, f"own {i}"] * 3000), "r", "o", 0, 0) for i in range(3)]
    out = {r.doc_id: r.line_dedup for r in dedup_lines(spark.createDataFrame(found, SCHEMA)).collect()}
    assert [out[i].n_dropped for i in range(3)] == [3000, 3000, 0]
    assert out[0].text == "\n".join(["own 0"] * 3000)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
