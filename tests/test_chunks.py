import pytest

from quire.functions import plain
from quire.operators import chunks as ck

MANIFEST = "book string, source_file string, license_status string, bibliography struct<title: string, title_source: string, authors: array<string>, authors_source: string, edition: string, publication_year: string, language: string>"
PAGE = "book string, page int, markdown string, status string, conversion_route string, printed_page_label string, outline_path array<string>, needs_visual_parser boolean, reason_codes array<string>"


def build(spark, pages, target=200, most=300, overlap=20, title="T"):
    rows = [("b", n, m, *rest, *("complete", "visual_llm", None, None, False, None)[len(rest) :]) for n, m, *rest in pages]
    manifest = spark.createDataFrame([("b", "f.pdf", "owned", (title, "filename", ["A"], None, None, None, "en"))], MANIFEST)
    out = ck.build_chunks(spark.createDataFrame(rows, PAGE), manifest, target=target, most=most, overlap=overlap)
    return sorted(out.collect(), key=lambda r: r.chunk_index)


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_labels_outline_and_flags(spark):
    (c,) = build(spark, [(18, "# Head\n\ntext here", "complete", "visual_llm", "3", ["Part", "Chapter"], True, ["r1", "r2"])])
    assert c.section == c.outline_section == "Chapter" and c.markdown_section == "Head" and c.printed_page_start == "3"
    assert c.citation == "A, T, PDF p. 18 (printed p. 3)" and c.visual_review_pages == [18] and c.reason_codes == ["r1", "r2"]
    assert c.body == "[p. 18]\n\n# Head\n\ntext here" and c.chunk_id == f"b-sha256-{c.content_sha256}"


def test_bound_before_marks_and_overlap(spark):
    got = build(spark, [(i, words(60, f"p{i}x")) for i in range(1, 7)], 120, 150, 20)
    assert len(got) > 1
    for c in got:
        assert plain.tokens(c.body) - 4 * len(c.included_pages) <= 150
    assert set(got[0].included_pages) & set(got[1].included_pages)


def test_mixed_quality(spark):
    (c,) = build(spark, [(1, "one"), (2, "two", "native_text_fallback", "native_fallback_after_llm")])
    assert c.source_quality == "mixed_gemini_and_native_text_fallback" and c.fallback_pages == [2] and "[p. 1]" in c.body and "[p. 2]" in c.body


def test_failed_pages_and_gaps(spark):
    got = build(spark, [(1, "one"), (2, "lost", "failed"), (3, "three")])
    assert [c.included_pages for c in got] == [[1], [3]] and "one" not in got[1].body


def test_oversized_table(spark):
    table = "<table>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(100)) + "</table>"
    got = build(spark, [(1, f"before\n\n{table}\n\nafter")], 40, 50, 5)
    big = [c for c in got if c.oversized]
    assert [c.oversized_reason for c in big] == ["atomic_html_table_exceeds_chunk_max"] and table in big[0].body
    assert all((c.oversized_reason is not None) == c.oversized for c in got)


def test_heading_breaks_from_half_target(spark):
    got = build(spark, [(1, f"{words(60)}\n\n# Next\n\n{words(10, 'v')}")], 100, 150, 0)
    assert len(got) == 2 and got[1].body.endswith(f"# Next\n\n{words(10, 'v')}") and got[1].section == "Next"


def test_ids_do_not_depend_on_index_or_bibliography(spark):
    a = build(spark, [(5, words(30))])[0]
    b = build(spark, [(1, words(250, "z")), (5, words(30))], title="Other")[-1]
    assert a.chunk_id == b.chunk_id and a.chunk_index != b.chunk_index and a.citation != b.citation


def test_blank_pages_make_nothing(spark):
    assert build(spark, [(1, " \n\n ")]) == []
    with pytest.raises(ValueError):
        ck.pack_chunks(None, 100, 50, 10)


def test_every_word_is_in_a_chunk_and_partitions_do_not_matter(spark):
    pages = [(i, words(37 * i % 190 + 1, f"q{i}x")) for i in range(1, 30)]
    got = build(spark, pages, 100, 130, 30)
    assert {w for _, m in pages for w in m.split()} <= {w for c in got for w in c.body.split()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        assert [c.chunk_id for c in build(spark, pages, 100, 130, 30)] == [c.chunk_id for c in got]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_vector_order(spark):
    rows = spark.createDataFrame([(f"b{i % 7}", i) for i in range(500)], "book string, chunk_index int").repartition(9)
    got = sorted(ck.vector_order(rows, ["book", "chunk_index"]).collect(), key=lambda r: r.vector_index)
    assert [r.vector_index for r in got] == list(range(500)) and [(r.book, r.chunk_index) for r in got] == sorted((r.book, r.chunk_index) for r in got)
