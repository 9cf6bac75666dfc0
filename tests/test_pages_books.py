from pyspark.sql import functions as F

from quire.operators import books as bk
from quire.operators import facts as fx
from quire.operators import pages as pg


def test_quality_codes(spark):
    texts = ["", " \n ", "�" * 5 + "good words here enough", "!!! ??? ... ---", "a" + " " * 9, "a\n\n\n\n", "plain text"]
    got = [r.reason_codes for r in pg.text_quality(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i").collect()]
    p = "native_text_"
    assert got == [[p + "empty"], [p + "empty"], [p + "invalid_characters"], [p + "low_alphanumeric_ratio"], [p + "excessive_spaces"], [p + "excessive_newlines"], []]


def test_outline(spark):
    outline = spark.createDataFrame([("b", 0, 1, "A", 1), ("b", 1, 2, "A1", 1), ("b", 2, 3, "A1x", 3), ("b", 3, 1, "B", 4), ("b", 4, 3, "Bx", 5), ("b", 5, 2, "B1", 0)], "book string, idx int, level int, title string, page int")
    tree = pg.outline_tree(outline)
    assert [r.path for r in tree.orderBy("idx").collect()] == [["A"], ["A", "A1"], ["A", "A1", "A1x"], ["B"], ["B", "Bx"], ["B", "B1"]]
    pages = spark.createDataFrame([("b", i) for i in range(1, 7)] + [("c", 1)], "book string, page int")
    got = {(r.book, r.page): r.outline_path for r in pg.outline_paths(pages, tree).collect()}
    assert got == {("b", 1): ["A", "A1"], ("b", 2): ["A", "A1"], ("b", 3): ["A", "A1", "A1x"], ("b", 4): ["B"], ("b", 5): ["B", "Bx"], ("b", 6): ["B", "Bx"], ("c", 1): None}


def test_breaker(spark):
    states = "ffcffffff"
    rows = [("b", i, {"f": "failed", "c": "complete"}[s]) for i, s in enumerate(states, 1)] + [("c", 1, "failed"), ("c", 2, None), ("c", 3, "failed")]
    assert [tuple(r) for r in pg.failure_runs(spark.createDataFrame(rows, "book string, page int, status string")).collect()] == [("b", 8)]


def test_histogram_map(spark):
    rows = spark.createDataFrame([("b", ["x", "y"]), ("b", ["x"]), ("c", [])], "book string, gates array<string>")
    assert [tuple(r) for r in pg.as_map(pg.histogram(rows, "gates", "gate"), "gate").collect()] == [("b", {"x": 2, "y": 1})]


def test_sidecars(spark):
    pdfs = spark.createDataFrame([("/i/a.pdf",), ("/i/b.pdf",), ("/i/c.pdf",)], "path string")
    sides = spark.createDataFrame([("/i/a.license.json", "﻿{1}"), ("/i/a.pdf.license.json", "{2}"), ("/i/b.pdf.license.json", "{3}")], "path string, content string")
    assert {r.path: r.license_json for r in bk.attach_sidecars(pdfs, sides).collect()} == {"/i/a.pdf": "{1}", "/i/b.pdf": "{3}", "/i/c.pdf": None}


def test_labels_and_licences(spark):
    row = spark.createDataFrame([(("T", ["A", "B"], "3rd", "1999"),)], "bibliography struct<title: string, authors: array<string>, edition: string, publication_year: string>")
    assert row.select(bk.book_label()).head()[0] == "A, B, T, 3rd ed., 1999"
    got = spark.createDataFrame([(None,), ("unspecified",), (" ",), ("owned",), ("stolen",)], "s string").select(bk.normalize_license(F.col("s")).alias("n"), bk.packable(bk.normalize_license(F.col("s"))).alias("p")).collect()
    assert [tuple(r) for r in got] == [("authorized", True), ("authorized", True), ("", False), ("owned", True), ("stolen", False)]


def test_marginalia_flags(spark):
    blocks = spark.createDataFrame([("b", "The Book 3", True), ("b", "12", True), ("b", "The Book 4", False), ("b", "body", True)], "book string, text string, edge boolean")
    repeated = spark.createDataFrame([("b", "the book", 4)], "book string, key string, n long")
    got = sorted((r.text, r.ignore_reason) for r in fx.without_marginalia(blocks, repeated).collect())
    assert got == [("12", "isolated_printed_page_number"), ("The Book 3", "repeated_running_header_or_footer"), ("The Book 4", None), ("body", None)]


def test_unmatched_tokens(spark):
    pairs = spark.createDataFrame([(1, "a b b c", "b a"), (2, "", "x"), (3, "x", "")], "id int, e string, o string")
    got = {r.id: (r.total, r.matched, r.unmatched) for r in fx.token_coverage(pairs, "e", "o", "id").collect()}
    assert got == {1: (4, 2, ["b", "c"]), 2: (0, 0, None), 3: (1, 0, ["x"])}
