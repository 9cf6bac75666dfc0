"""Segmentation and chunking.

Cutting a page into segments and packing a book's segments into overlapping chunks are sequential
folds, so those two run in Python, page by page and book by book; everything around them (section
carry, metadata, citations, addresses) is Catalyst.  A book is one group of the packer: thousands of
pages of text, which fits a task by far; many books spread over the cluster by their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.functions import hashing
from quire.functions import plain
from quire.functions import text as tx
from quire.operators import books
from quire.operators.pages import carry_section

SEGMENTS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("structural_block_type", T.StringType())]))


@F.pandas_udf(SEGMENTS)
def page_segments(markdown: pd.Series) -> pd.Series:
    """A page's blocks in order."""
    return markdown.map(lambda m: [{"text": t, "structural_block_type": k} for t, k in plain.segments(m or "")])


def segment(pages: DataFrame, markdown: str = "markdown", book: str = "book") -> DataFrame:
    """One row (book, page, seq, text, structural_block_type, tokens, section) a block, section carried by book."""
    rows = pages.select(F.col(book).alias("book"), "page", F.posexplode(page_segments(markdown)).alias("seq", "s")).select("book", "page", "seq", "s.*")
    rows = rows.withColumn("tokens", tx.tokens(F.col("text")))
    title = F.when(F.col("structural_block_type").isNull(), tx.heading(F.col("text")))
    return carry_section(rows, title, ["book"], ["page", "seq"])


class Packer:
    """Greedy packing with tail overlap, a block at a time."""

    def __init__(self, target: int, most: int, overlap: int) -> None:
        self.target, self.most, self.overlap = target, most, overlap
        self.now: list[tuple] = []
        self.total = 0

    def pieces(self, text: str, kind: str | None) -> list[str]:
        parts = [text] if kind else plain.split_long(text, self.most)
        return [p for p in parts if p.strip()]

    def _carry(self, tokens: int) -> None:
        """Keep the least tail that has ``overlap`` tokens, less what doesn't leave room for the next block."""
        kept, total = 0, 0
        while self.overlap > 0 and kept < len(self.now) and total < self.overlap:
            kept += 1
            total += self.now[-kept][-1]
        self.now = self.now[len(self.now) - kept :]
        while self.now and total + tokens > self.most:
            total -= self.now.pop(0)[-1]
        self.total = total

    def add(self, page: int, seq: int, text: str, section: str, kind: str | None) -> Iterator[list[tuple]]:
        """Yields each chunk that this block closes."""
        for part in self.pieces(text, kind):
            tokens = plain.tokens(part)
            if self.now:
                gap = page > self.now[-1][0] + 1
                opens = part.startswith("#") and plain.re.match(r"#{1,6}\s+.", part.split("\n", 1)[0])
                if gap or self.total + tokens > self.most or self.total >= self.target or (opens and self.total >= self.target // 2):
                    yield list(self.now)
                    if gap:
                        self.now, self.total = [], 0
                    else:
                        self._carry(tokens)
            self.now.append((page, seq, part, section, kind, tokens))
            self.total += tokens

    def rest(self) -> Iterator[list[tuple]]:
        if self.now:
            yield list(self.now)
            self.now, self.total = [], 0


PACKED = "book string, chunk_index int, blocks array<struct<page: int, seq: int, text: string, section: string, structural_block_type: string, tokens: int>>"


def pack_chunks(segments: DataFrame, target: int = 750, most: int = 900, overlap: int = 120) -> DataFrame:
    """Rows (book, chunk_index, blocks) from (book, page, seq, text, section, structural_block_type).

    A chunk ends before a page gap, before a block that would exceed ``most`` tokens, once it has
    ``target`` tokens, and before a heading once it has half of them.  The next chunk begins with the
    tail of the last unless a gap lies between.  Sorting is left to Spark, which spills; the fold
    streams over the sorted rows and holds one chunk at a time, so a book of any size passes.
    """
    if not 0 <= overlap < target <= most:
        raise ValueError("overlap < target <= most is required")
    fields = ["page", "seq", "text", "section", "structural_block_type"]
    names = [*fields, "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, packer, index, out = None, None, 0, []

        def emit(chunks: Iterator[list[tuple]]) -> None:
            nonlocal index
            for blocks in chunks:
                index += 1
                out.append({"book": book, "chunk_index": index, "blocks": [dict(zip(names, b, strict=True)) for b in blocks]})

        for batch in batches:
            for row in batch.to_pylist():
                if packer is None or row["book"] != book:
                    if packer:
                        emit(packer.rest())
                    book, packer, index = row["book"], Packer(target, most, overlap), 0
                emit(packer.add(*(row[f] for f in fields)))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        if packer:
            emit(packer.rest())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T._parse_datatype_string(PACKED)
    schema = to_arrow_schema(kind)
    ordered = segments.select("book", *fields).repartition("book").sortWithinPartitions("book", "page", "seq")
    return ordered.mapInArrow(run, kind)


def _ordered_distinct(blocks: Column, field: str) -> Column:
    return F.array_distinct(F.array_compact(F.transform(blocks, lambda b: b[field])))


def render_body(blocks: Column) -> Column:
    """Blocks joined by blank lines, a ``[p. N]`` mark wherever the page changes."""
    marked = F.transform(blocks, lambda b, i: F.when((i == 0) | (b["page"] != F.get(blocks, i - 1)["page"]), F.concat(F.lit("[p. "), b["page"], F.lit("]\n\n"), b["text"])).otherwise(b["text"]))
    return F.array_join(marked, "\n\n")


def describe(chunks: DataFrame, most: int = 900) -> DataFrame:
    """Add what the blocks alone tell: pages, sections, structure, body and size."""
    blocks = F.col("blocks")
    pages = F.array_sort(F.array_distinct(F.transform(blocks, lambda b: b["page"])))
    kinds = _ordered_distinct(blocks, "structural_block_type")
    too_long = F.array_distinct(F.transform(F.filter(blocks, lambda b: b["structural_block_type"].isNotNull() & (b["tokens"] > most)), lambda b: b["structural_block_type"]))
    sections = F.filter(F.transform(blocks, lambda b: b["section"]), lambda s: F.coalesce(s, F.lit("")) != "")
    described = chunks.withColumns(
        {
            "included_pages": pages,
            "page_start": F.array_min(pages),
            "page_end": F.array_max(pages),
            "markdown_section": F.coalesce(F.try_element_at(sections, F.lit(-1)), F.lit("")),
            "structural_block_types": kinds,
            "structural_block_type": F.when(F.size(kinds) == 0, F.lit(None)).when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).otherwise("mixed"),
            "too_long": too_long,
            "body": render_body(blocks),
        }
    )
    size = F.size("too_long")
    reason = (
        F.when(size == 1, F.concat(F.lit("atomic_"), F.get("too_long", F.lit(0)), F.lit("_exceeds_chunk_max")))
        .when(size > 1, "multiple_atomic_structural_blocks_exceed_chunk_max")
        .otherwise("rendered_page_markers_exceed_chunk_max")
    )
    described = described.withColumn("approximate_tokens", tx.tokens(F.col("body"))).withColumn("oversized", F.col("approximate_tokens") > most)
    return described.withColumn("oversized_reason", F.when(F.col("oversized"), reason)).drop("too_long")


def source_quality(pages: Column, fallback: Column, native: Column) -> Column:
    """One of six labels from the included, fallback and natively structured page lists."""
    n, f, s = F.size(pages), F.size(fallback), F.size(native)
    return (
        F.when(f == n, "native_text_fallback")
        .when(s == n, "native_structured")
        .when((f == 0) & (s == 0), "gemini_visual")
        .when(s == 0, "mixed_gemini_and_native_text_fallback")
        .when(f == 0, "mixed_gemini_and_native_structured")
        .otherwise("mixed_gemini_native_structured_and_native_text_fallback")
    )


def attach_pages(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Add what the chunk's pages tell: labels, outline, quality lists, reason codes, source quality.

    ``pages`` has (book, page, status, conversion_route, printed_page_label, outline_path,
    needs_visual_parser, reason_codes).  Pages are joined by (book, page) and regrouped by chunk.
    """
    known = pages.select("book", "page", "status", "conversion_route", "printed_page_label", "outline_path", F.coalesce("needs_visual_parser", F.lit(False)).alias("visual"), "reason_codes")
    used = chunks.select("book", "chunk_index", F.explode("included_pages").alias("page")).join(known, ["book", "page"], "left")
    listed = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("page"))))
    coded = F.sort_array(F.collect_list(F.struct("page", F.coalesce("reason_codes", F.array().cast("array<string>")).alias("codes"))))
    facts = used.groupBy("book", "chunk_index").agg(
        listed(F.col("status") == "native_text_fallback").alias("fallback_pages"),
        listed(F.col("conversion_route") == "native_structured").alias("native_structured_pages"),
        listed(F.col("visual")).alias("visual_review_pages"),
        F.array_distinct(F.flatten(F.transform(coded, lambda c: c["codes"]))).alias("reason_codes"),
        F.max_by("outline_path", F.when(F.size("outline_path") > 0, F.col("page"))).alias("outline_path"),
        F.min_by("printed_page_label", "page").alias("printed_page_start"),
        F.max_by("printed_page_label", "page").alias("printed_page_end"),
    )
    joined = chunks.join(facts, ["book", "chunk_index"])
    outline = F.when(F.size("outline_path") > 0, F.element_at("outline_path", -1))
    return joined.withColumns(
        {
            "outline_path": F.coalesce("outline_path", F.array().cast("array<string>")),
            "outline_section": F.coalesce(outline, F.lit("")),
            "section": F.when(F.coalesce(outline, F.lit("")) != "", outline).otherwise(F.col("markdown_section")),
            "needs_visual_review": F.size("visual_review_pages") > 0,
            "has_native_text_fallback": F.size("fallback_pages") > 0,
            "has_native_structured": F.size("native_structured_pages") > 0,
            "source_quality": source_quality(F.col("included_pages"), F.col("fallback_pages"), F.col("native_structured_pages")),
        }
    )


def address(chunks: DataFrame) -> DataFrame:
    """Add ``content_sha256`` and ``chunk_id``."""
    sha = hashing.chunk_content_sha256(F.col("book"), F.col("page_start"), F.col("page_end"), F.col("section"), F.col("body"))
    return chunks.withColumn("content_sha256", sha).withColumn("chunk_id", hashing.chunk_id(F.col("book"), F.col("content_sha256")))


def file_name(index: Column) -> Column:
    return F.concat(F.lit("chunk-"), F.lpad(index.cast("string"), 5, "0"), F.lit(".md"))


def build_chunks(pages: DataFrame, manifest: DataFrame, *, target: int = 750, most: int = 900, overlap: int = 120) -> DataFrame:
    """Chunk records of whole books.

    ``pages``: as ``attach_pages`` and markdown; only complete and fallback pages take part.
    ``manifest``: (book, source_file, license_status, bibliography).
    """
    chunkable = pages.where(F.col("status").isin("complete", "native_text_fallback"))
    packed = describe(pack_chunks(segment(chunkable), target, most, overlap), most)
    full = address(attach_pages(packed, pages)).join(manifest, "book")
    citation = books.pdf_citation(books.book_label(), F.col("page_start"), F.col("page_end"), F.col("printed_page_start"), F.col("printed_page_end"))
    return full.select(
        F.lit(5).alias("schema_version"), "chunk_id", "chunk_index", F.col("book").alias("book_id"), "source_file", F.col("bibliography.title").alias("book_title"),
        "bibliography.title_source", "bibliography.authors", "bibliography.authors_source", "bibliography.edition", "bibliography.publication_year", "bibliography.language",
        "page_start", "page_end", "printed_page_start", "printed_page_end", "section", "outline_section", "markdown_section", "outline_path", citation.alias("citation"), "license_status",
        "included_pages", "fallback_pages", "native_structured_pages", "visual_review_pages", "needs_visual_review", "reason_codes", "has_native_text_fallback", "has_native_structured",
        "source_quality", "structural_block_type", "structural_block_types", "body", "approximate_tokens", "oversized", "oversized_reason", F.lit(overlap).alias("overlap_target_tokens"),
        file_name(F.col("chunk_index")).alias("path"), "content_sha256", F.col("content_sha256").alias("sha256"),
    )


def chunk_markdown(chunks: DataFrame) -> DataFrame:
    """Add ``markdown``, the chunk's file: front matter, citation, body; and ``artifact_sha256``."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    front = F.concat_ws(
        "\n",
        F.lit("---"),
        line("chunk_id", tx.json_quoted(F.col("chunk_id"))),
        line("book_id", tx.json_quoted(F.col("book_id"))),
        line("pages", F.concat(F.lit("["), F.array_join("included_pages", ", "), F.lit("]"))),
        line("section", tx.json_quoted(F.col("section"))),
        line("citation", tx.json_quoted(F.col("citation"))),
        line("source_quality", F.col("source_quality")),
        F.lit("---"),
    )
    text = F.concat(front, F.lit("\n\n> Source: "), F.col("citation"), F.lit("\n\n"), F.col("body"), F.lit("\n"))
    return chunks.withColumn("markdown", text).withColumn("artifact_sha256", F.sha2(text, 256))


def vector_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add the 0-based ``vector_index`` in the global order of ``order``, without one task seeing all rows.

    Rows are range-partitioned and sorted; an index is the place in the partition plus the counts of
    the partitions before, which are one number each.
    """
    from quire.engine import cut, shuffle_width

    ranged = rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    numbered = cut(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return numbered.join(F.broadcast(bases), "_part").withColumn("vector_index", F.col("_base") + F.col("_at")).drop("_part", "_at", "_base")
