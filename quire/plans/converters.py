"""Plug-ins: document decoders and page converters, each built once a task.

A decoder turns a file's bytes into page records; a converter turns a page that isn't rendered
natively into Markdown.  Real ones need libraries or services that may be absent; the stand-ins are
deterministic, so everything around them can be run and tested.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PageInput:
    book_id: str
    page: int
    native_text: str
    image: bytes | None = None
    mime_type: str = "image/jpeg"


@dataclass(frozen=True)
class PageResult:
    markdown: str
    backend: str
    model: str
    usage: dict = field(default_factory=dict)


class ConversionError(Exception):
    """A page that couldn't be converted; ``reason`` as the service names it."""

    def __init__(self, reason: str, message: str = "") -> None:
        super().__init__(message or reason)
        self.reason = reason


class PageConverter(Protocol):
    def convert_page(self, page: PageInput) -> PageResult: ...

    def close(self) -> None: ...


class DocumentDecoder(Protocol):
    def pages(self, content: bytes) -> Iterator[dict]: ...


class TextConverter:
    """Stand-in for a visual parser: the native text as it is; refuses texts it is told to."""

    def __init__(self, refuse: dict[str, str] | None = None) -> None:
        self.refuse = refuse or {}

    def convert_page(self, page: PageInput) -> PageResult:
        for marker, reason in self.refuse.items():
            if marker in page.native_text:
                raise ConversionError(reason)
        if not page.native_text.strip():
            raise ConversionError("EMPTY_RESPONSE")
        return PageResult(page.native_text.strip(), "stub", "text-converter")

    def close(self) -> None:
        pass


class JsonDecoder:
    """Reads documents whose pages are stored as JSON: {"pages": [{"text": ..., "blocks": ...}, ...]}."""

    def pages(self, content: bytes) -> Iterator[dict]:
        document = json.loads(content)
        if document.get("encrypted"):
            raise ValueError("the document is protected by a password")
        yield from document["pages"]


PAGE = (
    "page int, page_count int, native_text string, width double, height double, printed_page_label string, outline_path array<string>, "
    "blocks string, tables string, images string, extraction_error string"
)


def decode(files: DataFrame, make: Callable[[], DocumentDecoder]) -> DataFrame:
    """One row a page of (book_id, content) files; a file that can't be opened is one row with page 0 and its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder, names = make(), ["book_id", *[c.split()[0] for c in PAGE.split(", ")]]
        for frame in frames:
            rows = []
            for book, content in zip(frame["book_id"], frame["content"], strict=True):
                try:
                    found = list(decoder.pages(bytes(content)))
                except Exception as x:
                    rows.append(dict.fromkeys(names) | {"book_id": book, "page": 0, "page_count": 0, "extraction_error": f"{type(x).__name__}: {x}"})
                    continue
                for number, page in enumerate(found, start=1):
                    rows.append(
                        {
                            "book_id": book, "page": number, "page_count": len(found), "native_text": page.get("text", ""), "width": page.get("width", 600.0), "height": page.get("height", 800.0),
                            "printed_page_label": page.get("label"), "outline_path": page.get("outline_path") or [], "blocks": json.dumps(page.get("blocks") or []),
                            "tables": json.dumps(page.get("tables") or []), "images": json.dumps(page.get("images") or []), "extraction_error": page.get("error"),
                        }
                    )
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return files.select("book_id", "content").mapInPandas(run, f"book_id string, {PAGE}")


OUTCOME = "book_id string, page int, markdown string, status string, conversion_route string, parser_backend string, parser_model string, llm_called boolean, error string"


def convert(pages: DataFrame, make: Callable[[], PageConverter]) -> DataFrame:
    """Outcome of each page: complete, native_text_fallback (refused, but there is native text) or failed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        converter = make()
        try:
            for frame in frames:
                rows = []
                for book, number, text in zip(frame["book_id"], frame["page"], frame["native_text"], strict=True):
                    text = text or ""
                    row = {"book_id": book, "page": number, "llm_called": True, "parser_backend": "stub", "parser_model": None, "error": None}
                    try:
                        result = converter.convert_page(PageInput(book, int(number), text))
                        row |= {"markdown": result.markdown, "status": "complete", "conversion_route": "visual_llm", "parser_backend": result.backend, "parser_model": result.model}
                    except ConversionError as x:
                        if x.reason == "RECITATION" and text.strip():
                            row |= {"markdown": text.strip(), "status": "native_text_fallback", "conversion_route": "native_fallback_after_llm", "error": x.reason}
                        else:
                            row |= {"markdown": "", "status": "failed", "conversion_route": "visual_llm_failed", "error": x.reason}
                    except Exception as x:
                        row |= {"markdown": "", "status": "failed", "conversion_route": "visual_llm_failed", "error": f"{type(x).__name__}: {x}"}
                    rows.append(row)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTCOME.split(", ")])
        finally:
            converter.close()

    return pages.select("book_id", "page", "native_text").mapInPandas(run, OUTCOME)


def native_outcome(pages: DataFrame) -> DataFrame:
    """Outcome of pages that the router lets render natively."""
    return pages.select(
        "book_id", "page", F.col("rendered.markdown").alias("markdown"), F.lit("complete").alias("status"), F.lit("native_structured").alias("conversion_route"),
        F.lit("native").alias("parser_backend"), F.lit(None).cast("string").alias("parser_model"), F.lit(False).alias("llm_called"), F.lit(None).cast("string").alias("error"),
    )
