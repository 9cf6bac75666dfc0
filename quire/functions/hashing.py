"""Identifiers: canonical JSON and content addresses, computed in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; strings keep non-ASCII characters, escapes are in lower case.  Fields must not be null."""
    json = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    lower = json
    for code in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)):  # the control characters whose escape has a letter
        lower = F.regexp_replace(lower, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
    return F.when(F.regexp(json, F.lit(r"\\u00[01][A-F]")), lower).otherwise(json)


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def chunk_content_sha256(book_id: Column, page_start: Column, page_end: Column, section: Column, body: Column) -> Column:
    """Address of a chunk's content: independent of its index and of the bibliography."""
    return sha256_text(
        canonical_json(
            schema=F.lit("rag-chunk-content-v1"), book_id=book_id, page_start=page_start, page_end=page_end, section=F.coalesce(section, F.lit("")), body=body
        )
    )


def chunk_id(book_id: Column, content_sha256: Column) -> Column:
    return F.concat(book_id, F.lit("-sha256-"), content_sha256)


def book_id(slug: Column, source_sha256: Column) -> Column:
    return F.concat(slug, F.lit("-"), F.substring(source_sha256, 1, 10))


def cache_key(model: str, dimensions: int, task_type: str, input_sha256: Column) -> Column:
    """Key of a cached embedding: the exact input under one model configuration."""
    return sha256_text(canonical_json(model=F.lit(model), dimensions=F.lit(dimensions), task_type=F.lit(task_type), content_sha256=input_sha256))
