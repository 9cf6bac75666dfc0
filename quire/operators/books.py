"""Books: bibliography, citations, licences, identity and sidecars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx

#: Licence states that may be packed (fixed values).
PACKABLE = ["licensed", "authorized", "owned", "public_domain", "public-domain"]
PLACEHOLDERS = ["untitled", "unknown", "document", "none", "null"]

BIBLIOGRAPHY = "title string, title_source string, authors array<string>, authors_source string, edition string, publication_year string, language string"


def valid_pdf_text(text: Column, title: bool = False) -> Column:
    """Embedded metadata worth showing: no placeholder, no word processor's name in front."""
    trimmed = tx.blank_to_null(text)
    folded = F.btrim(F.lower(trimmed), F.lit(" ._-"))
    bad = folded.isin(PLACEHOLDERS)
    if title:
        bad |= folded.rlike(rf"\A(microsoft word|libreoffice writer)[{tx.WS}]*[-:]")
    return F.when(~bad, trimmed)


def clean_authors(authors: Column) -> Column:
    """Trimmed, without empty and repeated names, in order; null if none is left."""
    found = F.array_distinct(F.array_compact(F.transform(authors, tx.blank_to_null)))
    return F.when(F.size(found) > 0, found)


def file_stem(path: Column) -> Column:
    name = F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)
    return F.when(name.rlike(r".\.[^.]*\z"), F.regexp_replace(name, r"\.[^.]*\z", "")).otherwise(name)


def resolve_bibliography(books: DataFrame) -> DataFrame:
    """Add ``bibliography`` from sidecar, earlier result, embedded metadata and file name.

    Reads source_file; license: struct(title, author, authors, edition, publication_year, year,
    language, bibliography: struct of the same); existing: struct as ``BIBLIOGRAPHY``; pdf_metadata:
    struct(title, author).  A value of an earlier run is kept if it came from a source of the same rank.
    """
    nested, flat, was, pdf = "license.bibliography", "license", "existing", "pdf_metadata"
    text = lambda path: tx.blank_to_null(F.col(path).cast("string"))
    titles = [
        (F.coalesce(text(f"{nested}.title"), text(f"{flat}.title")), "license_sidecar"),
        (F.when(F.col(f"{was}.title_source") == "license_sidecar", text(f"{was}.title")), "license_sidecar"),
        (valid_pdf_text(F.col(f"{pdf}.title"), title=True), "pdf_metadata"),
        (F.when(F.col(f"{was}.title_source") == "pdf_metadata", text(f"{was}.title")), "pdf_metadata"),
        (file_stem(F.col("source_file")), "filename"),
    ]
    one = lambda path: F.when(F.col(path).isNotNull(), F.array(F.col(path)))
    authors = [
        (F.coalesce(*[clean_authors(c) for c in (F.col(f"{nested}.authors"), one(f"{nested}.author"), F.col(f"{flat}.authors"), one(f"{flat}.author"))]), "license_sidecar"),
        (F.when(F.col(f"{was}.authors_source") == "license_sidecar", clean_authors(F.col(f"{was}.authors"))), "license_sidecar"),
        (clean_authors(F.array(valid_pdf_text(F.col(f"{pdf}.author")))), "pdf_metadata"),
        (F.when(F.col(f"{was}.authors_source") == "pdf_metadata", clean_authors(F.col(f"{was}.authors"))), "pdf_metadata"),
    ]
    first = lambda ranked: F.coalesce(*[c for c, _ in ranked])
    source = lambda ranked: F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for c, name in ranked])
    rest = {
        "edition": [f"{nested}.edition", f"{flat}.edition", f"{was}.edition"],
        "publication_year": [f"{nested}.publication_year", f"{nested}.year", f"{flat}.publication_year", f"{flat}.year", f"{was}.publication_year"],
        "language": [f"{nested}.language", f"{flat}.language", f"{was}.language"],
    }
    return books.withColumn(
        "bibliography",
        F.struct(
            first(titles).alias("title"),
            source(titles).alias("title_source"),
            F.coalesce(first(authors), F.array().cast("array<string>")).alias("authors"),
            source(authors).alias("authors_source"),
            *[F.coalesce(*map(text, paths)).alias(name) for name, paths in rest.items()],
        ),
    )


def book_label(bib: str = "bibliography") -> Column:
    """Authors, title, edition and year, what there is of them."""
    edition = tx.blank_to_null(F.col(f"{bib}.edition"))
    lower = F.lower(edition)
    edition = F.when(lower.contains("edition") | lower.contains("ed."), edition).otherwise(F.concat(edition, F.lit(" ed.")))
    authors = F.when(F.size(f"{bib}.authors") > 0, F.array_join(f"{bib}.authors", ", "))
    return F.concat_ws(", ", authors, F.col(f"{bib}.title"), edition, tx.blank_to_null(F.col(f"{bib}.publication_year")))


def pdf_citation(label: Column, first: Column, last: Column, printed_first: Column, printed_last: Column) -> Column:
    """'<label>, PDF p. N' or 'PDF pp. A-B', with printed page labels that add something."""
    a, b = tx.blank_to_null(printed_first), tx.blank_to_null(printed_last)
    last = F.coalesce(last, first)
    single = first == last
    pages = F.when(single, F.concat(F.lit("PDF p. "), first)).otherwise(F.concat(F.lit("PDF pp. "), first, F.lit("-"), last))
    one = F.concat(F.lit(" (printed p. "), a, F.lit(")"))
    span = F.concat(F.lit(" (printed pp. "), a, F.lit("-"), b, F.lit(")"))
    printed = F.when(a.isNull() | (single & (a == first.cast("string"))), "").when(single | b.isNull() | (a == b), one).otherwise(span)
    return F.concat(label, F.lit(", "), pages, printed)


def normalize_license(status: Column) -> Column:
    """Absent and ``unspecified`` become ``authorized``; an empty status stays empty, which is an error."""
    trimmed = tx.strip(status)
    return F.when(status.isNull() | (trimmed == "unspecified"), "authorized").otherwise(trimmed)


def packable(status: Column, include_unspecified: bool = False) -> Column:
    return F.coalesce(status.isin([*PACKABLE, *["unspecified"] * include_unspecified]), F.lit(False))


def find_existing(books: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add ``book_id`` of an earlier manifest with the same source hash: the shortest, then the least."""
    known = manifests.groupBy("source_sha256").agg(F.min_by("book_id", F.struct(F.length("book_id"), "book_id")).alias("existing_book_id"))
    return books.join(known, "source_sha256", "left")


def attach_sidecars(pdfs: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Add the content of ``X.license.json`` or else ``X.pdf.license.json``, by path."""
    stem = F.regexp_replace("path", r"\.[^./]*\z", "")
    first, second = (sidecars.select(F.col("path").alias(f"p{k}"), F.regexp_replace("content", r"\A\x{feff}", "").alias(f"c{k}")) for k in (1, 2))
    joined = pdfs.join(first, F.concat(stem, F.lit(".license.json")) == F.col("p1"), "left").join(second, F.concat(F.col("path"), F.lit(".license.json")) == F.col("p2"), "left")
    return joined.select(*pdfs.columns, F.coalesce("c1", "c2").alias("license_json"))


def locate_sources(books: DataFrame, files: DataFrame, folders: list[str]) -> DataFrame:
    """Add ``located``: the manifest's own path if it exists, else the first folder that has the file."""
    known = files.select("path").distinct()
    out = books
    tries = [F.col("source_path"), *[F.concat(F.lit(f"{f.rstrip('/')}/"), F.col("source_file")) for f in folders]]
    for k, path in enumerate(tries):
        out = out.join(known.withColumnRenamed("path", f"_p{k}"), path == F.col(f"_p{k}"), "left")
    names = [f"_p{k}" for k in range(len(tries))]
    return out.withColumn("located", F.coalesce(*names)).drop(*names)
