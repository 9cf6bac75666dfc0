"""Retrieval: search terms, postings, BM25, embedding inputs and the embedding cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.engine import cut
from quire.functions import hashing, plain
from quire.functions import text as tx

#: BM25 constants and column weights (fixed values).
K1, B = 1.2, 0.75
BODY_WEIGHT, SECTION_WEIGHT = 10.0, 3.0


@F.pandas_udf(T.ArrayType(T.StringType()))
def search_terms(raw: pd.Series) -> pd.Series:
    """Content terms of a question, eight at most."""
    return raw.map(lambda t: plain.search_terms(t or ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def index_terms(text: pd.Series) -> pd.Series:
    """Folded tokens of an indexed text."""
    return text.map(lambda t: plain.index_terms(t or ""))


def match_query(terms: Column) -> Column:
    """Terms quoted and joined by OR; null without terms."""
    quoted = F.transform(terms, lambda t: F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"')))
    return F.when(F.size(terms) > 0, F.array_join(quoted, " OR "))


def postings(chunks: DataFrame, key: str, body: str, section: str | None = None, folded: bool = True) -> DataFrame:
    """Inverted index: (key, term, tf_body, tf_section, length).

    ``folded`` uses the full folding (a UDF); otherwise the JVM's lower-case tokens, which agree on
    texts without composed letters.
    """
    terms = index_terms if folded else (lambda c: tx.lookup_terms(F.col(c)))
    parts = [chunks.select(key, F.explode_outer(terms(body)).alias("term"), F.lit(1).alias("in_body"))]
    if section:
        parts.append(chunks.select(key, F.explode_outer(terms(section)).alias("term"), F.lit(0).alias("in_body")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.where("term IS NOT NULL").groupBy(key, "term").agg(F.sum("in_body").alias("tf_body"), F.sum(1 - F.col("in_body")).alias("tf_section"))


def lengths(index: DataFrame, key: str) -> DataFrame:
    """(key, dl): tokens of both columns."""
    return index.groupBy(key).agg(F.sum(F.col("tf_body") + F.col("tf_section")).alias("dl"))


def scan_terms(chunks: DataFrame, key: str, body: str, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings of the asked ``terms`` with lengths, lengths of all texts) from the texts, when no index is stored.

    Lengths are array sizes and only asked terms are grouped, so nothing but matches is shuffled.
    The asked terms are a user's questions: few enough to broadcast, which is checked.
    """
    asked = terms.select("term").distinct()
    if asked.limit(100_001).count() > 100_000:
        raise ValueError("more than 100,000 terms: ask in blocks")
    split = chunks.select(key, tx.lookup_terms(F.col(body)).alias("all_terms"))
    # explode_outer: plain explode makes Spark split every text a second time in a filter
    found = split.select(key, F.size("all_terms").cast("long").alias("dl"), F.explode_outer("all_terms").alias("term")).join(F.broadcast(asked), "term", "left_semi")
    index = found.groupBy(key, "dl", "term").agg(F.count(F.lit(1)).alias("tf_body"), F.lit(0).cast("long").alias("tf_section"))
    return cut(index), split.select(key, F.size("all_terms").cast("long").alias("dl"))


def bm25(index: DataFrame, documents: DataFrame, queries: DataFrame, key: str, totals: DataFrame | None = None) -> DataFrame:
    """Scores (query, key, score), smaller is better: the weighted BM25 of the common full-text engines.

    ``queries`` has (query, term) with distinct terms.  Only the queries' terms of the index are
    joined.  ``documents`` is one row a document, for the count.  Lengths are the index's column
    ``dl`` if it has one, with ``totals`` (key, dl) of all documents for the average; otherwise both
    come from the index.
    """
    totals = lengths(index, key) if totals is None else totals
    if "dl" not in index.columns:
        index = index.join(totals, key)
    n_docs, all_tokens = documents.count(), totals.agg(F.sum("dl")).head()[0] or 0
    terms = queries.select("term").distinct()
    asked = index.join(F.broadcast(terms) if terms.limit(10_001).count() <= 10_000 else terms, "term", "left_semi")
    df = asked.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    idf = F.ln((F.lit(float(n_docs)) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    f = BODY_WEIGHT * F.col("tf_body") + SECTION_WEIGHT * F.col("tf_section")
    average = all_tokens / max(1, n_docs) or 1.0
    weight = F.when(idf > 0, idf).otherwise(F.lit(1e-6)) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("dl") / average))
    scored = asked.join(df, "term").join(queries, "term").select("query", key, weight.alias("w"))
    return scored.groupBy("query", key).agg((-F.sum("w")).alias("score"))


def top_k(scores: DataFrame, k: int, key: str) -> DataFrame:
    """The k best of each query, ties by key: adds ``rank``.  Ranks within salted parts first, so that a
    query that matches nearly everything isn't sorted in one task."""
    from pyspark.sql.window import Window

    part = F.pmod(F.hash(key), F.lit(64))
    first = Window.partitionBy("query", "part").orderBy("score", key)
    best = scores.withColumn("part", part).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("part", "rank")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("score", key))).where(F.col("rank") <= k)


def embedding_text(title: Column, authors: Column, edition: Column, year: Column, language: Column, section: Column, body: Column) -> Column:
    """What is embedded for a chunk: labelled lines, a blank line, the body."""
    some = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))
    people = F.array_join(F.filter(authors, lambda a: tx.strip(a) != ""), ", ")
    head = F.concat_ws("\n", F.concat(F.lit("Book: "), title), some("Authors", people), some("Edition", edition), some("Publication year", year), some("Language", language), F.concat(F.lit("Section: "), F.coalesce(section, F.lit(""))))
    return tx.strip(F.concat(head, F.lit("\n\n"), body))


def embedding_inputs(chunks: DataFrame) -> DataFrame:
    """(chunk_id, text, embedding_input_sha256) of chunk records."""
    text = embedding_text(*[F.col(c) for c in ("book_title", "authors", "edition", "publication_year", "language", "section", "body")])
    return chunks.select("chunk_id", text.alias("text")).withColumn("embedding_input_sha256", F.sha2("text", 256))


class FakeEmbedder:
    """Deterministic unit vectors from the text's hash: for tests and dry runs, without meaning."""

    model, task_type, semantic_vectors = "deterministic-fake", "RETRIEVAL_DOCUMENT", False

    def __init__(self, dimensions: int = 768) -> None:
        self.dimensions = dimensions

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [plain.fake_embedding(t, self.dimensions) for t in texts]

    def close(self) -> None:
        pass


def embed(inputs: DataFrame, make: Callable[[], FakeEmbedder], batch: int = 32) -> DataFrame:
    """Add ``embedding`` array<float> to (cache_key, text): an embedder for each task, batches of ``batch``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = make()
        try:
            for frame in frames:
                found: list[list[float]] = []
                for at in range(0, len(frame), batch):
                    texts = frame["text"].iloc[at : at + batch].tolist()
                    vectors = embedder.embed(texts)
                    if len(vectors) != len(texts) or any(len(v) != embedder.dimensions for v in vectors):
                        raise ValueError("the embedder returned a wrong number of vectors or dimensions")
                    found += vectors
                yield pd.DataFrame({"cache_key": frame["cache_key"], "embedding": found})
        finally:
            embedder.close()

    return inputs.select("cache_key", "text").mapInPandas(run, "cache_key string, embedding array<float>")


def with_cache(inputs: DataFrame, cache: DataFrame, make: Callable[[], FakeEmbedder]) -> tuple[DataFrame, DataFrame]:
    """(vectors of all inputs, new cache rows).

    Hits need a vector of the right length.  Misses are embedded once for each distinct input,
    however many chunks share it.
    """
    embedder = make()
    keyed = inputs.withColumn("cache_key", hashing.cache_key(embedder.model, embedder.dimensions, embedder.task_type, F.col("embedding_input_sha256")))
    good = cache.where(F.size("embedding") == embedder.dimensions).select("cache_key", "embedding").dropDuplicates(["cache_key"])
    new = embed(keyed.join(good, "cache_key", "left_anti").dropDuplicates(["cache_key"]), make)
    known = good.unionByName(new)
    return keyed.join(known, "cache_key").select("chunk_id", "cache_key", "embedding_input_sha256", "embedding"), new


def cosine_top_k(vectors: DataFrame, queries: DataFrame, key: str, k: int) -> DataFrame:
    """(query, key, score, rank) of the nearest unit vectors; an extension of the lexical search.

    ``queries`` has (query, q) and is broadcast, so it is checked to be at most 1,000 rows.
    """
    if queries.limit(1001).count() > 1000:
        raise ValueError("more than 1,000 query vectors: ask in blocks")
    dot = F.aggregate(F.zip_with("embedding", "q", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    scores = vectors.crossJoin(F.broadcast(queries)).select("query", key, (-dot).alias("score"))  # stated queries against all rows
    return top_k(scores, k, key).withColumn("score", -F.col("score"))
