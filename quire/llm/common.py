"""Helpers shared by the training-data operators.

Conventions that hold for every operator of this subpackage, unless its docstring says otherwise:

* a null text counts as the empty text; a null id is an ordinary value that groups with other nulls;
* every input row is one document and yields one result row, repeated rows included;
* results come back as one struct column named by ``out`` beside the unchanged input columns, so
  extra columns with any names survive (an input column called ``out`` itself is replaced);
* an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space and letters, as trim and translate arguments.
BLANK = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows an Arrow batch may hold; documents are long, so far fewer than Spark's 10,000.
BATCH_ROWS = 256

#: What a Python worker keeps from task to task, by operator; another operator's pass lets go of it.
CACHES: dict[str, dict] = {}


def cached(owner: str, key: str, make: Callable[[], object]) -> object:
    """``make()``, once in a worker for as long as it works for ``owner``."""
    mine = CACHES.setdefault(owner, {})
    if key not in mine:
        mine[key] = make()
    return mine[key]


def drop_caches(but: str) -> None:
    for owner in [o for o in CACHES if o != but]:
        del CACHES[owner]


def small_batches(spark: SparkSession) -> None:
    """Bound what one Python worker holds at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def arrow_map(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: T.StructType | str, at_once: int = BATCH_ROWS, owner: str = "") -> DataFrame:
    """``mapInArrow`` over column dictionaries: ``rows`` gets and yields {column: list or array}.

    ``at_once`` bounds the rows that are Python objects at a time; rows with long lists need few.
    ``owner`` names the caches of the worker that this pass goes on using.
    """
    small_batches(df.sparkSession)
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.common import drop_caches  # the worker's own module

        drop_caches(owner)

        def columns() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, at_once):
                    part = batch.slice(at, at_once)
                    yield {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}

        for out in rows(columns()):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def packed(docs: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """The input rows as (row, id, text): ``row`` holds the columns to hand back."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return docs.select(F.struct(*keep).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def unpacked(df: DataFrame, result: Column, out: str) -> DataFrame:
    return df.select("row.*", result.alias(out))


def split_hot(rows: DataFrame, lookup: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner", shares: int = 2000) -> DataFrame:
    """Join of ``rows`` with a ``lookup`` that is unique by ``keys``, safe for hot keys; inner or left.

    ``lookup[weight]`` is at most the number of ``rows`` with that key, and the weights sum to at
    most ``total``; so fewer than ``shares`` keys can weigh more than ``total / shares``.  Those
    keys, and only those, are broadcast; no key of the shuffled rest exceeds its share.
    """
    line = F.col(weight) * shares > F.lit(total)
    hot, cold = F.broadcast(lookup.where(line)), lookup.where(~line)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))
