"""Best-fit packing (operator 8): vector best-fit of token pieces into sequences.

A sequence has three capacities: tokens, documents (pieces) and attention cost (the sum of squared
piece lengths).  Pieces are placed by decreasing length; among the open sequences that can take a
piece under *every* constraint the best is chosen by the least weighted dot product of demand and
residual (the fullest along what the piece asks for), or by the least weighted norm of the residual
left over; the rule that needs fewer sequences wins.

Pieces of one length are alike, so the placement is decided on the histogram of lengths: at most
``capacity`` rows, whatever the corpus holds.  Sequences filled alike form one class with a
multiplicity, so the plan's size doesn't grow with the corpus either.  Each piece then finds its
place from its rank among the pieces of its length: ranks are counted within the tokenising tasks,
and the tasks' counts are summed over, so no task ever gets all pieces of a length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.engine import cut
from quire.llm.common import arrow_map, cached

#: The vocabulary's own split of normalised text (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CACHE_WORDS = 700_000
CACHE_PARTS = 700_000


class WordEncoder:
    """Ids of a ``tokenizers`` file as packed little-endian 32-bit integers, cached by word.

    A space or a line feed ends a pre-token in this vocabulary, white space yields no token, and
    normalisation never looks across white space; so a text's ids are those of its words in turn.
    Words of Latin-1 letters are lower-cased and split into pre-tokens here (normalisation does no
    more to them), so that "word", "Word" and "word," share one entry, and the library encodes all
    new pre-tokens as one text: each ends with the one token that carries the end-of-word mark.
    Any other word goes to the library as it stands.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same model for pre-tokens that are normalised and split already.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = Sequence([Split(" ", "removed"), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(1 + max(vocabulary.values()), dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.split = regex.compile(PATTERN).findall
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def _each(self, new: list[str]) -> dict[str, bytes]:
        """Words one by one."""
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        return {w: array("I", f.ids).tobytes() for w, f in zip(new, found, strict=True)}

    def _together(self, new: list[str]) -> dict[str, bytes]:
        """Pre-tokens as one text, cut after each end-of-word token."""
        ids = np.array(self.bare.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(ends) != len(new):
            return self._each(new)
        raw, ends = ids.tobytes(), ends.tolist()
        return {w: raw[a:b] for w, a, b in zip(new, [0, *ends[:-1]], ends, strict=True)}

    def _learn(self, new: set[str]) -> None:
        whole, marked, mixed, other = {}, {}, {}, []
        for w in new:
            if not (w.isascii() or max(w) < "\u0100") or "<|" in w:
                other.append(w)
            elif w.isalpha():
                whole[w] = w.lower()
            elif w[-1] in ".,;:!?" and w[:-1].isalpha():
                marked[w] = w[:-1].lower()
            else:
                mixed[w] = self.split(w.lower())
        wanted = {*whole.values(), *marked.values(), *(w[-1] for w in marked)}.union(*mixed.values())
        parts = self.parts
        if fresh := list(wanted - parts.keys()):
            parts |= self._together(fresh)
        words = self.words
        words |= {w: parts[p] for w, p in whole.items()}
        words |= {w: parts[p] + parts[w[-1]] for w, p in marked.items()}
        words |= {w: b"".join(map(parts.__getitem__, p)) for w, p in mixed.items()}
        if other:
            words |= self._each(other)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        if len(self.parts) > CACHE_PARTS:
            self.parts = {}
        found, new, get = [], set(), self.words.get
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            ids = list(map(get, words))
            gaps = [k for k, v in enumerate(ids) if v is None] if None in ids else []
            missing = [words[k] for k in gaps]
            new.update(missing)
            found.append((ids, gaps, missing))
        if new:
            self._learn(new)
        for ids, gaps, missing in found:
            for k, w in zip(gaps, missing, strict=True):
                ids[k] = self.words[w]
        return [b"".join(ids) for ids, _, _ in found]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of ``path``, kept from task to task."""
    return cached("packing", path, lambda: WordEncoder(path))


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str, text_col: str, end_id: int, with_ids: bool) -> DataFrame:
    """Rows (id, piece, start, length, crc, task, ordinal[, ids]): ordinal counts a length within a task."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        own, seen, task = encoder(tokenizer_path), np.zeros(capacity + 1, dtype=np.int64).tolist(), TaskContext.get().partitionId()
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            out = {k: [] for k in ("id", "piece", "start", "length", "crc", "task", "ordinal", "ids")}
            for i, ids in zip(batch["id"], own.encode([t or "" for t in batch["text"]]), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cutout = ids[at : at + 4 * capacity]
                    n = len(cutout) // 4
                    for key, value in zip(out, (i, piece, at // 4, n, zlib.crc32(cutout), task, seen[n], cutout if with_ids else None), strict=True):
                        out[key].append(value)
                    seen[n] += 1
            yield out

    schema = "id long, piece int, start long, length long, crc long, task int, ordinal long" + ", ids binary" * with_ids
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, schema, owner="packing")


class Classes:
    """Open sequences by class: residuals of the three resources, multiplicity and contents."""

    def __init__(self, capacities: tuple[int, int, int]) -> None:
        self.full = np.array(capacities, dtype=np.float64)
        self.left = np.zeros((64, 3))
        self.many = np.zeros(64, dtype=np.int64)
        self.inside: list[list[tuple[int, int]]] = []

    def add(self, left: np.ndarray, many: int, inside: list[tuple[int, int]]) -> int:
        n = len(self.inside)
        if n == len(self.many):
            self.left, self.many = np.vstack([self.left, np.zeros_like(self.left)]), np.concatenate([self.many, np.zeros_like(self.many)])
        self.left[n], self.many[n] = left, many
        self.inside.append(inside)
        return n

    def best(self, demand: np.ndarray, weights: np.ndarray, rule: str) -> int | None:
        n = len(self.inside)
        after = self.left[:n] - demand
        can = (after >= 0).all(axis=1) & (self.many[:n] > 0)
        if not can.any():
            return None
        if rule == "dot":
            score = (weights * (self.left[:n] / self.full) * (demand / self.full)).sum(axis=1)
        else:
            score = (weights * (after / self.full) ** 2).sum(axis=1)
        return int(np.argmin(np.where(can, score, np.inf)))


def place(histogram: dict[int, int], capacities: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> Classes:
    """Best-fit by decreasing length over a histogram {length: pieces}."""
    classes, w = Classes(capacities), np.array(weights)
    for length in sorted(histogram, reverse=True):
        todo, demand = histogram[length], np.array([length, 1, length * length], dtype=np.float64)
        while todo:
            at = classes.best(demand, w, rule)
            left, many, inside = (classes.full.copy(), None, []) if at is None else (classes.left[at].copy(), int(classes.many[at]), classes.inside[at])
            each = int((left // demand).min())
            if each < 1:
                raise ValueError(f"a piece of {length} tokens exceeds a sequence's capacities")
            each = min(each, todo)
            used = todo // each if many is None else min(many, todo // each)
            if at is not None:
                classes.many[at] -= used
            classes.add(left - each * demand, used, [*inside, (length, each)])
            todo -= used * each
    return classes


class Plan:
    """Where the k-th piece of a length goes: runs of ranks, sorted by (length, first rank)."""

    def __init__(self, classes: Classes) -> None:
        used: dict[int, int] = {}
        entries, first = [], 0
        for many, inside in zip(classes.many[: len(classes.inside)].tolist(), classes.inside, strict=True):
            if not many:
                continue
            offset = 0
            for length, each in inside:
                start = used.get(length, 0)
                entries.append((length, start, first, many, offset))
                used[length] = start + many * each
                offset += length * each
            first += many
        self.sequences = first
        table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5)
        self.length, self.start, self.first, self.many, self.offset = table.T.copy()
        self.lengths, self.begins = np.unique(self.length, return_index=True)
        self.ends = np.append(self.begins[1:], len(self.length))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence number and offset of each (length, rank)."""
        which = np.searchsorted(self.lengths, lengths)
        entry = np.empty(len(lengths), dtype=np.int64)
        for k in np.unique(which):
            mine, (a, b) = which == k, (self.begins[k], self.ends[k])
            entry[mine] = a + np.searchsorted(self.start[a:b], ranks[mine], side="right") - 1
        ahead = ranks - self.start[entry]
        return self.first[entry] + ahead % self.many[entry], self.offset[entry] + ahead // self.many[entry] * lengths


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    max_documents: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: id, piece int, start, length, crc, sequence_id, offset long[, ids binary].

    A document is its ids and then ``end_id``, so null and empty texts are one piece of length 1.
    Documents longer than ``capacity`` tokens are cut into pieces of that length, the last may be
    shorter.  ``max_documents`` bounds the pieces of a sequence and ``max_cost`` the sum of their
    squared lengths; unset, they allow whatever ``capacity`` tokens can hold.  ``crc`` is the CRC-32
    of the little-endian ids; ``offset`` is the place in the sequence, gapless from 0.  Repeated
    rows are packed as often as they occur; null ids pass through; other columns are not read; an
    empty table gives no rows.
    """
    capacities = (capacity, max_documents or capacity, max_cost or capacity * capacity)
    pieces = cut(pieces_of(docs, tokenizer_path, capacity, id_col, text_col, end_id, with_ids))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    plan = min((Plan(place(histogram, capacities, weights, rule)) for rule in ("norm", "dot")), key=lambda p: p.sequences)

    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("ordinal")).drop("base", "ordinal", "task")
    names = ["id", "piece", "start", "length", "crc"] + ["ids"] * with_ids

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            lengths, ranks = (np.array(batch[k], dtype=np.int64) for k in ("length", "rank"))
            sequence, offset = plan.find(lengths, ranks)
            yield {k: batch[k] for k in names} | {"sequence_id": sequence, "offset": offset}

    schema = "id long, piece int, start long, length long, crc long, " + "ids binary, " * with_ids + "sequence_id long, offset long"
    return arrow_map(ranked.select(*names, "rank"), rows, schema)
