"""BPE encoding and decoding (operator 7) by speculating and verifying.

For each new word the longest vocabulary entries are taken greedily from left to right.  That
proposal is the BPE encoding exactly if every adjacent pair of tokens is *compatible*: merging the
two tokens' bytes by themselves gives the same two tokens (each proposed token encodes to itself;
entries that don't are left out of the proposal).  All pairs of a batch are tested at once with
numpy, by undoing the merges on both sides of the boundary from the last to the first and looking
for one that would have crossed it earlier.  Only words with a failing pair are merged exactly.

Words are cached in the worker, in a table that is emptied when it is full; what a text costs is
then splitting and looking up.  Splitting at single spaces and line feeds agrees with the
vocabulary's own pattern; texts with any other white space go through that pattern whole.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, cached

#: The byte-level pre-tokeniser's pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 250_000
LONG_WORD = 100
SHORT_WORD = 40


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BpeCodec:
    """Encoder and decoder of one byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        text_id: dict[str, int] = spec["model"]["vocab"]
        size = 1 + max(text_id.values(), default=0)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(size, 1 + max(self.special.values(), default=0))
        self.bytes_of = [b""] * size
        for token, i in text_id.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.id_of = {self.bytes_of[i]: i for i in text_id.values()}
        self.decimal = [str(i) for i in range(size)]
        self.single = [self.id_of[bytes([b])] for b in range(256)]

        # Merges: rank by pair, and for each token the merge that makes it (rank -1: a single byte).
        self.pair_rank: dict[int, int] = {}  # by left * size + right
        self.made, self.left, self.right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.result: list[int] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, both = (text_id[a], text_id[b]), text_id[a + b]
            self.pair_rank[pair[0] * size + pair[1]] = rank
            self.result.append(both)
            if self.made[both] < 0:
                self.made[both], self.left[both], self.right[both] = rank, *pair
        self.size = size
        keys = np.array(list(self.pair_rank), dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array(list(self.pair_rank.values()), dtype=np.int64)[order]

        self.proposable = {b: i for b, i in self.id_of.items() if len(b) == 1 or self.merge(b) == [i]}
        self.reach: dict[bytes, int] = {}
        for entry in self.proposable:
            self.reach[entry[:3]] = max(len(entry), self.reach.get(entry[:3], 0))
        self.split = regex.compile(PATTERN).findall
        self.odd_space = re.compile(r"[ \n][ \n]|[^\S \n]|[\x1c-\x1f]|\A[ \n]|[ \n]\Z").search
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, tuple[int, ...]] = {}  # pre-tokens
        self.units: dict[str, tuple[int, ...]] = {}  # text between spaces; keys without the leading space

    def merge(self, word: bytes) -> list[int]:
        """The exact encoding: merge the lowest-ranked pair, leftmost first, until none is left."""
        ids = [self.single[b] for b in word]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        size, rank_of, result = self.size, self.pair_rank.get, self.result
        none = len(result)
        ranks = [rank_of(a * size + b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            ids[i] = result[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] * size + ids[i], none)
            if i < len(ranks):
                ranks[i] = rank_of(ids[i] * size + ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for words of any length."""
        n, size, rank_of = len(ids), self.size, self.pair_rank.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.result[rank], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of(ids[i] * size + ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] * size + ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match; ``reach`` tells how long entries with the next three bytes get."""
        out, at, n, find, reach = [], 0, len(word), self.proposable.get, self.reach.get
        while at < n:
            end = at + reach(word[at : at + 3], 2)
            if end > n:
                end = n
            while (i := find(word[at:end])) is None:
                end -= 1
            out.append(i)
            at = end
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens that encode to themselves: does their concatenation stay the pair?"""
        ok = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        limit = np.full(len(a), 1 << 40, dtype=np.int64)
        while len(live):
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            crossed = (self.keys[at] == key) & (self.ranks[at] < limit) if len(self.keys) else np.zeros(len(key), bool)
            ok[live[crossed]] = False
            made_a, made_b = self.made[a], self.made[b]
            go = ~crossed & ((made_a >= 0) | (made_b >= 0))
            undo_left = made_a > made_b  # equal ranks: the left merge came first, so the right is undone first
            limit = np.where(undo_left, made_a, made_b + 1)[go]
            a, b = np.where(undo_left, self.right[a], a)[go], np.where(undo_left, b, self.left[b])[go]
            live = live[go]
        return ok

    def learn_words(self, new: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Encode distinct pre-tokens."""
        names = list(new)
        raw = [w.encode("utf-8", "surrogatepass") for w in names]
        proposals = [self.propose(w) for w in raw]
        flat = np.fromiter(chain.from_iterable(proposals), dtype=np.int64)
        sizes = np.fromiter(map(len, proposals), dtype=np.int64, count=len(proposals))
        ends = np.cumsum(sizes)
        inner = np.ones(len(flat), dtype=bool)  # positions whose next token is in the same word
        inner[ends[sizes > 0] - 1] = False
        at = np.flatnonzero(inner)
        pairs, back = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        bad = at[~self.compatible(pairs // self.size, pairs % self.size)[back]]
        for k in np.unique(np.searchsorted(ends, bad, side="right")).tolist():
            proposals[k] = self.merge(raw[k])
        return dict(zip(names, map(tuple, proposals), strict=True))

    def _units(self, text: str) -> tuple[str, list[str]] | None:
        """The first unit and the rest, or None if the text must go through the pattern whole."""
        if not text or self.odd_space(text) or (self.at_special and self.at_special.search(text)):
            return None
        first, *rest = text.replace("\n", " \n").split(" ")
        return first, rest

    def encode(self, texts: list[str]) -> list[list[int]]:
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and scanning the caches over and over is slow
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.units) > CACHE_WORDS:
            self.units = {}
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        plans, new, get = [], set(), self.units.get
        pre: set[str] = set()  # pre-tokens of first units and of texts with odd white space
        for text in texts:
            if (cut := self._units(text)) is None:
                pieces = self.at_special.split(text) if self.at_special else [text]
                head = [p if p in self.special else self.split(p) for p in pieces]
                found, gaps, missing = [], [], []
            else:
                head, units = [self.split(cut[0])], cut[1]
                found = list(map(get, units))
                gaps = [k for k, v in enumerate(found) if v is None] if None in found else []
                missing = [units[k] for k in gaps]
                new.update(missing)
            pre.update(*(p for p in head if not isinstance(p, str)))
            plans.append((head, found, gaps, missing))

        single, several = {}, {}
        for u in new:  # most units are letters alone, or letters and one mark
            if u.isalpha():
                single[u] = " " + u
            elif u[-1] in ".,;:!?" and u[:-1].isalpha():
                several[u] = (" " + u[:-1], u[-1])
            else:
                several[u] = self.split(u if u[0] == "\n" else " " + u)
        pre.update(single.values(), *several.values())
        self.words |= self.learn_words(pre - self.words.keys())
        word, units = self.words.__getitem__, self.units
        units |= {u: word(p) for u, p in single.items()}
        units |= {u: tuple(chain.from_iterable(map(word, p))) for u, p in several.items()}

        out = []
        for head, found, gaps, missing in plans:
            ids: list[int] = []
            for p in head:
                ids += [self.special[p]] if isinstance(p, str) else chain.from_iterable(map(word, p))
            for k, u in zip(gaps, missing, strict=True):
                found[k] = units[u]
            ids += chain.from_iterable(found)
            out.append(ids)
        for cache, keys in ((self.words, pre), (units, new)):  # very long ones aren't kept
            for key in [w for w in keys if len(w) > LONG_WORD]:
                cache.pop(key, None)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> BpeCodec:
    """The worker's codec of ``path``, kept from task to task."""
    return cached("bpe", path, lambda: BpeCodec(path))


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>) in the input's multiplicity; null and empty texts have no ids."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"id": batch["id"], "ids": codec(path).encode([t or "" for t in batch["text"]])}

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, "id long, ids array<int>", owner="bpe")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """Rows (id, text) from rows (id, ids); null ids arrays give the empty text."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"id": batch["id"], "text": [codec(path).decode(ids or ()) for ids in batch["ids"]]}

    return arrow_map(tokens.select("id", "ids"), rows, "id long, text string", owner="bpe")


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: rows (id, n_tokens long, ids_sha256, decoded_sha256).

    ``ids_sha256`` is the digest of the decimal ids joined by commas, ``decoded_sha256`` that of the
    decoded text in UTF-8.  Nothing but digests leaves the worker, so no ids cross to the JVM.  Null
    and empty texts encode to nothing; repeated rows give repeated results; an empty table none.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        own = codec(path)
        digest = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            found = own.encode([t or "" for t in batch["text"]])
            yield {
                "id": batch["id"],
                "n_tokens": list(map(len, found)),
                "ids_sha256": [digest(",".join(map(own.decimal.__getitem__, ids))) for ids in found],
                "decoded_sha256": [digest(own.decode(ids)) for ids in found],
            }

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, schema, owner="bpe")
