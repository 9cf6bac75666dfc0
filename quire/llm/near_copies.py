"""Near copies by Jaccard similarity, with ``simhash`` (operator 5) as a pipeline stage.

Every distinct text is a node.  Multi-index hashing of the 64-bit fingerprints proposes the closest
pairs; but a similarity of 0.8 of five-word shingles is further apart than a few of 64 bits, so a
prefix join proposes the rest, exactly: in any one order of all shingles, two sets of similarity
``least`` share one of their first ``n - ceil(least * n) + 1``.  Each text is posted at those, and a
list makes pairs.  How many of their first shingles a pair shares bounds what it can share in all;
the few pairs that this leaves, and the fingerprints' pairs, are compared on their whole shingle
sets.  Nothing is sampled or estimated: the links are those that a comparison of all pairs finds.

The order is by hash at first.  Shingles whose list is longer than ``bucket`` (a passage that many
texts share) then go to the end of the order, by a bit array of bounded size, and only the texts
that held one are posted anew.  What still is crowded are texts made of common shingles almost
entirely: large families of edited copies.  There only links between texts that aren't connected yet
matter: members ask one leader a round for a link to their list's largest group while that halves
them, and the others are compared block by block inside tasks, which give a forest of links back.
That last step is the square of a family's unconnected part in comparisons, never in rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.engine import broadcast_if_small, cut, delete_path, release, stored
from quire.llm.common import BATCH_ROWS, arrow_map, split_hot
from quire.llm.components import components
from quire.llm.simhash import FOLD, fingerprint_links, simhash

#: Bits of a ``KeyFilter``: sixteen a key, up to 16 MB.  More keys make it less selective, not wrong.
FILTER_BITS = (1 << 16, 1 << 27)
#: Members of a block when crowded texts are compared, and shingles of a block product.
BLOCK, COLUMNS = 512, 4096


def _shingles(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word runs, ascending; a shorter text is one run."""
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, size)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], size) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(starts)))


def _signed(value: int) -> int:
    return (value ^ (1 << 63)) - (1 << 63)


def text_key(words: list[bytes]) -> int:
    """The node of a text: texts of the same words are one."""
    return _signed(xxhash.xxh64_intdigest(b" ".join(words)))


def prefix_length(size: int, least: float) -> int:
    """Of how many first shingles a set of ``size`` shares one with every set of similarity ``least``."""
    return size - math.ceil(least * size - 1e-9) + 1


class KeyFilter:
    """A set of keys as bits; a key that shares its bit with a member counts as a member."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, keys: DataFrame, count: int) -> KeyFilter:
        """From rows (key long); what comes to the driver is the bit array, at most."""
        size = min(max(FILTER_BITS[0], 1 << (16 * count).bit_length()), FILTER_BITS[1])
        code = f"key & {size - 1}L"
        words = keys.groupBy(F.expr(f"shiftright({code}, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(key & 63L AS int)))").alias("bits")).toArrow()
        out = np.zeros(size // 64, dtype=np.int64)
        out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        return cls(out.view(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        code = keys.view(np.uint64) & self.mask
        return (self.bits[(code >> np.uint64(3)).astype(np.int64)] >> (code & np.uint64(7)).astype(np.uint8)) & 1 == 1


def ordered_prefix(keys: np.ndarray, common: KeyFilter, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(first shingles in the order that has common ones last, those of them that the plain order doesn't post)."""
    late = common.has(keys)
    first = np.concatenate([keys[~late], keys[late]])[: prefix_length(len(keys), least)]
    return first, first[common.has(first) | ~np.isin(first, keys[: len(first)])]


def _lists(bucket: int, least: float, members: bool):
    """Pass over postings (key, n, size) sorted by key.

    Lists of up to ``bucket`` give pairs (a, b, shared, wanted), longer ones their key or, with
    ``members``, rows (key, a) of all their texts.  ``wanted`` is how many shared first shingles a
    pair of similarity ``least`` has at the least.
    """
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("wanted", pa.int32())])

    def long_list(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        rows = len(key) if members else 1
        return pa.RecordBatch.from_arrays([pa.array(key[:rows]), pa.array(n[:rows])] + [pa.nulls(rows, f.type) for f in list(schema)[2:]], schema=schema)

    def pairs(t: dict) -> pa.RecordBatch | None:
        found = []
        for d in range(1, bucket):
            at = np.flatnonzero(t["key"][:-d] == t["key"][d:])
            if not len(at):
                break
            (x, s), (y, r) = ((t["n"][i], t["size"][i].astype(np.int64)) for i in (at, at + d))
            fits = np.minimum(s, r) >= least * np.maximum(s, r) - 1e-9
            x, y, s, r = x[fits], y[fits], s[fits], r[fits]
            rest = np.ceil(least * np.maximum(s, r) - 1e-9) - 1  # shingles behind the prefix of the larger set
            wanted = np.ceil(least / (1 + least) * (s + r) - 1e-9) - rest
            found.append(np.stack([np.maximum(x, y), np.minimum(x, y), np.maximum(wanted, 1).astype(np.int64)]))
        if not found:
            return None
        (a, b, wanted), shared = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.array(shared.astype(np.int32)), pa.array(wanted.astype(np.int32))], schema=schema)

    def split(t: dict) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, t["key"][1:] != t["key"][:-1]])
        length = np.repeat(lengths := np.diff(np.r_[starts, len(t["key"])]), lengths)
        for at in starts[lengths > bucket]:
            here = t["key"] == t["key"][at]
            yield long_list(t["key"][here], t["n"][here])
        some = (length > 1) & (length <= bucket)
        if some.any() and (out := pairs({c: v[some] for c, v in t.items()})) is not None:
            yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, passed = None, None  # the last list so far, and the key of a long one whose members go straight through
        for batch in batches:
            t = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(("key", "n", "size"))}
            if left is not None:
                t = {c: np.concatenate([left[c], t[c]]) for c in t}
            if passed is not None and (more := t["key"] == passed).any():
                if members:
                    yield long_list(t["key"][more], t["n"][more])
                t = {c: v[~more] for c, v in t.items()}
            left = None
            if not len(t["key"]):
                continue
            last = t["key"] == t["key"][-1]
            if last.sum() > bucket:
                passed = t["key"][-1]
                yield long_list(t["key"][last], t["n"][last])
            else:
                left = {c: v[last] for c, v in t.items()}
            if not last.all():
                yield from split({c: v[~last] for c, v in t.items()})
        if left is not None:
            yield from split(left)

    return run


def _met(postings: DataFrame, bucket: int, least: float, members: bool) -> DataFrame:
    spark = postings.sparkSession
    ordered = postings.repartition("key").sortWithinPartitions("key")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")  # short rows
    met = cut(ordered.mapInArrow(_lists(bucket, least, members), "key long, a long, b long, shared int, wanted int"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    release(spark)
    return met


def _words(texts: list) -> list[list[bytes]]:
    return [(t or b"").translate(FOLD).split() for t in texts]


def _texts_of(docs: DataFrame, need: DataFrame) -> DataFrame:
    """Rows (id, text) of the nodes (n, rep); a repeated id may bring other texts along."""
    ids = broadcast_if_small(need.select("rep").distinct(), 500_000)
    return docs.join(ids, docs["id"].eqNullSafe(ids["rep"]), "left_semi")


def _shingle_sets(docs: DataFrame, need: DataFrame) -> DataFrame:
    """Whole shingle sets (n, shingles) of the needed nodes (n, rep) from rows (id, text)."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            words = _words(batch["text"])
            yield {"n": list(map(text_key, words)), "shingles": [_shingles(w, 5).astype("<u8").tobytes() for w in words]}

    return arrow_map(_texts_of(docs, need), rows, "n long, shingles binary").join(need.select("n"), "n", "left_semi").dropDuplicates(["n"])


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    one, two = (sets.select(F.col("n").alias(n), F.col("shingles").alias(k)) for n, k in (("a", "k1"), ("b", "k2")))
    # Leaders are asked by many: such nodes are met by a bounded broadcast, and the pairs don't move again.
    lookup = two.join(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("asked")), "b")
    met = split_hot(pairs.join(one, "a"), lookup, ["b"], "asked", pairs.count()).select("a", "b", "k1", "k2")

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch["k1"], batch["k2"], strict=True)):
                shared = len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
                if shared >= least * ((len(x) + len(y)) // 8 - shared) - 1e-9:
                    keep.append(k)
            yield {"a": [batch["a"][k] for k in keep], "b": [batch["b"][k] for k in keep]}

    return arrow_map(met, rows, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the materialised ``pairs`` (a, b) whose whole shingle sets are similar; many pairs go in portions, so disk use is bounded."""
    portions = -(-pairs.count() // max(20_000, sets.count()))
    if portions <= 1:
        return cut(_similar(pairs, sets, least))
    found = None
    for k in range(portions):
        part = cut(_similar(cut(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(portions)) == k)), sets, least))
        found = part if found is None else found.unionByName(part)
        release(pairs.sparkSession)
    return found


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (n, fp): equal fingerprints, and those that multi-index hashing links."""
    prints = cut(nodes.groupBy("fp").agg(F.min("n").alias("n0"), F.count(F.lit(1)).alias("copies")))
    links = fingerprint_links(prints.select("fp"), 32)
    one, two = (prints.select(F.col("fp").alias(k), F.col("n0").alias(n)) for k, n in (("a", "na"), ("b", "nb")))
    apart = links.join(one, "a").join(two, "b").select(F.greatest("na", "nb").alias("a"), F.least("na", "nb").alias("b"))
    same = split_hot(nodes.select("n", "fp"), prints.where("copies > 1"), ["fp"], "copies", nodes.count()).where("n <> n0")
    return apart.unionByName(same.select(F.greatest("n", "n0").alias("a"), F.least("n", "n0").alias("b")))


def _reordered(docs: DataFrame, nodes: DataFrame, crowded: DataFrame, bucket: int, least: float) -> tuple[DataFrame, KeyFilter] | None:
    """Texts that hold one of the ``crowded`` keys (key), posted anew: rows (n, size, prefix, fresh), and the common keys.

    All shingles of those texts are counted first, so that a passage goes to the end as a whole.
    """
    count = crowded.count()
    if not count:
        return None

    def holders(common: KeyFilter) -> DataFrame:
        def rows(batches: Iterator[dict]) -> Iterator[dict]:
            for batch in batches:
                keep = [k for k, p in enumerate(batch["prefix"]) if common.has(np.array(p, dtype=np.int64)).any()]
                yield {c: [batch[c][k] for k in keep] for c in ("n", "rep")}

        return cut(arrow_map(nodes.select("n", "rep", "prefix"), rows, "n long, rep long", at_once=64))

    def all_keys(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"key": np.concatenate([_shingles(w, 5) for w in _words(batch["text"])]).view(np.int64)}

    held = _texts_of(docs, holders(KeyFilter.of(crowded, count)))
    keys = arrow_map(held, all_keys, "key long", at_once=32).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > bucket).select("key")
    keys = cut(keys.unionByName(crowded).distinct())
    common = KeyFilter.of(keys, keys.count())
    release(docs.sparkSession)
    touched = holders(common)
    del held, keys

    def posted(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            words = _words(batch["text"])
            sets = [_shingles(w, 5) for w in words]
            both = [ordered_prefix(s, common, least) for s in sets]
            yield {"n": list(map(text_key, words)), "size": list(map(len, sets)), "prefix": [p.view(np.int64) for p, _ in both], "fresh": [f.view(np.int64) for _, f in both]}

    anew = arrow_map(_texts_of(docs, touched), posted, "n long, size int, prefix array<long>, fresh array<long>", at_once=32)
    anew = cut(anew.join(touched.select("n"), "n", "left_semi").dropDuplicates(["n"]))
    release(docs.sparkSession)
    return anew, common


def _fresh_postings(nodes: DataFrame, anew: DataFrame, common: KeyFilter) -> DataFrame:
    """Postings (key, n, size) of all texts at the keys under which some text is posted newly."""
    keys = cut(anew.select(F.explode("fresh").alias("key")).distinct())
    new = KeyFilter.of(keys, keys.count())

    def chosen(but: KeyFilter | None):
        def rows(batches: Iterator[dict]) -> Iterator[dict]:
            for batch in batches:
                keep = []
                for prefix in batch["prefix"]:
                    p = np.array(prefix, dtype=np.int64)
                    keep.append(p[:0] if but is not None and but.has(p).any() else p[new.has(p)])
                many = list(map(len, keep))
                yield {"key": np.concatenate(keep), "n": np.repeat(np.array(batch["n"], dtype=np.int64), many), "size": np.repeat(np.array(batch["size"], dtype=np.int32), many)}

        return rows

    fields, schema = ["n", "size", "prefix"], "key long, n long, size int"
    return arrow_map(nodes.select(*fields), chosen(common), schema, at_once=64).unionByName(arrow_map(anew.select(*fields), chosen(None), schema, at_once=64))


def _candidates(docs: DataFrame, nodes: DataFrame, bucket: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b) that may be similar, members (key, n) of lists that stay crowded) of nodes (n, rep, size, prefix).

    A similar pair that isn't among the pairs meets in a crowded list.
    """
    spark = docs.sparkSession
    postings = nodes.select(F.explode("prefix").alias("key"), "n", "size")
    met = _met(postings, bucket, least, members=False)
    rows = met.where("b IS NOT NULL").select("a", "b", "shared", "wanted")
    again = _reordered(docs, nodes, met.where("b IS NULL").select("key").distinct(), bucket, least)
    members = None
    if again:
        anew, common = again
        more = _met(_fresh_postings(nodes, anew, common), bucket, least, members=True)
        rows = rows.unionByName(more.where("b IS NOT NULL").select(*rows.columns))
        members = cut(more.where("b IS NULL").select("key", F.col("a").alias("n")).distinct())
    summed = rows.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("wanted").alias("wanted"))
    pairs = cut(summed.where("shared >= wanted").select("a", "b"))
    del met, rows, summed, again
    release(spark)
    return pairs, members if members is not None else spark.createDataFrame([], "key long, n long")


def _minor(members: DataFrame, turn: int) -> DataFrame:
    """Members of long lists outside their list's largest group, with a ``leader`` inside it; lists of one group have none."""
    parts = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min_by("n", F.xxhash64("n", F.lit(turn))).alias("n"))
    main = parts.groupBy("key").agg(F.max_by(F.struct("label", "n"), F.struct("c", "label")).alias("main"), F.sum("c").alias("weight"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    joined = split_hot(members, main, ["key"], "weight", members.count()).where("label <> main.label")
    return cut(joined.select(*members.columns, F.col("main.n").alias("leader"), F.col("main.label").alias("main")))


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the sets ``xs`` shares with each of ``ys``."""
    both = np.intersect1d(np.unique(np.concatenate(xs)), np.unique(np.concatenate(ys)), assume_unique=True)
    out = np.zeros((len(xs), len(ys)), dtype=np.float32)

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        column = np.searchsorted(both, values)
        there = column < len(both)
        there[there] = both[column[there]] == values[there]
        order = np.argsort(column[there], kind="stable")
        return row[there][order], column[there][order]

    if len(both):
        (xr, xc), (yr, yc) = placed(xs), placed(ys)
        for at in range(0, len(both), COLUMNS):
            x, y = (np.zeros((n, COLUMNS), dtype=np.float32) for n in out.shape)
            for matrix, row, column in ((x, xr, xc), (y, yr, yc)):
                a, b = np.searchsorted(column, (at, at + COLUMNS))
                matrix[row[a:b], column[a:b] - at] = 1
            out += x @ y.T
    return out


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """As few of the pairs as connect the same."""
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (r := root.get(i, i)) != i:
            root[i] = root.get(r, r)
            i = r
        return i

    out = []
    for a, b in pairs:
        if (x := find(a)) != (y := find(b)):
            root[x] = y
            out.append((a, b))
    return out


def block_links(key: int, xs: list[dict], ys: list[dict], least: float) -> list[tuple[int, int]]:
    """Links between two blocks of list ``key``: rows with n, label, main, keys (its crowded lists), shingles.

    A pair is compared in the first list that it shares, and only if it isn't connected.
    """
    if not xs or not ys:
        return []
    (xn, xl), (yn, yl) = [[np.array([r[c] for r in rows], dtype=np.int64) for c in ("n", "label")] for rows in (xs, ys)]
    before = [[np.array([k for k in r["keys"] if k < key], dtype=np.int64) for r in rows] for rows in (xs, ys)]
    todo = (xl[:, None] != yl[None, :]) & ((yl == xs[0]["main"])[None, :] | (xn[:, None] > yn[None, :])) & (overlaps(*before) == 0)
    sets = [[np.frombuffer(r["shingles"], "<u8") for r in rows] for rows in (xs, ys)]
    s, r = (np.array(list(map(len, x)), dtype=np.int64) for x in sets)
    todo &= np.minimum.outer(s, r) >= least * np.maximum.outer(s, r) - 1e-9
    x, y = np.flatnonzero(todo.any(axis=1)), np.flatnonzero(todo.any(axis=0))
    if not len(x):
        return []
    shared = overlaps([sets[0][k] for k in x], [sets[1][k] for k in y])
    near = todo[np.ix_(x, y)] & (shared >= least * (s[x][:, None] + r[y][None, :] - shared) - 1e-6)
    return _forest([(int(xn[x[i]]), int(yn[y[j]])) for i, j in np.argwhere(near)])


def _block_links(minor: DataFrame, members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links of crowded lists that minor members (key, n, label, main) have to others of their list (key, n, label)."""
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("weight"))
    few = minor.groupBy("key").agg(F.count(F.lit(1)).alias("few"))
    lists = cut(counts.join(few, "key").select("key", "weight", blocks("few").alias("bx"), blocks("weight").alias("by")))
    slot = lambda n: F.pmod(F.xxhash64("n"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    total = members.count()
    x = split_hot(minor, lists, ["key"], "weight", total).withColumn("x", slot("bx")).withColumn("y", every("by")).withColumn("side", F.lit(0))
    y = split_hot(members, lists, ["key"], "weight", total).withColumn("main", F.lit(None).cast("long")).withColumn("y", slot("by")).withColumn("x", every("bx")).withColumn("side", F.lit(1))
    fields = ["key", "x", "y", "side", "n", "label", "main"]
    known = members.groupBy("n").agg(F.collect_list("key").alias("keys")).join(sets, "n")
    dealt = x.select(*fields).unionByName(y.select(*fields)).join(known, "n")
    order = ["key", "x", "y"]

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        now, sides = None, ([], [])
        for batch in batches:
            for values in zip(*batch.values(), strict=True):
                row = dict(zip(batch, values, strict=True))
                if now != (at := tuple(row[c] for c in order)):
                    if now and (found := block_links(now[0], *sides, least)):
                        yield {"a": [a for a, _ in found], "b": [b for _, b in found]}
                    now, sides = at, ([], [])
                sides[row["side"]].append(row)
        if now and (found := block_links(now[0], *sides, least)):
            yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

    return cut(arrow_map(dealt.repartition(*order).sortWithinPartitions(*order), rows, "a long, b long"))


def _crowd_links(members: DataFrame, edges: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``edges`` and verified ones that connect what crowded lists (key, n) connect in all."""
    roots = components(edges)
    members = cut(members.join(roots.withColumnRenamed("node", "n"), "n", "left").select("key", "n", F.coalesce("root", "n").alias("label")))
    before, turn = None, 0
    while True:
        minor = _minor(members, turn)
        asked = cut(minor.groupBy(F.col("n").alias("a"), "label").agg(F.min(F.struct("leader", "main")).alias("l")).select("a", "label", F.col("l.leader").alias("b"), F.col("l.main").alias("to")))
        now = asked.count()
        if not now:
            return edges
        if before is not None and now * 2 > before:
            return edges.unionByName(_block_links(minor, members, sets, least))
        good = _verified(asked.select("a", "b"), sets, least)
        edges = edges.unionByName(good)
        roots = components(asked.join(good, ["a", "b"], "left_semi").select(F.col("label").alias("a"), F.col("to").alias("b")))
        members = cut(members.join(roots.withColumnRenamed("node", "label"), "label", "left").select("key", "n", F.coalesce("root", "label").alias("label")))
        before, turn = now, turn + 1
        del minor, asked, good, roots
        release(members.sparkSession)


def similar_links(docs: DataFrame, nodes: DataFrame, bucket: int, least: float) -> DataFrame:
    """Edges (a, b) that connect nodes (n, rep, fp, size, prefix) of rows (id, text) as all pairs of similarity ``least`` do."""
    pairs, members = _candidates(docs, nodes, bucket, least)
    pairs = cut(pairs.unionByName(_fingerprint_pairs(nodes)).distinct())
    release(docs.sparkSession)
    used = pairs.select(F.col("a").alias("n")).unionByName(pairs.select(F.col("b").alias("n"))).unionByName(members.select("n")).distinct()
    sets, path = stored(_shingle_sets(docs, cut(nodes.select("n", "rep").join(used, "n", "left_semi"))), "shingles")
    release(docs.sparkSession)
    edges = _verified(pairs, sets, least)
    del pairs, used
    release(docs.sparkSession)
    if not members.isEmpty():
        edges = cut(_crowd_links(members, edges, sets, least))
    delete_path(docs.sparkSession, path)
    return edges


def keep_one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = 0.8,
    bucket: int = 64,
) -> DataFrame:
    """The input rows without near copies: of each group the row with the smallest id stays.

    Groups are connected by links between any two texts whose sets of five-word shingles (A-Z
    lower-cased; a shorter text is one) have a Jaccard similarity of ``least`` or more.  Rows that
    share the smallest id count as one document, and one of them stays.  Rows with a null id can't
    stand for a group; they all stay.  Texts without words are copies of one another.  Extra columns
    of any name pass through.  An empty table gives an empty result.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            words = _words(batch["text"])
            sets = [_shingles(w, 5) for w in words]
            yield {
                "id": batch["id"], "n": list(map(text_key, words)), "fp": [_signed(simhash(t or b"")) for t in batch["text"]],
                "size": list(map(len, sets)), "prefix": [s[: prefix_length(len(s), least)].view(np.int64) for s in sets],
            }

    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    prints, path = stored(arrow_map(read, rows, "id long, n long, fp long, size int, prefix array<long>"), "fingerprints")
    texts = prints.groupBy("n").agg(F.min("id").alias("rep"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    nodes, nodes_path = stored(texts, "nodes")
    ids = cut(prints.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("rows")))
    delete_path(spark, path)
    release(spark)
    roots = components(similar_links(read, nodes, bucket, least))
    named = nodes.select("n", "rep").join(roots, nodes["n"] == roots["node"], "left").select("rep", F.coalesce("root", "n").alias("root"))
    keep = named.groupBy("root").agg(F.min("rep").alias("id")).where("id IS NOT NULL").select("id").distinct()
    keepers = cut(keep.join(ids, "id"))
    delete_path(spark, nodes_path)
    del prints, texts, nodes, roots, named, keep
    release(spark)
    own = F.col(f"`{id_col}`")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), own.cast("long").alias("id"))
    one = keyed.join(keepers, "id", "left_semi")
    if not keepers.where("rows > 1").isEmpty():
        one = one.dropDuplicates(["id"])
    return one.select("row.*").unionByName(docs.where(own.isNull()))
