"""URL filters (operator 9): a sort-merge range join of canonical keys with prefix rules.

A host's labels in reverse, each ended by a dot, make its canonical key: a rule for a host and all
its subdomains is then the interval of keys that begin with its own.  Rules and urls are sorted by
key and swept together; a stack holds the rules whose interval contains the current key, nested in
one another, so a key's candidates are exactly the stack.  Of those the longest whose path is a
prefix of the url's path decides.

Each task sorts the urls it reads by Spark's own sort, which spills, and sweeps them once against the
sorted rules: nothing is shuffled, and a hot host spreads over the tasks that read it.  The rules travel with the job, so there may be at
most ``max_rules`` of them; longer lists are a table that goes by ``judge_by_table``, which joins on
the hosts above each url's host instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import LOWER, UPPER, arrow_map

FOLD = {ord(a): b for a, b in zip(UPPER, LOWER, strict=True)}
MAX_RULES = 100_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): both empty without '://'; A-Z of the host lower-cased."""
    rest = (url or "").partition("://")[2]
    end = min((k for c in "/?#" if (k := rest.find(c)) >= 0), default=len(rest))
    tail = rest[end:]
    path = tail[: min((k for c in "?#" if (k := tail.find(c)) >= 0), default=len(tail))]
    return rest[:end].translate(FOLD), path


def canonical(host: str) -> str:
    """Labels in reverse, each ended by a dot: 'www.a.com' -> 'com.a.www.'."""
    return ".".join(reversed(host.split("."))) + "." if host else ""


class Sweep:
    """One pass over sorted (key, path) beside sorted rules (key, path, rule, verdict)."""

    def __init__(self, rules: list[tuple[str, str, str, str]]) -> None:
        self.rules, self.at = rules, 0
        self.stack: list[tuple[str, list[tuple[str, str, str]]]] = []  # (key, [(path, rule, verdict), ...]), nested

    def _leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of a key that isn't below the ones before."""
        self._leave(key)
        while self.at < len(self.rules) and self.rules[self.at][0] <= key:
            own, *rule = self.rules[self.at]
            self.at += 1
            if key.startswith(own):
                self._leave(own)
                if not self.stack or self.stack[-1][0] != own:
                    self.stack.append((own, []))
                self.stack[-1][1].append(tuple(rule))
        best = max(((len(rule), len(own), rule, verdict) for own, inside in self.stack for prefix, rule, verdict in inside if path.startswith(prefix)), default=None)
        return best[2:] if best else (None, None)


def sweep(keys: Iterable[tuple[str, str]], rules: list[tuple[str, str, str, str]]) -> Iterator[tuple[str | None, str | None]]:
    """(rule, verdict) for each of the sorted (key, path); rules are sorted (key, path, rule, verdict)."""
    state = Sweep(rules)
    return (state.judge(key, path) for key, path in keys)


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """One row (id, host, path, rule, verdict) for each input row.

    ``rules`` are (verdict, host, path prefix).  A rule fits its host and all subdomains if the
    url's path starts with its path; the longest (host and path together, then host) wins.  Without
    a fitting rule ``rule`` is null and ``verdict`` is ``default``.  Null urls and urls without
    '://' have an empty host and path.  An empty host fits no rule.  Repeated rows give repeated
    results; null ids pass; other columns are not read.
    """
    if len(rules) > max_rules:
        raise ValueError("too many rules to send with the job: use judge_by_table")
    ordered = sorted({(canonical(h.translate(FOLD)), p, h.translate(FOLD) + p, v) for v, h, p in rules})

    def split(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            parts = [split_url(u) for u in batch["url"]]
            yield {"id": batch["id"], "host": [h for h, _ in parts], "path": [p for _, p in parts], "key": [canonical(h) for h, _ in parts]}

    def judged(batches: Iterator[dict]) -> Iterator[dict]:
        state = Sweep(ordered)
        for batch in batches:
            found = [state.judge(*at) for at in zip(batch["key"], batch["path"], strict=True)]
            yield {c: batch[c] for c in ("id", "host", "path")} | {"rule": [r for r, _ in found], "verdict": [v or default for _, v in found]}

    read = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    keyed = arrow_map(read, split, "id long, host string, path string, key string")
    return arrow_map(keyed.sortWithinPartitions("key", "path"), judged, "id long, host string, path string, rule string, verdict string")


def judge_by_table(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``judge_urls`` for a rule table (verdict, host, path) of any size.

    Each distinct host and path asks for its host and the hosts above it: an equi-join, whose matches
    the longest wins.  Null and repeated ids are ordinary.
    """
    after = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(after, r"(?s)\A[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(after, r"(?s)\A[^/?#]*(/[^?#]*)", 1)
    urls = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    labels = F.split("host", r"\.", -1)
    above = urls.where("host <> ''").select("host", "path").distinct().select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("asked"))
    rule = rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    fits = above.join(rule, F.col("asked") == F.col("r_host")).where(F.expr("startswith(path, r_path)"))
    full = F.concat("r_host", "r_path")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.char_length(full).alias("a"), F.char_length("r_host").alias("b"), full.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select("id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
