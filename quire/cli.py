"""Command line: doctor, scan, watch, status, ingest, retry, rebuild-book, pack."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from quire.config import Settings
from quire.functions.plain import page_ranges


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quire", description="Build and check citation-preserving corpora.")
    parser.add_argument("--root", default=".", help="folder of the corpus and its .env")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("doctor", "check the environment"), ("scan", "ingest what is in the inbox"), ("ingest", "the same as scan"), ("watch", "ingest for ever"), ("status", "list the books")):
        commands.add_parser(name, help=text)
    retry = commands.add_parser("retry", help="process failed pages again")
    retry.add_argument("--pages", type=page_ranges, default=None, help="for example 4,7-9")
    retry.add_argument("--include-fallback", action="store_true")
    rebuild = commands.add_parser("rebuild-book", help="derive chunks anew")
    rebuild.add_argument("book_id", nargs="*")
    pack = commands.add_parser("pack", help="check and export the corpus")
    pack.add_argument("--output", default=None)
    pack.add_argument("--fake-embeddings", action="store_true")
    return parser


def doctor(settings: Settings) -> dict[str, bool]:
    import importlib.util

    found = {f"package {p}": importlib.util.find_spec(p) is not None for p in ("pyspark", "pyarrow", "pandas", "numpy")}
    return found | {f"folder {n}": (settings.root / n).is_dir() for n in ("inbox", "processed", "failed")}


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    try:
        settings = Settings.load(args.root)
    except ValueError as x:
        print(f"error: {x}", file=sys.stderr)
        return 2
    settings.ensure_directories()
    if args.command == "doctor":
        checks = doctor(settings)
        print("\n".join(f"{'ok' if ok else 'missing':8}{name}" for name, ok in checks.items()))
        return int(not all(checks.values()))
    from quire.engine import session, table  # noqa: F401
    from quire.operators.retrieval import FakeEmbedder
    from quire.plans import converters, ingest

    spark = session("quire")
    try:
        if args.command in ("scan", "ingest", "retry"):
            pages = getattr(args, "pages", None)
            books = ingest.ingest(
                spark, settings, converters.JsonDecoder, converters.TextConverter, now=datetime.now(UTC).replace(tzinfo=None), retry_pages=pages, retry_fallback=getattr(args, "include_fallback", False)
            )
            books.select("book_id", "status", "page_count").show(truncate=False)
        elif args.command == "watch":
            from quire.streaming.inbox import watch

            watch(spark, settings.path("inbox"), settings.path("state/inbox"), settings.path("state/checkpoint"), settings.inbox_poll_seconds).awaitTermination()
        elif args.command == "status":
            ingest._table(spark, settings, "books").select("book_id", "status", "page_count", "failed_pages", "fallback_pages").orderBy("book_id").show(truncate=False)
        elif args.command == "rebuild-book":
            ingest.rebuild(spark, settings, args.book_id or None)
        elif args.command == "pack":
            make = lambda: FakeEmbedder(settings.embedding_dimensions)
            print(ingest.pack(spark, settings, make, allow_fake=args.fake_embeddings, sqlite=args.output))
    except ValueError as x:
        print(f"error: {x}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
