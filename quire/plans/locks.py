"""One writer a book: a lock file on the driver, taken over from a process that is gone."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path


class Locked(RuntimeError):
    """Another live process works on the book."""


def alive(pid: int) -> bool:
    try:
        os.kill(pid, 0)
    except ProcessLookupError:
        return False
    except PermissionError:
        return True
    return pid > 0


def _owner(path: Path) -> int | None:
    try:
        return int(json.loads(path.read_text())["pid"])
    except (OSError, ValueError, KeyError, TypeError):
        return None


@contextmanager
def book_lock(folder: str | Path, book_id: str, source: str = "") -> Iterator[None]:
    """Hold ``book_id``; a lock whose owner doesn't run any more is removed and taken once."""
    path = Path(folder) / f"{book_id}.lock"
    path.parent.mkdir(parents=True, exist_ok=True)
    for attempt in range(2):
        try:
            handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            break
        except FileExistsError:
            owner = _owner(path)
            if attempt or (owner is not None and alive(owner)):
                raise Locked(f"{book_id} is being worked on by process {owner}") from None
            path.unlink(missing_ok=True)
    with os.fdopen(handle, "w") as f:
        json.dump({"pid": os.getpid(), "source": source}, f)
    try:
        yield
    finally:
        if _owner(path) == os.getpid():
            path.unlink(missing_ok=True)
