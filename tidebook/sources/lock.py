"""One collection at a time."""

from __future__ import annotations

import os
from pathlib import Path


class LockHeld(RuntimeError):
    """Another run holds the lock."""


class RunLock:
    """A lock file on the driver, made when entered and removed when left. One left behind stays until someone removes it."""

    def __init__(self, path: str | Path):
        self.path = Path(path)

    def __enter__(self) -> RunLock:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        try:
            made = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError as e:
            raise LockHeld(f"another run holds {self.path}") from e
        with os.fdopen(made, "w") as f:
            f.write(f"{os.getpid()}\n")
        return self

    def __exit__(self, *_: object) -> None:
        self.path.unlink(missing_ok=True)
