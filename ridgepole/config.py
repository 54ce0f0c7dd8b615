"""Where the data lives and how jobs treat existing output."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DataPaths:
    """Root folders, as URIs any executor can reach."""

    raw: str
    clean: str
    dictionaries: str

    @classmethod
    def under(cls, root: str) -> "DataPaths":
        root = root.rstrip("/")
        return cls(f"{root}/raw", f"{root}/clean", f"{root}/dictionaries")


@dataclass(frozen=True)
class LoadOptions:
    """``overwrite`` replaces data output, ``overwrite_dictionaries`` parsed dictionaries."""

    overwrite: bool = False
    overwrite_dictionaries: bool = False
    # how many independent per-file Spark jobs the driver keeps in flight
    parallel_jobs: int = 8
