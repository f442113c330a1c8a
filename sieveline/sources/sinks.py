"""Writers: detail tables, documents, and an append-only log."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame

from sieveline.operators.diff import Diff


def detail(diff: Diff, folder: str) -> list[str]:
    """Writes only-source, only-target, changed and repeated rows as Parquet below a folder."""
    parts = {"only_source": diff.only_source(), "only_target": diff.only_target(), "changed": diff.changed(), "repeated_source": diff.repeated_rows("source"), "repeated_target": diff.repeated_rows("target")}
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
    return list(parts)


def document(path: str | os.PathLike, content: dict) -> Path:
    """Writes JSON in one step: readers see the old file or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.tmp")
    part.write_text(json.dumps(content, ensure_ascii=False, indent=1, default=str), encoding="utf-8")
    part.replace(path)
    return path


def unused_name(folder: str | os.PathLike, stem: str, suffix: str = ".json") -> Path:
    """The next name of a series that was never used: stem, stem_v2, stem_v3, ..."""
    folder = Path(folder)
    taken = [1 for p in folder.glob(f"{stem}{suffix}")] + [int(m[1]) for p in folder.glob(f"{stem}_v*{suffix}") if (m := re.fullmatch(rf"{re.escape(stem)}_v(\d+)", p.name.removesuffix(suffix)))]
    n = max(taken, default=0) + 1
    return folder / (f"{stem}{suffix}" if n == 1 else f"{stem}_v{n}{suffix}")


def append_log(path: str | os.PathLike, entry: dict) -> int:
    """Appends a JSON line with the next sequence number, under a lock."""
    import fcntl

    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a+", encoding="utf-8") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        f.seek(0)
        n = sum(1 for _ in f) + 1
        f.write(json.dumps({"seq": n, **entry}, ensure_ascii=False, default=str) + "\n")
    return n


def report(df: DataFrame) -> list[dict]:
    """A small result (a row per column, control or table) as dictionaries."""
    return [r.asDict(recursive=True) for r in df.collect()]
