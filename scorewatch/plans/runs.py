"""A run of report pages that can be stopped and resumed.

A run is a folder. Every page is written into its own folder under
``pages/`` and then entered in ``done/<page>.json`` with its row count and
digest. A restart with the same run folder skips pages that are entered and
writes the others again, so a page is either whole or written anew.

Pages share masters (resolved dates, base frames). A master is staged when
the first unfinished page that needs it is built, and dropped after the last
such page; masters that only finished pages need are not built at all.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_page, write_table
from ..sources.snapshots import _fs, digest
from .staging import Scope, stage


@dataclass(frozen=True)
class Page:
    """One output: ``build`` gets the masters it ``needs`` by name."""
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    large: bool = False


@dataclass
class Masters:
    """Shared frames by name: staged once on first use, dropped after their last user.

    ``build`` maps a name to a function of the masters already at hand and
    the names it needs itself.
    """
    spark: SparkSession
    build: dict[str, tuple[tuple[str, ...], Callable[[dict[str, DataFrame]], DataFrame]]]
    held: dict[str, tuple[Scope, DataFrame]] = field(default_factory=dict)
    built: list[str] = field(default_factory=list)

    def closure(self, names: Iterable[str]) -> set[str]:
        """The names and everything they are built from."""
        out, todo = set(), list(names)
        while todo:
            name = todo.pop()
            if name not in out:
                out.add(name)
                todo += self.build[name][0]
        return out

    def get(self, name: str) -> DataFrame:
        if name not in self.held:
            needs, build = self.build[name]
            made = build({n: self.get(n) for n in needs})        # what it stages on the way is the run's
            scope = Scope()
            with scope.begin(self.spark):
                frame = stage(made, f"master-{name}")
            self.held[name] = (scope, frame)
            self.built.append(name)
        return self.held[name][1]

    def keep_only(self, names: set[str]) -> None:
        for name in [n for n in self.held if n not in names]:
            self.held.pop(name)[0].drop(self.spark)


def _enter(spark: SparkSession, path: str, entry: dict) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    out.close()


def finished(spark: SparkSession, root: str) -> dict[str, dict]:
    """Page name -> entry of the pages a run has finished."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/done")
    if not fs.exists(folder) or not len(fs.listStatus(folder)):
        return {}
    rows = spark.read.text(folder.toString(), wholetext=True).collect()     # one small entry per page
    entries = {}
    for row in rows:
        try:
            entry = json.loads(row[0])
        except ValueError:                                                  # cut off while it was written: not finished
            continue
        entries[entry["page"]] = entry
    return entries


def run_pages(spark: SparkSession, pages: list[Page], masters: Masters, root: str) -> dict[str, dict]:
    """Write every page that is not finished yet, in order; returns the entries of all pages.

    An error stops the run; what is finished stays finished, and staged masters are dropped. Frames
    that pages and masters stage on their way may be shared by later pages and are dropped when the run ends.
    """
    root = root.rstrip("/")
    done = finished(spark, root)
    todo, shared = [p for p in pages if p.name not in done], Scope()
    try:
        with shared.begin(spark):
            for i, page in enumerate(todo):
                masters.keep_only(masters.closure(n for later in todo[i:] for n in later.needs))
                built, own = page.build({n: masters.get(n) for n in page.needs}), Scope()
                with own.begin(spark):
                    frame = stage(built, f"page-{page.name}")
                path = f"{root}/pages/{page.name}"
                if page.large:
                    write_table(frame, path)
                else:
                    write_page(frame, path, list(page.order))
                rows, total = digest(frame)
                own.drop(spark)
                done[page.name] = {"page": page.name, "path": path, "rows": rows, "digest": str(total)}
                _enter(spark, f"{root}/done/{page.name}.json", done[page.name])
    finally:
        masters.keep_only(set())
        shared.drop(spark)
    return {p.name: done[p.name] for p in pages}
