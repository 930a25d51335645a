"""Releases of built packs: what goes where, what is there already, credits, a page of the data, source files.

Uploading has side effects, so it goes through a store that the caller names; FolderReleases keeps releases
in a folder and serves as the model of one. Everything here works on a release's files, which are few; tables
stay with the executors."""

from __future__ import annotations

import json
import os
import shutil
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame

CREDITS = "ATTRIBUTION.txt"


@dataclass(frozen=True)
class Attribution:
    """Whose data it is, and the texts that say so."""

    datasets: tuple[str, ...]
    version: str
    institution: str
    place: str
    when: str
    terms: str = ""

    @property
    def citation(self) -> str:
        cited = [f"{name}. Version: {self.version}." for name in self.datasets]
        return "\n".join([*cited, f"{self.institution}, {self.place}. {self.when}."])

    def notes(self, title: str, lines: list[str] = ()) -> str:
        """A release's description: its title, what it holds, the citation and the terms."""
        parts = [title, "\n".join(f"- {x}" for x in lines), f"Data derived from:\n{self.citation}", f"See {CREDITS} for citation and terms.", f"Terms of use: {self.terms}" if self.terms else ""]
        return "\n\n".join(p for p in parts if p) + "\n"

    def credits(self, processing: list[str] = ()) -> str:
        """The text of the file that goes with every release."""
        return self.notes("Citation", list(processing))


class Releases(Protocol):
    """Where releases are kept."""

    def exists(self, release: str) -> bool: ...

    def create(self, release: str, title: str, notes: str) -> None: ...

    def assets(self, release: str) -> set[str]: ...

    def upload(self, release: str, path: str, name: str) -> None: ...

    def write(self, release: str, text: str, name: str) -> None: ...

    def url(self, release: str, name: str) -> str: ...


class FolderReleases:
    """Releases as folders, each with its files; a file appears whole or not at all."""

    def __init__(self, root: str, base_url: str) -> None:
        self.root, self.base_url = root, base_url.rstrip("/")

    def _at(self, release: str, name: str = "") -> str:
        return os.path.join(self.root, release, name) if name else os.path.join(self.root, release)

    def exists(self, release: str) -> bool:
        return os.path.isdir(self._at(release))

    def create(self, release: str, title: str, notes: str) -> None:
        os.makedirs(self._at(release))
        self.write(release, f"{title}\n\n{notes}", "NOTES.txt")

    def assets(self, release: str) -> set[str]:
        return {n for n in os.listdir(self._at(release)) if not n.endswith(".part")} if self.exists(release) else set()

    def upload(self, release: str, path: str, name: str) -> None:
        shutil.copyfile(path, self._at(release, f"{name}.part"))
        os.replace(self._at(release, f"{name}.part"), self._at(release, name))

    def write(self, release: str, text: str, name: str) -> None:
        with open(self._at(release, f"{name}.part"), "w") as f:
            f.write(text)
        os.replace(self._at(release, f"{name}.part"), self._at(release, name))

    def url(self, release: str, name: str) -> str:
        return f"{self.base_url}/{release}/{name}"


@dataclass
class Published:
    """What a run of publish() did."""

    created: int = 0
    present: int = 0
    uploaded: int = 0
    skipped: int = 0
    urls: dict[str, str] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


def publish(files: DataFrame, store: Releases, credit: Attribution, workers: int = 8, dry: bool = False) -> Published:
    """Puts packs into their releases: what is there already stays, what fails is reported and stops its release only.

    files: (release_name, region_id, path), see planning.bundles and sinks.files.export. One row is read at a
    time, ordered by release. A dry run writes nothing and gives no addresses."""

    def one(release: str, rows: list) -> Published:
        out = Published()
        try:
            if store.exists(release):
                out.present += 1
            else:
                out.created += 1
                if not dry:
                    store.create(release, release, credit.notes(f"{len(rows)} packs", [r.region_id for r in rows]))
            there = store.assets(release)
            for r in rows:
                name = os.path.basename(r.path)
                if name in there:
                    out.skipped += 1
                else:
                    if not os.path.exists(r.path):
                        raise FileNotFoundError(r.path)
                    out.uploaded += 1
                    if not dry:
                        store.upload(release, r.path, name)
                if not dry:
                    out.urls[r.region_id] = store.url(release, name)
            if CREDITS not in there and not dry:
                store.write(release, credit.credits(), CREDITS)
        except OSError as e:
            return Published(errors=[f"{release}: {e}"])
        return out

    def grouped():
        name, rows = None, []
        for r in files.select("release_name", "region_id", "path").orderBy("release_name", "region_id").toLocalIterator():
            if r.release_name != name and rows:
                yield name, rows
                rows = []
            name = r.release_name
            rows.append(r)
        if rows:
            yield name, rows

    total = Published()
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for done in pool.map(lambda x: one(*x), grouped()):
            for k in ("created", "present", "uploaded", "skipped"):
                setattr(total, k, getattr(total, k) + getattr(done, k))
            total.urls |= done.urls
            total.errors += done.errors
    return total


def page(title: str, data: dict) -> str:
    """A page that holds its data: a table of them, drawn from JSON in the page itself."""
    held = json.dumps(data, sort_keys=True, default=str).replace("</", "<\\/")
    name = title.replace("&", "&amp;").replace("<", "&lt;")
    return (
        f'<!doctype html><html><head><meta charset="utf-8"><title>{name}</title></head><body><h1>{name}</h1><table id="rows"></table>'
        f'<script type="application/json" id="data">{held}</script><script>'
        'const d = JSON.parse(document.getElementById("data").textContent), t = document.getElementById("rows");'
        "for (const k of Object.keys(d)) { const r = t.insertRow(); r.insertCell().textContent = k; r.insertCell().textContent = JSON.stringify(d[k]); }"
        "</script></body></html>\n"
    )


def fetched(url: str, path: str, timeout: float = 60, agent: str = "Mozilla/5.0") -> int:
    """Downloads a file, whole or not at all; its bytes."""
    request = urllib.request.Request(url, headers={"User-Agent": agent})
    with urllib.request.urlopen(request, timeout=timeout) as answer, open(f"{path}.part", "wb") as out:
        shutil.copyfileobj(answer, out)
    os.replace(f"{path}.part", path)
    return os.path.getsize(path)


def download(files: dict[str, str], folder: str, fetch: Callable[[str, str], int] = fetched) -> dict[str, dict]:
    """Fetches files (name to address) into a folder; by name, the bytes or the error. One that fails stops no other."""
    os.makedirs(folder, exist_ok=True)
    report = {}
    for name, url in files.items():
        try:
            report[name] = {"bytes": fetch(url, os.path.join(folder, name)), "error": None}
        except OSError as e:
            report[name] = {"bytes": None, "error": str(e)}
    return report
