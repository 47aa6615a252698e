"""Bytes of a file by place, read inside tasks."""

from __future__ import annotations

import pyarrow.fs

#: Bytes of one page: headers and index nodes are read by pages.
PAGE_BYTES = 1 << 13
#: Pages that a reader keeps.
PAGES = 64
#: Names of stores in Spark that have another one in the ranged reader.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of an address, and the place in it."""
    scheme, mark, rest = path.partition("://")
    return pyarrow.fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}" if mark else "file://" + path.removeprefix("file:"))


class RangedFile:
    """Bytes of a file by place; small reads are served from the last few pages."""

    def __init__(self, path: str):
        system, name = store(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()
        self.pages: dict[int, bytes] = {}
        #: Bytes fetched so far.
        self.fetched = 0

    def _fetch(self, at: int, size: int) -> bytes:
        data = self.file.read_at(size, at)
        self.fetched += len(data)
        return data

    def __call__(self, at: int, size: int) -> bytes:
        first, last = at // PAGE_BYTES, (at + max(size, 1) - 1) // PAGE_BYTES
        if last - first > 1:
            return self._fetch(at, size)
        held = b""
        for page in range(first, last + 1):
            if page not in self.pages:
                if len(self.pages) >= PAGES:
                    self.pages.pop(next(iter(self.pages)))
                self.pages[page] = self._fetch(page * PAGE_BYTES, PAGE_BYTES)
            held += self.pages[page]
        return held[at - first * PAGE_BYTES : at - first * PAGE_BYTES + size]


class WholeFile:
    """The same of bytes in memory."""

    def __init__(self, raw: bytes):
        self.raw, self.size = raw, len(raw)

    def __call__(self, at: int, size: int) -> bytes:
        return self.raw[at : at + size]
