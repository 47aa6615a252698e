"""Ranged downloads: each range is fetched in the task that holds it, and files
are put together in the store from the rows of their ranges."""

from __future__ import annotations

import http.client
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.intervals import byte_ranges
from spanloom.sources.ranged import store

TRIES, TIMEOUT = 4, 120


#: Statuses that another try can change, besides those of servers.
PASSING = (408, 425, 429)
#: Bytes of a body that are held at once.
CHUNK_BYTES = 1 << 20


def transient(error: Exception) -> bool:
    """Whether asking again can help: not where the address is known to be wrong."""
    return not isinstance(error, urllib.error.HTTPError) or error.code in PASSING or error.code >= 500


def opened(url: str, first: int | None = None, last: int | None = None, tries: int = TRIES):
    """An answer to read from, with growing pauses between tries."""
    headers = {} if first is None else {"Range": f"bytes={first}-{'' if last is None else last}"}
    for n in range(tries):
        try:
            return urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=TIMEOUT)
        except (urllib.error.URLError, OSError) as error:
            if n == tries - 1 or not transient(error):
                raise
            time.sleep(min(10, 2**n))


def request(url: str, first: int | None = None, last: int | None = None, tries: int = TRIES):
    """(status, headers, body); a body that breaks off is asked for again."""
    for n in range(tries):
        try:
            with opened(url, first, last, tries - n) as answer:
                return answer.status, dict(answer.headers), answer.read()
        except (urllib.error.URLError, OSError, http.client.HTTPException) as error:
            if n == tries - 1 or not transient(error):
                raise
            time.sleep(min(10, 2**n))


def by_host(rows: DataFrame, url: str, slots: int) -> DataFrame:
    """Rows dealt so that a host is asked by ``slots`` tasks at once at most."""
    host = F.regexp_extract(url, "^[a-z]+://([^/]*)", 1)
    return rows.repartition(host, F.pmod(F.xxhash64(url), F.lit(slots)))


def bodies(urls: DataFrame, slots: int = 4, tries: int = TRIES) -> DataFrame:
    """(url, body, error) of small answers: index pages, metadata, manifests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                body, error = None, None
                try:
                    body = request(url, tries=tries)[2].decode("utf-8", "replace")
                except (urllib.error.URLError, OSError, ValueError, http.client.HTTPException) as e:
                    error = f"{url}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([url]), pa.array([body], pa.string()), pa.array([error], pa.string())], names=["url", "body", "error"])

    return by_host(urls.select("url").distinct(), "url", slots).mapInArrow(run, "url string, body string, error string")


def probe(urls: DataFrame, tries: int = 1) -> DataFrame:
    """(url, reachable, ranged, size) by a request for one byte, asked once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column(0).to_pylist():
                try:
                    status, headers, _ = request(url, 0, 0, tries)
                    total = headers.get("Content-Range", "").rpartition("/")[2] or headers.get("Content-Length", "")
                    rows.append((url, status in (200, 206), status == 206, int(total) if total.isdigit() else None))
                except (urllib.error.URLError, OSError, ValueError):
                    rows.append((url, False, False, None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.bool_(), pa.bool_(), pa.int64()))], names=["url", "reachable", "ranged", "size"])

    return urls.select("url").mapInArrow(run, "url string, reachable boolean, ranged boolean, size long")


def fetch(probed: DataFrame, connections: int = 30, tries: int = TRIES) -> DataFrame:
    """(url, part, start, content) of every range of the probed files; files that
    take no ranges come as one part. A body of the wrong size fails."""
    sized = probed.filter("reachable").withColumn("size", F.coalesce("size", F.lit(1)))
    many = byte_ranges(sized.filter("ranged"), "size", connections).select("url", "part", "start", "stop")
    one = sized.filter("not ranged").select("url", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, part, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                _, _, body = request(url, None if stop is None else start, stop, tries)
                if stop is not None and len(body) != stop - start + 1:
                    raise ValueError(f"{url}: {len(body)} bytes instead of {stop - start + 1}")
                yield pa.RecordBatch.from_arrays([pa.array([url]), pa.array([part], pa.int64()), pa.array([start], pa.int64()), pa.array([body], pa.binary())], names=["url", "part", "start", "content"])

    return many.unionByName(one).mapInArrow(run, "url string, part long, start long, content binary")


def save(parts: DataFrame, names: DataFrame, folder: str) -> DataFrame:
    """(url, path, size) of the files put together in ``folder``.

    ``parts`` is what ``fetch`` gives, ``names`` has ``url, name``. The ranges of a
    file meet in one task in their order and are written as they come, under a
    temporary name that is moved when the file is whole; a task that runs again
    replaces what it left. Missing ranges fail.
    """
    address = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    ordered = parts.join(names.select("url", "name"), "url").repartition("url").sortWithinPartitions("url", "part").select("url", "name", "start", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(address)
        system.create_dir(root, recursive=True)
        held: tuple | None = None
        size = 0

        def ended() -> Iterator[pa.RecordBatch]:
            if held is not None:
                url, name, draft, stream = held
                stream.close()
                system.move(draft, f"{root}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([url]), pa.array([f"{root}/{name}"]), pa.array([size], pa.int64())], names=["url", "path", "size"])

        for batch in batches:
            for row in range(batch.num_rows):
                url, name, start, content = (c[row].as_py() for c in batch.columns)
                if held is None or held[0] != url:
                    yield from ended()
                    draft, size = f"{root}/.{name}.{uuid.uuid4().hex}", 0
                    held = url, name, draft, system.open_output_stream(draft)
                if start != size:
                    raise ValueError(f"{url}: a range is missing at {size}")
                held[3].write(content)
                size += len(content)
        yield from ended()

    return ordered.mapInArrow(run, "url string, path string, size long")


def stream_to_store(requests: DataFrame, slots: int = 4, tries: int = TRIES) -> DataFrame:
    """(name, part, error): ranges written to files of their own in the store.

    ``requests`` has ``name, url, part, start, stop, path`` (no start: the whole
    body). Bodies go from the answer to the store a megabyte at a time and never
    through rows. A range that ends early is asked for again; what still fails is
    an error of its row, and its file is removed.
    """

    def one(url: str, start: int | None, stop: int | None, path: str) -> str | None:
        system, place = store(path)
        for n in range(tries):
            try:
                size = 0
                with opened(url, start, stop, tries - n) as answer, system.open_output_stream(place) as out:
                    if start is not None and answer.status != 206:
                        raise ValueError("the server sent no range")
                    while chunk := answer.read(CHUNK_BYTES):
                        out.write(chunk)
                        size += len(chunk)
                if start is not None and size != stop - start + 1:
                    raise OSError(f"{size} bytes of {stop - start + 1}")
                if not size:
                    raise ValueError("an empty body")
                return None
            except (urllib.error.URLError, OSError, ValueError, http.client.HTTPException) as error:
                if n == tries - 1 or isinstance(error, ValueError) or not transient(error):
                    return f"{url}: {error}"
                time.sleep(min(10, 2**n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, url, part, start, stop, path in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), pa.array([one(url, start, stop, path)], pa.string())], names=["name", "part", "error"])

    asked = requests.select("name", "url", "part", "start", "stop", "path")
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    dealt = asked.repartition(host, F.pmod(F.xxhash64("url", "part"), F.lit(slots)))
    return dealt.mapInArrow(run, "name string, part long, error string")
