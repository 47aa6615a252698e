"""Tracks to files: addresses are resolved as joins, files are fetched in rounds.

Every provider's tracks are resolved at once: metadata, index pages and manifests
are fetched once each, become tables, and meet the tracks in joins. A track then
has its candidate addresses in order. Round by round, the next candidate of every
track without a file is downloaded: its ranges are streamed into the store side by
side, put behind one another, checked, and moved to their name. What no candidate
gives, and what cannot be resolved, ends in a table of failures.
"""

from __future__ import annotations

import logging
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.text import absolute_url, base_sum_urls, safe_filename
from spanloom.operators.intervals import byte_ranges
from spanloom.operators.manifests import METADATA, both_sources, chained_index, exact_or_canonical, link_index, reachable_candidates, tag_index

from spanloom.session import written
from spanloom.sources.bigwig import BigWigFile, readable_bigwigs
from spanloom.sources.http import CHUNK_BYTES, bodies, by_host, probe, stream_to_store
from spanloom.sources.ranged import RangedFile, store
from spanloom.sources.text import expected_names, present_files

log = logging.getLogger(__name__)
#: Tasks that ask one host at once; more ranges of its files wait their turn.
SLOTS = 8


@dataclass
class Sites:
    """The public addresses of each provider, best first."""

    metadata: str = "https://www.encodeproject.org"
    base_sums: tuple[str, ...] = ("https://duffel.rail.bio/recount3", "https://idies.jhu.edu/recount3/data")
    tag_mirror: str = "https://hgdownload.soe.ucsc.edu/gbdb/hg38/fantom5/"
    tag_root: str = "https://fantom.gsc.riken.jp/5/datahub/hg38/ctss/"
    tag_folders: tuple[str, ...] = (
        "human.cell_line.LQhCAGE/", "human.cell_line.hCAGE/", "human.fractionation.hCAGE/", "human.primary_cell.LQhCAGE/",
        "human.primary_cell.hCAGE/", "human.timecourse.LQhCAGE/", "human.timecourse.hCAGE/", "human.tissue.hCAGE/",
    )
    atlas: tuple[str, ...] = ("https://decoder-genetics.wustl.edu/catlasv1/humanenhancer/data/bw/", "https://catlas.org/humanenhancer/data/bw/")
    targets: str = "https://raw.githubusercontent.com/calico/borzoi/main/examples/targets_human.txt"


#: What resolvers return: candidates in order, or why there are none.
_FOUND = ["track_id", "urls", "error"]


def _judged(rows: DataFrame, message: Column) -> DataFrame:
    """Rows with ``urls``; an error where there are none."""
    none = F.coalesce(F.size("urls"), F.lit(0)) < 1
    return rows.select("track_id", F.when(none, F.array().cast("array<string>")).otherwise(F.col("urls")).alias("urls"), F.when(none, message).alias("error"))


def _frame(spark: SparkSession, urls: list[str]) -> DataFrame:
    return spark.createDataFrame([(u,) for u in urls], "url string")


def _by_metadata(tracks: DataFrame, sites: Sites) -> DataFrame:
    """The link in the JSON metadata of each track's file."""
    accession = F.coalesce("source.file_accession", F.regexp_replace("track_id", "[+-]+$", ""))
    api = F.coalesce("source.api_url", F.concat(F.lit(f"{sites.metadata}/files/"), accession, F.lit("/?format=json")))
    asked = tracks.select("track_id", api.alias("url"))
    answers = bodies(asked, SLOTS).withColumn("m", F.from_json("body", METADATA))
    met = asked.join(answers, "url", "left")
    good = F.coalesce((F.lower("m.file_format") == "bigwig") & F.col("m.href").isNotNull(), F.lit(False))
    urls = F.when(good, F.array(absolute_url(F.lit(sites.metadata), F.col("m.href"))))
    return _judged(met.withColumn("urls", urls), F.coalesce("error", F.concat(F.lit("the metadata names no bigWig link: "), "url")))


def _by_base_sums(tracks: DataFrame, sites: Sites) -> DataFrame:
    """Those of the spelt-out addresses that answer."""
    sample = F.coalesce("source.sample_id", "track_id")
    candidates = base_sum_urls(F.coalesce("description", F.lit("")), sample, F.array(*map(F.lit, sites.base_sums)))
    spelt = written(tracks.select("track_id", candidates.alias("candidates")))
    asked = spelt.select(F.explode("candidates").alias("url")).distinct()
    there = written(probe(by_host(asked, "url", SLOTS))).filter("reachable")
    found = reachable_candidates(spelt, F.col("candidates"), there, "track_id")
    return _judged(found, F.lit("no candidate address answers"))


def _pages(spark: SparkSession, bases: list[str]) -> DataFrame:
    return bodies(_frame(spark, bases), SLOTS).select(F.col("url").alias("base"), F.col("body").alias("html"), "error")


def _by_tags(tracks: DataFrame, sites: Sites) -> DataFrame:
    """Library and strand in the mirror's index, then in the official folders'."""
    folders = [sites.tag_root.rstrip("/") + "/" + f for f in sites.tag_folders]
    pages = written(_pages(tracks.sparkSession, [sites.tag_mirror, *folders]))
    failed = pages.filter("error is not null").first()
    if failed is not None:
        raise ValueError(f"an index could not be read: {failed['error']}")
    index = link_index(pages, "base", "html")
    mirror = tag_index(index.filter(F.col("base") == sites.tag_mirror), any_case=True)
    official = tag_index(chained_index(index, folders), any_case=False)
    library = F.regexp_replace(F.coalesce("source.sample_id", "track_id"), "[+-]+$", "")
    asked = tracks.select("track_id", library.alias("library"), "strand")
    message = F.concat(F.lit("no file of library "), "library", F.lit(" and strand "), F.coalesce("strand", F.lit("null")))
    return _judged(both_sources(asked, mirror, official, ["library", "strand"]), message)


def _by_atlas(tracks: DataFrame, sites: Sites) -> DataFrame:
    """The expected file name in the index of each host that answers."""
    spark = tracks.sparkSession
    if "://" in sites.targets and sites.targets.startswith("http"):
        body = bodies(_frame(spark, [sites.targets])).first()
        if body["error"]:
            raise ValueError(body["error"])
        listed = spark.createDataFrame([(body["body"],)], "body string").select(F.posexplode(F.split("body", "\r?\n")).alias("place", "value"))
    else:
        listed = spark.read.text(sites.targets).withColumn("place", F.monotonically_increasing_id())
    pages = written(_pages(spark, list(sites.atlas)))
    from spanloom.operators.manifests import answering_hosts

    hosts = answering_hosts(pages, list(sites.atlas))
    index = written(link_index(pages.filter("html is not null"), "base", "html"))
    named = tracks.select("track_id").join(expected_names(listed).withColumnRenamed("identifier", "track_id"), "track_id", "left")
    found = exact_or_canonical(named, index, "stem", hosts)
    return _judged(found, F.when(F.col("stem").isNull(), F.lit("no expected file name")).otherwise(F.concat(F.lit("no host has a file like "), "stem")))


RESOLVERS = {"ENCODE": _by_metadata, "recount3/GTEx": _by_base_sums, "FANTOM5": _by_tags, "CATlas": _by_atlas}


def resolve(tracks: DataFrame, sites: Sites) -> DataFrame:
    """``track_id, provider, urls, error``: the candidate addresses of every track
    in order. A provider whose index cannot be read, or that is unknown, is an
    error of its tracks and of no others. Only what occurs is asked for."""
    held = written(tracks)
    out = []
    for row in held.select("provider").distinct().collect():
        provider = row["provider"]
        own = held.filter(F.col("provider").eqNullSafe(F.lit(provider)))
        try:
            if provider not in RESOLVERS:
                raise ValueError(f"unsupported provider {provider!r}")
            found = written(RESOLVERS[provider](own, sites))
        except ValueError as error:
            found = own.select("track_id", F.array().cast("array<string>").alias("urls"), F.lit(str(error)).alias("error"))
        out.append(found.select(*_FOUND).withColumn("provider", F.lit(provider)))
    return reduce(DataFrame.unionByName, out) if out else held.select("track_id", F.array().cast("array<string>").alias("urls"), F.lit(None).cast("string").alias("error"), "provider")


def _assembled(files: DataFrame, folder: str) -> DataFrame:
    """(track_id, error): parts put behind one another, checked and moved."""

    def one(name: str, parts: int, draft: str) -> str | None:
        system, root = store(folder)
        source = f"{root}/{draft}"
        try:
            whole = f"{source}/whole"
            with system.open_output_stream(whole) as out:
                for part in range(parts):
                    with system.open_input_stream(f"{source}/{part:06d}") as held:
                        while chunk := held.read(CHUNK_BYTES):
                            out.write(chunk)
            if not BigWigFile(RangedFile(f"{folder.rstrip('/')}/{draft}/whole")).chroms():
                raise ValueError("no chromosomes")
            system.move(whole, f"{root}/{name}")
            return None
        except (ValueError, OSError, struct.error, UnicodeDecodeError) as error:
            return f"no valid BigWig file: {error}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for track, name, parts, draft in rows:
                yield pa.RecordBatch.from_arrays([pa.array([track]), pa.array([one(name, parts, draft)], pa.string())], names=["track_id", "error"])

    return files.select("track_id", "name", "parts", "draft").repartition("track_id").mapInArrow(run, "track_id string, error string")


def _round(wanted: DataFrame, folder: str, connections: int) -> DataFrame:
    """(track_id, error): one try of ``wanted(track_id, name, url)``."""
    stamp = uuid.uuid4().hex
    asked = written(wanted.withColumn("draft", F.concat(F.lit(f".parts-{stamp}/"), "name")))
    probed = written(probe(by_host(asked.select("url").distinct(), "url", SLOTS), tries=4))
    sized = asked.join(probed, "url")
    ranged = byte_ranges(sized.filter("reachable and ranged and size > 0"), "size", connections).select("track_id", "name", "url", "draft", F.col("part").cast("long"), "start", "stop")
    whole = sized.filter("reachable and not (ranged and coalesce(size, 0) > 0)").select("track_id", "name", "url", "draft", F.lit(0).cast("long").alias("part"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))
    parts = written(ranged.unionByName(whole).withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), "draft", F.lit("/"), F.lpad(F.col("part").cast("string"), 6, "0"))))
    system, root = store(folder)
    for row in parts.select("draft").distinct().toLocalIterator():
        system.create_dir(f"{root}/{row['draft']}", recursive=True)
    fetched = written(stream_to_store(parts, SLOTS))
    by_file = fetched.groupBy("name").agg(F.count(F.lit(1)).alias("parts"), F.max("error").alias("error"))
    states = written(sized.join(by_file, "name", "left").select("track_id", "name", "draft", "parts", F.when(~F.col("reachable"), F.concat("url", F.lit(": no answer"))).otherwise(F.col("error")).alias("error")))
    done = written(_assembled(states.filter("error is null"), folder))
    if system.get_file_info(f"{root}/.parts-{stamp}").type != pyarrow.fs.FileType.NotFound:
        system.delete_dir(f"{root}/.parts-{stamp}")
    return states.filter("error is not null").select("track_id", "error").unionByName(done)


def download(spark: SparkSession, tracks: DataFrame, folder: str, *, sites: Sites | None = None, connections: int = 30, deep_scan: bool = False) -> DataFrame:
    """Fetch what ``folder`` lacks of ``tracks(id, provider, strand, description,
    source)``; returns the failures ``track_id, provider, error``.

    Files are named by the safe form of the id. ``deep_scan`` opens each file that
    is there; without it one that is not empty counts.
    """
    sites = sites or Sites()
    named = tracks.select(F.col("id").alias("track_id"), "provider", "strand", "description", "source", F.concat(safe_filename(F.col("id")), F.lit(".bw")).alias("name"))
    system, root = store(folder)
    system.create_dir(root, recursive=True)
    there = None
    if any(f.base_name.endswith(".bw") for f in system.get_file_info(pyarrow.fs.FileSelector(root))):
        there = readable_bigwigs(spark, folder).filter("valid").select(F.concat("track_id", F.lit(".bw")).alias("name")) if deep_scan else present_files(spark, folder).filter("length > 0").select("name")
    missing = written(named if there is None else named.join(there.distinct(), "name", "left_anti"))
    resolved = written(resolve(missing.drop("name"), sites))
    failed = resolved.filter("error is not null").select("track_id", "provider", "error")
    left = written(resolved.filter("error is null").join(missing.select("track_id", "name"), "track_id").select("track_id", "provider", "name", "urls", F.lit(None).cast("string").alias("error")))
    most = left.agg(F.max(F.size("urls"))).first()[0] or 0
    for place in range(most):  # a round for each further candidate
        trying = left.filter(F.size("urls") > place)
        if trying.isEmpty():
            break
        tried = written(_round(trying.select("track_id", "name", F.get("urls", F.lit(place)).alias("url")), folder, connections))
        kept = left.join(tried.withColumnRenamed("error", "now"), "track_id", "left")
        spent = (F.size("urls") <= place) | F.col("now").isNotNull()
        left = written(kept.filter(spent).select("track_id", "provider", "name", "urls", F.coalesce("now", "error").alias("error")))
    log.info("%d tracks were missing", missing.count())
    return failed.unionByName(left.select("track_id", "provider", F.concat(F.lit("all candidate sources failed: "), "error").alias("error")))
