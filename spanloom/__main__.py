"""Command line: ``python -m spanloom regions|tracks|download|shards|index|process|status ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spanloom.functions.numeric import TARGET_TOTAL
from spanloom.operators.manifests import build_tracks, numbered
from spanloom.operators.splits import SEED, build_shards
from spanloom.operators.status import repair_manifest, status_counts
from spanloom.plans.download import Sites
from spanloom.plans.download import download as fetch_tracks
from spanloom.plans.process import exists, output_status, process_shard, process_shards, required_files, shard_windows
from spanloom.plans.regions import MOST_BAD, STRIDE, WINDOW, find_windows
from spanloom.session import written
from spanloom.sources import sinks
from spanloom.sources.bigwig import file_totals, read_bigwig_windows
from spanloom.sources.fasta import make_fasta_index, read_fasta_windows
from spanloom.sources.text import CHROMS, read_bed, read_fasta, read_regions, read_shard, read_shards, read_target_manifest, read_tracks


def regions(spark: SparkSession, a: argparse.Namespace) -> None:
    masks = [read_bed(spark, path, "strict", CHROMS) for path in (a.unmappable, a.blacklist)]
    found = find_windows(read_fasta(spark, a.fasta), *masks, size=a.window_size, stride=a.stride, limit=a.max_bad_fraction)
    (sinks.publish_bed5 if a.one_file else sinks.write_bed5)(found, a.output)


def tracks(spark: SparkSession, a: argparse.Namespace) -> None:
    made = build_tracks(read_target_manifest(spark, a.manifest)).orderBy("row_index").drop("row_index")
    sinks.write_json_lines(made, a.output, nulls=True, one_file=a.one_file)


def shards(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_shards(build_shards(read_regions(spark, a.regions, lines=True), wanted=a.target_shards, seed=a.seed, exact=a.exact_shuffle), a.output, one_file=a.one_file)


def index(spark: SparkSession, a: argparse.Namespace) -> None:
    made = make_fasta_index(spark, a.fasta).orderBy("offset").select(F.concat_ws("\t", "chrom", "length", "offset", "line_bases", "line_bytes").alias("value"))
    sinks.publish_lines(made, a.output or f"{a.fasta}.fai")


def process(spark: SparkSession, a: argparse.Namespace) -> None:
    """One shard, or without a number or an id all shards of the split."""
    listed = numbered(read_tracks(spark, a.tracks, lines=True), ["line"], "track_index").select("track_index", F.col("id").alias("track_id"), F.col("preprocessing.sum_stat").alias("sum_stat"))
    masks = tuple(read_bed(spark, path, "lenient") for path in (a.blacklist, a.unmappable))
    files = required_files(spark, listed, a.raw_dir)
    totals = written(file_totals(files))
    if exists(spark, f"{a.fasta}.fai"):  # windows by their own bytes
        sequence = lambda windows: read_fasta_windows(spark, a.fasta, windows)
    elif a.fasta.endswith(".gz"):
        sequence = read_fasta(spark, a.fasta)
    else:
        made = written(make_fasta_index(spark, a.fasta))
        sequence = lambda windows: read_fasta_windows(spark, a.fasta, windows, made)
    settings = {"totals": totals, "target": a.target_total, "batch_size": a.track_batch_size}
    if a.shard_number is None and a.shard_id is None:
        chosen = read_shards(spark, a.shards).filter(F.col("split") == a.split)
        signal = lambda tracks, windows: read_bigwig_windows(files.join(tracks, "track_id", "left_semi"), windows)
        states = process_shards(spark, chosen, listed, sequence, signal, masks, f"{a.output_root}/all-{a.split}", **settings)
        for row in states.groupBy("complete").count().orderBy("complete").collect():
            print("complete" if row["complete"] else "partial", row["count"])
        return
    chosen = read_shard(spark, a.shards, a.split, a.shard_number, a.shard_id)
    name = chosen.first()["shard_id"]
    signal = read_bigwig_windows(files, shard_windows(chosen))
    print(name, process_shard(spark, chosen, listed, sequence, signal, masks, f"{a.output_root}/{a.split}/{name}", **settings))


def download(spark: SparkSession, a: argparse.Namespace) -> None:
    """Fetch the missing files of a manifest; exit code 2 where some fail."""
    settings = {}
    if a.sites:  # a JSON object of addresses in place of the public ones
        lines = spark.read.text(a.sites, wholetext=True).first()["value"]
        settings["sites"] = Sites(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(lines).items()})
    failures = written(fetch_tracks(spark, read_tracks(spark, a.tracks), a.output_dir, connections=a.connections, deep_scan=a.deep_scan, **settings))
    n = sinks.write_failures(failures, f"{a.output_dir.rstrip('/')}/download_failures")
    print("failures", n)
    if n:
        raise SystemExit(2)


def status(spark: SparkSession, a: argparse.Namespace) -> None:
    """Counts by state of the shards of a manifest, from their outputs; the shards
    to run again go to a manifest of JSON lines."""
    found = output_status(spark, read_shards(spark, a.shards, lines=True), a.output_root)
    for name, n in status_counts(found).first().asDict().items():
        print(name, n)
    if a.repair:
        wanted = repair_manifest(found, a.everything).orderBy("original_index")
        sinks.publish_lines(wanted.select(F.to_json(F.struct(*wanted.columns)).alias("value")), a.repair)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spanloom")
    sub = top.add_subparsers(dest="command", required=True)

    def command(work, *options: tuple[str, dict]) -> None:
        own = sub.add_parser(work.__name__)
        own.set_defaults(work=work)
        for name, settings in options:
            own.add_argument(name, **settings)

    one_file = ("--one-file", {"action": "store_true", "help": "one published file in place of part files"})
    need, number = {"required": True}, lambda kind, value: {"type": kind, "default": value}
    command(regions, ("--fasta", need), ("--unmappable", need), ("--blacklist", need), ("--window-size", number(int, WINDOW)), ("--stride", number(int, STRIDE)), ("--max-bad-fraction", number(float, MOST_BAD)), ("--output", need), one_file)
    command(tracks, ("--manifest", need), ("--output", need), one_file)
    command(shards, ("--regions", need), ("--output", need), ("--target-shards", number(int, 1000)), ("--seed", number(int, SEED)), ("--exact-shuffle", {"action": argparse.BooleanOptionalAction, "default": True}), one_file)
    command(download, ("--tracks", need), ("--output-dir", need), ("--connections", number(int, 30)), ("--deep-scan", {"action": "store_true"}), ("--sites", {}))
    command(index, ("--fasta", need), ("--output", {}))
    command(status, ("--shards", need), ("--output-root", need), ("--repair", {}), ("--everything", {"action": "store_true"}))
    command(
        process, ("--split", need), ("--shard-number", {"type": int}), ("--shard-id", {}), ("--shards", need), ("--tracks", need), ("--raw-dir", need), ("--fasta", need),
        ("--blacklist", need), ("--unmappable", need), ("--output-root", need), ("--target-total", number(float, TARGET_TOTAL)), ("--track-batch-size", number(int, 16)),
    )
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    a.work(spark or SparkSession.builder.appName("spanloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
