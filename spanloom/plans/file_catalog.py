"""Registered queries of sources and sinks: shared tables as files and back.

Each query writes what Spark derives from a table in a file format, reads it by the
source of that format, and returns the rows. The files lie in a folder of their own
under ``spark.checkpoint.dir``, which goes when the result is written down.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.manifests import build_tracks
from spanloom.plans.catalog import SHARDED_SQL, SPANS, _merged_sql, _sharded, _spans, query
from spanloom.plans.process import delete
from spanloom.session import checkpoint_dir, table, written
from spanloom.sources import fasta, sinks, text


def _in_folder(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of ``work(folder)``, kept after the folder is gone."""
    folder = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    try:
        return written(work(folder))
    finally:
        delete(spark, folder)


def _lines(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))


def _with(spark: SparkSession, lines: DataFrame, *more: str) -> DataFrame:
    return lines.unionByName(spark.createDataFrame([(m,) for m in more], "value string"))


@query(f"select event_type as chrom, start, \"end\" from ({SPANS}) where event_type in ('click', 'view')")
def bed_strict(spark, sf):
    """Comments go, and lines of other chromosomes before their numbers are read."""

    def work(folder: str) -> DataFrame:
        lines = _lines(_spans(spark, sf), "event_type", "start", "end", "event_id")
        _with(spark, lines, "# a comment", "track name=x", "browser position", "", "odd\tx\ty", "other\t9\t9").write.text(folder)
        return text.read_bed(spark, folder, "strict", ("click", "view"))

    return _in_folder(spark, work)


@query(_merged_sql(f"""select event_type as chrom, start, "end" from ({SPANS})""", "chrom"))
def bed_lenient_merged(spark, sf):
    """Gzip files with empty intervals, merged by chromosome."""

    def work(folder: str) -> DataFrame:
        spans = _spans(spark, sf)
        lines = _lines(spans.unionByName(spans.withColumn("end", F.col("start") - F.col("event_id") % 2)), "event_type", "start", "end")
        lines.write.option("compression", "gzip").text(folder)
        return text.read_merged_bed(spark, folder)

    return _in_folder(spark, work)


@query(f"select event_type as chrom, start, \"end\" from ({SPANS}) where event_id % 3 > 0")
def bed_tolerant(spark, sf):
    """Lines with fewer than three fields go too."""

    def work(folder: str) -> DataFrame:
        whole = F.concat_ws(" \t", "event_type", F.col("start").cast("string"), F.col("end").cast("string"))
        short = F.concat_ws(" ", "event_type", F.col("start").cast("string"))
        _spans(spark, sf).select(F.when(F.col("event_id") % 3 > 0, whole).otherwise(short).alias("value")).write.text(folder)
        return text.read_bed(spark, folder, "tolerant")

    return _in_folder(spark, work)


@query("""
with r as (select 'chr' || (l_orderkey % 24 + 1) as chrom, l_orderkey * 100 + l_linenumber as start, max(l_orderkey * 100 + l_linenumber + 1 + l_partkey % 50) as "end" from lineitem group by 1, 2)
select chrom, start, "end", row_number() over (order by case when chrom in ('chr23', 'chr24') then 99 else substr(chrom, 4)::int end, chrom, start) - 1 as place from r""")
def regions_file(spark, sf):
    """One published file in chromosome order, read with the places of its lines."""

    def work(folder: str) -> DataFrame:
        start = F.col("l_orderkey") * 100 + F.col("l_linenumber")
        spans = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("chr"), F.col("l_orderkey") % 24 + 1).alias("chrom"), start.alias("start")).agg(F.max(start + 1 + F.col("l_partkey") % 50).alias("end"))
        sinks.publish_bed5(spans.withColumns({"bad_bp": F.lit(0).cast("long"), "bad_fraction": F.lit(0.0)}), f"{folder}/regions.bed")
        rows = text.read_regions(spark, f"{folder}/regions.bed", lines=True).withColumn("split", F.lit("all"))
        from spanloom.operators.splits import placed

        return placed(rows, [F.col("line")], "place").select("chrom", "start", "end", "place")

    return _in_folder(spark, work)


@query(SHARDED_SQL + " select shard_id, place - min(place) over () as window_index, lang as chrom, doc_id as start, doc_id + n_chars as \"end\" from e where shard_id = 'val-00002'")
def shard_lookup(spark, sf):
    """One shard of a written manifest by its number in the split."""

    def work(folder: str) -> DataFrame:
        from spanloom.operators.splits import shard_manifest
        from spanloom.plans.process import shard_windows

        windows = _sharded(spark, sf).withColumn("chrom", F.col("lang")).withColumn("start", F.col("doc_id")).withColumn("end", F.col("doc_id") + F.col("n_chars"))
        sinks.write_shards(shard_manifest(windows), folder)
        shard = text.read_shard(spark, folder, "val", number=3)
        return shard_windows(shard).select(F.lit("val-00002").alias("shard_id"), F.col("window_index").cast("long"), "chrom", "start", "end")

    return _in_folder(spark, work)


BASES_SQL = """
with d as (select doc_id, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) as s from documents),
w as (select doc_id, s, unnest(generate_series(0, length(s) - 50, 370)) as start from d where length(s) >= 50)
"""


def _genome(spark: SparkSession, sf: str, folder: str) -> tuple[str, DataFrame]:
    """Documents as the records of one FASTA file with lines of 60 letters."""
    bases = table(spark, sf, "documents").select("doc_id", F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")).alias("s"))
    cut = F.regexp_replace(F.regexp_replace("s", "(.{60})", "$1\n"), "\n$", "")
    path = f"{folder}/genome.fa"
    sinks.publish_lines(bases.select(F.concat(F.lit(">d"), "doc_id", F.lit(" a document\n"), cut).alias("value")), path)
    return path, bases


@query(BASES_SQL + """ select 'd' || doc_id as chrom, start, start + 50 as "end", substr(s, start::int + 1, 50) as seq from w""")
def fasta_windows(spark, sf):
    """Windows of a FASTA file by an index made from its bytes."""

    def work(folder: str) -> DataFrame:
        path, bases = _genome(spark, sf, folder)
        starts = F.explode(F.sequence(F.lit(0).cast("long"), F.length("s").cast("long") - 50, F.lit(370).cast("long")))
        windows = bases.filter(F.length("s") >= 50).select(F.concat(F.lit("d"), "doc_id").alias("chrom"), starts.alias("start")).withColumn("end", F.col("start") + 50)
        return fasta.read_fasta_windows(spark, path, windows, fasta.make_fasta_index(spark, path))

    return _in_folder(spark, work)


@query(BASES_SQL + """, p as (select doc_id, regexp_extract_all(s, '([ACGT]+|[^ACGT]+)', 1) as l from d),
q as (select doc_id, unnest(l) as piece, unnest(range(len(l))) as pos from p),
r as (select doc_id, piece, sum(length(piece)) over (partition by doc_id order by pos rows unbounded preceding) as "end" from q)
select 'd' || doc_id as chrom, ("end" - length(piece))::bigint as start, "end"::bigint as "end" from r where regexp_matches(piece, '^[ACGT]')""")
def fasta_clean_runs(spark, sf):
    """Clean runs of a scanned FASTA file, over the borders of its chunks."""

    def work(folder: str) -> DataFrame:
        path, _ = _genome(spark, sf, folder)
        return text.clean_runs(text.read_fasta(spark, path, chunk=700))

    return _in_folder(spark, work)


@query(BASES_SQL + """ select 'd' || doc_id as chrom, length(s)::bigint as length from d where length(s) > 0""")
def fasta_index(spark, sf):
    """Names and lengths of the records of a FASTA file, by splits of its bytes."""

    def work(folder: str) -> DataFrame:
        path, _ = _genome(spark, sf, folder)
        return fasta.make_fasta_index(spark, path, split=1 << 18).filter("length > 0").select("chrom", "length")

    return _in_folder(spark, work)


@query(f"""select event_type as track_id, user_id::varchar as chrom, start, "end", value::float as value from ({SPANS})""")
def bedgraph_tracks(spark, sf):
    """A bedGraph file for each track, named by it."""

    def work(folder: str) -> DataFrame:
        spans = written(_spans(spark, sf))
        for row in spans.select("event_type").distinct().collect():
            own = spans.filter(F.col("event_type") == row["event_type"]).withColumn("value", F.col("value").cast("float"))
            sinks.publish_lines(_lines(own, "user_id", "start", "end", "value"), f"{folder}/{row['event_type']}.bedgraph", header="track type=bedGraph")
        return text.read_bedgraph(spark, folder)

    return _in_folder(spark, work)


@query(r"""
with r as (select p_partkey, 'id' || (p_partkey % 700) as identifier, case when p_size % 3 = 0 then '/x/atac/catlas/' else '/x/other/' end || replace(p_name, ' ', '_') || '.bw' as file from part),
k as (select *, row_number() over (partition by identifier order by p_partkey desc) as n from r where file like '%/atac/catlas/%')
select identifier, regexp_replace(regexp_extract(file, '([^/]*)$', 1), '\.bw$', '') as stem from k where n = 1""")
def expected_file_names(spark, sf):
    """File names that a target manifest expects; the last row of a name wins."""

    def work(folder: str) -> DataFrame:
        place = F.when(F.col("p_size") % 3 == 0, F.lit("/x/atac/catlas/")).otherwise(F.lit("/x/other/"))
        rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("id"), F.col("p_partkey") % 700).alias("identifier"), F.concat(place, F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".bw")).alias("file"))
        sinks.publish_lines(_lines(rows.orderBy("p_partkey"), "p_partkey", "identifier", "file"), f"{folder}/targets.txt", header="index\tidentifier\tfile")
        return text.read_expected_names(spark, f"{folder}/targets.txt")

    return _in_folder(spark, work)


@query("""
select p_partkey - 1 as row_index, p_name as id, case when p_partkey % 2 = 0 then p_retailprice end as scale,
  case p_partkey % 3 when 0 then 'sum' when 1 then 'mean' else 'sum_sqrt' end as sum_stat from part where p_partkey % 5 <> 4""")
def tracks_file(spark, sf):
    """A target manifest as TSV, built to tracks, written as JSON lines and read."""

    def work(folder: str) -> DataFrame:
        kind = F.element_at(F.array(*[F.lit(x) for x in ("/rna/encode/a", "/dnase/encode/a", "/atac/catlas/a", "/cage/fantom/a", "/histone/x")]), (F.col("p_partkey") % 5 + 1).cast("int"))
        statistic = F.element_at(F.array(F.lit("sum"), F.lit("mean"), F.lit("sum_sqrt")), (F.col("p_partkey") % 3 + 1).cast("int"))
        scale = F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice").cast("string")).otherwise("")
        rows = table(spark, sf, "part").withColumns({"index": F.col("p_partkey") - 1, "file": kind, "sum_stat": statistic, "scale": scale, "none": F.lit("")})
        header = "\t".join(("index", "identifier", "file", "clip", "clip_soft", "scale", "sum_stat", "strand_pair", "description"))
        sinks.publish_lines(_lines(rows, "index", "p_name", "file", "none", "none", "scale", "sum_stat", "index", "p_type"), f"{folder}/targets.txt", header=header)
        made = build_tracks(text.read_target_manifest(spark, f"{folder}/targets.txt"))
        sinks.write_json_lines(made.withColumn("description", F.col("row_index").cast("string")).drop("row_index"), f"{folder}/tracks", nulls=True)
        read = text.read_tracks(spark, f"{folder}/tracks")
        return read.select(F.col("description").cast("long").alias("row_index"), "id", "preprocessing.scale", "preprocessing.sum_stat")

    return _in_folder(spark, work)


@query("""select 'o' || o_orderkey as track_id, o_orderstatus as provider, 'a b c ' || o_orderpriority as error from orders where o_orderstatus <> 'O'""")
def failure_report(spark, sf):
    """The report of failures, errors on one line, read back as TSV."""

    def work(folder: str) -> DataFrame:
        error = F.concat(F.lit("a\tb\nc\r"), "o_orderpriority")
        failed = table(spark, sf, "orders").filter("o_orderstatus <> 'O'").select(F.concat(F.lit("o"), "o_orderkey").alias("track_id"), F.col("o_orderstatus").alias("provider"), error.alias("error"))
        sinks.write_failures(failed, folder)
        return spark.read.csv(folder, sep="\t", header=True, schema="track_id string, provider string, error string", quote="")

    return _in_folder(spark, work)


@query("""select c_mktsegment as track_id, count(*)::bigint as rows from customer where c_mktsegment <> 'BUILDING' group by 1""")
def required_tracks(spark, sf):
    """The files of tracks by the safe form of their names; all must be there."""
    from spanloom.plans.process import required_files

    def work(folder: str) -> DataFrame:
        customers = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
        for row in customers.select("c_mktsegment").distinct().collect():
            name = row["c_mktsegment"]
            sinks.publish_lines(_lines(customers.filter(F.col("c_mktsegment") == name), "c_custkey"), f"{folder}/{name}.bw")
        files = required_files(spark, customers.select(F.col("c_mktsegment").alias("track_id")).distinct(), folder)
        rows = spark.read.text(folder).select(F.col("_metadata.file_name").alias("name"), "value")
        found = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
        return rows.join(found, "name").groupBy("track_id").agg(F.count(F.lit(1)).alias("rows"))

    return _in_folder(spark, work)
