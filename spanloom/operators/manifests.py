"""Track manifests and the lookups that resolve tracks to addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pyspark.sql import types as T

from spanloom.functions.text import EXCLUDED, absolute_url, canonical_name, classify_path, cleaned, hrefs, library_and_strand, source_struct, split_strand, whole_number


def strand_partners(rows: DataFrame, index: str, pair: str, name: str) -> DataFrame:
    """``rows`` with ``partner``: the name of the row whose ``index`` is ``pair``;
    null where the pair is no number, missing, or the row itself. All rows are
    looked up, also those that later filters drop."""
    wanted = rows.withColumn("__pair", whole_number(F.col(pair)))
    other = rows.select(F.col(index).alias("__index"), F.col(name).alias("partner"))
    return wanted.join(other, (F.col("__pair") == F.col("__index")) & (F.col("__pair") != F.col(index)), "left").drop("__pair", "__index")


def build_tracks(manifest: DataFrame, dataset: str = "borzoi") -> DataFrame:
    """Track records from manifest rows numbered by ``row_index`` from 0."""
    paired = strand_partners(manifest, "row_index", "strand_pair", "identifier").withColumn("kind", classify_path(F.col("file")))
    kept = paired.filter(F.col("kind.assay") != EXCLUDED).withColumn("own", split_strand(F.col("identifier")))
    number = lambda c: cleaned(F.col(c).cast("double")).alias(c)
    return kept.select(
        F.col("row_index"),
        F.col("identifier").alias("id"),
        F.lit(dataset).alias("dataset"),
        F.col("kind.assay").alias("assay"),
        F.col("kind.provider").alias("provider"),
        F.col("own.strand").alias("strand"),
        F.col("partner").alias("strand_pair"),
        F.col("description"),
        source_struct(F.col("kind.provider"), F.col("own.stable_id")).alias("source"),
        F.struct(number("scale"), F.col("sum_stat"), number("clip_soft"), number("clip")).alias("preprocessing"),
    )


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def link_index(pages: DataFrame, base: str, html: str, suffix: str = ".bw") -> DataFrame:
    """(base, ordinal, filename, url) of all links of the pages with the suffix."""
    rest = F.posexplode(hrefs(F.col(html), suffix)).alias("ordinal", "href")
    rows = pages.select(F.col(base).alias("base"), rest)
    url = absolute_url(F.col("base"), F.col("href"))
    return rows.select("base", "ordinal", F.regexp_extract(url, "([^/]*)$", 1).alias("filename"), url.alias("url"))


def last_wins(rows: DataFrame, keys: list[str], value: str, ordinal: str) -> DataFrame:
    """One row per key: the value of the highest ordinal (ties: the larger value)."""
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(ordinal, value)).alias(value))


def chained_index(index: DataFrame, bases: list[str]) -> DataFrame:
    """The index of several folders as one: rows of other bases go, and ``ordinal``
    follows the order of ``bases``, so later folders replace earlier ones."""
    place = F.array_position(F.array(*[F.lit(b) for b in bases]), F.col("base"))
    return index.filter(place > 0).withColumn("ordinal", (place - 1) * (1 << 32) + F.col("ordinal"))


def answering_hosts(pages: DataFrame, hosts: list[str]) -> list[str]:
    """The hosts, in order, whose index page (``base, html``) came back; a host
    without one is left out, and an error names all if none answers."""
    there = {r["base"] for r in pages.filter(F.col("html").isNotNull() & F.col("base").isin(hosts)).select("base").distinct().collect()}
    if not there:
        raise ValueError(f"no index could be read of {', '.join(hosts)}")
    return [h for h in hosts if h in there]


def unique_only(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that have exactly one distinct value, with it."""
    return rows.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__high")).filter(F.col(value) == F.col("__high")).drop("__high")


def tag_index(index: DataFrame, any_case: bool) -> DataFrame:
    """(library, strand, url) of tag-count files; later links replace earlier."""
    named = index.withColumn("key", library_and_strand(F.col("filename"), any_case)).filter(F.col("key").isNotNull())
    return last_wins(named.select("key.library", "key.strand", "ordinal", "url"), ["library", "strand"], "url", "ordinal")


def both_sources(tracks: DataFrame, first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """``urls``: ordered distinct addresses from the first index, then the second."""
    joined = tracks.join(first.select(*keys, F.col("url").alias("__u1")), keys, "left").join(second.select(*keys, F.col("url").alias("__u2")), keys, "left")
    return joined.withColumn("urls", F.array_distinct(F.array_compact(F.array("__u1", "__u2")))).drop("__u1", "__u2")


def exact_or_canonical(tracks: DataFrame, index: DataFrame, stem: str, hosts: list[str]) -> DataFrame:
    """``urls`` in host order: on each host the exact file name, else the
    canonical name where only one address has it."""
    own = tracks
    for number, host in enumerate(hosts):
        files = index.filter(F.col("base") == host)
        exact = last_wins(files, ["filename"], "url", "ordinal").select(F.col("filename").alias("__f"), F.col("url").alias(f"__e{number}"))
        canonical = unique_only(files.select(canonical_name(F.col("filename")).alias("__c"), "url"), "__c", "url").withColumnRenamed("url", f"__n{number}")
        own = own.join(exact, F.concat(F.col(stem), F.lit(".bw")) == F.col("__f"), "left").drop("__f")
        own = own.join(canonical, canonical_name(F.col(stem)) == F.col("__c"), "left").drop("__c")
    found = [F.coalesce(f"__e{i}", f"__n{i}") for i in range(len(hosts))]
    return own.withColumn("urls", F.array_distinct(F.array_compact(F.array(*found)))).select(*tracks.columns, "urls")


def require_urls(resolved: DataFrame, name: str) -> DataFrame:
    """The rows, or an error that names one without any address."""
    message = F.concat(F.lit("no address for "), F.coalesce(F.col(name).cast("string"), F.lit("null")))
    return resolved.filter(F.when(F.size("urls") > 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def dispatch(tracks: DataFrame, routes: dict[str, object], provider: str = "provider") -> DataFrame:
    """Each provider's rows through its own resolver, all in one union; a row of
    another provider fails."""
    known = F.col(provider).isin(*routes)
    checked = tracks.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unsupported provider: "), F.coalesce(provider, F.lit("null")))).cast("boolean")))
    out = None
    for name, resolve in routes.items():
        part = resolve(checked.filter(F.col(provider) == name))
        out = part if out is None else out.unionByName(part)
    return out


def first_success(attempts: DataFrame, keys: list[str], value: str, priority: str, ok: Column) -> DataFrame:
    """The successful value of the best (lowest) priority for each key."""
    return attempts.filter(ok).groupBy(*keys).agg(F.min_by(value, F.struct(priority, value)).alias(value))


def missing_files(tracks: DataFrame, files: DataFrame, key: str, size: str = "length") -> DataFrame:
    """Tracks without a non-empty file."""
    return tracks.join(files.filter(F.col(size) > 0).select(key), key, "left_anti")


def available(tracks: DataFrame, files: DataFrame, key: str, size: str = "length") -> DataFrame:
    """Tracks that have a non-empty file."""
    return tracks.join(files.filter(F.col(size) > 0).select(key), key, "left_semi")


def numbered(rows: DataFrame, order: list[str], name: str = "row_index", by: list[str] | None = None) -> DataFrame:
    """Row numbers from 0 within ``by``; for manifests, whose rows are few."""
    return rows.withColumn(name, (F.row_number().over(W.partitionBy(*(by or [F.lit(0)])).orderBy(*order)) - 1).cast("long"))


#: The part of a file's metadata that is read.
METADATA = T.StructType([T.StructField("file_format", T.StringType()), T.StructField("href", T.StringType())])


def metadata_urls(answers: DataFrame, body: str, site: str) -> DataFrame:
    """``answers`` with ``url`` from a file's JSON metadata; a file that is no
    bigWig or has no link fails."""
    parsed = answers.withColumn("__m", F.from_json(body, METADATA))
    good = (F.lower("__m.file_format") == "bigwig") & F.col("__m.href").isNotNull()
    checked = parsed.filter(F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("the file's metadata names no bigWig link")).cast("boolean")))
    return checked.withColumn("url", absolute_url(F.lit(site), F.col("__m.href"))).drop("__m")


def reachable_candidates(tracks: DataFrame, candidates: Column, existing: DataFrame, key: str) -> DataFrame:
    """``urls``: the candidates of each track that ``existing(url)`` has, in their
    order; empty where none is."""
    tried = tracks.select(key, F.posexplode(candidates).alias("place", "url")).join(existing.select("url").distinct(), "url", "left_semi")
    found = tried.groupBy(key).agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("place", "url"))), lambda c: c["url"])).alias("urls"))
    return tracks.join(found, key, "left").withColumn("urls", F.coalesce("urls", F.array().cast("array<string>")))


def with_canonical_order(rows: DataFrame, names: tuple[str, ...], column: str = "chrom", rank: str = "chrom_rank") -> DataFrame:
    """``rank`` of each row in a fixed order of names; unknown names come last."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col(column))
    return rows.withColumn(rank, F.when(place == 0, len(names) + 1).otherwise(place))
