"""Scalar expressions on names, identifiers and sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Base codes of a sequence; every other character is 4.
BASES = "ACGTacgt"
CODES = "01230123"

#: Path parts in order, with the assay and provider they mean.
ASSAYS = (
    ("/rna/encode/", "RNA-seq", "ENCODE"),
    ("/dnase/encode/", "DNase-seq", "ENCODE"),
    ("/rna/recount3/", "RNA-seq", "recount3/GTEx"),
    ("/cage/fantom/", "CAGE", "FANTOM5"),
    ("/atac/catlas/", "ATAC-seq", "CATlas"),
)
EXCLUDED = "exclude"

#: Address forms of the providers.
ENCODE_FILE = "https://www.encodeproject.org/files/"
FANTOM_PORTAL = "https://fantom.gsc.riken.jp/5/"
RECOUNT_PORTAL = "https://rna.recount.bio/"
CATLAS_PORTAL = "http://catlas.org/humanenhancer/"
BASE_SUMS = "/human/data_sources/gtex/base_sums/"

SOURCE_FIELDS = ("provider", "file_accession", "api_url", "download_base_url", "sample_id", "project", "track_id", "portal")


class _Digits(dict):
    """Digits by code point; all that is no base is ``4``."""

    def __missing__(self, code: int) -> str:
        return "4"


DIGITS = _Digits({ord(base): code for base, code in zip(BASES, CODES)})


@pandas_udf(T.StringType())
def encode_sequence(seq: pd.Series) -> pd.Series:
    """Digits 0-4 of a sequence, one for each character (a batch at a time: the
    built-in functions replace characters one by one, far slower)."""
    return seq.map(lambda s: s.translate(DIGITS), na_action="ignore")


@pandas_udf(T.ArrayType(T.ByteType()))
def sequence_codes(seq: pd.Series) -> pd.Series:
    """``encode_sequence`` as array<tinyint>."""
    return seq.map(lambda s: np.frombuffer(s.translate(DIGITS).encode(), np.int8) - 48, na_action="ignore")


def safe_filename(name: Column) -> Column:
    """Runs of characters outside ``[A-Za-z0-9_.+-]`` as one ``_``; none at the ends."""
    return F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_.+-]+", "_"), "^_+|_+$", "")


def canonical_name(name: Column) -> Column:
    """Lower-case letters and digits of a file name without its ``.bw``."""
    return F.regexp_replace(F.lower(F.regexp_replace(name, "(?i)\\.bw$", "")), "[^a-z0-9]", "")


def classify_path(path: Column) -> Column:
    """Struct (assay, provider) by the first path part found, else excluded."""
    low = F.lower(F.coalesce(path, F.lit("")))
    found = None
    for part, assay, provider in ASSAYS:
        value = F.struct(F.lit(assay).alias("assay"), F.lit(provider).alias("provider"))
        found = F.when(low.contains(part), value) if found is None else found.when(low.contains(part), value)
    return found.otherwise(F.struct(F.lit(EXCLUDED).alias("assay"), F.lit(EXCLUDED).alias("provider")))


def split_strand(identifier: Column) -> Column:
    """Struct (stable_id, strand): one trailing sign taken off, else ``.``."""
    sign = F.right(identifier, F.lit(1))
    signed = sign.isin("+", "-")
    return F.struct(F.when(signed, F.substring(identifier, F.lit(1), F.length(identifier) - 1)).otherwise(identifier).alias("stable_id"), F.when(signed, sign).otherwise(F.lit(".")).alias("strand"))


def accession(identifier: Column) -> Column:
    """All trailing signs taken off."""
    return F.regexp_replace(identifier, "[+-]+$", "")


def source_struct(provider: Column, stable_id: Column) -> Column:
    """The union of the providers' source records; an unknown provider fails."""
    fields = {
        "ENCODE": {"provider": F.lit("ENCODE"), "file_accession": stable_id, "api_url": F.concat(F.lit(ENCODE_FILE), stable_id, F.lit("/?format=json")), "download_base_url": F.concat(F.lit(ENCODE_FILE), stable_id, F.lit("/@@download/"))},
        "FANTOM5": {"provider": F.lit("FANTOM5"), "sample_id": stable_id, "portal": F.lit(FANTOM_PORTAL)},
        "recount3/GTEx": {"provider": F.lit("recount3"), "sample_id": stable_id, "project": F.lit("GTEx"), "portal": F.lit(RECOUNT_PORTAL)},
        "CATlas": {"provider": F.lit("CATlas"), "track_id": stable_id, "portal": F.lit(CATLAS_PORTAL)},
    }
    made = None
    for name, own in fields.items():
        record = F.struct(*[own.get(f, F.lit(None).cast("string")).cast("string").alias(f) for f in SOURCE_FIELDS])
        made = F.when(provider == name, record) if made is None else made.when(provider == name, record)
    return made.otherwise(F.raise_error(F.concat(F.lit("unsupported provider: "), F.coalesce(provider, F.lit("null")))).cast(f"struct<{','.join(f + ':string' for f in SOURCE_FIELDS)}>"))


def study_spellings(description: Column) -> Column:
    """Ordered distinct spellings of the text after the first colon (or all)."""
    tail = F.when(description.contains(":"), F.substring(description, F.locate(":", description) + 1, F.length(description))).otherwise(description)
    upper = F.upper(F.trim(F.coalesce(tail, F.lit(""))))
    under = F.replace(upper, F.lit(" "), F.lit("_"))
    return F.array_distinct(F.array(upper, under, F.replace(upper, F.lit("-"), F.lit("_")), F.replace(under, F.lit("-"), F.lit("_"))))


def base_sum_urls(description: Column, sample: Column, mirrors: Column) -> Column:
    """Candidate addresses: every spelling, and for each every mirror in order."""
    bare = F.regexp_replace(sample, "\\.\\d+$", "")
    tail = F.right(bare, F.lit(2))
    return F.array_distinct(F.flatten(F.transform(study_spellings(description), lambda study: F.transform(mirrors, lambda m: F.concat(m, F.lit(BASE_SUMS), F.right(study, F.lit(2)), F.lit("/"), study, F.lit("/"), tail, F.lit("/gtex.base_sums."), study, F.lit("_"), sample, F.lit(".ALL.bw"))))))


def library_and_strand(filename: Column, any_case: bool) -> Column:
    """Struct (library, strand) of a tag-count file name; null where either is
    missing. ``any_case`` also takes the library id in other cases."""
    library = F.regexp_extract(filename, f"{'(?i)' if any_case else ''}(CNhs\\d+)", 1)
    low = F.lower(filename)
    strand = F.when(low.contains(".ctss.fwd.bw"), F.lit("+")).when(low.contains(".ctss.rev.bw"), F.lit("-"))
    return F.when((library != "") & strand.isNotNull(), F.struct(library.alias("library"), strand.alias("strand")))


def file_stem(path: Column) -> Column:
    """The last path part without its final suffix."""
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), "(?<=.)\\.[^.]*$", "")


def hrefs(html: Column, suffix: str = ".bw") -> Column:
    """Link targets that end in ``suffix`` in any case, in document order."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    return F.filter(found, lambda h: F.lower(h).endswith(suffix.lower()))


def _solved(path: Column) -> Column:
    """A rooted path without its ``.`` and ``..`` parts."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    empty = F.array().cast("array<string>")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, empty, step)
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")))


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` against ``base``: full addresses stay, those that begin with two
    slashes take the scheme, rooted ones the host, others the folder of the base;
    ``.`` and ``..`` are solved, a lone query or fragment follows the base."""
    bare, marked = F.regexp_replace(base, "[?#].*$", ""), F.regexp_replace(base, "#.*$", "")
    scheme = F.regexp_extract(bare, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    host = F.regexp_extract(bare, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*)", 1)
    folder = F.regexp_replace(F.substring(bare, F.length(host) + 1, F.length(bare)), "[^/]*$", "")
    joined = F.when(href.startswith("/"), href).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), href))
    path, tail = F.regexp_replace(joined, "[?#].*$", ""), F.regexp_extract(joined, "([?#].*)$", 1)
    plain = F.when(path.contains("/."), _solved(path)).otherwise(path)
    whole = F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href))
    return whole.when(href == "", base).when(href.startswith("?"), F.concat(bare, href)).when(href.startswith("#"), F.concat(marked, href)).otherwise(F.concat(host, plain, tail))


def shard_name(split: Column, number: Column) -> Column:
    return F.format_string("%s-%05d", split, number)


def one_line(message: Column) -> Column:
    """Tabs and line ends as spaces."""
    return F.translate(message, "\t\n\r", "   ")


def label(*parts: Column) -> Column:
    """Parts joined by `` | ``; a null part reads ``None``."""
    return F.concat_ws(" | ", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def whole_number(value: Column) -> Column:
    """An integer, or null where the text is none."""
    return F.trim(value.cast("string")).try_cast("long")


def cleaned(value: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(value), value)


def file_size(content_range: Column, content_length: Column) -> Column:
    """Size from ``Content-Range`` (after the slash), else ``Content-Length``."""
    total = F.regexp_extract(F.coalesce(content_range, F.lit("")), r"/(\d+)$", 1)
    return F.when(total != "", total.cast("long")).otherwise(whole_number(content_length))
