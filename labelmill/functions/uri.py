"""Object URIs: parts, names, types, ids and output names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = "gs://"

# MIME type by suffix (case counts), anything else is a pdf.
MIME_BY_SUFFIX = {
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}
DEFAULT_MIME = "application/pdf"

# File format by lower-case extension.
FORMAT_BY_EXTENSION = {
    "pdf": "pdf",
    "ppt": "ppt",
    "pptx": "ppt",
    "doc": "doc",
    "docx": "doc",
    "html": "html",
    "htm": "html",
    "txt": "string_link",
}

# Fixed value: the folder for shards of documents too large for a direct call.
CHUNK_FOLDER = "temp_async_output"

# Extensions a batch accepts, in any case.
SUPPORTED_EXTENSIONS = ["pptx", "pdf", "docx"]


def has_scheme(uri: Column) -> Column:
    return F.coalesce(F.startswith(uri, F.lit(SCHEME)), F.lit(False))


def _after_scheme(uri: Column) -> Column:
    return F.substring(uri, len(SCHEME) + 1, 2**31 - 1)


def bucket(uri: Column) -> Column:
    """Bucket of an object URI; null for anything else."""
    return F.when(has_scheme(uri), F.substring_index(_after_scheme(uri), "/", 1))


def key(uri: Column) -> Column:
    """Object key, ``''`` when there is none; null for a foreign URI."""
    rest = _after_scheme(uri)
    begin = F.length(F.substring_index(rest, "/", 1)) + 2
    return F.when(has_scheme(uri), rest.substr(begin, F.length(rest)))


def uri_status(uri: Column) -> Column:
    return F.when(has_scheme(uri), F.lit("ok")).otherwise(F.lit("invalid_uri"))


def file_name(uri: Column) -> Column:
    """Text after the last slash; ``unknown`` when there is no URI at all."""
    return F.when(
        F.coalesce(uri, F.lit("")) == "", F.lit("unknown")
    ).otherwise(F.substring_index(uri, "/", -1))


def mime_type(uri: Column) -> Column:
    kind = F.lit(DEFAULT_MIME)
    for suffix, mime in MIME_BY_SUFFIX.items():
        kind = F.when(F.endswith(uri, F.lit(suffix)), F.lit(mime)).otherwise(kind)
    return kind


def file_format(name: Column, source_type: Column | None = None) -> Column:
    """Format from the extension; a video has its own, whatever its name."""
    pairs = [F.lit(x) for pair in FORMAT_BY_EXTENSION.items() for x in pair]
    extension = F.lower(F.substring_index(name, ".", -1))
    known = F.try_element_at(F.create_map(*pairs), extension)
    by_name = F.when(F.contains(name, F.lit(".")), known)
    result = F.coalesce(by_name, F.lit("unknown"))
    if source_type is None:
        return result
    return F.when(source_type == "video", F.lit("video")).otherwise(result)


def is_supported(uri: Column) -> Column:
    return F.lower(uri).rlike(rf"[.]({'|'.join(SUPPORTED_EXTENSIONS)})\z")


def document_id(name: Column, at: Column) -> Column:
    """Name before its first dot, made safe, and the run's time."""
    stem = F.regexp_replace(F.substring_index(name, ".", 1), r"[^\p{L}\p{N}_\-]", "_")
    return F.concat_ws("_", stem, F.date_format(at, "yyyyMMddHHmmss"))


def resolve_input(
    input_bucket: Column, prefix: Column, folder: Column, path: Column
) -> Column:
    """Where a job lists its input: the first setting that is given wins.

    A bucket with its prefix, else a folder, else the path up to its first
    ``*`` (whatever follows the star is ignored). Null when nothing fits.
    """
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    starred = given(path) & F.contains(path, F.lit("*"))
    return (
        F.when(
            given(input_bucket),
            F.concat(F.lit(SCHEME), input_bucket, F.lit("/"), F.coalesce(prefix, F.lit(""))),
        )
        .when(given(folder), folder)
        .when(starred, F.substring_index(path, "*", 1))
    )


def _joined(folder: Column, name: Column) -> Column:
    return F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), name)


def base_name(name: Column) -> Column:
    """Name without its last extension."""
    return F.when(
        F.contains(name, F.lit(".")),
        F.substring(name, F.lit(1), F.length(name) - F.length(F.substring_index(name, ".", -1)) - 1),
    ).otherwise(name)


def csv_path(folder: Column, name: Column) -> Column:
    """Output path of a CSV; the suffix is added only where it is missing."""
    full = F.when(F.endswith(name, F.lit(".csv")), name).otherwise(
        F.concat(name, F.lit(".csv"))
    )
    return _joined(folder, full)


def document_csv_path(folder: Column, uri: Column) -> Column:
    return csv_path(folder, F.concat(base_name(F.substring_index(uri, "/", -1)), F.lit("_metadata.csv")))


def batch_csv_path(folder: Column, at: Column) -> Column:
    stamp = F.date_format(at, "yyyyMMdd_HHmmss")
    return csv_path(folder, F.concat(F.lit("batch_metadata_"), stamp))


def video_csv_path(folder: Column, video: Column, at: Column) -> Column:
    stamp = F.date_format(at, "yyyyMMdd_HHmmss")
    return csv_path(folder, F.concat(F.lit("video_"), video, F.lit("_"), stamp, F.lit("_metadata")))


def sidecar_path(folder: Column, name: Column) -> Column:
    """Path of the text kept beside the metadata."""
    return _joined(folder, F.concat(F.lit("parsing/"), name, F.lit(".txt")))


def chunk_prefix(output_bucket: Column, uri: Column, at: Column) -> Column:
    """Where the shards of a document too large for a direct call are put."""
    return F.concat(
        F.lit(SCHEME),
        output_bucket,
        F.lit(f"/{CHUNK_FOLDER}/"),
        F.date_format(at, "yyyyMMdd_HHmmss"),
        F.lit("/"),
        F.substring_index(uri, "/", -1),
        F.lit("/"),
    )


def chunk_folder(uri: Column) -> Column:
    """Run and document folder of a shard or of a ``chunk_prefix``, else ``''``.

    Scheme and bucket are left out: a store may list them in another form.
    """
    return F.regexp_extract(uri, rf"(?:^|/)({CHUNK_FOLDER}/[^/]+/[^/]+/)", 1)
