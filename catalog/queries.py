"""One query per operator, over the given tables."""

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I
from labelmill.functions import anchors, answers, rules, text, uri, videos
from labelmill.operators import (
    assemble,
    extraction,
    labelling,
    media,
    quality,
    recognition,
    records,
    report,
    routing,
    shards,
    video,
)
from labelmill.plans import batch
from labelmill.plans import video as video_plan
from labelmill.schema import METADATA_COLUMNS
from labelmill.session import scratch_path, stored
from labelmill.sinks.tables import write_by_uri, write_metadata_csv, write_text_sidecar
from labelmill.sources.tables import read_metadata_csv

RUN_AT = datetime(2024, 1, 29, 14, 30, 5)
RUN_DATE = "2024-01-29"
ROUTE_LIMIT = 10_000
PART_CHARS = assemble.PART_CHARS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _at():
    return F.lit(RUN_AT.isoformat(sep=" ")).cast("timestamp_ntz")


# --- listing, routing, names ---------------------------------------------------


@query
def file_manifest(spark, sf_dir):
    return routing.select_objects(I.listing(spark, sf_dir)).select(
        "uri", "length", "file_name", "mime_type"
    )


@query
def object_info(spark, sf_dir):
    created = F.timestamp_seconds(F.lit(1_700_000_000) + F.col(I.DOC_ID) * 3601)
    listed = I.listing(spark, sf_dir).withColumn(
        "modificationTime", F.when(F.col(I.DOC_ID) % 7 > 0, created)
    )
    return routing.object_info(listed)


@query
def resolve_inputs(spark, sf_dir):
    c = F.col
    base = uri.resolve_input(c("input_bucket"), c("prefix"), c("folder"), c("path"))
    jobs = I.job_settings(spark, sf_dir).select(I.DOC_ID, base.alias("base"))
    return jobs.select(
        I.DOC_ID, uri.bucket(c("base")).alias("bucket"), uri.key(c("base")).alias("prefix")
    )


@query
def supported_files(spark, sf_dir):
    return routing.supported_files(I.listing(spark, sf_dir)).select("uri", "length")


@query
def size_route(spark, sf_dir):
    route = routing.size_route(F.col("length"), ROUTE_LIMIT)
    return I.listing(spark, sf_dir).select("uri", "length", route.alias("route"))


def _done(spark, sf_dir):
    reviewed = I.table(spark, sf_dir, "labels").select(I.DOC_ID)
    return I.listing(spark, sf_dir).join(reviewed, I.DOC_ID).select("uri")


@query
def already_processed(spark, sf_dir):
    done = _done(spark, sf_dir)
    return routing.already_processed(I.listing(spark, sf_dir), done).select("uri", "length")


@query
def pending_files(spark, sf_dir):
    done = _done(spark, sf_dir)
    return routing.pending_files(I.listing(spark, sf_dir), done).select("uri", "length")


@query
def pending_by_table(spark, sf_dir):
    """The same against a table bucketed by URI, which two runs have added to."""
    name = f"done_{uuid.uuid4().hex}"
    done = _done(spark, sf_dir).withColumn("at", F.lit(RUN_DATE))
    early = F.xxhash64("uri") % 2 == 0
    write_by_uri(done.filter(early), name, scratch_path(spark, "done"))
    write_by_uri(done.filter(~early), name)
    return routing.pending_files(I.listing(spark, sf_dir), spark.table(name)).select("uri", "length")


@query
def uri_split(spark, sf_dir):
    u = F.col("url")
    stored = F.concat(
        F.lit("gs://"), F.regexp_replace("url", "^https?://", "")
    )
    both = I.table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, u).otherwise(stored).alias("uri")
    )
    return both.select(
        "page_id",
        uri.bucket(F.col("uri")).alias("bucket"),
        uri.key(F.col("uri")).alias("key"),
        uri.uri_status(F.col("uri")).alias("status"),
    )


@query
def mime_type(spark, sf_dir):
    return I.listing(spark, sf_dir).select("uri", uri.mime_type(F.col("uri")).alias("mime_type"))


@query
def file_format(spark, sf_dir):
    name = uri.file_name(F.col("uri"))
    kind = F.when(F.col(I.DOC_ID) % 13 == 0, "video").otherwise("document")
    return I.listing(spark, sf_dir).select(
        "uri", uri.file_format(name, kind).alias("file_format")
    )


@query
def document_id(spark, sf_dir):
    name = uri.file_name(F.col("uri"))
    return I.listing(spark, sf_dir).select(
        I.DOC_ID, uri.document_id(name, _at()).alias("document_id")
    )


@query
def output_names(spark, sf_dir):
    return batch.output_names(I.listing(spark, sf_dir), "out/metadata//", RUN_AT)


# --- texts -----------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return I.texts(spark, sf_dir).select(
        I.DOC_ID, text.clean_text(F.col("full_text")).alias("cleaned")
    )


@query
def prompt_text(spark, sf_dir):
    return labelling.label_requests(I.texts(spark, sf_dir))


def _parsed_shards(spark, sf_dir):
    return shards.parse_shards(I.shard_files(spark, sf_dir))


def _merged(spark, sf_dir):
    parsed = _parsed_shards(spark, sf_dir)
    return shards.merge_shards(parsed, chars=PART_CHARS, size=F.col("length"))


@query
def anchor_slice(spark, sf_dir):
    cut = F.transform(
        F.flatten(F.transform("pages", lambda p: p["paragraphs"])), lambda q: q["segments"]
    )
    all_segments = F.flatten(cut)
    return _parsed_shards(spark, sf_dir).select(
        "shard_uri", anchors.anchor_text(F.col("text"), all_segments).alias("anchored")
    )


@query
def page_text(spark, sf_dir):
    pages = F.explode(anchors.page_texts(F.col("text"), F.col("pages")))
    return _parsed_shards(spark, sf_dir).select("shard_uri", pages.alias("p")).select(
        "shard_uri", F.col("p.page_number").cast("bigint").alias("page_number"), "p.text"
    )


@query
def shard_merge(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    numbers = F.transform("pages", lambda p: p["page_number"].cast("string"))
    mentions = F.transform(
        "entities", lambda e: F.concat(e["mention_text"], F.lit("@"), e["confidence"].cast("string"))
    )
    return merged.select(
        "uri",
        "part",
        "start",
        "mime_type",
        "full_text",
        F.array_join(numbers, ",").alias("page_numbers"),
        F.array_join("pages.text", "|").alias("page_texts"),
        F.array_join(mentions, ",").alias("mentions"),
        "status",
    )


@query
def shard_owner(spark, sf_dir):
    """Shard files below the folders of their documents, told apart by path alone."""
    u = F.col("uri")
    folder = uri.chunk_prefix(uri.bucket(u), u, _at())
    files = I.shard_files(spark, sf_dir).select(
        F.concat(folder, F.lit("job/0/"), uri.file_name(F.col("shard_uri"))).alias("shard_uri"),
        "length",
    )
    names = batch.output_names(I.listing(spark, sf_dir), "out", RUN_AT)
    return shards.owned_shards(files, names).select("uri", "shard_uri", "length")


@query
def page_stats(spark, sf_dir):
    return shards.page_stats(_parsed_shards(spark, sf_dir))


@query
def entity_list(spark, sf_dir):
    return shards.entity_list(_parsed_shards(spark, sf_dir))


@query
def text_sidecar(spark, sf_dir):
    path = scratch_path(spark, "sidecar")
    write_text_sidecar(I.texts(spark, sf_dir), path, "first")
    write_text_sidecar(I.texts(spark, sf_dir), path, "second")
    write_text_sidecar(I.texts(spark, sf_dir), path, "second")
    return spark.read.parquet(path).select("uri", "part", "full_text", "run")


@query
def extract_documents(spark, sf_dir):
    files = I.texts(spark, sf_dir).select("uri", F.encode("full_text", "UTF-8").alias("content"))
    found = extraction.extract_documents(files, extraction.plain_text)
    return found.select(
        "uri",
        "mime_type",
        "full_text",
        F.size("pages").cast("bigint").alias("page_count"),
        F.array_join("pages.text", "\f").alias("page_texts"),
        F.size("entities").cast("bigint").alias("entity_count"),
        "status",
    )


# --- answers and records ------------------------------------------------------------


@query
def strip_fences(spark, sf_dir):
    return I.answers(spark, sf_dir).select(
        I.DOC_ID, text.strip_fences(F.col("response")).alias("body")
    )


@query
def response_parse(spark, sf_dir):
    return labelling.parse_responses(I.answers(spark, sf_dir), RUN_DATE).select(
        "uri", "status", "file_format", "content_summary"
    )


@query
def metadata_defaults(spark, sf_dir):
    parsed = labelling.parse_responses(I.answers(spark, sf_dir), RUN_DATE)
    return parsed.select("uri", *METADATA_COLUMNS)


@query
def quarantine(spark, sf_dir):
    parsed = labelling.parse_responses(I.answers(spark, sf_dir), RUN_DATE)
    return routing.split_quarantine(parsed)[1].select("uri", "status")


@query
def status_counts(spark, sf_dir):
    return routing.status_counts(labelling.parse_responses(I.answers(spark, sf_dir), RUN_DATE))


@query
def flatten_records(spark, sf_dir):
    stored = I.answers(spark, sf_dir).select("uri", F.col("response").alias("record"))
    return records.flatten_records(stored)


@query
def label_documents(spark, sf_dir):
    def labeler(request: str) -> str:
        if "$" in request:
            raise ValueError("no prices, please")
        kind = "FAQ" if "?" in request else "카탈로그"
        return f'```json\n{{"metadata": {{"source": "{kind}"}}, "content_summary": "{len(request)}"}}\n```'

    labelled = labelling.label_documents(I.texts(spark, sf_dir), labeler, RUN_DATE)
    return labelled.select("uri", "type", "source", "file_format", "content_summary", "status", "error")


@query
def label_store(spark, sf_dir):
    """Labelled twice with one store: the second time by a labeler that knows no answer."""

    def labeler(request: str) -> str:
        return f'{{"metadata": {{"type": "FAQ"}}, "content_summary": "{len(request)}"}}'

    def silent(request: str) -> str:
        raise ValueError("asked again")

    store = scratch_path(spark, "store")
    texts = I.texts(spark, sf_dir)
    labelling.label_documents(texts, labeler, RUN_DATE, store=store).write.format("noop").mode("overwrite").save()
    labelled = labelling.label_documents(texts, silent, RUN_DATE, store=store)
    return labelled.select("uri", "type", "file_format", "content_summary", "status", "error")


@query
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_metadata_csv(I.records(spark, sf_dir), path)
    return read_metadata_csv(spark, path)


@query
def append_records(spark, sf_dir):
    existing = I.records(spark, sf_dir)
    reviewed = I.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("gs://reviewed/"), F.col("doc_id").cast("string")).alias("uri"),
        F.when(F.col("quality") == 1, "기술정보").otherwise("UNKNOWN").alias("type"),
        F.lit("NULL").alias("version"),
    )
    return records.append_records(
        existing.select("uri", "type", "version", "year1", "updated_at"), reviewed
    )


# --- reports ---------------------------------------------------------------------------


@query
def distribution_report(spark, sf_dir):
    return report.distribution_report(I.records(spark, sf_dir))


@query
def report_order(spark, sf_dir):
    """The report in the order in which it is printed."""
    return report.placed_report(report.distribution_report(I.records(spark, sf_dir)))


@query
def xev_distribution(spark, sf_dir):
    return report.xev_distribution(I.records(spark, sf_dir))


@query
def top_models(spark, sf_dir):
    return report.top_models(I.records(spark, sf_dir))


@query
def report_totals(spark, sf_dir):
    return report.report_totals(I.records(spark, sf_dir))


def _earlier(spark, sf_dir):
    docs = I.told(spark, sf_dir).withColumn("page_count", F.ceil(F.length("full_text") / 1000))
    kind = F.when(F.col(I.DOC_ID) % 13 == 0, "video").otherwise("document")
    return records.earlier_projection(docs, I.MODELS, _at(), kind)


@query
def earlier_projection(spark, sf_dir):
    return _earlier(spark, sf_dir)


@query
def earlier_report(spark, sf_dir):
    return report.earlier_report(_earlier(spark, sf_dir))


# --- quality ------------------------------------------------------------------------------


@query
def domain_violations(spark, sf_dir):
    return quality.domain_violations(
        I.records(spark, sf_dir), I.DOC_ID, I.countries(spark, sf_dir)
    )


@query
def region_country_check(spark, sf_dir):
    return quality.region_country_check(
        I.located(spark, sf_dir), I.countries(spark, sf_dir), I.DOC_ID
    )


@query
def label_accuracy(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    generated = docs.select(
        I.DOC_ID,
        F.when(F.col("n_chars") >= 300, "1").otherwise("0").alias("quality"),
        F.lit("0").alias("toxic"),
    )
    reviewed = I.table(spark, sf_dir, "labels").select(
        I.DOC_ID, F.col("quality").cast("string").alias("quality"),
        F.col("toxic").cast("string").alias("toxic"),
    )
    return quality.label_accuracy(generated, reviewed, ["quality", "toxic"], I.DOC_ID)


# --- rules -----------------------------------------------------------------------------------


@query
def model_recognise(spark, sf_dir):
    return I.told(spark, sf_dir).select(
        I.DOC_ID, rules.model_name(F.col("full_text"), I.MODELS).alias("model")
    )


@query
def model_dictionary(spark, sf_dir):
    """The first name of a dictionary table in every text."""
    names = stored(recognition.dictionary(I.lexicon(spark, sf_dir)), "names")
    return recognition.recognise(I.told(spark, sf_dir), I.DOC_ID, "full_text", names)


@query
def type_classify(spark, sf_dir):
    told = F.col("full_text")
    return I.told(spark, sf_dir).select(
        I.DOC_ID,
        rules.car_type(told).alias("car_type"),
        rules.engine_type(told).alias("engine_type"),
        rules.xev_type(told).alias("xev"),
    )


@query
def price_extract(spark, sf_dir):
    return records.price_rows(I.told(spark, sf_dir), I.DOC_ID, "full_text")


@query
def keyword_topk(spark, sf_dir):
    return records.keyword_topk(I.texts(spark, sf_dir), I.DOC_ID, "full_text")


@query
def summary_paragraph(spark, sf_dir):
    return I.texts(spark, sf_dir).select(
        I.DOC_ID, text.summary_paragraph(F.col("full_text")).alias("summary")
    )


@query
def language_tag(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select(
        I.DOC_ID, rules.language_tag(F.col("lang")).alias("language")
    )


@query
def model_years(spark, sf_dir):
    found = I.told(spark, sf_dir).select(
        I.DOC_ID, rules.model_years(F.col("full_text")).alias("years")
    )
    return found.select(
        I.DOC_ID, F.array_min("years").alias("year1"), F.array_max("years").alias("year2")
    )


# --- videos --------------------------------------------------------------------------------


@query
def video_id(spark, sf_dir):
    ids = I.video_urls(spark, sf_dir).select(
        "page_id", videos.video_id(F.col("url")).alias("video_id")
    )
    return ids.withColumn(
        "status", F.when(F.col("video_id").isNull(), "not_a_video").otherwise("ok")
    )


@query
def video_info(spark, sf_dir):
    return video.video_info(I.video_answers(spark, sf_dir))


@query
def caption_tracks(spark, sf_dir):
    return video.caption_tracks(I.caption_answers(spark, sf_dir))


@query
def transcript_select(spark, sf_dir):
    return video.select_tracks(I.spoken_tracks(spark, sf_dir))


@query
def transcript_text(spark, sf_dir):
    return video.transcript_texts(I.spoken_lines(spark, sf_dir), chars=PART_CHARS)


def _videos(spark, sf_dir):
    ids = video_plan.video_ids(I.video_urls(spark, sf_dir))
    documents = video_plan.distinct_videos(
        ids,
        I.video_answers(spark, sf_dir),
        I.spoken_tracks(spark, sf_dir),
        I.spoken_lines(spark, sf_dir),
        PART_CHARS,
    )
    return ids, documents


@query
def video_document(spark, sf_dir):
    """The text that every URL leads to; URLs without one keep a status row."""
    ids, documents = _videos(spark, sf_dir)
    return video_plan.documents_of_urls(ids, stored(documents, "videos"))


@query
def video_reference(spark, sf_dir):
    """The text that every URL leads to, by id."""
    ids, documents = _videos(spark, sf_dir)
    return video_plan.references_of_urls(ids, stored(documents, "videos"))


@query
def media_transcript(spark, sf_dir):
    """Recordings put together from the segments they were transcribed in."""
    return media.media_transcripts(I.spoken_segments(spark, sf_dir), chars=PART_CHARS)


# --- whole jobs --------------------------------------------------------------------------------


def _labelled(spark, sf_dir):
    listed = routing.select_objects(I.told(spark, sf_dir))
    return labelling.rule_labels(
        routing.supported_files(listed), I.MODELS, RUN_DATE, language=F.col("lang")
    )


@query
def batch_records(spark, sf_dir):
    """Listed, filtered, labelled by rules: the 13 columns."""
    return _labelled(spark, sf_dir)


@query
def batch_report(spark, sf_dir):
    """The report on the records of a batch."""
    return report.distribution_report(_labelled(spark, sf_dir))


@query
def video_records(spark, sf_dir):
    """Videos to the 13 columns."""
    ids, found = _videos(spark, sf_dir)
    documents = stored(found, "videos")
    good = routing.split_quarantine(documents)[0]
    labels = video_plan.video_records(good, RUN_DATE, I.MODELS)
    records = video_plan.records_of_urls(ids, documents, labels)
    return records.filter("found = 'ok'").select("uri", *METADATA_COLUMNS)
