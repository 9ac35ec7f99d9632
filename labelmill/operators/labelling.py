"""Documents to labels: by text rules, or by a function the caller brings."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import answers as A
from labelmill.functions import rules as R
from labelmill.functions import text as X
from labelmill.functions import uri as U
from labelmill.operators.assemble import PART_CHARS, head_text, told_apart, whole_lines
from labelmill.operators.recognition import UNKNOWN, first_names
from labelmill.operators.skew import join_hot, join_narrow
from labelmill.schema import FIELD_DEFAULTS, METADATA_COLUMNS, REQUEST_TEXT_CHARS
from labelmill.session import configure, stored

# What an answer store holds, and bytes of an answer beside a document.
ANSWERS = "digest string, response string"
ANSWER_BYTES = 8_000


def label_requests(documents: DataFrame, source_type: str = "document") -> DataFrame:
    """``(uri, file_format, request)`` of documents ``(uri, part, full_text)``.

    The text is cut here, before any Python worker sees it. A document kept in
    several parts is sent with the beginning of its parts in order. A repeated
    ``uri`` gives a request for each of its documents.
    """
    fmt = U.file_format(U.file_name(F.col("uri")), F.lit(source_type))
    whole = documents.filter(F.col("part") == "").select(
        "uri", X.request_text(F.coalesce("full_text", F.lit(""))).alias("head")
    )
    heads = head_text(_parts(documents), "_doc", "part", "full_text", REQUEST_TEXT_CHARS)
    beginnings = whole.unionByName(heads.select("_doc.uri", "head"))
    return beginnings.select(
        "uri",
        fmt.alias("file_format"),
        X.label_request(fmt, F.col("head")).alias("request"),
    )


def ask_labeler(
    requests: DataFrame, labeler: Callable[[str], str], partitions: int | None = None
) -> DataFrame:
    """Add ``response`` and ``error`` by calling ``labeler`` once per request.

    Calls run in Python workers. These are sent the requests alone, a hundred at
    a time: a worker's memory depends neither on the rows of its task nor on
    the Arrow batches of the session. A call that fails costs its own row only:
    its response is null and ``error`` says why. ``partitions`` spreads the
    calls when the input has too few partitions.
    """
    if partitions:
        requests = requests.repartition(partitions)

    def call(request: str) -> tuple[str | None, str | None]:
        try:
            response = labeler(request)
            if not isinstance(response, str):
                raise TypeError(f"labeler returned {type(response).__name__}")
            return str.__str__(response), None  # subclasses of str have no place in a row
        except Exception as e:  # one bad document must not stop the others
            return None, f"{type(e).__name__}: {e}"

    # Not deterministic, so that no step of a plan repeats or moves the calls.
    ask = F.udf(call, "response STRING, error STRING", useArrow=False).asNondeterministic()
    asked = requests.select("uri", "file_format", ask("request").alias("_answer"))
    return asked.select("uri", "file_format", "_answer.response", "_answer.error")


def answers_in(spark: SparkSession, store: str) -> DataFrame:
    """``(digest, response)`` kept at ``store``, one row per request."""
    kept = spark.read.schema(ANSWERS).parquet(store)
    return kept.groupBy("digest").agg(F.min("response").alias("response"))


def ask_once(
    requests: DataFrame, labeler: Callable[[str], str], store: str, partitions: int | None = None
) -> DataFrame:
    """``ask_labeler`` with a memory: requests whose answers are kept at ``store`` are not sent.

    Equal requests are sent once, however many documents they stand for, and
    their answer is kept for later runs; a failed call is not, so it is tried
    again. ``store`` is a folder of its own on storage the executors share.
    """
    spark = requests.sparkSession
    spark.createDataFrame([], ANSWERS).write.mode("ignore").parquet(store)
    digest = F.sha2(F.col("request"), 256).alias("digest")
    asked = stored(requests.select("uri", "file_format", "request", digest), "requests")
    new = asked.select("digest", "request").dropDuplicates(["digest"])
    new = new.join(answers_in(spark, store), "digest", "left_anti")
    sent = new.select(F.col("digest").alias("uri"), F.lit("").alias("file_format"), "request")
    answered = stored(ask_labeler(sent, labeler, partitions), "answers")
    answered = answered.select(F.col("uri").alias("digest"), "response", "error")
    answered.filter("error IS NULL").select("digest", "response").write.mode("append").parquet(store)
    failed = answered.filter("error IS NOT NULL")
    known = answers_in(spark, store).unionByName(failed, allowMissingColumns=True)
    documents = asked.select("uri", "file_format", "digest")
    return join_hot(documents, known, "digest", F.col("uri"), ANSWER_BYTES).drop("digest")


def parse_responses(responses: DataFrame, run_date: str) -> DataFrame:
    """Responses to ``uri``, 13 metadata columns, ``status`` and ``error``.

    Whatever is wrong with an answer, its document keeps a row: the default
    record, with ``status`` naming the reason.
    """
    configure(responses.sparkSession)
    error = F.col("error") if "error" in responses.columns else F.lit(None).cast("string")
    parsed = responses.select(
        "uri",
        "file_format",
        error.alias("error"),
        A.parse_answer(F.col("response")).alias("parsed"),
    )
    judged = parsed.withColumn("labels", A.labels_of(F.col("parsed"))).withColumn(
        "status",
        F.when(F.col("error").isNotNull(), "labeler_error").otherwise(
            A.answer_status(F.col("parsed"), F.col("labels"))
        ),
    )
    fields = A.answer_fields(
        *[F.col(c) for c in ("parsed", "labels", "status", "file_format")], F.lit(run_date)
    )
    return judged.select("uri", *fields, "status", "error")


def label_documents(
    documents: DataFrame,
    labeler: Callable[[str], str],
    run_date: str,
    source_type: str = "document",
    partitions: int | None = None,
    store: str | None = None,
) -> DataFrame:
    """Metadata records of documents, labelled by a caller's function.

    With ``store`` answers are kept and used again, see ``ask_once``.
    """
    requests = label_requests(documents, source_type)
    if store:
        return parse_responses(ask_once(requests, labeler, store, partitions), run_date)
    return parse_responses(ask_labeler(requests, labeler, partitions), run_date)


def _parts(documents: DataFrame, *others: Column) -> DataFrame:
    """``(_doc, part, full_text)`` of the documents kept in several parts."""
    text = F.coalesce("full_text", F.lit("")).alias("full_text")
    parted = documents.filter(F.col("part") != "").select("uri", "part", text, *others)
    return told_apart(parted, "uri", "part", "full_text").drop("uri")


def rule_labels(
    documents: DataFrame,
    models: list[str] | DataFrame,
    run_date: str,
    source_type: str = "document",
    language: Column | None = None,
    limit: int = PART_CHARS,
) -> DataFrame:
    """Metadata records by text rules: no service, no Python worker, no shuffle
    for documents in one row.

    ``models`` is a short list of names, or a ``recognition.dictionary`` of any
    length; what it finds is joined to the finished rows, never to texts. What a
    text does not state stays at its default. Documents kept in several
    parts are cut anew at line breaks, judged part by part and combined, with
    the result they would have in one row; only a line above the limit is
    judged in pieces.
    """
    code = F.lit(None).cast("string") if language is None else language
    tag = R.language_tag(code).alias("language")
    text = F.coalesce("full_text", F.lit(""))
    in_one = documents.filter(F.col("part") == "").withColumn("_key", F.struct("uri", F.xxhash64("full_text")))
    whole = in_one.select(
        "_key", "uri", tag, *_findings(text, models), X.summary_paragraph(text).alias("content_summary")
    )
    whole = _named(whole, in_one, models).drop("_key")
    labels = whole.drop("_paragraph").unionByName(
        _combine_parts(_parts(documents, tag), models, limit)
    )
    fmt = U.file_format(U.file_name(F.col("uri")), F.lit(source_type))
    given = set(labels.columns)
    fixed = {**FIELD_DEFAULTS, "updated_at": run_date}
    columns = [
        F.col(c) if c in given
        else fmt.alias(c) if c == "file_format"
        else F.lit(fixed[c]).cast("string").alias(c)
        for c in METADATA_COLUMNS
    ]
    return labels.select("uri", *columns)


def _named(rows: DataFrame, texts: DataFrame, models: list[str] | DataFrame) -> DataFrame:
    """``rows`` with the models that a dictionary finds in ``texts``; both have ``_key``."""
    if not isinstance(models, DataFrame):
        return rows
    found = first_names(texts, "_key", "full_text", models)
    joined = rows.drop("model").join(found, "_key", "left")
    return joined.withColumn("model", F.coalesce("name", F.lit(UNKNOWN))).drop("name")


def _findings(text: Column, models: list[str] | DataFrame) -> list[Column]:
    """What the rules find in a text that is made of whole lines."""
    years = R.model_years(text)
    listed = [] if isinstance(models, DataFrame) else models
    return [
        R.model_name(text, listed).alias("model"),
        R.xev_type(text).alias("xev"),
        F.array_min(years).alias("year1"),
        F.array_max(years).alias("year2"),
        X.long_paragraph(text).alias("_paragraph"),
    ]


def _combine_parts(parts: DataFrame, models: list[str] | DataFrame, limit: int) -> DataFrame:
    """Findings of documents in parts; every step reduces before it shuffles."""
    lines = whole_lines(parts, "_doc", "part", "full_text", limit).withColumn("_key", F.struct("_doc", "part"))
    found = lines.select("_key", "_doc", "part", *_findings(F.col("full_text"), models))
    found = _named(found, lines, models)

    def first(name: str, found_one: Column) -> Column:
        return F.min_by(name, F.when(found_one, F.col("part")))

    combined = found.groupBy("_doc").agg(
        F.coalesce(first("model", F.col("model") != "UNKNOWN"), F.lit("UNKNOWN")).alias("model"),
        F.max("xev").alias("xev"),
        F.min("year1").alias("year1"),
        F.max("year2").alias("year2"),
        first("_paragraph", F.col("_paragraph").isNotNull()).alias("_paragraph"),
    )
    spoken = parts.groupBy("_doc").agg(F.min("language").alias("language"))
    openings = opening_of_parts(parts, X.SUMMARY_FALLBACK)
    return (
        combined.join(spoken, "_doc")
        .join(openings, "_doc", "left")
        .select(
            "_doc.uri",
            "language",
            *[c for c in combined.columns if c not in ("_doc", "_paragraph")],
            F.coalesce("_paragraph", "head", F.lit("")).alias("content_summary"),
        )
    )


def opening_of_parts(parts: DataFrame, chars: int) -> DataFrame:
    """The first characters of each document, white space at its ends ignored."""
    written = X.strip(F.col("full_text")) != ""
    ends = parts.filter(written).groupBy("_doc").agg(
        F.min("part").alias("_first"), F.max("part").alias("_last")
    )
    blanks, text = F.lit(X.WHITESPACE), F.col("full_text")
    text = F.when(F.col("part") == F.col("_first"), F.ltrim(text, blanks)).otherwise(text)
    text = F.when(F.col("part") == F.col("_last"), F.rtrim(text, blanks)).otherwise(text)
    inner = (
        join_narrow(parts, ends, ["_doc"], F.col("part"))
        .filter(F.col("part").between(F.col("_first"), F.col("_last")))
        .select("_doc", "part", F.coalesce(text, F.lit("")).alias("full_text"))
    )
    return head_text(inner, "_doc", "part", "full_text", chars)
