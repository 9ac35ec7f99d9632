"""Record tables: flatten, append, the earlier column layout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.functions import answers as A
from labelmill.functions import rules as R
from labelmill.functions import text as X
from labelmill.functions import uri as U
from labelmill.operators.assemble import told_apart, whole_lines
from labelmill.operators.labelling import opening_of_parts
from labelmill.schema import EARLIER_COLUMNS, METADATA_COLUMNS
from labelmill.session import configure


def flatten_records(records: DataFrame, column: str = "record") -> DataFrame:
    """JSON records, nested or flat, to the 13 columns and ``status``."""
    configure(records.sparkSession)
    others = [c for c in records.columns if c != column]
    record, nested = F.col("_record"), F.col("_nested")
    parsed = (
        records.withColumn("_record", A.parse_strict(F.col(column)))
        .withColumn("_nested", A.labels_of(record))
        .withColumn("status", A.record_status(record, nested))
    )
    return parsed.select(*others, *A.record_fields(record, nested, F.col("status")), "status")


def metadata_table(records: DataFrame) -> DataFrame:
    """The fixed 13 columns in their order."""
    return records.select(*METADATA_COLUMNS)


def append_records(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """All old rows and all new ones, columns matched by name.

    Without an existing table the new rows are the result. Values stay texts:
    nothing is typed anew.
    """
    if existing is None:
        return new
    return existing.unionByName(new, allowMissingColumns=True)


def price_rows(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, currency, amount)`` of every amount in a text."""
    return documents.select(key, F.explode(R.prices(F.col(text))).alias("p")).select(
        key, "p.currency", "p.amount"
    )


def keyword_topk(documents: DataFrame, key: str, text: str, k: int = 10) -> DataFrame:
    """``(key, rank, word, n)``: the most frequent words of each row's text.

    Counted inside the row, without a shuffle.
    """
    counted = documents.select(key, R.word_counts(F.col(text)).alias("_counts"))
    return counted.select(key, F.explode(R.top_words(F.col("_counts"), k)).alias("w")).select(
        key, "w.rank", "w.word", "w.n"
    )


def keyword_topk_of_parts(parts: DataFrame, key: str, text: str, k: int = 10) -> DataFrame:
    """The same for documents that are spread over several rows.

    Each row is counted first, so only distinct words are shuffled, and the
    rank filter is applied before and after the words of a document meet.
    """
    counts = (
        parts.select(key, F.explode(R.word_counts(F.col(text))).alias("c"))
        .groupBy(key, F.col("c.word").alias("word"))
        .agg((-F.sum("c.neg")).alias("n"))
    )
    best = W.partitionBy(key).orderBy(F.desc("n"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(key, F.col("rank").cast("bigint").alias("rank"), "word", "n")


def earlier_projection(
    documents: DataFrame, models: list[str], at: Column, source_type: Column | str = "document"
) -> DataFrame:
    """The earlier 15 columns of documents ``(uri, part, full_text, page_count)``.

    ``features`` and ``specifications`` have no rule and stay null. Documents in
    several parts are cut anew at line breaks; what each piece says is merged to
    what the whole text would say. Without a column ``part`` all are whole.
    ``at`` and ``source_type`` hold for all rows of a document.
    """
    kind = F.lit(source_type) if isinstance(source_type, str) else source_type
    given = documents if "part" in documents.columns else documents.withColumn("part", F.lit(""))
    text = F.coalesce("full_text", F.lit(""))
    rows = given.select(
        "uri", "part", text.alias("full_text"), F.col("page_count").cast("bigint").alias("page_count"),
        at.alias("_time"), kind.alias("source_type"),
    )
    words = F.transform(R.top_words(R.word_counts(F.col("full_text"))), lambda w: w["word"])
    whole = rows.filter(F.col("part") == "").select(
        "uri", "page_count", "_time", "source_type", *_earlier_findings(models),
        F.length("full_text").cast("bigint").alias("text_length"),
        F.array_join(words, ", ").alias("keywords"),
        X.summary_paragraph(F.col("full_text")).alias("summary"),
    )
    found = whole.unionByName(_earlier_of_parts(rows.filter(F.col("part") != ""), models))
    name = U.file_name(F.col("uri"))
    made = {
        "document_id": U.document_id(name, F.col("_time")),
        "file_name": name,
        "upload_date": F.date_format("_time", "yyyy-MM-dd"),
        "features": F.lit(None).cast("string"),
        "specifications": F.lit(None).cast("string"),
        "gcs_uri": F.col("uri"),
    }
    return found.select(*[made.get(c, F.col(c)).alias(c) for c in EARLIER_COLUMNS])


def _earlier_findings(models: list[str]) -> list[Column]:
    text = F.col("full_text")
    return [
        R.model_name(text, models).alias("car_model"),
        R.car_type(text).alias("car_type"),
        R.engine_type(text).alias("engine_type"),
        R.price_text(text).alias("price"),
    ]


def _earlier_of_parts(rows: DataFrame, models: list[str]) -> DataFrame:
    """Findings of documents in parts, merged from what their pieces say."""
    facts = F.struct("page_count", "_time", "source_type").alias("facts")
    parts = told_apart(rows.select("uri", "part", "full_text", facts), "uri", "part", "full_text")
    lines = whole_lines(parts, "_doc", "part", "full_text")
    pieces = lines.select(
        "_doc", "part", *_earlier_findings(models), X.long_paragraph(F.col("full_text")).alias("paragraph")
    )

    def first(name: str, there: Column) -> Column:
        return F.min_by(name, F.when(there, F.col("part"))).alias(name)

    def best(name: str, kinds: list[str]) -> Column:
        place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col(name))
        return F.min_by(name, F.when(place > 0, place)).alias(name)

    merged = pieces.groupBy("_doc").agg(
        first("car_model", F.col("car_model") != "UNKNOWN"),
        best("car_type", R.CAR_TYPES),
        best("engine_type", R.ENGINE_TYPES),
        first("price", F.col("price").isNotNull()),
        first("paragraph", F.col("paragraph").isNotNull()),
    )
    top = keyword_topk_of_parts(lines, "_doc", "full_text").groupBy("_doc").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("top")
    )
    sizes = parts.groupBy("_doc").agg(
        F.sum(F.length("full_text").cast("bigint")).alias("text_length"), F.min("facts").alias("facts")
    )
    opening = opening_of_parts(parts, X.SUMMARY_FALLBACK)
    joined = sizes.join(merged, "_doc", "left").join(top, "_doc", "left").join(opening, "_doc", "left")
    unknown = lambda c: F.coalesce(c, F.lit("UNKNOWN")).alias(c)
    return joined.select(
        "_doc.uri", "facts.*", unknown("car_model"), unknown("car_type"), unknown("engine_type"), "price",
        "text_length",
        F.array_join(F.coalesce("top.word", F.array().cast("array<string>")), ", ").alias("keywords"),
        F.coalesce("paragraph", "head", F.lit("")).alias("summary"),
    )
