"""Inputs derived from the given tables, one row in for one row out.

The tables hold no office files, answers or videos. Each function rewrites a
whole table into the shape an operator reads; remainders of the row's id only
choose among variants, no row is left out. ``sql.py`` says the same in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_ID = "doc_id"


def table(spark: SparkSession, sf_dir: str, name: str, spread: str | None = None) -> DataFrame:
    """A given table; ``spread`` names a key to spread a tiny one over.

    One small file is one task, whatever the number of cores. A table with as
    many splits as cores is left as it is.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, spread)
    return df


def pick(values: list[str | None], n: Column | int, by: str = DOC_ID) -> Column:
    """One of the values, by the remainder of the row's id."""
    options = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(options, (F.col(by) % len(values)).cast("int")) if n == 1 else F.get(
        options, (F.floor(F.col(by) / n) % len(values)).cast("int")
    )


# --- documents as stored files ----------------------------------------------

SUFFIXES = [".pdf", ".pptx", ".PPTX", ".docx", ".doc", ".html", ".txt", "/", ".tar.gz", ".PDF", ""]


def document_uri() -> Column:
    return F.concat(
        F.lit("gs://"), "source", F.lit("/in/Prüf ü-"), F.col(DOC_ID).cast("string"),
        F.lit(".v2"), pick(SUFFIXES, 1),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, uri, length)``, folder markers included."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(DOC_ID, document_uri().alias("uri"), F.col("n_chars").alias("length"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, uri, part, full_text, lang)``."""
    docs = table(spark, sf_dir, "documents", spread=DOC_ID)
    return docs.select(
        DOC_ID, document_uri().alias("uri"), F.lit("").alias("part"),
        F.col("text").alias("full_text"), "lang",
    )


# --- texts with something for the rules to find ------------------------------

MODELS = ["Aurora", "Borealis", "Borealis GT", "Cirrus"]
SPOKEN_MODELS = ["Aurora", "borealis gt", "BOREALIS", "Cirrus and Aurora", "auroras", "Nimbus"]
KINDS = ["SUV", "sedan", "electric SUV", "Plug-in Hybrid", "hybrid Sedan", "SUVs", "wagon"]
COSTS = ["3,000만원", "$30,000", "1,200만 원 or $9,500.50", "nothing", "$ 5 and $7"]
YEARS = ["2019", "2021 to 2024", "120245", "1998/2003", "none"]


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``texts`` with a sentence in front that names a model, a price, years."""
    sentence = F.concat(
        F.lit("The "), pick(SPOKEN_MODELS, 1), F.lit(" "), pick(KINDS, 2),
        F.lit(" costs "), pick(COSTS, 3), F.lit(" since "), pick(YEARS, 5), F.lit(".\n"),
    )
    return texts(spark, sf_dir).withColumn("full_text", F.concat(sentence, "full_text"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name)``: the models, part names, and the first three words of benchmark items."""
    three = r"^([\p{L}\p{N}]+ [\p{L}\p{N}]+ [\p{L}\p{N}]+)"
    models = spark.createDataFrame([(m,) for m in MODELS], "name string")
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    items = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", three, 1).alias("name"))
    return models.union(parts).union(items)


# --- labelling answers --------------------------------------------------------


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


FULL_LABELS = (
    '"type":"기술정보","source":"FAQ","region":"A1(KOREA)","country":"Korea",'
    '"model":"QX (One)","xev":null,"year1":2024,"year2":"2025","language":"ko-KR",'
    '"version":"v2.0.1","updated_at":"2024-02-29","file_format":"web"'
)
SOME_LABELS = '"type":"브랜드","type":"비즈니스","region":null,"xev":"Hybrid"'


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, uri, file_format, response)``: answers of many shapes."""
    docs = texts(spark, sf_dir)
    summary = F.concat(F.lit('"content_summary":'), quoted(F.col("full_text")))
    full = F.concat(F.lit('{"metadata":{' + FULL_LABELS + "},"), summary, F.lit("}"))
    some = F.concat(F.lit('{"metadata":{' + SOME_LABELS + "},"), summary, F.lit("}"))
    flat = F.concat(F.lit("{" + FULL_LABELS + ","), summary, F.lit("}"))
    shapes = [
        full,
        F.concat(F.lit("```json\n"), full, F.lit("\n```")),
        F.concat(F.lit("```"), some, F.lit("``` \n")),
        F.concat(full, F.lit(" as asked")),
        some,
        F.lit('{"metadata":{}}'),
        F.concat(F.lit('{"metadata":null,'), summary, F.lit("}")),
        F.concat(F.lit('{"metadata":[1],'), summary, F.lit("}")),
        flat,
        F.concat(F.lit("["), full, F.lit("]")),
        F.lit(" "),
        F.lit('{"metadata":{"type":null,"model":"A"},"content_summary":null}'),
        F.lit(None).cast("string"),
    ]
    which = (F.col(DOC_ID) % len(shapes)).cast("int")
    response = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        response = F.when(which == i, shape).otherwise(response)
    return docs.select(
        DOC_ID, "uri", pick(["pdf", "ppt", "unknown"], 1).alias("file_format"),
        response.alias("response"),
    )


# --- metadata records -----------------------------------------------------------

TYPES = ["브랜드", "차종정보", "비즈니스", "고객정보", "기술정보", None, "", "other"]
SOURCES = ["도메인", "FAQ", "카탈로그", "YOUTUBE", "오너스매뉴얼", "UNKNOWN", "blog"]
REGIONS = ["UNKNOWN", "COMMON", "A1(KOREA)", "A2(APAC)", "B1(NORTH AMERICA)", "Mars", None]
XEVS = [None, "", "Hybrid", "Plugin-Hybrid", "Diesel"]
VERSIONS = ["v1.0.0", "1.0", "v2.10.3-rc.1", None]
DATES = ["2024-01-29", "2024-02-30", "29.01.2024", "2023-12-01"]
FORMATS = ["ppt", "pdf", "html", "doc", "video", "unknown", "xls"]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, uri)`` and the 13 columns, good and bad values mixed."""
    docs = table(spark, sf_dir, "documents")
    model_no = (F.col(DOC_ID) % 41).cast("string")
    return docs.select(
        DOC_ID,
        document_uri().alias("uri"),
        pick(TYPES, 1).alias("type"),
        pick(SOURCES, 2).alias("source"),
        pick(REGIONS, 3).alias("region"),
        F.concat(F.lit("NATION_"), (F.col(DOC_ID) % 27).cast("string")).alias("country"),
        F.when(F.col(DOC_ID) % 6 == 0, None)
        .when(F.col(DOC_ID) % 5 == 0, F.concat(F.lit("M"), model_no, F.lit(" PE (Name)")))
        .otherwise(F.concat(F.lit("m"), (F.col(DOC_ID) % 23).cast("string")))
        .alias("model"),
        pick(XEVS, 1).alias("xev"),
        F.when(F.col(DOC_ID) % 4 > 0, ((F.col(DOC_ID) % 30) + 1995).cast("string")).alias("year1"),
        F.when(F.col(DOC_ID) % 9 > 0, F.lit("24")).alias("year2"),
        F.when(F.col(DOC_ID) % 3 == 0, F.concat("lang", F.lit("-XX"))).otherwise(F.upper("lang")).alias("language"),
        pick(VERSIONS, 1).alias("version"),
        pick(DATES, 3).alias("updated_at"),
        pick(FORMATS, 1).alias("file_format"),
        F.col("text").alias("content_summary"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(country, region)`` of the nations."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


WORLD = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "UNKNOWN", None]


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with regions of the region table."""
    return records(spark, sf_dir).withColumn("region", pick(WORLD, 1))


# --- OCR shards --------------------------------------------------------------------

PARAGRAPH = 80
SHARD_NAMES = ["0", "2", "10"]


def shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uri, shard_uri, content, length)``: each text in three shards of one page.

    Paragraphs are 80 characters wide. As in the service's JSON an index of 0
    is left out, indices are texts, and the last paragraph has no end.
    """
    docs = texts(spark, sf_dir)
    third = F.ceil(F.length("full_text") / 3)
    shards = docs.select(
        "uri", "full_text", "lang", F.posexplode(F.array(*[F.lit(n) for n in SHARD_NAMES])).alias("i", "name")
    ).select(
        "uri",
        F.concat("uri", F.lit("/doc-"), "name", F.lit(".json")).alias("shard_uri"),
        F.col("full_text").substr(F.col("i") * third + 1, third).alias("text"),
        "lang",
        "i",
    )
    last = F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / PARAGRAPH)

    def segment(j: Column) -> Column:
        start = F.when(j > 0, (j * PARAGRAPH).cast("string"))
        end = F.when(j < last, ((j + 1) * PARAGRAPH).cast("string"))
        return F.struct(start.alias("startIndex"), end.alias("endIndex"))

    def paragraph(j: Column) -> Column:
        anchor = F.struct(F.array(segment(j)).alias("textSegments"))
        return F.struct(F.struct(anchor.alias("textAnchor")).alias("layout"))

    paragraphs = F.transform(F.sequence(F.lit(0).cast("bigint"), last), paragraph)
    page = F.struct((F.col("i") + 1).alias("pageNumber"), paragraphs.alias("paragraphs"))
    entity = F.struct(
        F.lit("language").alias("type"), F.col("lang").alias("mentionText"),
        ((F.col("i") + 1) / 4).alias("confidence"),
    )
    body = F.struct("text", F.array(page).alias("pages"), F.array(entity).alias("entities"))
    return shards.select(
        "uri", "shard_uri", F.to_json(body).alias("content"),
        F.octet_length("text").alias("length"),
    )


# --- videos --------------------------------------------------------------------------


def video_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url)``: video URLs of all forms, and pages that are none."""
    n = F.col("page_id").cast("string")
    forms = [
        ("https://www.youtube.com/watch?v=vid", ""),
        ("https://youtu.be/vid", "?t=5"),
        ("https://youtube.com/watch?list=x&v=vid", "#t=v"),
        ("https://m.youtube.com/embed/vid", "?rel=0"),
        ("https://WWW.YouTube.com:443/v/vid", "/extra"),
        None,
        ("https://www.youtube.com/watch?v=&v=vid", "%2D1"),
        ("https://youtu.be/vid", "/extra"),
        ("https://user@youtube.com/watch?vv=1&v=a+vid", "%zz"),
        ("www.youtube.com/watch?v=vid", ""),
        ("https://www.youtube.com/watch?list=", ""),
    ]
    url = F.col("url")
    for i, form in enumerate(forms):
        if form:
            built = F.concat(F.lit(form[0]), n, F.lit(form[1]))
            url = F.when(F.col("page_id") % len(forms) == i, built).otherwise(url)
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


def video_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(video_id, response)``; some answers name no video or lack a field."""
    pages = table(spark, sf_dir, "pages")
    title = F.concat(F.lit('"title":'), quoted(F.col("url")), F.lit(","))
    description = F.when(F.col("page_id") % 4 == 1, "").otherwise(
        F.concat(F.lit('"description":'), quoted(F.col("html")), F.lit(","))
    )
    answer = F.concat(
        F.lit('{"items":[{"snippet":{'), title, description,
        F.lit('"channelTitle":"c'), (F.col("page_id") % 5).cast("string"),
        F.lit('","publishedAt":"2024-01-29T00:00:00Z","defaultLanguage":"ko"}}]}'),
    )
    response = F.when(F.col("page_id") % 9 == 4, '{"items":[]}').otherwise(answer)
    return pages.select(
        F.concat(F.lit("vid"), F.col("page_id").cast("string")).alias("video_id"),
        response.alias("response"),
    )


def caption_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(video_id, response)`` with two, one or no caption tracks."""
    pages = table(spark, sf_dir, "pages")
    item = lambda k, lang, kind: F.concat(
        F.lit('{"id":"t'), F.col("page_id").cast("string"), F.lit(f'-{k}","snippet":{{"language":"'),
        lang, F.lit(f'","trackKind":"{kind}"}}}}'),
    )
    two = F.concat(F.lit('{"items":['), item(1, pick(["ko", "de"], 1, "page_id"), "ASR"), F.lit(","),
                   item(2, pick(["en", "fr", "ko"], 1, "page_id"), "standard"), F.lit("]}"))
    one = F.concat(F.lit('{"items":['), item(1, F.lit("en"), "standard"), F.lit("]}"))
    response = F.when(F.col("page_id") % 5 == 0, "{}").when(F.col("page_id") % 5 == 1, one).otherwise(two)
    return pages.select(
        F.concat(F.lit("vid"), F.col("page_id").cast("string")).alias("video_id"),
        response.alias("response"),
    )


def spoken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(video_id, track_id, seq, text)``: a role's turns are a track's lines."""
    talks = table(spark, sf_dir, "conversations")
    return talks.select(
        F.concat(F.lit("vid"), F.col("conv_id").cast("string")).alias("video_id"),
        F.col("role").alias("track_id"),
        F.col("turn").alias("seq"),
        F.when(F.col("turn") % 5 != 4, F.col("text")).alias("text"),
    )


def spoken_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(video_id, track_id, language, is_generated)``, a row per line."""
    talks = table(spark, sf_dir, "conversations")
    language = (
        F.when(F.col("role") == "system", F.lit("ko"))
        .when(F.col("role") == "user", pick(["en", "ko", "de"], 1, "conv_id"))
        .otherwise(pick(["en", "fr"], 1, "conv_id"))
    )
    return talks.select(
        F.concat(F.lit("vid"), F.col("conv_id").cast("string")).alias("video_id"),
        F.col("role").alias("track_id"),
        language.alias("language"),
        (F.col("role") == "user").alias("is_generated"),
    )


SEGMENT_MS = 15_000


def spoken_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uri, start_ms, end_ms, text)``: a conversation is a recording, a turn a segment.

    Some turns were not understood, and of some recordings the beginning is lost.
    """
    talks = table(spark, sf_dir, "conversations")
    start = (F.col("turn") + F.when(F.col("conv_id") % 7 == 3, 1).otherwise(0)) * SEGMENT_MS
    return talks.select(
        F.concat(F.lit("gs://talks/"), F.col("conv_id").cast("string"), F.lit(".mp4")).alias("uri"),
        start.cast("bigint").alias("start_ms"),
        (start + SEGMENT_MS).cast("bigint").alias("end_ms"),
        F.when((F.col("conv_id") % 5 > 0) | (F.col("turn") % 3 > 0), F.col("text")).alias("text"),
    )


# --- job settings -----------------------------------------------------------------


def job_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, input_bucket, prefix, folder, path)``, each partly blank."""
    docs = table(spark, sf_dir, "documents")
    n = F.col(DOC_ID).cast("string")
    return docs.select(
        DOC_ID,
        F.when(F.col(DOC_ID) % 3 == 0, F.col("source")).otherwise("").alias("input_bucket"),
        F.when(F.col(DOC_ID) % 2 == 0, F.concat("lang", F.lit("/"))).alias("prefix"),
        F.when(F.col(DOC_ID) % 5 == 0, F.concat(F.lit("gs://"), "source", F.lit("/"), n)).alias("folder"),
        F.concat(F.lit("gs://"), "source", F.lit("/x/"), pick(["*", "*.pdf", "a.pdf", "a*b*"], 1)).alias("path"),
    )
