"""The registered queries in DuckDB SQL, over the same given tables.

Common table expressions repeat the derived inputs of ``inputs.py``.
"""

from catalog import inputs as I
from labelmill.functions.rules import STOP_WORDS
from labelmill.functions.text import (
    REQUEST_CLOSING,
    REQUEST_CONTENT,
    REQUEST_FORMAT,
    REQUEST_OPENING,
    WHITESPACE,
)
from labelmill.operators.assemble import PART_CHARS
from labelmill.schema import DOMAINS, METADATA_COLUMNS, SUMMARY_CHARS

RUN_DATE = "2024-01-29"
WORD = r"[^\p{L}\p{N}]"


def _text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


def _pick(values, n: int, by: str = "doc_id") -> str:
    place = f"({by} // {n}) % {len(values)}"
    return f"([{_list(values)}]::VARCHAR[])[{place} + 1]"


def _strip(text: str) -> str:
    return f"trim({text}, {_text(WHITESPACE)})"


def _name(uri: str) -> str:
    return f"split_part({uri}, '/', -1)"


def _extension(name: str) -> str:
    return f"split_part({name}, '.', -1)"


def _mime(uri: str) -> str:
    office = "application/vnd.openxmlformats-officedocument"
    return (
        f"CASE WHEN ends_with({uri}, '.pptx') THEN '{office}.presentationml.presentation'"
        f" WHEN ends_with({uri}, '.docx') THEN '{office}.wordprocessingml.document'"
        f" ELSE 'application/pdf' END"
    )


def _format(name: str) -> str:
    return (
        f"CASE WHEN NOT contains({name}, '.') THEN 'unknown' ELSE"
        f" CASE lower({_extension(name)}) WHEN 'pdf' THEN 'pdf'"
        " WHEN 'ppt' THEN 'ppt' WHEN 'pptx' THEN 'ppt' WHEN 'doc' THEN 'doc'"
        " WHEN 'docx' THEN 'doc' WHEN 'html' THEN 'html' WHEN 'htm' THEN 'html'"
        " WHEN 'txt' THEN 'string_link' ELSE 'unknown' END END"
    )


SUPPORTED = "regexp_matches(lower(uri), '[.](pptx|pdf|docx)$')"

URI = f"'gs://' || source || '/in/Prüf ü-' || doc_id || '.v2' || {_pick(I.SUFFIXES, 1)}"
LISTING = f"listing AS (SELECT doc_id, {URI} AS uri, n_chars AS length FROM documents)"
TEXTS = f"texts AS (SELECT doc_id, {URI} AS uri, text AS full_text, lang FROM documents)"
TOLD = (
    f"told AS (SELECT doc_id, {URI} AS uri, lang, 'The ' || {_pick(I.SPOKEN_MODELS, 1)} || ' ' ||"
    f" {_pick(I.KINDS, 2)} || ' costs ' || {_pick(I.COSTS, 3)} || ' since ' ||"
    f" {_pick(I.YEARS, 5)} || '.' || chr(10) || text AS full_text FROM documents)"
)

# --- answers ------------------------------------------------------------------

_SUMMARY = "'\"content_summary\":' || to_json(text)"
_FULL = f"'{{\"metadata\":{{{I.FULL_LABELS}}},' || {_SUMMARY} || '}}'"
_SOME = f"'{{\"metadata\":{{{I.SOME_LABELS}}},' || {_SUMMARY} || '}}'"
_SHAPES = [
    _FULL,
    f"'```json' || chr(10) || {_FULL} || chr(10) || '```'",
    f"'```' || {_SOME} || '``` ' || chr(10)",
    f"{_FULL} || ' as asked'",
    _SOME,
    "'{\"metadata\":{}}'",
    f"'{{\"metadata\":null,' || {_SUMMARY} || '}}'",
    f"'{{\"metadata\":[1],' || {_SUMMARY} || '}}'",
    f"'{{{I.FULL_LABELS},' || {_SUMMARY} || '}}'",
    f"'[' || {_FULL} || ']'",
    "' '",
    "'{\"metadata\":{\"type\":null,\"model\":\"A\"},\"content_summary\":null}'",
]
_CASES = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(_SHAPES))
ANSWERS = (
    f"answers AS (SELECT doc_id, {URI} AS uri, {_pick(['pdf', 'ppt', 'unknown'], 1)} AS file_format,"
    f" CASE doc_id % {len(_SHAPES) + 1} {_CASES} END AS response FROM documents)"
)


def _unfenced(answer: str) -> str:
    body = f"regexp_replace({_strip(answer)}, '^```json', '')"
    return _strip(f"regexp_replace(regexp_replace({body}, '^```', ''), '```$', '')")


# A repeated key keeps its last value; SQL keeps the first, so it is removed.
FENCED = f"bodies AS (SELECT doc_id, uri, file_format, {_unfenced('response')} AS body FROM answers)"
_DOC = "replace(body, '\"type\":\"브랜드\",', '')"
PARSED = (
    f"parsed AS (SELECT *, CASE WHEN json_valid(body) THEN {_DOC}::JSON END AS j FROM bodies),"
    " judged AS (SELECT *, CASE WHEN j IS NULL THEN 'not_json'"
    " WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object'"
    " WHEN json_exists(j, '$.metadata') AND json_type(j, '$.metadata') <> 'OBJECT'"
    " THEN 'metadata_not_an_object' ELSE 'ok' END AS status FROM parsed)"
)
ANSWER_CTES = f"WITH {ANSWERS}, {FENCED}, {PARSED}"


def _field(name: str, default: str, rejected: str, path: str = "$.metadata.") -> str:
    at = f"'{path}{name}'"
    return (
        f"CASE WHEN status <> 'ok' THEN {rejected}"
        f" WHEN coalesce(json_exists(j, {at}), false) THEN json_extract_string(j, {at}) ELSE {default} END AS {name}"
    )


_DEFAULTS = {
    **{c: "'UNKNOWN'" for c in ("type", "source", "region", "country", "model", "language")},
    **{c: "NULL" for c in ("xev", "year1", "year2")},
    "version": "'v1.0.0'",
    "updated_at": f"'{RUN_DATE}'",
}
_ANSWER_FIELDS = ", ".join(
    _field(c, "''", "''", "$.") if c == "content_summary"
    else _field(c, "file_format", "'UNKNOWN'") if c == "file_format"
    else _field(c, _DEFAULTS[c], _DEFAULTS[c])
    for c in METADATA_COLUMNS
)


def _record_field(name: str) -> str:
    top = f"CASE WHEN json_exists(j, '$.{name}') THEN json_extract_string(j, '$.{name}') ELSE '' END"
    if name == "content_summary":
        value = top
    else:
        inside = (
            f"CASE WHEN json_exists(j, '$.metadata.{name}')"
            f" THEN json_extract_string(j, '$.metadata.{name}') ELSE '' END"
        )
        value = f"CASE WHEN json_exists(j, '$.metadata') THEN {inside} ELSE {top} END"
    return f"CASE WHEN status = 'ok' THEN {value} END AS {name}"


# --- metadata records -----------------------------------------------------------

_MODEL = (
    "CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 5 = 0"
    " THEN 'M' || (doc_id % 41) || ' PE (Name)' ELSE 'm' || (doc_id % 23) END"
)
RECORDS = f"""records AS (SELECT doc_id, {URI} AS uri,
  {_pick(I.TYPES, 1)} AS type, {_pick(I.SOURCES, 2)} AS source, {_pick(I.REGIONS, 3)} AS region,
  'NATION_' || (doc_id % 27) AS country, {_MODEL} AS model, {_pick(I.XEVS, 1)} AS xev,
  CASE WHEN doc_id % 4 > 0 THEN (doc_id % 30 + 1995)::VARCHAR END AS year1,
  CASE WHEN doc_id % 9 > 0 THEN '24' END AS year2,
  CASE WHEN doc_id % 3 = 0 THEN lang || '-XX' ELSE upper(lang) END AS language,
  {_pick(I.VERSIONS, 1)} AS version, {_pick(I.DATES, 3)} AS updated_at,
  {_pick(I.FORMATS, 1)} AS file_format, text AS content_summary FROM documents)"""
COUNTRIES = (
    "countries AS (SELECT n_name AS country, r_name AS region"
    " FROM nation JOIN region ON n_regionkey = r_regionkey)"
)


def _report(source: str) -> str:
    """Value counts section by section, as a reader would write them."""
    parts = [f"SELECT 'total' AS dimension, NULL AS value, NULL AS label, count(*) AS n FROM {source} HAVING count(*) > 0"]
    for c in ("type", "source", "region", "language", "file_format"):
        parts.append(
            f"SELECT '{c}', {c}, {c}, count(*) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        )
    parts.append(
        "SELECT 'xev', xev, CASE WHEN xev IS NULL OR xev = '' THEN 'NULL (Non-Hybrid)' ELSE xev END,"
        f" count(*) FROM {source} GROUP BY xev"
    )
    parts.append(
        f"SELECT * FROM (SELECT 'model', model, model, count(*) FROM {source}"
        " WHERE model IS NOT NULL GROUP BY model ORDER BY count(*) DESC, model LIMIT 10)"
    )
    return " UNION ALL ".join(parts)


# --- quality -------------------------------------------------------------------

_CHECKS = {
    "type": ("domain", f"type IN ({_list([*DOMAINS['type'], 'UNKNOWN'])})"),
    "source": ("domain", f"source IN ({_list([*DOMAINS['source'], 'UNKNOWN'])})"),
    "region": ("domain", f"region IN ({_list(DOMAINS['region'])})"),
    "country": ("domain", "country IN ('UNKNOWN', 'COMMON') OR country IN (SELECT country FROM countries)"),
    "model": ("format", r"model IN ('UNKNOWN', 'COMMON') OR regexp_matches(model, '^[A-Z0-9]+( PE)? \(.+\)$')"),
    "xev": ("domain", "xev IS NULL OR xev IN ('Hybrid', 'Plugin-Hybrid')"),
    "year1": ("format", "year1 IS NULL OR regexp_full_match(year1, '[0-9]{4}')"),
    "year2": ("format", "year2 IS NULL OR regexp_full_match(year2, '[0-9]{4}')"),
    "language": (
        "format",
        "language = 'UNKNOWN' OR regexp_full_match(language, '[a-z]{2,3}(-[A-Z][a-z]{3})?(-([A-Z]{2}|[0-9]{3}))?')",
    ),
    "version": (
        "format",
        "regexp_full_match(version, 'v[0-9]+[.][0-9]+[.][0-9]+(-[0-9A-Za-z.-]+)?([+][0-9A-Za-z.-]+)?')",
    ),
    "updated_at": (
        "format",
        "regexp_full_match(updated_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(updated_at AS DATE) IS NOT NULL",
    ),
    "file_format": (
        "domain", f"file_format IN ({_list([*DOMAINS['file_format'], 'doc', 'unknown', 'UNKNOWN'])})"
    ),
    "content_summary": ("length", f"length(content_summary) <= {SUMMARY_CHARS}"),
}
_VIOLATIONS = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS \"column\", {c} AS value, '{rule}' AS rule FROM records"
    f" WHERE NOT coalesce({ok}, false)"
    for c, (rule, ok) in _CHECKS.items()
)

# --- rules -----------------------------------------------------------------------


def _word(names) -> str:
    longest = sorted(names, key=lambda n: (-len(n), n))
    return f"(?i)(?:^|{WORD})({'|'.join(longest)})(?:{WORD}|$)"


def _model(text: str) -> str:
    found = f"lower(regexp_extract({text}, '{_word(I.MODELS)}', 1))"
    cases = " ".join(f"WHEN {_text(m.lower())} THEN {_text(m)}" for m in I.MODELS)
    return f"CASE {found} {cases} ELSE 'UNKNOWN' END"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '(?i)(?:^|{WORD})(?:{pattern})(?:{WORD}|$)')"


def _car_type(t: str) -> str:
    return f"CASE WHEN {_has(t, 'suv')} THEN 'SUV' WHEN {_has(t, 'sedan')} THEN 'Sedan' ELSE 'UNKNOWN' END"


def _engine(t: str) -> str:
    return (
        f"CASE WHEN {_has(t, 'electric')} THEN 'Electric'"
        f" WHEN {_has(t, 'hybrid')} THEN 'Hybrid' ELSE 'UNKNOWN' END"
    )


def _xev(t: str) -> str:
    return (
        f"CASE WHEN {_has(t, 'plug-?in[- ]hybrid')} THEN 'Plugin-Hybrid'"
        f" WHEN {_has(t, 'hybrid')} THEN 'Hybrid' END"
    )


def _summary(text: str) -> str:
    lines = f"list_transform(regexp_split_to_array({text}, '[\\r\\n]+'), lambda l: {_strip('l')})"
    first = f"list_filter({lines}, lambda l: length(l) >= 50)[1]"
    return f"substring(coalesce({first}, substring({_strip(text)}, 1, 200)), 1, 1000)"


def _years(text: str) -> str:
    # Every run of digits that is a year as a whole.
    return (
        f"list_filter(regexp_extract_all({text}, '[0-9]+'),"
        " lambda y: regexp_full_match(y, '(19|20)[0-9]{2}'))"
    )


def _language(code: str) -> str:
    return (
        f"CASE {code} WHEN 'ko' THEN 'ko-KR' WHEN 'en' THEN 'en-US' WHEN 'de' THEN 'de-DE'"
        " WHEN 'fr' THEN 'fr-FR' WHEN 'es' THEN 'es-ES' ELSE 'UNKNOWN' END"
    )


_NUMBER = "([0-9][0-9,]*(?:[.][0-9]+)?)"
_AMOUNTS = (
    "SELECT doc_id, 'KRW' AS currency, replace(unnest(regexp_extract_all(full_text,"
    rf" '{_NUMBER}\s*만\s*원', 1)), ',', '')::DOUBLE * 10000 AS amount FROM told"
    " UNION ALL SELECT doc_id, 'USD', replace(unnest(regexp_extract_all(full_text,"
    rf" '[$]\s*{_NUMBER}', 1)), ',', '')::DOUBLE FROM told"
)
_PRICE = (
    r"nullif(regexp_extract(full_text, '([0-9][0-9,]*(?:[.][0-9]+)?\s*만\s*원"
    r"|[$]\s*[0-9][0-9,]*(?:[.][0-9]+)?)', 1), '')"
)


def _keywords(source: str) -> str:
    return f"""words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(full_text), '{WORD}+')) AS word FROM {source}),
  counted AS (SELECT doc_id, word, count(*) AS n FROM words
    WHERE length(word) >= 2 AND word NOT IN ({_list(STOP_WORDS)}) GROUP BY doc_id, word),
  ranked AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rank, word, n FROM counted)"""


_KIND = "CASE WHEN doc_id % 13 = 0 THEN 'video' ELSE 'document' END"
_EARLIER = f"""WITH {TOLD}, {_keywords('told')},
  keywords AS (SELECT doc_id, string_agg(word, ', ' ORDER BY rank) AS keywords FROM ranked WHERE rank <= 10 GROUP BY doc_id),
  earlier AS (SELECT
    regexp_replace(split_part({_name('uri')}, '.', 1), '[^\\p{{L}}\\p{{N}}_\\-]', '_', 'g') || '_20240129143005' AS raw_id,
    told.*, {_name('uri')} AS name, coalesce(keywords, '') AS keywords
    FROM told LEFT JOIN keywords USING (doc_id)),
  rows AS (SELECT CASE WHEN name = '' THEN '_20240129143005' ELSE raw_id END AS document_id,
    {_KIND} AS source_type, name AS file_name, '{RUN_DATE}' AS upload_date,
    {_model('full_text')} AS car_model, {_car_type('full_text')} AS car_type, {_engine('full_text')} AS engine_type,
    {_PRICE} AS price, ceil(length(full_text) / 1000)::BIGINT AS page_count, length(full_text) AS text_length,
    NULL::VARCHAR AS features, keywords, {_summary('full_text')} AS summary,
    NULL::VARCHAR AS specifications, uri AS gcs_uri FROM earlier)"""

# --- shards -----------------------------------------------------------------------

# Shards 0, 2, 10 of a text, and the place of each in name order: 0, 10, 2.
SHARDS = (
    f"shards AS (SELECT uri, lang, i, uri || '/doc-' || (['0', '2', '10'])[i + 1] || '.json' AS shard_uri,"
    " substring(full_text, i * ceil(length(full_text) / 3)::BIGINT + 1, ceil(length(full_text) / 3)::BIGINT) AS text"
    " FROM texts, (SELECT unnest([0, 1, 2]) AS i))"
)
_WIDTH = I.PARAGRAPH
_PAGE = _strip(
    f"array_to_string(list_transform(range(0, greatest(length(text) - 1, 0) // {_WIDTH} + 1),"
    f" lambda k: substring(text, k * {_WIDTH} + 1, {_WIDTH})), chr(10))"
)

# --- videos -----------------------------------------------------------------------

_FORMS = [
    "'https://www.youtube.com/watch?v=vid' || page_id",
    "'https://youtu.be/vid' || page_id || '?t=5'",
    "'https://youtube.com/watch?list=x&v=vid' || page_id || '#t=v'",
    "'https://m.youtube.com/embed/vid' || page_id || '?rel=0'",
    "'https://WWW.YouTube.com:443/v/vid' || page_id || '/extra'",
    "url",
    "'https://www.youtube.com/watch?v=&v=vid' || page_id || '%2D1'",
    "'https://youtu.be/vid' || page_id || '/extra'",
    "'https://user@youtube.com/watch?vv=1&v=a+vid' || page_id || '%zz'",
    "'www.youtube.com/watch?v=vid' || page_id",
    "'https://www.youtube.com/watch?list=' || page_id",
]
URLS = (
    f"urls AS (SELECT page_id, CASE page_id % {len(_FORMS)} "
    + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FORMS))
    + " END AS url FROM pages)"
)
IDS = r"""split AS (SELECT page_id, url,
    lower(regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '[?&]v=([^&#]+)', 1) AS v FROM urls),
  ids AS (SELECT page_id, url, CASE
    WHEN host = 'youtu.be' THEN ltrim(path, '/')
    WHEN host NOT IN ('www.youtube.com', 'youtube.com', 'm.youtube.com') THEN NULL
    WHEN path = '/watch' THEN replace(replace(v, '+', ' '), '%2D', '-')
    WHEN starts_with(path, '/embed/') OR starts_with(path, '/v/') THEN split_part(path, '/', 3) END AS video_id
    FROM split)"""
INFO = """info AS (SELECT 'vid' || page_id AS video_id, page_id % 9 <> 4 AS found,
    url AS title, CASE WHEN page_id % 4 = 1 THEN '' ELSE html END AS description,
    'c' || (page_id % 5) AS channel FROM pages)"""
TRACKS = f"""tracks AS (SELECT DISTINCT 'vid' || conv_id AS video_id, role AS track_id,
    CASE role WHEN 'system' THEN 'ko' WHEN 'user' THEN {_pick(['en', 'ko', 'de'], 1, 'conv_id')}
      ELSE {_pick(['en', 'fr'], 1, 'conv_id')} END AS language,
    role = 'user' AS is_generated FROM conversations),
  chosen AS (SELECT video_id, track_id, language, is_generated FROM (SELECT *, row_number() OVER (PARTITION BY video_id
      ORDER BY language <> 'ko', is_generated, track_id) AS k FROM tracks WHERE language IN ('ko', 'en')) WHERE k = 1)"""
SPOKEN = """spoken AS (SELECT 'vid' || conv_id AS video_id, role AS track_id,
    string_agg(CASE WHEN turn % 5 <> 4 THEN text ELSE '' END, chr(10) ORDER BY turn) AS transcript
    FROM conversations GROUP BY conv_id, role)"""


def _in_parts(source: str, text: str, chars: int) -> str:
    """Each text of ``source`` cut every so many characters; adds ``k``, ``part``, ``start``."""
    return f"""SELECT * REPLACE (substring({text}, k * {chars} + 1, {chars}) AS {text}),
      CASE WHEN n = 1 THEN '' ELSE lpad(k::VARCHAR, 12, '0') END AS part, k * {chars} AS start
      FROM (SELECT *, unnest(range(n)) AS k FROM (
        SELECT *, greatest(1, ceil(length({text}) / {chars}))::BIGINT AS n FROM {source}))"""


def texts_in_parts(chars: int) -> dict[str, str]:
    """The queries whose texts come in parts of so many characters."""
    return {
        "shard_merge": f"""WITH {TEXTS}, {SHARDS}, placed AS (
            SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY uri ORDER BY shard_uri
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
              greatest(1, ceil(sum(length(text)) OVER (PARTITION BY uri) / {chars})) AS n FROM shards),
          lists AS (SELECT uri, least(ahead // {chars}, n - 1)::BIGINT AS k,
              string_agg((i + 1)::VARCHAR, ',' ORDER BY shard_uri) AS page_numbers,
              string_agg({_PAGE}, '|' ORDER BY shard_uri) AS page_texts,
              string_agg(lang || '@' || (['0.25', '0.5', '0.75'])[i + 1], ',' ORDER BY shard_uri) AS mentions
            FROM placed GROUP BY ALL),
          merged AS (SELECT uri, string_agg(text, '' ORDER BY shard_uri) AS full_text FROM shards GROUP BY uri),
          parts AS ({_in_parts("merged", "full_text", chars)})
          SELECT uri, part, start, {_mime('uri')} AS mime_type, full_text, coalesce(page_numbers, '') AS page_numbers,
            coalesce(page_texts, '') AS page_texts, coalesce(mentions, '') AS mentions, 'ok' AS status
          FROM parts LEFT JOIN lists USING (uri, k)""",
        "transcript_text": f"""WITH {SPOKEN}, parts AS ({_in_parts("spoken", "transcript", chars)})
          SELECT video_id, track_id, part, start, transcript FROM parts""",
        "media_transcript": f"""WITH segments AS (
            SELECT 'gs://talks/' || conv_id || '.mp4' AS uri,
              (turn + CASE WHEN conv_id % 7 = 3 THEN 1 ELSE 0 END) * {I.SEGMENT_MS} AS begins,
              CASE WHEN conv_id % 5 > 0 OR turn % 3 > 0 THEN text END AS said FROM conversations),
          media AS (SELECT uri, string_agg(coalesce(said, ''), chr(10) ORDER BY begins) AS full_text,
              count(*) AS segments, (count(*) * {I.SEGMENT_MS})::BIGINT AS spoken_ms,
              CASE WHEN count(*) > count(said) THEN 'missing_text'
                WHEN min(begins) = 0 AND count(*) * {I.SEGMENT_MS} = max(begins) + {I.SEGMENT_MS} THEN 'ok'
                ELSE 'missing_segment' END AS status FROM segments GROUP BY uri),
          parts AS ({_in_parts("media", "full_text", chars)})
          SELECT uri, part, start, full_text, segments, spoken_ms, status FROM parts""",
        "video_document": f"""{VIDEOS}, parts AS ({_in_parts("videos", "full_text", chars)})
          SELECT uri, video_id, part, start, full_text, status FROM parts""",
        "video_reference": f"""{VIDEOS} SELECT url AS uri, ids.video_id,
            CASE WHEN documents.video_id IS NOT NULL THEN greatest(1, ceil(length(full_text) / {chars}))::BIGINT END AS parts,
            length(full_text) AS chars,
            CASE WHEN ids.video_id IS NULL THEN 'not_a_video' ELSE coalesce(status, 'video_not_found') END AS status
          FROM ids LEFT JOIN documents USING (video_id)""",
    }


VIDEOS = f"""WITH {URLS}, {IDS}, {INFO}, {TRACKS}, {SPOKEN},
  documents AS (SELECT info.video_id,
    CASE WHEN found THEN '[Video Title] ' || title || chr(10) || '[Channel] ' || channel || chr(10) ||
      '[Published] 2024-01-29T00:00:00Z' || chr(10) || chr(10) || '[Transcript]' || chr(10) ||
      CASE WHEN coalesce(transcript, '') = '' THEN description ELSE transcript END END AS full_text,
    CASE WHEN found THEN 'ok' ELSE 'video_not_found' END AS status
    FROM info SEMI JOIN ids USING (video_id) LEFT JOIN chosen USING (video_id)
      LEFT JOIN spoken ON spoken.video_id = chosen.video_id AND spoken.track_id = chosen.track_id),
  videos AS (SELECT url AS uri, ids.video_id, full_text,
    CASE WHEN ids.video_id IS NULL THEN 'not_a_video' ELSE coalesce(status, 'video_not_found') END AS status
    FROM ids LEFT JOIN documents USING (video_id))"""

# --- records by rule ------------------------------------------------------------------


def _rule_records(source: str, language: str, file_format: str) -> str:
    t = "full_text"
    return f"""SELECT uri, 'UNKNOWN' AS type, 'UNKNOWN' AS source, 'UNKNOWN' AS region, 'UNKNOWN' AS country,
    {_model(t)} AS model, {_xev(t)} AS xev, list_min({_years(t)}) AS year1, list_max({_years(t)}) AS year2,
    {language} AS language, 'v1.0.0' AS version, '{RUN_DATE}' AS updated_at,
    {file_format} AS file_format, {_summary(t)} AS content_summary FROM {source}"""


_BATCH = (
    f"WITH {TOLD}, batch AS ("
    + _rule_records("told", _language("lang"), _format(_name("uri")))
    + f" WHERE NOT ends_with(uri, '/') AND {SUPPORTED})"
)

_REQUEST = (
    f"'{REQUEST_OPENING}' || chr(10) || chr(10) || '{REQUEST_FORMAT}' || {_format(_name('uri'))} || chr(10) || chr(10) ||"
    f" '{REQUEST_CONTENT}' || chr(10) || substring(full_text, 1, 10000) || chr(10) || chr(10) || '{REQUEST_CLOSING}'"
)

_BASE = (
    "CASE WHEN coalesce(bucket, '') <> '' THEN 'gs://' || bucket || '/' || coalesce(prefix, '')"
    " WHEN coalesce(folder, '') <> '' THEN folder WHEN contains(path, '*') THEN split_part(path, '*', 1) END"
)
JOBS = f"""jobs AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS bucket,
  CASE WHEN doc_id % 2 = 0 THEN lang || '/' END AS prefix,
  CASE WHEN doc_id % 5 = 0 THEN 'gs://' || source || '/' || doc_id END AS folder,
  'gs://' || source || '/x/' || {_pick(['*', '*.pdf', 'a.pdf', 'a*b*'], 1)} AS path FROM documents)"""

_REVIEWED = """compared AS (SELECT CASE WHEN n_chars >= 300 THEN '1' ELSE '0' END = quality::VARCHAR AS quality,
  '0' = toxic::VARCHAR AS toxic FROM documents JOIN labels USING (doc_id))"""


def _accuracy(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(*) AS reviewed, count(*) FILTER ({column}) AS correct,"
        f" count(*) FILTER ({column}) / count(*) AS accuracy,"
        f" count(*) FILTER ({column}) / count(*) >= 0.9 AS passed FROM compared"
    )


ORACLES: dict[str, str] = {
    "file_manifest": f"""WITH {LISTING} SELECT uri, length, {_name('uri')} AS file_name, {_mime('uri')} AS mime_type
      FROM listing WHERE NOT ends_with(uri, '/')""",
    "object_info": f"""WITH {LISTING} SELECT uri, length AS size, {_mime('uri')} AS content_type,
      CASE WHEN doc_id % 7 > 0 THEN strftime(make_timestamp((1700000000 + doc_id * 3601) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'
        ELSE '' END AS created FROM listing""",
    "resolve_inputs": f"""WITH {JOBS}, bases AS (SELECT doc_id, {_BASE} AS base FROM jobs)
      SELECT doc_id, split_part(base, '/', 3) AS bucket,
        CASE WHEN base IS NOT NULL THEN regexp_replace(base, '^gs://[^/]*/?', '') END AS prefix FROM bases""",
    "supported_files": f"WITH {LISTING} SELECT uri, length FROM listing WHERE {SUPPORTED}",
    "size_route": f"""WITH {LISTING} SELECT uri, length,
      CASE WHEN length > 10000 THEN 'chunked' ELSE 'direct' END AS route FROM listing""",
    "already_processed": f"""WITH {LISTING} SELECT uri, length FROM listing
      WHERE uri IN (SELECT l.uri FROM listing l JOIN labels USING (doc_id))""",
    "pending_files": f"""WITH {LISTING} SELECT uri, length FROM listing
      WHERE uri NOT IN (SELECT l.uri FROM listing l JOIN labels USING (doc_id))""",
    "pending_by_table": f"""WITH {LISTING} SELECT uri, length FROM listing
      WHERE uri NOT IN (SELECT l.uri FROM listing l JOIN labels USING (doc_id))""",
    "uri_split": """WITH uris AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url
        ELSE 'gs://' || regexp_replace(url, '^https?://', '') END AS uri FROM pages)
      SELECT page_id, CASE WHEN starts_with(uri, 'gs://') THEN split_part(uri, '/', 3) END AS bucket,
        CASE WHEN starts_with(uri, 'gs://') THEN regexp_replace(uri, '^gs://[^/]*/?', '') END AS key,
        CASE WHEN starts_with(uri, 'gs://') THEN 'ok' ELSE 'invalid_uri' END AS status FROM uris""",
    "mime_type": f"WITH {LISTING} SELECT uri, {_mime('uri')} AS mime_type FROM listing",
    "file_format": f"""WITH {LISTING} SELECT uri, CASE WHEN doc_id % 13 = 0 THEN 'video'
      ELSE {_format(_name('uri'))} END AS file_format FROM listing""",
    "document_id": rf"""WITH {LISTING} SELECT doc_id, regexp_replace(split_part({_name('uri')}, '.', 1),
      '[^\p{{L}}\p{{N}}_\-]', '_', 'g') || '_20240129143005' AS document_id FROM listing""",
    "output_names": f"""WITH {LISTING}, named AS (SELECT uri, {_name('uri')} AS name FROM listing)
      SELECT uri, 'out/metadata/' || regexp_replace(name, '[.][^.]*$', '') || '_metadata.csv' AS csv_path,
        'out/metadata/parsing/' || name || '.txt' AS sidecar_path,
        'gs://' || split_part(uri, '/', 3) || '/temp_async_output/20240129_143005/' || name || '/' AS chunk_prefix
      FROM named""",
    "clean_text": f"""WITH {TEXTS} SELECT doc_id, trim(regexp_replace(full_text, '\\s+', ' ', 'g')) AS cleaned FROM texts""",
    "prompt_text": f"""WITH {TEXTS} SELECT uri, {_format(_name('uri'))} AS file_format, {_REQUEST} AS request FROM texts""",
    "anchor_slice": f"WITH {TEXTS}, {SHARDS} SELECT shard_uri, text AS anchored FROM shards",
    "page_text": f"WITH {TEXTS}, {SHARDS} SELECT shard_uri, (i + 1)::BIGINT AS page_number, {_PAGE} AS text FROM shards",
    "page_stats": f"""WITH {TEXTS} SELECT uri, 3::BIGINT AS page_count, length(full_text) AS text_length FROM texts""",
    "entity_list": f"""WITH {TEXTS}, {SHARDS} SELECT uri,
        row_number() OVER (PARTITION BY uri ORDER BY shard_uri) - 1 AS position, 'language' AS type,
        lang AS mention_text, (i + 1) / 4 AS confidence FROM shards""",
    "shard_owner": f"""WITH {TEXTS}, {SHARDS}, named AS (
        SELECT uri, {_name('uri')} AS name, 'gs://' || split_part(uri, '/', 3) AS bucket FROM texts),
      files AS (SELECT name, shard_uri, octet_length(encode(text))::BIGINT AS length, bucket FROM shards JOIN named USING (uri))
      SELECT named.uri, files.bucket || '/temp_async_output/20240129_143005/' || files.name || '/job/0/'
        || {_name('shard_uri')} AS shard_uri, length
      FROM files JOIN named USING (name) WHERE name <> ''""",
    "text_sidecar": f"""WITH {TEXTS} SELECT uri, '' AS part, full_text, unnest(['first', 'second']) AS run FROM texts""",
    "extract_documents": f"""WITH {TEXTS} SELECT uri, {_mime('uri')} AS mime_type, full_text,
        len(string_split(full_text, chr(12)))::BIGINT AS page_count,
        array_to_string(list_transform(string_split(full_text, chr(12)), lambda p: {_strip('p')}), chr(12)) AS page_texts,
        0::BIGINT AS entity_count, 'ok' AS status FROM texts""",
    "strip_fences": f"WITH {ANSWERS}, {FENCED} SELECT doc_id, body FROM bodies",
    "response_parse": f"{ANSWER_CTES} SELECT uri, status, {_field('file_format', 'file_format', _text('UNKNOWN'))},"
    f" {_field('content_summary', _text(''), _text(''), '$.')} FROM judged",
    "metadata_defaults": f"{ANSWER_CTES} SELECT uri, {_ANSWER_FIELDS} FROM judged",
    "quarantine": f"{ANSWER_CTES} SELECT uri, status FROM judged WHERE status <> 'ok'",
    "status_counts": f"{ANSWER_CTES} SELECT status, count(*) AS n FROM judged GROUP BY status",
    "flatten_records": f"""WITH {ANSWERS}, bodies AS (SELECT doc_id, uri, file_format, response AS body FROM answers), {PARSED},
      renamed AS (SELECT uri, j, CASE status WHEN 'not_json' THEN 'not_a_record' ELSE status END AS status FROM judged)
      SELECT uri, {', '.join(_record_field(c) for c in METADATA_COLUMNS)}, status FROM renamed""",
    "label_documents": f"""WITH {TEXTS}, asked AS (SELECT uri, {_REQUEST} AS request FROM texts),
      judged AS (SELECT *, contains(request, '$') AS failed FROM asked)
      SELECT uri, 'UNKNOWN' AS type,
        CASE WHEN failed THEN 'UNKNOWN' WHEN contains(request, '?') THEN 'FAQ' ELSE '카탈로그' END AS source,
        CASE WHEN failed THEN 'UNKNOWN' ELSE {_format(_name('uri'))} END AS file_format,
        CASE WHEN failed THEN '' ELSE length(request)::VARCHAR END AS content_summary,
        CASE WHEN failed THEN 'labeler_error' ELSE 'ok' END AS status,
        CASE WHEN failed THEN 'ValueError: no prices, please' END AS error FROM judged""",
    "label_store": f"""WITH {TEXTS}, asked AS (SELECT uri, {_REQUEST} AS request FROM texts)
      SELECT uri, 'FAQ' AS type, {_format(_name('uri'))} AS file_format, length(request)::VARCHAR AS content_summary,
        'ok' AS status, NULL::VARCHAR AS error FROM asked""",
    "csv_round_trip": f"WITH {RECORDS} SELECT "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in METADATA_COLUMNS) + " FROM records",
    "append_records": f"""WITH {RECORDS} SELECT uri, type, version, year1, updated_at FROM records
      UNION ALL SELECT 'gs://reviewed/' || doc_id, CASE WHEN quality = 1 THEN '기술정보' ELSE 'UNKNOWN' END, 'NULL', NULL, NULL FROM labels""",
    "distribution_report": f"WITH {RECORDS} {_report('records')}",
    "report_order": f"""WITH {RECORDS}, report AS ({_report('records')})
      SELECT *, row_number() OVER (ORDER BY list_position(['total', 'type', 'source', 'region', 'model', 'xev',
        'language', 'file_format'], dimension), n DESC, value NULLS FIRST) - 1 AS place FROM report""",
    "xev_distribution": f"""WITH {RECORDS} SELECT xev, CASE WHEN xev IS NULL OR xev = '' THEN 'NULL (Non-Hybrid)' ELSE xev END AS label,
      count(*) AS n FROM records GROUP BY xev""",
    "top_models": f"""WITH {RECORDS} SELECT model, count(*) AS n FROM records WHERE model IS NOT NULL
      GROUP BY model ORDER BY n DESC, model LIMIT 10""",
    "report_totals": f"WITH {RECORDS} SELECT count(*) AS n FROM records",
    "earlier_projection": f"{_EARLIER} SELECT * FROM rows",
    "earlier_report": f"""{_EARLIER} SELECT 'total' AS dimension, NULL AS value, count(*) AS n, round(avg(page_count), 2) AS mean_pages FROM rows
      UNION ALL SELECT 'car_model', car_model, count(*), NULL FROM rows GROUP BY car_model
      UNION ALL SELECT 'source_type', source_type, count(*), NULL FROM rows GROUP BY source_type""",
    "domain_violations": f"WITH {RECORDS}, {COUNTRIES} {_VIOLATIONS}",
    "region_country_check": f"""WITH {RECORDS}, {COUNTRIES},
      located AS (SELECT doc_id, country, {_pick(I.WORLD, 1)} AS region FROM records)
      SELECT doc_id, l.region, l.country, c.region AS expected_region FROM located l LEFT JOIN countries c USING (country)
      WHERE l.region <> 'UNKNOWN' AND l.region IS DISTINCT FROM c.region""",
    "label_accuracy": f"WITH {_REVIEWED} {_accuracy('quality')} UNION ALL {_accuracy('toxic')}",
    "model_recognise": f"WITH {TOLD} SELECT doc_id, {_model('full_text')} AS model FROM told",
    "model_dictionary": rf"""WITH {TOLD}, listed AS (
        SELECT unnest([{_list(I.MODELS)}]) AS name UNION ALL SELECT p_name FROM part
        UNION ALL SELECT regexp_extract(text, '^([\p{{L}}\p{{N}}]+ [\p{{L}}\p{{N}}]+ [\p{{L}}\p{{N}}]+)', 1) FROM benchmark),
      names AS (SELECT lower(name) AS lowered, min(name) AS name FROM listed
        WHERE regexp_matches(name, '[\p{{L}}\p{{N}}]') GROUP BY ALL),
      words AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(full_text), '{WORD}+')) AS word FROM told),
      near AS (SELECT doc_id, name, lowered FROM words JOIN names
        ON word = regexp_extract(lowered, '[\p{{L}}\p{{N}}]+')),
      placed AS (SELECT doc_id, name, lowered, length(regexp_extract(lower(full_text), '(?s)^(|.*?{WORD})' || lowered || '(?:{WORD}|$)', 1)) AS place,
          regexp_matches(lower(full_text), '(?s)(?:^|{WORD})' || lowered || '(?:{WORD}|$)') AS there
        FROM near JOIN told USING (doc_id) WHERE contains(lower(full_text), lowered)),
      first AS (SELECT doc_id, arg_min(name, [place, -length(lowered)]) AS model FROM placed WHERE there GROUP BY doc_id)
      SELECT doc_id, coalesce(model, 'UNKNOWN') AS model FROM told LEFT JOIN first USING (doc_id)""",
    "type_classify": f"""WITH {TOLD} SELECT doc_id, {_car_type('full_text')} AS car_type,
      {_engine('full_text')} AS engine_type, {_xev('full_text')} AS xev FROM told""",
    "price_extract": f"WITH {TOLD} {_AMOUNTS}",
    "keyword_topk": f"WITH {TEXTS}, {_keywords('texts')} SELECT doc_id, rank, word, n FROM ranked WHERE rank <= 10",
    "summary_paragraph": f"WITH {TEXTS} SELECT doc_id, {_summary('full_text')} AS summary FROM texts",
    "language_tag": f"SELECT doc_id, {_language('lang')} AS language FROM documents",
    "model_years": f"""WITH {TOLD} SELECT doc_id, list_min({_years('full_text')}) AS year1,
      list_max({_years('full_text')}) AS year2 FROM told""",
    "video_id": f"""WITH {URLS}, {IDS} SELECT page_id, video_id,
      CASE WHEN video_id IS NULL THEN 'not_a_video' ELSE 'ok' END AS status FROM ids""",
    "video_info": f"""WITH {INFO} SELECT video_id,
      CASE WHEN found THEN title END AS title, CASE WHEN found THEN description END AS description,
      CASE WHEN found THEN channel END AS channel, CASE WHEN found THEN '2024-01-29T00:00:00Z' END AS published_at,
      CASE WHEN found THEN 'ko' END AS default_language, CASE WHEN found THEN '' END AS default_audio_language,
      CASE WHEN found THEN 'ok' ELSE 'video_not_found' END AS status FROM info""",
    "caption_tracks": f"""WITH numbered AS (SELECT page_id, unnest(CASE page_id % 5 WHEN 0 THEN [0] WHEN 1 THEN [3] ELSE [1, 2] END) AS k FROM pages)
      SELECT 'vid' || page_id AS video_id,
        CASE k WHEN 0 THEN NULL WHEN 2 THEN 't' || page_id || '-2' ELSE 't' || page_id || '-1' END AS track_id,
        CASE k WHEN 1 THEN {_pick(['ko', 'de'], 1, 'page_id')} WHEN 2 THEN {_pick(['en', 'fr', 'ko'], 1, 'page_id')} WHEN 3 THEN 'en' END AS language,
        CASE WHEN k > 0 THEN k = 1 END AS is_generated FROM numbered""",
    "transcript_select": f"WITH {TRACKS} SELECT * FROM chosen",
    "batch_records": f"{_BATCH} SELECT * FROM batch",
    "batch_report": f"{_BATCH} {_report('batch')}",
    "video_records": f"{VIDEOS}, good AS (SELECT * FROM videos WHERE status = 'ok') "
    + _rule_records("good", _text("UNKNOWN"), _text("video")),
    **texts_in_parts(PART_CHARS),
}
