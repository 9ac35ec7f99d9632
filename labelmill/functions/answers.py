"""Labelling answers: strict JSON, absent keys against nulls, defaults.

``VARIANT`` keeps what a typed parse loses: whether a key is absent or null.
An absent key takes its default, a null stays null.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelmill.functions.let import let
from labelmill.functions.text import strip_fences
from labelmill.schema import FIELD_DEFAULTS, LABEL_FIELDS, METADATA_COLUMNS

# Closes the array an answer is wrapped in; must not occur in an answer.
_END = "end-of-answer-5f1c9a70d2b44e0f"


def parse_strict(text: Column) -> Column:
    """JSON as ``VARIANT``, null unless the whole text is one JSON value.

    ``try_parse_json`` stops after the first value and ignores what follows.
    Wrapped as ``[text, end]`` anything behind the first value either breaks
    the array or makes it longer than two.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))
    return let(F.try_parse_json(wrapped), _sole_value)


def _sole_value(v: Column) -> Column:
    closed = F.try_variant_get(v, "$[1]", "string") == _END
    alone = F.try_variant_get(v, "$[2]", "variant").isNull()
    return F.when(closed & alone, F.try_variant_get(v, "$[0]", "variant"))


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def has_key(value: Column, key: str) -> Column:
    """Whether the key is there at all, with a null value or another."""
    return F.try_variant_get(value, f"$.{key}", "variant").isNotNull()


def text_at(value: Column, key: str) -> Column:
    """Value as text; nested values as JSON, null for a null or absent key."""
    return F.try_variant_get(value, f"$.{key}", "string")


def field_or(value: Column, key: str, default: Column) -> Column:
    return F.when(has_key(value, key), text_at(value, key)).otherwise(default)


def labels_of(parsed: Column) -> Column:
    """The ``metadata`` of an answer or a stored record."""
    return F.try_variant_get(parsed, "$.metadata", "variant")


def answer_status(parsed: Column, labels: Column) -> Column:
    """``ok``, or why the answer is replaced by the default record."""
    return (
        F.when(parsed.isNull(), F.lit("not_json"))
        .when(~is_object(parsed), F.lit("not_an_object"))
        .when(labels.isNotNull() & ~is_object(labels), F.lit("metadata_not_an_object"))
        .otherwise(F.lit("ok"))
    )


def parse_answer(answer: Column) -> Column:
    return parse_strict(strip_fences(answer))


def answer_fields(
    parsed: Column, labels: Column, status: Column, file_format: Column, run_date: Column
) -> list[Column]:
    """The 13 metadata columns of a parsed answer.

    A rejected answer yields the default record, whose ``file_format`` is
    ``UNKNOWN``; in an accepted one an absent ``file_format`` is taken from the
    file's extension.
    """
    ok = status == "ok"
    defaults = {k: F.lit(v).cast("string") for k, v in FIELD_DEFAULTS.items()}
    defaults["updated_at"] = run_date
    defaults["file_format"] = file_format
    rejected = {**defaults, "file_format": F.lit("UNKNOWN")}

    columns = [
        F.when(ok, field_or(labels, k, defaults[k])).otherwise(rejected[k]).alias(k)
        for k in LABEL_FIELDS
    ]
    summary = F.when(ok, field_or(parsed, "content_summary", F.lit(""))).otherwise(F.lit(""))
    return columns + [summary.alias("content_summary")]


def record_status(record: Column, nested: Column) -> Column:
    """``ok``, or why a stored record cannot be flattened."""
    return F.regexp_replace(answer_status(record, nested), "^not_json$", "not_a_record")


def record_fields(record: Column, nested: Column, status: Column) -> list[Column]:
    """The 13 columns of a stored record, nested or flat.

    Fields come from ``metadata`` when that key exists, else from the top
    level, never from both; the summary always comes from the top level. An
    absent key is ``''``, a null stays null.
    """
    usable = status == "ok"

    def column(name: str) -> Column:
        at_top = field_or(record, name, F.lit(""))
        if name == "content_summary":
            value = at_top
        else:
            inside = field_or(nested, name, F.lit(""))
            value = F.when(nested.isNotNull(), inside).otherwise(at_top)
        return F.when(usable, value).alias(name)

    return [column(c) for c in METADATA_COLUMNS]
