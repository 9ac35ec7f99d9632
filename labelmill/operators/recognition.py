"""Names of a dictionary table found in texts.

A text is cut into words once. Words that begin a name are found by a join with
the dictionary, and what follows such a word is held against the whole name, so
the cost grows with the text and not with the number of names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.let import let
from labelmill.operators.skew import join_narrow

UNKNOWN = "UNKNOWN"
# Names that may be broadcast, once counted; about 200 bytes each.
BROADCAST_NAMES = 200_000

_WORD = r"([\p{L}\p{N}]++)([^\p{L}\p{N}]*+)"
_LETTER = r"[\p{L}\p{N}]"


def dictionary(names: DataFrame, column: str = "name") -> DataFrame:
    """``(first, before, lowered, name)`` of a table of names, one row per lower-case name.

    ``first`` is the first word, ``before`` what stands in front of it. Of names
    that differ in case only the smallest counts. Null names and names without a
    letter or digit are left out.
    """
    name = F.col(column).cast("string")
    known = names.filter(name.rlike(_LETTER)).groupBy(F.lower(name).alias("lowered"))
    return known.agg(F.min(name).alias("name")).select(
        F.regexp_extract("lowered", _WORD, 1).alias("first"),
        F.regexp_extract("lowered", r"^([^\p{L}\p{N}]*+)", 1).alias("before"),
        "lowered",
        "name",
    )


def _words(text: Column, words: Column | int, before: Column | int) -> Column:
    """Each word as ``(at, word, ahead, behind)``: with what follows it and what is in front.

    ``ahead`` reaches over so many words, ``behind`` over so many characters.
    """

    def prepared(parts: Column) -> Column:
        both = F.arrays_zip(parts["found"].alias("w"), parts["gaps"].alias("g"))
        return F.struct(
            parts["found"].alias("found"),
            parts["gaps"].alias("gaps"),
            F.transform(both, lambda p: F.concat(p["w"], p["g"])).alias("joined"),
            F.regexp_extract(parts["text"], r"^([^\p{L}\p{N}]*+)", 1).alias("front"),
        )

    def listed(parts: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            gap = F.when(i == 0, parts["front"]).otherwise(F.get(parts["gaps"], i - 1))
            return F.struct(
                i.alias("at"),
                w.alias("word"),
                F.array_join(F.slice(parts["joined"], i + 1, words), "").alias("ahead"),
                F.right(gap, F.lit(before)).alias("behind"),
                ((i == 0) & (F.length(gap) <= before)).alias("opens"),
            )

        return F.transform(parts["found"], word)

    lowered = F.lower(text)
    parts = F.struct(
        lowered.alias("text"),
        F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(1)).alias("found"),
        F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(2)).alias("gaps"),
    )
    # Named before they are used for every word, so each is made once per text.
    return let(let(parts, prepared), listed)


def first_names(documents: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """``(key, name)``: the first name of a ``dictionary`` in each text, for texts that hold one.

    Case is ignored; a name stands alone, not inside a longer word. Of names that
    begin at the same place the longest counts. No text is shuffled: words meet
    the dictionary, broadcast if it is small or else spread over salts of its
    words, and only what is found is grouped. A key that occurs twice is one.
    """
    longest, width = names.agg(
        F.max(F.size(F.regexp_extract_all("lowered", F.lit(_WORD), F.lit(1)))), F.max(F.length("before"))
    ).first()
    listed = F.explode(_words(F.col(text), longest or 1, (width or 0) + 1)).alias("w")
    words = documents.select(F.col(key).alias("_key"), listed).select("_key", "w.*")
    if names.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES:
        met = words.join(F.broadcast(names), words["word"] == names["first"])
    else:
        met = join_narrow(
            words.withColumnRenamed("word", "first"), names, ["first"], F.concat_ws(" ", "_key", "at"), "inner"
        )
    tail = F.col("lowered").substr(F.length("before") + 1, F.length("lowered"))
    follows = F.startswith("ahead", tail) & ~F.substring(
        F.col("ahead"), F.length(tail) + 1, F.lit(1)
    ).rlike(_LETTER)
    # In front of a name that begins with a mark, no word may end.
    room = F.col("opens") | (F.length("behind") > F.length("before")) | (F.col("before") == "")
    stands = F.endswith("behind", "before") & room
    place = F.struct("at", -F.length("before"), -F.length("lowered"), "lowered")
    found = met.filter(follows & stands).groupBy("_key").agg(F.min_by("name", place).alias("name"))
    return found.select(F.col("_key").alias(key), "name")


def recognise(documents: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """``(key, model)`` of every document: its first name, else ``UNKNOWN``."""
    found = first_names(documents, key, text, names)
    return (
        documents.select(key)
        .join(found, key, "left")
        .select(key, F.coalesce("name", F.lit(UNKNOWN)).alias("model"))
    )
