"""File contents to documents, by an extractor the caller brings."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions import uri as U
from labelmill.schema import EXTRACTED

# Takes URI, content and MIME type; answers with the keys ``full_text``,
# ``pages`` and ``entities``, the last two optional.
Extractor = Callable[[str, bytes, str], dict]


def extract_documents(files: DataFrame, extractor: Extractor) -> DataFrame:
    """Documents of files ``(uri, content)``; a failing file keeps a status row.

    Content is read in the tasks that extract it and is never shuffled; Spark
    packs files into partitions by their length.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri, mime, content in zip(batch["uri"], batch["mime_type"], batch["content"]):
                row = {"uri": uri, "mime_type": mime, "status": "ok", "error": None}
                try:
                    found = extractor(uri, bytes(content), mime)
                    row["full_text"] = found["full_text"]
                    row["pages"] = list(found.get("pages", []))
                    row["entities"] = list(found.get("entities", []))
                except Exception as e:  # one bad file must not stop the others
                    row.update(full_text=None, pages=[], entities=[])
                    row.update(status="extractor_error", error=f"{type(e).__name__}: {e}")
                rows.append(row)
            names = ["uri", "mime_type", "full_text", "pages", "entities", "status", "error"]
            yield pd.DataFrame(rows, columns=names)

    chosen = files.select("uri", U.mime_type(F.col("uri")).alias("mime_type"), "content")
    done = chosen.mapInPandas(extract, EXTRACTED)
    return done


def _plain_text() -> Extractor:
    # Made inside a function, it travels to the workers as code: they need not
    # have this package installed.
    def plain_text(uri: str, content: bytes, mime_type: str) -> dict:
        """Extractor for text files: form feeds separate the pages."""
        text = content.decode("utf-8")
        pages = [
            {"page_number": i, "text": page.strip()}
            for i, page in enumerate(text.split("\f"), start=1)
        ]
        return {"full_text": text, "pages": pages, "entities": []}

    return plain_text


plain_text = _plain_text()
