"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from kestrel.session import cut_lineage
from kestrel.sources.tables import table

__all__ = ["cut_lineage", "document_key", "free_name", "n_words", "row_key", "table", "text_slices"]


def n_words(text: Column) -> Column:
    """Number of words of ``text`` (null: 0), JVM-side."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def document_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a document, by its id (which may be null or repeat) and text."""
    return F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))


def row_key(df: DataFrame) -> Column:
    """128-bit key of a row by all its columns: rows that differ in any have different keys."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{f.name}`").cast("string").alias(f"c{i}") if isinstance(f.dataType, BinaryType) else F.col(f"`{f.name}`").alias(f"c{i}")
                                              for i, f in enumerate(df.schema.fields)]), {"ignoreNullFields": "false"})))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_slices(batches: Iterator, size: int = 1 << 20) -> Iterator[tuple]:
    """Arrow batches as (columns, texts) pieces of about ``size`` bytes of text.

    The last column must be the text as binary; the others come back as Python
    lists.  A single longer text makes a piece of its own, whole.  Pieces bound
    what a Python worker holds however many rows an Arrow batch has.
    """
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        start = held = 0
        for i in range(batch.num_rows):
            held += len(texts[i].as_buffer()) if texts[i].is_valid else 0
            if held >= size or i == batch.num_rows - 1:
                part = batch.slice(start, i + 1 - start)
                yield [c.to_pylist() for c in part.columns[:-1]], [b or b"" for b in part.columns[-1].to_pylist()]
                start, held = i + 1, 0
