"""Lines that stand in several documents, kept in one of them only.

The lines of every text are exploded to 128-bit hashes of their keys (the line
without white space at its ends, A-Z in lower case). Per hash the distinct
documents are counted and the smallest ``doc_id`` is noted. The lines then meet
the hashes that stand in ``min_documents`` documents or more, which gives every
document the keys it loses, and each text is put together again, line by line
in its place, without them.

A key that stands in a third of all documents is one group: its count combines
before the shuffle, and for the join its rows are dealt over as many parts as
its share of all rows asks for. At most ``PARTS`` keys can be that frequent, so
the list of these that travels to the tasks is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import park

MIN_CHARS = 10  # code points of a key that may be dropped
MIN_DOCUMENTS = 2
PARTS = 1000  # a key with more than this part of all rows is dealt over several tasks
ROWS = 1 << 16  # of a batch that goes to Spark


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line of a text in UTF-8."""
    return [line.strip() for line in text.lower().split(b"\n")]  # bytes: only ASCII is changed


def _counts(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (
        len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars
    )


def _digests(text: bytes, min_chars: int) -> list[bytes | None]:
    """Hash of each line's key; None for one too short to be dropped."""
    return [xxhash.xxh3_128_digest(k) if _counts(k, min_chars) else None for k in line_keys(text)]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist())


def _explode(docs: DataFrame, min_chars: int, parts: dict[bytes, int]) -> DataFrame:
    """A row per document and distinct key; ``part`` spreads the keys of ``parts``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(ids, digests, part):
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])),
                 pa.array(part, pa.int32()), pa.array(ids, pa.int64())],
                ["h1", "h2", "part", "doc_id"],
            )

        ids, digests, part = [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                found = set(_digests(text, min_chars)) - {None}
                digests += found
                ids += [doc_id] * len(found)
                spread = (doc_id * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32
                part += [spread % parts[d] if d in parts else 0 for d in found] if parts else [0] * len(found)
                if len(ids) >= ROWS:
                    yield batch_of(ids, digests, part)
                    ids, digests, part = [], [], []
        if ids:
            yield batch_of(ids, digests, part)

    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(rows, "h1 long, h2 long, part int, doc_id long")


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Keys (``h1``, ``h2``) of at least ``min_documents`` documents, with
    ``n_documents`` and ``first_doc``, the smallest id."""
    lines = _explode(docs, min_chars, {})
    counted = lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc_id").alias("n_documents"), F.min("doc_id").alias("first_doc")
    )
    return counted.where(F.col("n_documents") >= min_documents)


def _lost_keys(docs: DataFrame, shared: DataFrame, min_chars: int) -> DataFrame:
    """Per ``doc_id`` the hashes (two numbers each, one after the other) it loses."""
    total = shared.agg(F.sum("n_documents")).first()[0] or 0
    share = F.ceil(F.col("n_documents") * PARTS / F.lit(max(total, 1))).cast("int")
    # n_documents add up to total, so fewer than PARTS keys have a share above 1.
    frequent = {
        np.array([r["h1"], r["h2"]], "<i8").tobytes(): r["share"]
        for r in shared.select("h1", "h2", share.alias("share")).where("share > 1").toLocalIterator()
    }
    dealt = shared.select("h1", "h2", "first_doc", F.explode(F.sequence(F.lit(0), share - 1)).alias("part"))
    lost = _explode(docs, min_chars, frequent).join(dealt, ["h1", "h2", "part"]).where("doc_id <> first_doc")
    return lost.groupBy("doc_id").agg(F.flatten(F.collect_set(F.array("h1", "h2"))).alias("lost"))


def dedupe_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``kept_text``, ``n_lines`` before and ``n_dropped``.

    A key of at least ``min_chars`` code points that stands in at least
    ``min_documents`` documents loses all its lines except those of the smallest
    ``doc_id`` that holds it. A null or empty text is one empty line. Rows of one
    ``doc_id`` are one document: they count once, and each keeps or loses a key
    as the others do. Rows without ``doc_id`` are returned whole: they neither
    count nor lose lines. An empty table gives no rows; other columns are not
    read, so they may have any names.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shared = park(shared_lines(docs, min_chars, min_documents), "shared-lines")
    joined = docs.join(_lost_keys(docs, shared, min_chars), "doc_id", "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, lost in zip(_texts(batch), batch.column("lost")):
                lines = text.split(b"\n")
                stay = lines
                if lost.is_valid:
                    numbers = lost.values.to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                    drop = {numbers[i : i + 16] for i in range(0, len(numbers), 16)}
                    stay = [x for x, d in zip(lines, _digests(text, min_chars)) if d not in drop]
                kept.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()).view(pa.string()),
                 pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["doc_id", "kept_text", "n_lines", "n_dropped"],
            )

    return joined.select("doc_id", "text", "lost").mapInArrow(
        rebuild, "doc_id long, kept_text string, n_lines long, n_dropped long"
    )


def oracle(min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> str:
    """The query's rows in SQL, line by line."""
    return rf"""
    with docs as (
      select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents
    ), lines as (
      select row_no, doc_id, unnest(string_split(text, chr(10))) as line,
        unnest(range(len(string_split(text, chr(10))))) as pos
      from docs
    ), keyed as (
      select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
      from lines
    ), shared as (
      select line_key, min(doc_id) as first_doc from keyed
      where length(line_key) >= {min_chars}
      group by line_key having count(distinct doc_id) >= {min_documents}
    ), judged as (
      select k.*, coalesce(k.doc_id <> s.first_doc, false) as dropped
      from keyed k left join shared s using (line_key)
    )
    select any_value(doc_id) as doc_id, cast(count(*) as bigint) as n_lines,
      cast(count(*) filter (where dropped) as bigint) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
    from judged group by row_no
    """
