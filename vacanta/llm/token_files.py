"""Token ids in Arrow files of fixed-size sequences, and reading them back.

A file holds record batches of two fixed-size lists, ``ids`` and ``mask``: all
sequences have ``LENGTH`` ids, so sequence ``i`` lies at a known place and is
read without copying. The ids of the documents follow each other, each
document closed by ``END``; only the last sequence of a file is filled up, and
its mask says which ids are real. A second file beside it has one row per
document: id, first id in the file, number of ids.

Documents are sorted by id over the whole table and each sorted piece writes
one file, so ascending files are the table in order. Files get names of their
own at each attempt; only names that a finished task reports count. They go to
the shared folder through Arrow's file systems. Ids need two bytes where the
vocabulary allows.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator
from types import ModuleType
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm.common import park
from vacanta.sources.workspace import new_folder

TOKENIZER = "byte_bpe_50k.json"
LENGTH = 1024
ROWS = 128  # sequences a batch
END = 0
KNOWN_WORDS = 200_000  # remembered encodings of a worker, twice; some 80 MB together
LONG_WORD = 64  # characters; longer words are not remembered, which bounds the memory
WORDS_AT_ONCE = 500  # learned by one call
BYTES_AT_ONCE = 2_000_000  # of texts whose distinct words are looked up together

# What a byte that ends a word may be followed by, and what a byte that starts one
# follows: white space after anything else, marks after letters and digits. A byte
# of a longer character has to be looked at with the one before.
_SPACES, _MARKS = b" \n", bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_SPACE, _MARK, _SPACE_IF, _MARK_IF = 1, 2, 4, 8
_ENDS, _STARTS = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
_ENDS[33:127] = _SPACE
_ENDS[[c for c in range(128) if chr(c).isalnum()]] |= _MARK
_ENDS[128:] = _SPACE_IF | _MARK_IF
_STARTS[list(_SPACES)] = _SPACE | _SPACE_IF
_STARTS[list(_MARKS)] = _MARK | _MARK_IF
# Last two bytes of the white space beyond ASCII; some other characters end alike.
_WIDE_SPACE = np.zeros((256, 256), bool)
_WIDE_SPACE[np.ix_([0xC2, 0x80, 0x81, 0x9A, 0xA0], [*range(0x80, 0x8B), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])] = True
# Letters of two bytes, U+00C0 to U+00FF without the signs of times and division.
_LATIN = np.zeros((256, 256), bool)
_LATIN[0xC3, 0x80:0xC0] = True
_LATIN[0xC3, [0x97, 0xB7]] = False


def word_starts(data: np.ndarray) -> np.ndarray:
    """Whether a word starts at each byte of some texts, the end included.

    A byte-level tokenizer's pattern never joins what lies on two sides of
    these places, nor do the ids of one side depend on the other: white space
    after something else, and a mark (no apostrophe, as in ``'s``) after a
    letter or digit. Where that is in doubt, no word starts.
    """
    starts = np.zeros(len(data) + 1, bool)
    found = _ENDS[data[:-1]] & _STARTS[data[1:]]
    starts[1 : len(data)] = found & (_SPACE | _MARK) != 0
    at = np.flatnonzero(found & (_SPACE_IF | _MARK_IF)) + 1
    pair = data[at - 2], data[at - 1]
    starts[at] = np.where(found[at - 1] & _SPACE_IF, ~_WIDE_SPACE[pair], _LATIN[pair])
    return starts


class Encoder:
    """Ids of whole texts as bytes, by the tokenizers library.

    With a byte-level tokenizer a text is the ids of its words in turn (see
    ``word_starts``), and each distinct word goes to the library once, many
    words to a call. A text with a special token in it goes there whole, and
    so does every text with a tokenizer of another kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        before = self.tokenizer.pre_tokenizer
        self.splits = (
            self.tokenizer.normalizer is None
            and isinstance(before, pre_tokenizers.ByteLevel)
            and before.use_regex
            and not before.add_prefix_space
            and vocabulary.keys() >= set(before.alphabet())
            and not any(c.isspace() for c in "".join(self.special))
        )
        # Bytes that each id stands for: one per character of a byte-level token.
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.lengths[list(vocabulary.values())] = [len(token) for token in vocabulary]
        # Words of late, and those before them: what is met again stays.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The encoder of this worker process; its words serve all tasks that run here."""
        state = vars(sys.modules.setdefault("_vacanta_worker", ModuleType("_vacanta_worker")))
        return state.setdefault("encoders", {}).get(path) or state["encoders"].setdefault(path, cls(path))

    def whole(self, text: str) -> bytes:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, self.type).tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Encode distinct words, many as one text; ids are told apart by their bytes.

        A word after another must start with white space, or have a line end
        put before it, and the one before must not end with white space. Words
        that cannot stand so, and long ones, are encoded by themselves.
        """
        alone, spaced, apart = [], [], []
        for word in words:
            if len(word) > LONG_WORD or word[-1].isspace():
                alone.append(word)
            elif word[0] in " \n":
                spaced.append(word)
            else:
                (alone if word[0].isspace() else apart).append(word)
        learned = {word: self.whole(word) for word in alone}
        for some, between in ((spaced, ""), (apart, "\n")):
            for at in range(0, len(some), WORDS_AT_ONCE):
                part = some[at : at + WORDS_AT_ONCE]
                learned.update(zip(part, self._joined(part, between), strict=True))
        return learned

    def _joined(self, words: list[str], between: str) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([between + between.join(words)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, self.type)
        ends = np.cumsum(self.lengths[ids])
        sizes = np.array([len(word.encode()) for word in words])
        upto = np.cumsum(sizes + len(between))
        first, after = (
            (np.searchsorted(ends, places, "right") * self.type.itemsize).tolist() for places in (upto - sizes, upto)
        )
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(first, after, strict=True)]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = pa.array(np.full(len(texts), not self.splits))
        for token in self.special if self.splits else ():
            whole = pc.or_(whole, pc.match_substring(texts, token))
        apart = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        encoded = self._by_words(pc.if_else(whole, "", texts) if apart else texts)
        for at in apart:
            encoded[at] = self.whole(texts[at].as_py())
        return encoded

    def _by_words(self, texts: pa.Array) -> list[bytes]:
        bounds, data = _strings(texts)
        starts = word_starts(data)
        starts[bounds] = True
        places = np.flatnonzero(starts)
        words = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
        coded = words.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        ends, raw = _strings(ids.take(coded.indices))
        cuts = ends[np.searchsorted(places, bounds)].tolist()
        raw = raw.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        for k in missing:
            found[k] = self.older.get(words[k])
        learned = self.learn([words[k] for k in missing if found[k] is None])
        for k in missing:
            if found[k] is None:
                found[k] = learned[words[k]]
        if len(self.known) + len(missing) > KNOWN_WORDS:
            self.known, self.older, missing = {}, self.known, range(len(words))
        self.known.update((words[k], found[k]) for k in missing if len(words[k]) <= LONG_WORD)
        return found


def _strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and bytes of an array of large strings, from 0."""
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    return bounds - bounds[0], data


class SequenceWriter:
    """Writes a stream of ids as batches of equal sequences; holds one batch."""

    def __init__(self, sink, id_type: np.dtype, length: int):
        self.type, self.length = id_type, length
        kind = pa.from_numpy_dtype(id_type)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[bytes] = []
        self.held = 0
        self.batch = length * ROWS * id_type.itemsize

    def write(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.batch:
            data = memoryview(b"".join(self.waiting))
            whole = self.held // self.batch * self.batch
            for at in range(0, whole, self.batch):
                self._batch(data[at : at + self.batch])
            self.waiting = [bytes(data[whole:])]
            self.held -= whole

    def _batch(self, data) -> None:
        ids = np.frombuffer(data, self.type)
        rows = -(-len(ids) // self.length)
        flat = np.zeros(rows * self.length, self.type)
        flat[: len(ids)] = ids
        mask = np.arange(len(flat)) < len(ids)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(a), self.length) for a in (flat, mask)]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._batch(b"".join(self.waiting))
        self.file.close()


def _runs(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in turn, so many at once as make some ``BYTES_AT_ONCE`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    at = done = 0
    while at < len(texts):
        upto = min(int(np.searchsorted(ends, done + BYTES_AT_ONCE)) + 1, len(texts))
        yield texts.slice(at, upto - at)
        at, done = upto, int(ends[upto - 1])


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's URI with the file system that Spark resolves it against."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    return uri if "://" in uri else uri.replace(":/", ":///", 1)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder's URI; a plain path is a local one."""
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class TokenFiles(NamedTuple):
    """``manifest`` has per file: number, name, documents, ids; files lie in ``folder``."""

    folder: str
    manifest: DataFrame
    length: int


def write_tokens(
    docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, length: int = LENGTH
) -> TokenFiles:
    """Encode whole texts and write them in ascending order of doc_id.

    ``docs`` has doc_id and text; other columns are not read. A null text is
    empty and gives its end id alone. Null ids come first; rows of equal id
    are ordered by their text, and equal rows are written each. No rows give
    an empty manifest.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or new_folder(spark, "tokens"))
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = (
        docs.select("doc_id", text.alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, index = Encoder.of_worker(tokenizer), None, None
        end = np.array([END], encoder.type).tobytes()
        documents = ids = 0
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        rows = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            if writer is None:
                files, path = place(folder)
                files.create_dir(path, recursive=True)
                sinks = [files.open_output_stream(f"{path}/{name}.{kind}.arrow") for kind in ("ids", "index")]
                writer = SequenceWriter(sinks[0], encoder.type, length)
                index = pa.ipc.new_file(sinks[1], rows)
            counts = []
            for texts in _runs(batch.column(1)):
                for encoded in encoder.encode(texts):
                    writer.write(encoded)
                    writer.write(end)
                    counts.append(len(encoded) // encoder.type.itemsize + 1)
            starts = ids + np.concatenate([[0], np.cumsum(counts)])
            columns = [batch.column(0).cast(pa.int64()), pa.array(starts[:-1]), pa.array(counts, pa.int64())]
            index.write_batch(pa.record_batch(columns, schema=rows))
            ids, documents = int(starts[-1]), documents + len(counts)
        if writer is not None:
            writer.close()
            index.close()
            for sink in sinks:
                sink.close()
            number = TaskContext.get().partitionId()
            yield pa.record_batch(
                {"number": pa.array([number], pa.int32()), "name": [name], "documents": [documents], "ids": [ids]}
            )

    manifest = ordered.mapInArrow(write, "number int, name string, documents long, ids long")
    return TokenFiles(folder, park(manifest, "manifest"), length)


def read_tokens(spark: SparkSession, files: TokenFiles, sequences: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Reads the files that the manifest names, a batch at a time. With
    ``sequences`` gives instead one row per stored sequence: number (from 0),
    ids, mask.
    """
    # A few numbers per file.
    parts = sorted(files.manifest.collect())
    rows, before, stored = [], 0, 0
    for part in parts:
        rows.append((part["name"], before, stored))
        before += part["ids"]
        stored += -(-part["ids"] // files.length)
    schema = "name string, before long, stored long"
    tasks = spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))
    folder, length = files.folder, files.length

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = place(folder)
                with (
                    store.open_input_file(f"{path}/{name}.ids.arrow") as data,
                    store.open_input_file(f"{path}/{name}.index.arrow") as index,
                ):
                    yield from _documents(pa.ipc.open_file(data), pa.ipc.open_file(index), before, length)

    def stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                store, path = place(folder)
                with store.open_input_file(f"{path}/{name}.ids.arrow") as data:
                    reader = pa.ipc.open_file(data)
                    for k in range(reader.num_record_batches):
                        got = reader.get_batch(k)
                        numbers = pa.array(np.arange(first, first + got.num_rows))
                        first += got.num_rows
                        yield pa.record_batch(
                            [numbers, got.column(0).cast(pa.list_(pa.int32(), length)).cast(pa.list_(pa.int32())),
                             got.column(1).cast(pa.list_(pa.bool_()))],
                            names=["number", "ids", "mask"],
                        )

    if sequences:
        return tasks.mapInArrow(stored_rows, "number long, ids array<int>, mask array<boolean>")
    return tasks.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(data, index, before: int, length: int) -> Iterator[pa.RecordBatch]:
    """Checksums of one file's documents; a document may lie in several batches."""
    number, ids, begin = -1, np.zeros(0, "<u4"), 0  # the batch at hand and its first id's place
    for k in range(index.num_record_batches):
        rows = index.get_batch(k)
        sums = []
        for start, count in zip(rows.column(1).to_numpy(), rows.column(2).to_numpy(), strict=True):
            crc, at = 0, int(start)
            end = at + int(count)
            while at < end:
                if at >= begin + len(ids):
                    begin += len(ids)
                    number += 1
                    ids = data.get_batch(number).column(0).flatten().to_numpy().astype("<u4")
                upto = min(end, begin + len(ids))
                crc = zlib.crc32(ids[at - begin : upto - begin].tobytes(), crc)
                at = upto
            sums.append(crc)
        starts = pa.array(rows.column(1).to_numpy() + before)
        yield pa.record_batch(
            [rows.column(0), starts, rows.column(2), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
