"""Token ids as length-delimited binary records, with an offset index beside each file.

A record is: payload length (u64), masked checksum of those 8 bytes (u32), payload, masked checksum of the payload (u32),
all little-endian. The payload is the document's id (i64), the bytes of a token id (u8: 2 or 4) and the ids. A checksum c
(CRC-32) is stored as ((c >> 15 | c << 17) + 0xa282ead8) mod 2 ** 32, so that checksums of data holding checksums stay
sound. The index has, per record, document id, token count and byte offset, so records can be read in any order.

Documents are dealt by ranges of doc_id; a task writes its range to files of bounded size, each under a name of its own
attempt that is renamed when complete, so a repeated task leaves the same files.
"""

from __future__ import annotations

import gc
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.ngram_join import slices
from martloom.llm.shared import partitions, release, shared_folder, written

FILE_BYTES = 8 << 20
#: Words, and pieces of them with marks, whose ids a worker remembers, up to 200 bytes each; text encoded at a time.
REMEMBERED, ENCODED_BYTES = 400_000, 4 << 20
#: Words of letters that are encoded in one text.
JOINED = 256
NO_ID = -(1 << 63)
_PUNCTUATION = '.,;:!?"()[]{}|*%$&#+-/<=>@\\^_`~'


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Whole texts to ids as bytes. The tokenizer never joins text across the start of a single space after a word, nor across a
    line's end between two words, so a text is encoded piece by piece, and pieces seen before are looked up, each once for all
    texts of a call. A text with white space after a space goes whole."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens: dict[str, np.ndarray] = {}
        for lead, byte in ((" ", "\u0120"), ("\n", "\u010a")):
            self.opens[lead] = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.opens[lead][[i for token, i in vocabulary.items() if token.startswith(byte)]] = True
        self.words: dict[str, dict[str, bytes]] = {lead: {} for lead in self.opens}
        self.pieces: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _learn(self, words: list[str], lead: str, joined: int) -> None:
        """Words after `lead` each, several in one text if they have letters only: then each begins at a token with `lead`."""
        width = np.dtype(self.kind).itemsize
        texts = [words[i : i + joined] for i in range(0, len(words), joined)]
        for group, e in zip(texts, self.tokenizer.encode_batch_fast([lead + lead.join(g) for g in texts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=self.kind)
            begins = np.flatnonzero(self.opens[lead][ids]) if len(group) > 1 else np.zeros(1, np.int64)
            if len(begins) != len(group):
                self._learn(group, lead, 1)
                continue
            data, bounds = ids.tobytes(), [*(begins * width).tolist(), len(ids) * width]
            for w, a, b in zip(group, bounds[:-1], bounds[1:], strict=True):
                self.words[lead][w] = data[a:b]

    @staticmethod
    def _letters(piece: str) -> str:
        """The piece without the marks that end it, if the rest is letters only; else all of it."""
        letters = piece.rstrip(_PUNCTUATION)
        return letters if letters.isalpha() else piece

    def _ids(self, pieces: list[str], lead: str) -> list[bytes]:
        """Ids of pieces after `lead`: those of their letters and those of the marks that end them."""
        known, marks = self.words[lead], self.marks
        letters = [self._letters(p) for p in pieces]
        new = {w for w in letters if w not in known}
        self._learn([w for w in new if w.isalpha()], lead, JOINED)
        self._learn([w for w in new if not w.isalpha()], lead, 1)
        out = []
        for p, w in zip(pieces, letters, strict=True):
            if len(w) == len(p):
                out.append(known[w])
            else:
                mark = p[len(w) :]
                if mark not in marks:
                    marks[mark] = self.whole(mark)
                out.append(known[w] + marks[mark])
        return out

    @staticmethod
    def _lines(piece: str) -> list[str]:
        """The piece's lines, if no white space stands beside the ends of lines; else all of it."""
        lines = piece.split("\n")
        return lines if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines) else [piece]

    def _add(self, pieces: list[str]) -> None:
        """Remember ids of pieces after a space."""
        for known in (*self.words.values(), self.marks):
            if len(known) > REMEMBERED:
                known.clear()
        plain = [p for p in pieces if "\n" not in p]
        lines = [self._lines(p) for p in pieces if "\n" in p]
        self.pieces.update(zip(plain, self._ids(plain, " "), strict=True))
        first, later = [x[0] for x in lines], list({x for own in lines for x in own[1:]})
        after = dict(zip(later, self._ids(later, "\n"), strict=True))
        for own, ids in zip(lines, self._ids(first, " "), strict=True):
            self.pieces["\n".join(own)] = b"".join([ids, *map(after.__getitem__, own[1:])])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; there are no nulls among `texts`."""
        split = pc.split_pattern(texts, " ")
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        distinct, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        ids = list(map(self.pieces.get, distinct))
        apart = np.zeros(len(distinct), dtype=bool)
        new = []
        for i in [i for i, known in enumerate(ids) if known is None]:
            if not distinct[i] or distinct[i][0].isspace():
                apart[i], ids[i] = True, b""
            else:
                new.append(i)
        self._add([distinct[i] for i in new])
        for i in new:
            ids[i] = self.pieces[distinct[i]]
        # A text's first piece has no space before it. Its ids stand behind those of all pieces.
        begin = ends - np.diff(ends, prepend=0)
        first = [distinct[i] for i in code[begin].tolist()]
        code = code.astype(np.int64)
        code[begin] = len(ids) + np.arange(len(begin))
        ids += [self.whole(x) if x else b"" for x in first]
        places = np.flatnonzero(np.concatenate((apart, np.zeros(len(begin), dtype=bool)))[code])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.kind).itemsize
        start = np.cumsum(size) - size
        upto = np.cumsum(size[code])
        data = np.frombuffer(b"".join(ids), dtype=self.kind)
        at = np.repeat(start[code] - upto + size[code], size[code])
        at += np.arange(len(at))
        data = data[at]
        bounds = [0, *upto[ends - 1].tolist()]
        out = [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for t in np.unique(np.searchsorted(ends, places, "right")).tolist():
            out[t] = self.whole(texts[t].as_py())
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class _Writer:
    """Files of one task, each closed when it is full."""

    def __init__(self, folder: str) -> None:
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.task, self.attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        self.made: list[tuple[int, int, int, int]] = []
        self.parts: list[bytes] = []
        self.index: list[tuple[int, int, int]] = []
        self.at = 0

    def add(self, doc_id: int, ids: bytes, width: int) -> None:
        payload = struct.pack("<qB", doc_id, width) + ids
        head = struct.pack("<Q", len(payload))
        record = head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))
        self.index.append((doc_id, len(ids) // width, self.at))
        self.parts.append(record)
        self.at += len(record)
        if self.at >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if not self.parts:
            return
        name = f"{self.task:06d}-{len(self.made):06d}"
        for suffix, data in (("idx", np.array(self.index, dtype="<i8").tobytes()), ("bin", b"".join(self.parts))):
            draft = f"{self.folder}/_{name}-{self.attempt}.{suffix}"
            with self.store.open_output_stream(draft) as f:
                f.write(data)
            self.store.move(draft, f"{self.folder}/{name}.{suffix}")
        self.made.append((self.task, len(self.made), len(self.index), sum(n for _, n, _ in self.index)))
        self.parts, self.index, self.at = [], [], 0


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write `docs` (doc_id, text) in ascending doc_id order below `folder`; returns (task, file, records, tokens) per file.

    A null or empty text is written as its end id alone, a null doc_id as NO_ID before all others. Repeated rows are
    written each; rows of one doc_id follow one another by text. `folder` must be one that pyarrow's file systems write to.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the worker holds millions of strings and makes no cycles; looking for some takes a tenth of the time
        encoder, writer = _encoder(tokenizer), _Writer(folder)
        width = np.dtype(encoder.kind).itemsize
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                for name, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                    writer.add(name, ids + end, width)
        writer.close()
        gc.enable()
        release()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in writer.made], pa.int64()) for i in range(4)], ["task", "file", "records", "tokens"])

    return written(ranged.mapInArrow(write, "task long, file long, records long, tokens long"), "record-files")


def records_of(content: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) of each record of a file; a wrong checksum or length raises."""
    at = 0
    while at < len(content):
        head = content[at : at + 8]
        (length,) = struct.unpack("<Q", head)
        payload = content[at + 12 : at + 12 + length]
        checks = struct.unpack("<I", content[at + 8 : at + 12]) + struct.unpack("<I", content[at + 12 + length : at + 16 + length])
        if checks != (masked(head), masked(payload)):
            raise ValueError(f"damaged record at byte {at}")
        doc_id, width = struct.unpack("<qB", payload[:9])
        yield doc_id, np.frombuffer(payload, dtype=f"<u{width}", offset=9)
        at += 16 + length


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(task, file, place, doc_id, before, n_tokens, ids_crc32) per record: `before` counts the tokens before it in its file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                task, file = map(int, name.rpartition("/")[2].removesuffix(".bin").split("-"))
                found = [(d, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, ids in records_of(content.as_py())]
                n = np.array([x[1] for x in found], dtype=np.int64)
                columns = [np.full(len(found), task), np.full(len(found), file), np.arange(len(found)), [x[0] for x in found], np.cumsum(n) - n, n, [x[2] for x in found]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["task", "file", "place", "doc_id", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*.bin").load(folder).select("path", "content")
    return files.mapInArrow(read, "task long, file long, place long, doc_id long, before long, n_tokens long, ids_crc32 long")


def read_at(folder: str, file: str, places: list[int]) -> list[tuple[int, np.ndarray]]:
    """Records of one file by their places in it, in the order asked for, through the offset index."""
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{file}.idx") as f:
        index = np.frombuffer(f.read(), dtype="<i8").reshape(-1, 3)
    out = []
    with store.open_input_file(f"{path}/{file}.bin") as f:
        for p in places:
            f.seek(int(index[p, 2]))
            (length,) = struct.unpack("<Q", f.read(8))
            f.seek(int(index[p, 2]))
            out += list(records_of(f.read(16 + length)))
    return out


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents, read the files back: doc_id, start (tokens of all documents before), n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-records")
    files = write_records(docs, tokenizer, folder, end_id)
    tasks = files.groupBy("task").agg(F.sum("tokens").alias("tokens"))
    upto = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.withColumn("task_start", F.coalesce(F.sum("tokens").over(upto), F.lit(0))).select("task", "task_start")
    within = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("file_start", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(tasks, "task")
    starts = written(starts.select("task", "file", (F.col("task_start") + F.col("file_start")).alias("file_start")), "file-starts")
    rows = read_records(spark, folder).join(starts, ["task", "file"])
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return rows.select(doc.alias("doc_id"), (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
