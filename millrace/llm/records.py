"""Token ids as length-delimited binary records with masked checksums and an offset index.

A shard ``shard-NNNNN.rec`` is a run of records. Each record is

    length   unsigned 64-bit, of the payload in bytes
    check    unsigned 32-bit, masked CRC-32 of the eight length bytes
    payload  the serialised sequence
    check    unsigned 32-bit, masked CRC-32 of the payload

all little-endian. The mask turns a checksum right by 15 bits and adds 0xA282EAD8, so that a
checksum of data that holds checksums stays meaningful. A payload is one byte of id width (2 or 4), one
byte that is 1 where the document id is NULL, the id as signed 64-bit, and the token ids.

``shard-NNNNN.idx`` is the offset index: per record its offset and payload length, both unsigned 64-bit. It lets a
loader read records in any order (``read_at``) without a pass over the shard.

Documents are dealt to shards by ranges of their id, so shard order and record order together are
ascending id order; NULL ids come first. Equal ids lie together, within a shard by text, and all are kept.
Shards are moved to their place when complete, and a repeated task writes the same bytes, so a lost
executor leaves no half shard. Ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` for any tokenizer file, strings of special tokens included.
Defined results: a NULL text is encoded as an empty one, which has the end id
alone; an empty table gives no shards and no rows; extra columns are not written.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import filesystem, map_batches, per_worker, publish, table
from millrace.session import scratch_path

MASK_ADD = 0xA282EAD8
HEAD, TAIL, PAYLOAD_HEAD, INDEX_ENTRY = "<QI", "<I", "<BBq", "<QQ"
HEAD_BYTES, TAIL_BYTES, PAYLOAD_HEAD_BYTES, INDEX_BYTES = map(struct.calcsize, (HEAD, TAIL, PAYLOAD_HEAD, INDEX_ENTRY))
READ_BYTES = 4 << 20
ROWS_HELD = 500  # texts that are Python strings at once


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    return (((check >> 15) | (check << 17)) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack(TAIL, masked(length)), payload, struct.pack(TAIL, masked(payload))))


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(PAYLOAD_HEAD, width, doc_id is None, doc_id or 0) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, no_id, doc_id = struct.unpack_from(PAYLOAD_HEAD, payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=PAYLOAD_HEAD_BYTES)
    return (None if no_id else doc_id), ids


def read_stream(source):
    """(document id, ids) of each record of an open shard, with a bounded buffer."""
    buffer, at = b"", 0

    def need(count: int) -> bool:
        nonlocal buffer, at
        if len(buffer) - at < count:
            parts, have = [buffer[at:]], len(buffer) - at
            while have < count:
                more = source.read(max(READ_BYTES, count - have))
                if not more:
                    break
                parts.append(more)
                have += len(more)
            buffer, at = b"".join(parts), 0
        return len(buffer) - at >= count

    while need(1):
        if not need(HEAD_BYTES):
            raise ValueError("shard ends within a record's length")
        length, check = struct.unpack_from(HEAD, buffer, at)
        if masked(buffer[at : at + 8]) != check:
            raise ValueError("checksum of a record's length is wrong")
        at += HEAD_BYTES
        if not need(length + TAIL_BYTES):
            raise ValueError("shard ends within a record")
        payload = buffer[at : at + length]
        if masked(payload) != struct.unpack_from(TAIL, buffer, at + length)[0]:
            raise ValueError("checksum of a record is wrong")
        at += length + TAIL_BYTES
        yield unpack(payload)


def read_at(folder: str, shard: int, positions: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """The records at some positions of a shard, through its offset index."""
    files, root = filesystem(folder)
    found = []
    with files.open_input_file(f"{root}/{shard_name(shard)}.idx") as index:
        with files.open_input_file(f"{root}/{shard_name(shard)}.rec") as records:
            for position in positions:
                index.seek(position * INDEX_BYTES)
                offset, length = struct.unpack(INDEX_ENTRY, index.read(INDEX_BYTES))
                records.seek(offset)
                found.extend(read_stream(_Slice(records.read(HEAD_BYTES + length + TAIL_BYTES))))
    return found


class _Slice:
    def __init__(self, data: bytes):
        self.data = data

    def read(self, _: int) -> bytes:
        data, self.data = self.data, b""
        return data


def shard_name(shard: int) -> str:
    return f"shard-{shard:05d}"


# The settings for which a text's ids are those of its words. White space parts words and is dropped, ASCII capitals count
# as small letters, and a run of letters is always a unit of its own.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}


# The letter that byte-level vocabularies have for a byte: printable Latin-1 characters stand for themselves, the others for those from 256 on.
BYTE_LETTERS = dict(zip([b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)], range(256, 512)))


class WordEncoder:
    """The ids that a tokenizer gives to texts.

    Where its settings never join words across white space (``WORDWISE``), each distinct word is given to it once and its ids are
    kept: a run of Latin letters straight to its model, the other new words of a text together, held apart by a mark. At most ``keep``
    words are kept in each of two generations, so memory is bounded and frequent words stay. Texts that hold a string of an added token, or a
    character that Python takes for white space and the tokenizer does not, and all texts under other settings, are encoded whole.
    """

    PER_CALL = 1000
    MARK = "\x01"
    STOPS = ".,;:!?"
    STEM_END = "\u0100"  # letters up to here stay letters when they are made small
    NOT_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str, end_id: int, keep: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.by_words = all(settings.get(k) == v for k, v in WORDWISE.items())
        self.whole = (*(t["content"] for t in settings.get("added_tokens", [])), *self.NOT_SPACES)
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.end = np.array([end_id], self.kind).tobytes()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.keep = keep
        self.model = self.tokenizer.model
        self.mark = self._ids(self.MARK)
        self.stops = {c: self._ids(c).tobytes() for c in self.STOPS}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learn(self, words: list[str]) -> None:
        mixed, pack = [], struct.pack
        letter = "<H" if self.width == 2 else "<I"
        for word in words:
            if word.isalpha() and (plain := word.isascii()) | (max(word) < self.STEM_END):  # small letters: capitals were made small
                held = word if plain else word.encode().decode("latin-1").translate(BYTE_LETTERS)
                self.new[word] = b"".join([pack(letter, t.id) for t in self.model.tokenize(held)])
            else:
                mixed.append(word)
        for begin in range(0, len(mixed), self.PER_CALL):
            part = mixed[begin : begin + self.PER_CALL]
            ids = self._ids(f" {self.MARK} ".join(part))
            cuts = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else np.empty(0, int)
            if len(cuts) == len(part) - 1:
                raw, width, at = ids.tobytes(), self.width, 0
                for word, cut in zip(part, [*cuts.tolist(), len(ids)]):
                    self.new[word] = raw[at * width : cut * width]
                    at = cut + 1
            else:  # a word holds the mark itself
                for word in part:
                    self.new[word] = self._ids(word).tobytes()

    def _missing(self, words: set[str]) -> None:
        """Fill in words that the younger generation does not hold."""
        new, old, learn, stopped = self.new, self.old, set(), []
        for word in words:
            if (ids := old.get(word)) is not None:
                new[word] = ids
                continue
            # punctuation after letters is a unit of its own
            stem, stop = word, ""
            if word[-1] in self.STOPS and max(word) < self.STEM_END and word[:-1].isalpha():
                stem, stop = word[:-1], word[-1]
            if stem.isalpha() and (stem.isascii() or max(stem) < self.STEM_END):  # others may become the string of an added token
                stem = stem.lower()
            if stem not in new:
                if (ids := old.get(stem)) is not None:
                    new[stem] = ids
                else:
                    learn.add(stem)
            if stem != word:
                stopped.append((word, stem, stop))
        self._learn(sorted(learn))
        for word, stem, stop in stopped:
            new[word] = new[stem] + self.stops[stop] if stop else new[stem]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text and the end id, as little-endian integers."""
        text = text or ""
        if not self.by_words or any([part in text for part in self.whole]):
            return self._ids(text).tobytes() + self.end
        words = text.split()
        try:
            return b"".join(map(self.new.__getitem__, words)) + self.end
        except KeyError:
            if len(self.new) > self.keep:
                self.old, self.new = self.new, {}
            self._missing(set(words).difference(self.new))
            return b"".join(map(self.new.__getitem__, words)) + self.end


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> list[tuple[int, int, int]]:
    """Encode and write all documents; (shard, documents, ids) of each shard that has any, in order."""
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row")
    )
    # the row number only parts equal ids, should one id have very many rows
    dealt = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "text")

    def write(batches):
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        encoder = per_worker((tokenizer, end_id), lambda: WordEncoder(tokenizer, end_id))
        index, counts = [], [0, 0, 0]  # documents, ids, bytes

        def records(out):
            batch = first
            while batch is not None:
                for at in range(0, batch.num_rows, ROWS_HELD):
                    part = batch.slice(at, ROWS_HELD)
                    for number, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        ids = encoder.encode(value)
                        record = frame(pack(number, ids, encoder.width))
                        index.append((counts[2], len(record) - HEAD_BYTES - TAIL_BYTES))
                        out.write(record)
                        counts[0] += 1
                        counts[1] += len(ids) // encoder.width
                        counts[2] += len(record)
                batch = next(batches, None)

        publish(folder, f"{shard_name(shard)}.rec", attempt, records)
        publish(folder, f"{shard_name(shard)}.idx", attempt, lambda out: out.write(np.array(index, "<u8").tobytes()))
        yield pa.RecordBatch.from_pydict({"shard": [shard], "documents": [counts[0]], "ids": [counts[1]]})

    written = map_batches(dealt.select("doc_id", "text"), write, "shard long, documents long, ids long")
    return sorted(tuple(row) for row in written.collect())  # one short row per shard


def read_records(spark: SparkSession, folder: str, shards: list[tuple[int, int, int]]) -> DataFrame:
    """Per record: doc_id, start, n_tokens, ids_crc32, shard and position, checked against both checksums."""
    starts, total = [], 0
    for shard, _, ids in shards:
        starts.append((shard, total))
        total += ids

    def read(batches):
        files, root = filesystem(folder)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                shard, start = starts[number]
                rows = []
                with files.open_input_stream(f"{root}/{shard_name(shard)}.rec", compression=None) as source:
                    for position, (doc_id, ids) in enumerate(read_stream(source)):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), shard, position))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _as_batch(rows)
                            rows = []
                yield _as_batch(rows)

    numbers = spark.range(0, len(shards), 1, max(1, len(shards)))
    return map_batches(numbers, read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, position long")


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def token_records(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the records of all documents below the shared folder and read them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = scratch_path(docs.sparkSession, "records")
    return read_records(docs.sparkSession, folder, write_records(docs, folder, tokenizer))


def op1_token_records(spark, sf_dir):
    return token_records(table(spark, sf_dir, "documents"))
