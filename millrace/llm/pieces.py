"""SentencePiece encoding and decoding of byte-pair models by vectorised merge rounds.

Encoding. A text gets the white space mark in front and for each space, and is read as its characters. The pair of neighbours whose
joined piece has the best score is merged, the leftmost first, until no pair makes a piece; characters without a piece become byte pieces.

Rounds. Words are cut where no piece of the vocabulary holds the two characters beside the cut, so no merge crosses it. All new words of many
documents lie in one flat array of symbols. A round finds the least pair rank of every word (a segmented minimum), merges all pairs of
that rank from the left in every word at once, and moves the rest together; finished words leave the array. Where a merge could make
a pair that goes before the next merge of the same rank (the vocabulary tells for which pieces), a word merges its leftmost pair only in
this round; runs of more than ``PATIENT`` such pairs, as long white space is, are merged in order by a queue. So ids are those
of the library for every text, and no word costs more than its length times a logarithm.

Words that are met again keep their ids in the worker, at most ``KEEP`` of them in each of two generations; a new word costs little more than its
merge rounds, so the cost of a text does not rise once the words of a corpus are more than are kept.

Decoding gathers the bytes of all pieces of a batch at once, with the rules of the library for byte pieces, unknown and control ids.

Models: byte pairs with byte fallback, without character maps, user-defined or unused pieces and without removal of white space; any
other is refused. Defined results: NULL and empty texts have no ids and are decoded as empty; NULL ids are decoded as empty. Texts of any length are encoded
whole. Repeated rows each get a row; an empty table gives no rows. Other columns pass through; a clash with the name of the new column is
refused.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import map_batches, per_worker, table

SPACE = "▁"
KEEP = 300_000
PATIENT = 32
CHARACTERS = 1 << 21  # of the documents that are encoded together
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NO_RANK = np.int32(2**31 - 1)
CODES = 0x110000


class Pieces:
    """A model as tables. Symbols are piece ids, then characters that only stand inside pieces, then all other characters."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = {p.type for p in model.pieces}
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only byte-pair models with byte fallback and plain pieces can be encoded")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that keep characters and white space as they are can be encoded")
        self.front = SPACE if spec.add_dummy_prefix else ""
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.size = len(model.pieces)
        self.byte_id = np.zeros(256, np.int32)
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                self.byte_id[int(piece.piece[3:5], 16)] = i
        # symbols of characters
        symbols = dict(normal)
        for c in sorted({c for piece in normal for c in piece} - set(normal)):
            symbols[c] = self.size + len(symbols) - len(normal)
        self.base = self.size + len(symbols) - len(normal)
        self.symbol = np.arange(self.base, self.base + CODES, dtype=np.int32)
        self.code = np.full(self.base, -1, np.int32)  # of the symbols below the base that are one character
        for piece, symbol in symbols.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = symbol
                self.code[symbol] = ord(piece)
        # ranks and pairs
        scores = sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        rank = {piece: rank_of[model.pieces[i].score] for piece, i in normal.items()}
        pairs = [
            (symbols[piece[:k]] * self.base + symbols[piece[k:]], i)
            for piece, i in normal.items()
            for k in range(1, len(piece))
            if piece[:k] in symbols and piece[k:] in symbols
        ]
        pairs.sort()
        self.pair = np.array([k for k, _ in pairs], np.int64)
        self.joined = np.array([i for _, i in pairs], np.int32)
        self.pairs = None
        self.rank = np.full(self.base, NO_RANK, np.int32)
        self.hasty = np.zeros(self.base, bool)  # joins at once into a piece that goes before its equals
        for piece, i in normal.items():
            self.rank[i] = rank[piece]
        for piece in normal:
            for part in [piece[:k] for k in range(1, len(piece))] + [piece[k:] for k in range(1, len(piece))]:
                if part in normal and rank[piece] <= rank[part]:
                    self.hasty[normal[part]] = True
        beside = sorted({ord(a) * CODES + ord(b) for piece in normal for a, b in zip(piece, piece[1:])})
        self.beside = np.array(beside, np.int64)
        # where texts may be cut into words by plain string functions
        within = {c for piece in normal if len(piece) > 1 for c in piece}
        self.spaces_begin = not any(SPACE in piece.lstrip(SPACE) for piece in normal)
        self.line_alone = "\n" not in within
        self.parts = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if self.line_alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # decoding
        raw = [self._surface(p) for p in model.pieces]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.lengths = np.array([len(r) for r in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.kind = np.array([p.type for p in model.pieces], np.int8)
        self.spaced = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])

        self.unknown = model.trainer_spec.unk_surface.encode()

    @staticmethod
    def _surface(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return "\u0000".encode()  # replaced by the surface of the model
        return piece.piece.replace(SPACE, " ").encode()

    # ---- encoding ----

    def words(self, text: str) -> list[str]:
        """Parts of a text that no merge crosses; joined they are the text as it is encoded (empty parts may stand between)."""
        if not text:
            return []
        if not self.spaces_begin:
            return [self.front + text.replace(" ", SPACE)]
        if self.front and not (text[0] == " " or "  " in text or SPACE in text):
            text = SPACE + text.replace(" ", " " + SPACE)
            return (text.replace("\n", " \n ") if self.line_alone else text).split(" ")
        return self.parts.findall(self.front + text.replace(" ", SPACE))

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair makes and its rank, ``NO_RANK`` if none."""
        key = left.astype(np.int64) * self.base + right
        key[(left >= self.base) | (right >= self.base)] = -1
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        piece = self.joined[place]
        return piece, np.where(self.pair[place] == key, self.rank[piece], NO_RANK)

    def pair_table(self) -> dict[int, tuple[int, int]]:
        """Rank and piece of each pair, for single questions."""
        if self.pairs is None:
            self.pairs = dict(zip(self.pair.tolist(), zip(self.rank[self.joined].tolist(), self.joined.tolist())))
        return self.pairs

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words (ascending) after all merges."""
        done_symbols, done_words = [], []
        size = len(symbols)
        piece, rank = np.zeros(size, np.int32), np.full(size, NO_RANK, np.int32)

        def look(at: np.ndarray) -> None:
            piece[at], rank[at] = self.lookup(symbols[at], symbols[at + 1])

        look(np.flatnonzero(word[1:] == word[:-1]))
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(first, len(word)))
            least = np.minimum.reduceat(rank, first)
            finished = least == NO_RANK
            at = np.flatnonzero((rank == np.repeat(least, lengths)) & (rank != NO_RANK))
            hasty = self.hasty[piece[at]]
            stay = np.ones(len(symbols), bool)
            if hasty.any():
                number = np.searchsorted(first, at, "right") - 1  # of the word among those that are left
                in_word = np.bincount(number, minlength=len(first))
                hurry = np.zeros(len(first), bool)
                hurry[number[hasty]] = True
                for k in np.flatnonzero(hurry & (in_word > PATIENT)):
                    merged = self._in_order(symbols[first[k] : first[k] + lengths[k]])
                    done_symbols.append(merged)
                    done_words.append(np.full(len(merged), word[first[k]]))
                    stay[first[k] : first[k] + lengths[k]] = False
                alone = np.concatenate(([True], number[1:] != number[:-1]))
                at = at[(~hurry[number] | alone) & stay[at]]
            # of neighbours every second one, from the left
            place = np.arange(len(at))
            begin = np.concatenate(([True], at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, bool)
            at = at[(place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0] if len(at) else at
            symbols[at] = piece[at]
            gone = np.repeat(finished, lengths)
            if gone.any():
                done_symbols.append(symbols[gone])
                done_words.append(word[gone])
            stay &= ~gone
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            new = place[at]
            symbols, word, piece, rank = symbols[stay], word[stay], piece[stay], rank[stay]
            # only pairs with a merged symbol are new
            rank[new] = NO_RANK
            right = new[new + 1 < len(symbols)]
            look(right[word[right] == word[right + 1]])
            left = new[new > 0] - 1
            look(left[word[left] == word[left + 1]])
        if not done_symbols:
            return symbols, word
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _in_order(self, symbols: np.ndarray) -> np.ndarray:
        """One word merged pair by pair, the best and leftmost first."""
        symbols = symbols.copy()
        after = np.arange(1, len(symbols) + 1).tolist()
        before = np.arange(-1, len(symbols) - 1).tolist()
        alive = [True] * len(symbols)
        piece, rank = self.lookup(symbols[:-1], symbols[1:])
        held = symbols.tolist()
        queue = [(int(r), i, held[i], held[i + 1], int(p)) for i, (p, r) in enumerate(zip(piece, rank)) if r != NO_RANK]
        heapq.heapify(queue)

        table = self.pair_table()

        def offer(i: int, j: int) -> None:
            if held[i] < self.base and held[j] < self.base and (found := table.get(held[i] * self.base + held[j])):
                heapq.heappush(queue, (found[0], i, held[i], held[j], found[1]))

        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= len(held) or held[i] != a or held[j] != b:
                continue
            held[i], alive[j] = made, False
            after[i] = after[j]
            if after[j] < len(held):
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return np.array([s for s, a in zip(held, alive) if a], np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        if not len(codes):
            return [b""] * len(words)
        key = codes[:-1] * CODES + codes[1:]
        place = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        cut = np.concatenate(([True], self.beside[place] != key))
        cut[ends[:-1][ends[:-1] < len(codes)]] = True
        segment = np.cumsum(cut) - 1
        word_of = np.repeat(np.arange(len(words)), lengths)[cut]
        symbols, segment = self.merge(self.symbol[codes], segment)
        # characters without a piece become their bytes
        code = np.where(symbols >= self.base, symbols - self.base, self.code[np.minimum(symbols, self.base - 1)])
        bare = symbols >= self.size
        wide = np.where(bare, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        ids = np.repeat(np.where(bare, 0, symbols), wide).astype("<i4")
        if bare.any():
            raw = np.frombuffer(code[bare].astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
            ids[np.repeat(bare, wide)] = self.byte_id[raw]
        counts = np.bincount(word_of[segment], weights=wide, minlength=len(words)).astype(np.int64)
        ends = np.cumsum(counts) * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist())]

    # ---- decoding ----

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of ids; ``ends`` are the edges of the runs."""
        counts = np.diff(ends)
        lengths = self.lengths[ids]
        starts = self.starts[ids]
        if len(ids):
            # the first piece that has a surface loses a white space mark
            row = np.repeat(np.arange(len(counts)), counts)
            shown = np.flatnonzero(lengths > 0)
            first = shown[np.concatenate(([True], row[shown][1:] != row[shown][:-1]))] if len(shown) else shown
            first = first[self.spaced[ids[first]]] if self.front else first[:0]
            lengths[first] -= 1
            starts[first] += 1
        total = np.cumsum(lengths)
        place = np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)
        data = self.blob[place].tobytes()
        edges = np.concatenate(([0], total))[ends].tolist()
        strange = (self.kind[ids] == UNKNOWN) | (self.kind[ids] == CONTROL)
        odd = np.zeros(len(counts), bool)
        if strange.any():
            odd[np.repeat(np.arange(len(counts)), counts)[strange]] = True
        out = []
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if odd[k]:
                out.append(self._decode_one(ids[ends[k] : ends[k + 1]]))
                continue
            try:
                out.append(data[a:b].decode())
            except UnicodeDecodeError:
                out.append(self._decode_one(ids[ends[k] : ends[k + 1]]))
        return out

    def _decode_one(self, ids: np.ndarray) -> str:
        """One run with unknown or control ids, or bytes that are no text."""
        out, held, began = [], b"", False
        for i in [*ids.tolist(), None]:
            if i is not None and self.kind[i] == BYTE:
                held += bytes([self.blob[self.starts[i]]])
                began = True
                continue
            while held:
                for n in range(min(4, len(held)), 0, -1):
                    try:
                        out.append(held[:n].decode())
                    except UnicodeDecodeError:
                        continue
                    if len(out[-1]) == 1:
                        held = held[n:]
                        break
                    out.pop()
                else:
                    out.append("�")
                    held = held[1:]
            if i is None or self.kind[i] == CONTROL:
                continue
            first, began = not began, True
            if self.kind[i] == UNKNOWN:
                out.append(self.unknown.decode())
                continue
            text = self.blob[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes().decode()
            out.append(text[1:] if self.front and self.spaced[i] and first else text)
        return "".join(out)


class Encoder:
    """Encodes texts and keeps the ids of words it has met."""

    def __init__(self, path: str, keep: int = KEEP):
        self.pieces = Pieces(path)
        self.keep = keep
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the edges between texts."""
        split = [self.pieces.words(t) if t else [] for t in texts]
        if len(self.new) > self.keep:
            self.old, self.new = self.new, {"": b""}
        known, old = self.new, self.old
        missing = []
        for word in set().union(*split).difference(known):
            ids = old.get(word)
            if ids is None:
                missing.append(word)
            else:
                known[word] = ids
        known.update(zip(missing, self.pieces.encode_words(missing)))
        rows = [b"".join(map(known.__getitem__, words)) for words in split]
        ends = np.cumsum([0, *map(len, rows)]) // 4
        return np.frombuffer(b"".join(rows), "<i4"), ends


def _parts(batch: pa.RecordBatch, size_of) -> list[pa.RecordBatch]:
    """A batch in slices of about ``CHARACTERS``."""
    out, begin, held = [], 0, 0
    for i, size in enumerate(size_of):
        held += size
        if held >= CHARACTERS:
            out.append(batch.slice(begin, i + 1 - begin))
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        out.append(batch.slice(begin))
    return out


def _refuse(schema: T.StructType, old: str, new: str) -> None:
    if new.lower() in (f.name.lower() for f in schema.fields if f.name != old):
        raise ValueError(f"there is a column {new} already")


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column of ids in place of its text."""
    at = docs.columns.index(text)
    _refuse(docs.schema, text, ids)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())) if f.name == text else f for f in docs.schema.fields]

    def run(batches):
        encoder = per_worker(("pieces", model), lambda: Encoder(model))
        for batch in batches:
            sizes = [len(t) if t else 0 for t in batch.column(at).to_pylist()]
            for part in _parts(batch, sizes):
                flat, ends = encoder.encode(part.column(at).to_pylist())
                columns = list(part.columns)
                columns[at] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, names=[ids if i == at else n for i, n in enumerate(part.schema.names)])

    return map_batches(docs, run, T.StructType(fields))


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` and a column with the text of their ids. Ids outside the vocabulary are an error."""
    at = rows.columns.index(ids)
    _refuse(rows.schema, "", text)
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        pieces = per_worker(("pieces", model), lambda: Encoder(model)).pieces
        for batch in batches:
            column = batch.column(at)
            lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            for part in _parts(batch, (lengths * 4).tolist()):
                own = part.column(at)
                counts = np.nan_to_num(own.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = own.flatten().to_numpy(zero_copy_only=False)
                texts = pieces.decode(flat, np.concatenate(([0], np.cumsum(counts))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text])

    return map_batches(rows, run, schema)


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(docs.select("doc_id", "text"), model), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op11_pieces(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"))
