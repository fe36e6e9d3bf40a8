"""SentencePiece BPE encoding by a prefix table, and decoding.

The encoding of every prefix of a text ends in one certain token. With an
automaton that reports all vocabulary pieces ending at a position, the last
token of a prefix is the reported piece t for which (last token of the prefix
before t, t) is a compatible pair: merging the two tokens' characters by score
gives these two tokens again. A row of pairwise compatible tokens is the
encoding, so exactly one candidate passes, and walking back through the table
gives the ids. The time is linear in the text, whatever its length.

Two neighbouring characters that no piece has side by side always belong to
different tokens. Texts are cut there first (before the white-space mark of a
word, and inside words), and the parts are remembered in bounded caches.
Characters outside the vocabulary become their UTF-8 bytes.

One pass over the documents, no shuffle. The model's bytes travel with the
task; their size is checked.

Defined cases: a null or empty text has no ids and decodes to ''; a text that
holds U+2581 decodes to a space there, as the library does; decoding replaces
each byte of a broken UTF-8 sequence by U+FFFD.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, release

MARK = "▁"
#: Words that each of a worker's caches remembers at most (some 250 bytes each).
#: 26 MB of the documents at hand have 514,000 different words and 313,000 parts.
CACHE_WORDS = 300_000
#: Pairs of tokens that a worker remembers at most.
CACHE_PAIRS = 450_000
#: Longest word that is remembered.
CACHE_LENGTH = 64
#: More than there are pieces and characters.
TOKENS = 1 << 24
MAX_MODEL_BYTES = 16 << 20
SCHEMA = "doc_id long, ids array<int>, decoded string"


class Remembered(dict):
    """A bounded cache: when it is full, half of it (the older) goes."""

    def keep(self, key: str, value: bytes) -> None:
        if len(key) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                for old in list(islice(self, CACHE_WORDS // 2)):
                    del self[old]
            self[key] = value


class PieceBpe:
    """Vocabulary, merge scores and automaton of one model (made once per worker)."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        kinds = proto.SentencePiece
        if (norm.precompiled_charsmap or norm.normalization_rule_tsv or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or proto.trainer_spec.model_type != proto.trainer_spec.BPE):
            raise ValueError("a BPE model without normalisation rules is expected")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        lib = SentencePieceProcessor(model_proto=model)
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.unknown = lib.unk_id()
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        # what each id stands for when decoded
        self.is_byte = np.zeros(len(proto.pieces), bool)
        self.is_byte[list(self.byte_ids.values())] = True
        plain = {kinds.NORMAL: lambda p: p.piece.replace(MARK, " "), kinds.BYTE: lambda p: "",
                 kinds.CONTROL: lambda p: "", kinds.UNKNOWN: lambda p: proto.trainer_spec.unk_surface}
        self.raw = [plain[p.type](p).encode() for p in proto.pieces]
        for b, i in self.byte_ids.items():
            self.raw[i] = bytes([b])
        self.spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(MARK) for p in proto.pieces])
        # pieces that merging can reach, in an automaton
        self.automaton = ahocorasick.Automaton()
        self.chars = set("".join(self.scores))
        for piece, i in self.ids.items():
            if self._merge(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.joins = {p[k:k + 2] for p in self.scores for k in range(len(p) - 1)}
        self.by_word = not any(j[1] == MARK != j[0] for j in self.joins)
        self.alone = "\n" not in self.chars  # a line break never joins a token
        self.line_break = self._bytes_of("\n")
        self.pairs: dict[int, bool] = {}
        self.words, self.parts = Remembered(), Remembered()
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def _merge(self, text: str) -> list[str]:
        """Merges the characters of a short text, best score first, then leftmost."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their characters are merged."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        a, b = self.text_of(left), self.text_of(right)
        fits = self.pairs[left * TOKENS + right] = self._merge(a + b) == [a, b]
        return fits

    def text_of(self, token: int) -> str:
        return self.pieces[token] if token < len(self.pieces) else chr(token - len(self.pieces))

    def _bytes_of(self, char: str) -> list[int]:
        """Ids of a character that no piece is: its bytes, or the unknown id."""
        if char in self.ids:
            return [self.ids[char]]
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def segment(self, text: str) -> list[int]:
        """Ids of a normalised text by its prefix table: `token[k]` is the last
        token of the prefix that ends with character k, `width[k]` its length.
        A character that no piece ends with is a token of its own, numbered
        after the pieces."""
        n, known, first_char = len(text), self.pairs.get, len(self.pieces)
        token, width = [0] * n, [0] * n
        for end, (size, number) in self.automaton.iter(text):
            if width[end]:
                continue
            before = end - size
            if before >= 0:
                if not width[before]:
                    token[before], width[before] = first_char + ord(text[before]), 1
                fits = known(token[before] * TOKENS + number)
                if fits is None:
                    fits = self._fits(token[before], number)
                if not fits:
                    continue
            token[end], width[end] = number, size
        out, at = [], n - 1
        while at >= 0:
            if width[at] and token[at] < first_char:
                out.append(token[at])
                at -= width[at]
            else:
                out += self._bytes_of(text[at])[::-1]
                at -= 1
        return out[::-1]

    def forget(self) -> None:
        """Empties the caches, so that an idle worker holds the vocabulary only."""
        for cache in (self.words, self.parts, self.pairs):
            cache.clear()
        release()

    def _word(self, word: str) -> bytes:
        """int32 ids of one word as bytes: of its parts, each remembered."""
        joins, known, lo, out = self.joins, self.parts.get, 0, []
        ends = [k for k, pair in enumerate(map(add, word, word[1:]), 1) if pair not in joins]
        ends.append(len(word))
        for hi in ends:
            part, lo = word[lo:hi], hi
            ids = known(part)
            if ids is None:
                ids = array("i", self.segment(part)).tobytes()
                self.parts.keep(part, ids)
            out.append(ids)
        ids = b"".join(out)
        self.words.keep(word, ids)
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        text = self.prefix + text.replace(" ", MARK)
        if not self.by_word:
            return np.frombuffer(self._word(text), np.int32)
        known, word = self.words.get, self._word
        if not self.alone:
            return np.frombuffer(b"".join([known(w) or word(w) for w in self.cut.findall(text)]), np.int32)
        br = np.array(self.line_break, np.int32).tobytes()
        return np.frombuffer(br.join([b"".join([known(w) or word(w) for w in self.cut.findall(line)])
                                      for line in text.split("\n")]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library writes it."""
        if not len(ids):
            return ""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        if self.prefix and self.spaced[ids[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: np.ndarray) -> str:
        """Runs of byte ids on their own: each byte outside a whole character is U+FFFD."""
        out, run = [], bytearray()

        def flush() -> None:
            k = 0
            while k < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[k:k + size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                k += size
            run.clear()

        for k, i in enumerate(ids.tolist()):
            if self.is_byte[i]:
                run += self.raw[i]
                continue
            flush()
            piece = self.raw[i].decode()
            out.append(piece[1:] if k == 0 and self.prefix and self.spaced[i] else piece)
        flush()
        return "".join(out)


_MADE: dict[str, PieceBpe] = {}


def tokenizer(model: bytes) -> PieceBpe:
    key = hashlib.sha256(model).hexdigest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = PieceBpe(model)
    return _MADE[key]


def read_model(path: str) -> bytes:
    """The model file's bytes; the size bound is what tasks may carry."""
    with open(path, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: over {MAX_MODEL_BYTES} bytes")
    return model


def _coded(bpe: PieceBpe, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
    ids = [bpe.encode(t) for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return (pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
            pa.array([bpe.decode(x) for x in ids], pa.string()))


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, all ids of the whole text (no begin or end ids), and the text
    that the ids decode to; one row per input row."""
    model = read_model(model_path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model)
        for cols in chunks(batches):
            ids, decoded = _coded(bpe, cols["text"])
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), ids, decoded],
                                             ["doc_id", "ids", "decoded"])
        bpe.forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(rows, SCHEMA)


def encode_rows(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """The documents with all their other columns, ids and decoded (which
    replace columns of these names and the text)."""
    model = read_model(model_path)
    keep = [c for c in docs.columns if c not in (text_col, "ids", "decoded")]
    row = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*keep).alias("row"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model)
        for batch in batches:
            done = 0
            for cols in chunks([batch.select(["text"])]):
                n = len(cols["text"])
                ids, decoded = _coded(bpe, cols["text"])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(done, n), ids, decoded], ["row", "ids", "decoded"])
                done += n
        bpe.forget()

    kind = row.schema["row"].dataType.simpleString()
    return row.mapInArrow(rows, f"row {kind}, ids array<int>, decoded string").select("row.*", "ids", "decoded")
