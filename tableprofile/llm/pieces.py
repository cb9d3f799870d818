"""SentencePiece vocabularies: encoding by a Viterbi pass over Aho-Corasick matches, and decoding."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.common import in_small_batches, lists

SPACE = "▁"  # the mark that pieces hold in place of a space
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: What a character outside the vocabulary scores below the worst piece; fixed value of the format.
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces with scores, read from a model file on the driver and sent to tasks as plain lists."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.normal: list[tuple[str, int, float]] = []
        self.bytes = [-1] * 256
        self.unknown = model.unk_id()
        self.text: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.normal.append((piece, i, model.get_score(i)))
                self.text.append(piece.replace(SPACE, " ").encode())
        self.key = hashlib.sha256(repr((self.normal, self.bytes, self.unknown, self.text)).encode()).hexdigest()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in self.normal):
            raise ValueError("a piece crosses the start of a word; words cannot be encoded one by one")
        if SPACE not in {p for p, _, _ in self.normal}:
            raise ValueError("the vocabulary has no piece for a space")


class Encoder:
    """The automaton, and the segmentations of short words met of late: at most max_words (some 300 bytes each), the older half going when the younger is full."""

    def __init__(self, vocabulary: Vocabulary, max_words: int = 300_000) -> None:
        import ahocorasick

        self.v, self.half = vocabulary, max(1, max_words // 2)
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in vocabulary.normal:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.fallback = min(score for _, _, score in vocabulary.normal) - UNKNOWN_PENALTY

    def segment(self, word: str) -> tuple[int, ...]:
        """The pieces with the largest sum of scores; ties go to the longest last piece.

        One pass: at each end the automaton names every piece that ends there, the longest by its
        state and the shorter ones by output links, and each may better the best sum up to that end.
        A character may always be spelt in bytes (without byte pieces: as unknown).
        """
        n, fallback, unknown = len(word), self.fallback, (1, -1, 0.0)
        best, last = [0.0] * (n + 1), [unknown] * (n + 1)
        reached = 0
        for end, piece in self.automaton.iter(word):
            while reached <= end:  # ends up to here can be reached by one unknown character
                reached += 1
                best[reached] = best[reached - 1] + fallback
            total = best[end + 1 - piece[0]] + piece[2]
            if total > best[end + 1]:
                best[end + 1], last[end + 1] = total, piece
        out: list[int] = []
        while n:
            length, i, _ = last[n]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.spelt(word[n - 1]))
            n -= length
        return tuple(reversed(out))

    def spelt(self, char: str) -> list[int]:
        """Ids of the bytes of a character, last first."""
        ids = [self.v.bytes[b] for b in reversed(char.encode())]
        return ids if min(ids) >= 0 else [self.v.unknown]

    def word(self, word: str) -> tuple[bytes, bytes]:
        """Ids of a word, as the bytes of 32-bit numbers, and the bytes that they decode to."""
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = self.coded(self.segment(word))
            if len(word) <= 64:
                if len(self.young) >= self.half:
                    self.old, self.young = self.young, {}
                self.young[word] = found
        return found

    def coded(self, ids: Sequence[int]) -> tuple[bytes, bytes]:
        return array("i", ids).tobytes(), b"".join(map(self.v.text.__getitem__, ids))

    def both(self, text: str) -> tuple[np.ndarray, bytes]:
        """Ids of a text, and the bytes that they decode to.

        A space is put before the text. A mark of the vocabulary inside the text is spelt in bytes.
        """
        if not text:
            return np.zeros(0, np.int32), b""
        found: list[tuple[bytes, bytes]] = []
        for at, part in enumerate(text.split(SPACE)):
            if at:
                found.append(self.coded(self.spelt(SPACE)[::-1]))
            marked = (SPACE if at == 0 else "") + part.replace(" ", SPACE)
            found.extend(map(self.word, CHUNK.findall(marked)))
        return np.frombuffer(b"".join([ids for ids, _ in found]), np.int32), b"".join([decoded for _, decoded in found])[1:]

    def encode(self, text: str) -> list[int]:
        return self.both(text)[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.text.__getitem__, ids))[1:]


_encoders: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python worker, kept from task to task; one vocabulary at a time."""
    if vocabulary.key not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.key] = Encoder(vocabulary)
    return _encoders[vocabulary.key]


def encoded(docs: DataFrame, model_file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text, and what they decode to.

    Returns doc_id, n_tokens, ids, decoded_sha256 (lowercase hex of the decoded bytes), exact (the
    decoded bytes are the text). A text is a sequence of words, each with the spaces before it; no
    piece crosses the start of a word, so the best segmentation of the text is that of its words.
    A null or empty text has no ids; repeated rows give repeated results; an empty table gives no
    rows; other columns are not read. The best sum of scores is what is computed for every model
    file, also one whose own encoder merges pairs.
    """
    vocabulary = Vocabulary(model_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, digests, exact = [], [], []
                for value in part.column(1).to_pylist():
                    found, back = encoder.both(value)
                    ids.append(found)
                    digests.append(hashlib.sha256(back).hexdigest())
                    exact.append(back == value.encode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()), lists(ids, pa.int32()), pa.array(digests, pa.string()), pa.array(exact, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "decoded_sha256", "exact"],
                )

    rows = in_small_batches(docs).select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, exact boolean")
