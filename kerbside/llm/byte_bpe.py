"""Byte-level BPE encoding and decoding through a SentencePiece BPE model written straight from a rank file.

Each byte string of the vocabulary becomes a piece of printable characters, one per byte, scored by its negative rank, so
that the model merges in rank order. Normalisation is the identity. Pre-tokens are encoded apart, as merges never cross
them; decoding maps the pieces' characters back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array

import regex
import sentencepiece
from pyspark.sql import DataFrame

from .batches import id_and_text, map_slices


def byte_alphabet() -> list[str]:
    """A printable character for each byte: its own where it is printable and no space, else one from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(lines: bytes) -> list[bytes]:
    """The byte strings of a rank file by rank; ranks must run from 0 without gaps."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines.splitlines() if line)}
    return [ranks[k] for k in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protobuf field: varint, 32-bit float or length-delimited, by the value's type."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_proto(vocabulary: list[bytes]) -> bytes:
    """A serialised SentencePiece model whose ids are the ranks; the unknown piece, never used, comes last."""
    # Field numbers and enum values of the public sentencepiece_model.proto.
    pieces, trainer, normalizer = 1, 2, 3
    piece, score, kind, unknown = 1, 2, 3, 2
    model_type, bpe, unk_id, vocab_size = 3, 2, 40, 4
    name, dummy_prefix, extra_spaces, escape_spaces = 1, 3, 4, 5
    letters = byte_alphabet()
    out = [
        _field(pieces, _field(piece, "".join(letters[b] for b in token).encode()) + _field(score, float(-rank)))
        for rank, token in enumerate(vocabulary)
    ]
    out.append(_field(pieces, _field(piece, b"<unk>") + _field(score, 0.0) + _field(kind, unknown)))
    off = (1 << 64) - 1  # bos, eos and pad are off: -1 as an int32 varint
    ids = _field(unk_id, len(vocabulary)) + b"".join(_field(k, off) for k in (41, 42, 43))
    out.append(_field(trainer, _field(model_type, bpe) + _field(vocab_size, len(vocabulary) + 1) + ids))
    out.append(_field(normalizer, _field(name, b"identity") + _field(dummy_prefix, 0) + _field(extra_spaces, 0) + _field(escape_spaces, 0)))
    return b"".join(out)


class Codec:
    """Encodes text to ids and decodes ids to bytes; keeps about ``CACHE`` encoded pre-tokens."""

    CACHE = 1 << 18

    def __init__(self, proto: bytes, pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.pattern = regex.compile(pattern)
        letters = byte_alphabet()
        self.to_letters = "".join(letters)
        back = {c: b for b, c in enumerate(letters)}
        size = self.model.get_piece_size() - 1
        self.tokens = [bytes(back[c] for c in self.model.id_to_piece(k)) for k in range(size)]
        self.ranks = {t: k for k, t in enumerate(self.tokens)}
        self.cache: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Encode ``words`` into the cache: those that are a piece themselves by lookup, the others by merging."""
        merge, raw = [], []
        for word in words:
            data = word.encode("utf-8", "surrogatepass")
            if (rank := self.ranks.get(data)) is not None:
                self.cache[word] = rank.to_bytes(4, "little")
            else:
                merge.append(word)
                raw.append(data)
        if merge:
            # 0xFF occurs in no UTF-8 text, so it parts the words, and it is its own letter.
            mapped = b"\xff".join(raw).decode("latin-1").translate(self.to_letters).split("\xff")
            for word, ids in zip(merge, self.model.encode(mapped, out_type=int, num_threads=1), strict=True):
                self.cache[word] = array("I", ids).tobytes()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; the texts' new pre-tokens go to the model at once."""
        words = [self.pattern.findall(t) for t in texts]
        missing = set().union(*words).difference(self.cache)
        if len(self.cache) + len(missing) > self.CACHE:
            self.cache.clear()
            missing = set().union(*words)
        self._learn(missing)
        return [b"".join(map(self.cache.__getitem__, w)) for w in words]

    def encode(self, text: str) -> list[int]:
        packed = self.encode_many([text])[0]
        return list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def decode_packed(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I"))) if packed else b""

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.tokens[k] for k in ids)


_codecs: dict[tuple[str, str], Codec] = {}


def tokenize(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and ids when asked. A null text is an empty one: no tokens, the
    digests of nothing. Repeated rows give repeated results; other columns of ``docs`` are not read. The rank file is read
    on the driver and its model, of a size fixed by the vocabulary, is broadcast.
    """
    with open(rank_file, "rb") as f:
        proto = model_proto(read_ranks(f.read()))
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    key = (hashlib.sha256(proto).hexdigest(), pattern)
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        if key not in _codecs:
            _codecs[key] = Codec(shared.value, pattern)
        codec = _codecs[key]
        packed = codec.encode_many([t or "" for t in cols["text"]])
        made = {
            "doc_id": cols["id"],
            "n_tokens": [len(p) // 4 for p in packed],
            "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
            "decoded_sha256": [hashlib.sha256(codec.decode_packed(p)).hexdigest() for p in packed],
        }
        if with_ids:
            made["ids"] = [list(memoryview(p).cast("I")) if p else [] for p in packed]
        return made

    return map_slices(id_and_text(docs, id_col, text_col), kernel, out)
