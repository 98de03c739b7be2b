"""SentencePiece models run by the tokenizers library.

The model file is parsed as a protocol buffer, and its parts are rebuilt: the normaliser (character map,
extra white space, dummy prefix), the metaspace marker, the scores (as unigram log-probabilities, or as
the order of BPE merges) and the byte fallback. Batches are encoded and decoded by the library's own
threads, and parity with SentencePiece is verified on everything that is encoded.

Where no piece holds a marker after another character, a BPE text is the sequence of its chunks (a run of
markers and what follows), each encoded and verified once per worker and remembered; any other model
encodes whole texts. Texts are always encoded to their end.

Defined results for odd rows: a NULL text is the empty string, which has no ids and is at parity; a text
that holds the marker itself comes back with spaces, as SentencePiece returns it; repeated rows get a row
each; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
#: Chunks kept per worker, in a current and an older half.
REMEMBERED_CHUNKS = 400_000
GROUP_CHARS = 1_000_000
# Fixed values of the format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of every field of a protocol buffer message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    one_space: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def chunked(self) -> bool:
        return (self.kind == BPE and not self.charsmap and self.dummy_prefix and not self.one_space
                and not any(re.search(f"[^{MARKER}]{MARKER}", p) for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED))
                and not any(t == USER_DEFINED for _, _, t in self.pieces))


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel([])
    for number, value in wire_fields(data):
        if number == 1:
            piece = dict(wire_fields(value))
            model.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(wire_fields(value))
            model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            rule = dict(wire_fields(value))
            model.charsmap = rule.get(2, b"")
            model.dummy_prefix, model.one_space = bool(rule.get(3, 1)), bool(rule.get(4, 1))
    return model


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs that make each piece, best score first: the order in which BPE merges."""
    scores = {p: s for p, s, t in model.pieces if t in (NORMAL, USER_DEFINED)}
    found = []
    for at, (piece, score, kind) in enumerate(model.pieces):
        if kind in (NORMAL, USER_DEFINED):
            found += [(-score, at, cut, piece[:cut], piece[cut:]) for cut in range(1, len(piece))
                      if piece[:cut] in scores and piece[cut:] in scores]
    return [x[3:] for x in sorted(found)]


def build_tokenizer(model: PieceModel):
    """A ``tokenizers.Tokenizer`` that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocabulary, merges_of(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are known")
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.one_space:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARKER)] if model.dummy_prefix else []
    out = Tokenizer(core)
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    out.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return out


class PieceCodec:
    """Encodes, decodes and verifies batches of texts in one worker."""

    _open: dict[tuple[str, int], PieceCodec] = {}

    def __init__(self, path: str, threads: int = 1):
        # The library reads these when its threads start.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.tokenizer = build_tokenizer(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.threads = threads
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.wrong: set[str] = set()

    @classmethod
    def of(cls, path: str, threads: int = 1) -> PieceCodec:
        if (path, threads) not in cls._open:
            cls._open[path, threads] = cls(path, threads)
        return cls._open[path, threads]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Little-endian 32-bit ids of every text, and whether they are those of SentencePiece."""
        if not self.model.chunked:
            ids = [list(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            wanted = self.reference.encode(texts, num_threads=self.threads)
            return [_packed(x) for x in ids], [a == b for a, b in zip(ids, wanted, strict=True)]
        ids_out: list[bytes] = []
        parity: list[bool] = []
        at = 0
        while at < len(texts):
            lines, size = [], 0
            while at < len(texts) and (not lines or size < GROUP_CHARS):
                text = texts[at]
                lines.append(re.findall(f"{MARKER}+[^{MARKER}]*", MARKER + text.replace(" ", MARKER)) if text else [])
                size += len(text)
                at += 1
            missing = set().union(*lines).difference(self.known)
            if missing:
                if len(missing) + len(self.known) > REMEMBERED_CHUNKS // 2:
                    self.older, self.known = self.known, {}
                    self.wrong &= self.older.keys()
                    missing = set().union(*lines)
                back = missing & self.older.keys()
                self.known.update((c, self.older[c]) for c in back)
                self._learn(list(missing - back))
            known, wrong = self.known, self.wrong
            ids_out += [b"".join([known[c] for c in line]) for line in lines]
            parity += [not wrong or wrong.isdisjoint(line) for line in lines]
        return ids_out, parity

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks as texts whose first marker is the dummy prefix, by both libraries."""
        for at in range(0, len(chunks), 2000):
            some = chunks[at:at + 2000]
            texts = [c[1:].replace(MARKER, " ") for c in some]
            wanted = self.reference.encode(texts, num_threads=self.threads)
            if self.threads > 1:
                found = [list(e.ids) for e in self.tokenizer.encode_batch_fast([t or " " for t in texts], add_special_tokens=False)]
            else:
                tokenize = self.tokenizer.model.tokenize
                found = [[t.id for t in tokenize(c)] for c in some]
            for chunk, ids, want in zip(some, found, wanted, strict=True):
                if chunk == MARKER:  # SentencePiece adds no prefix to an empty text: a lone marker has nothing to be compared with
                    ids = want = [t.id for t in self.tokenizer.model.tokenize(chunk)]
                self.known[chunk] = _packed(ids)
                if ids != want:
                    self.wrong.add(chunk)

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.tokenizer.decode_batch([np.frombuffer(x, "<u4").tolist() for x in ids], skip_special_tokens=False)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode_documents(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", threads: int = 1,
                     with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, parity, round_trip[, ids]`` of every document.

    ``threads`` should be the cores of one task (``spark.task.cpus``). ``round_trip``: decoding gives the text back.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, parity boolean, round_trip boolean" + (", ids array<int>" if with_ids else "")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec.of(model, threads)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = [t or "" for t in b.column(1).to_pylist()]
                ids, parity = codec.encode(texts)
                same = [back == t for back, t in zip(codec.decode(ids), texts, strict=True)]
                columns = [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                           pa.array(parity, pa.bool_()), pa.array(same, pa.bool_())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip", "ids"][:len(columns)])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(each, out)


def decode_documents(encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids", threads: int = 1) -> DataFrame:
    """``doc_id, text`` from arrays of ids; NULL arrays give NULL."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec.of(model, threads)
        for b in batches:
            rows = b.column(1).to_pylist()
            texts = codec.decode([_packed(r or []) for r in rows])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if r is None else t for r, t in zip(rows, texts, strict=True)], pa.string())],
                                             names=["doc_id", "text"])

    kind = encoded.schema[doc_id].dataType.simpleString()
    return encoded.select(F.col(doc_id), F.col(ids)).mapInArrow(each, f"doc_id {kind}, text string")
