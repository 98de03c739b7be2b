"""Tokenizing in tasks, with a bounded memory of words."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

#: Words kept per worker, about 250 bytes each, in a current and an older half: when the current one is full it
#: becomes the older one, from which words still in use return. Results do not depend on it.
REMEMBERED_WORDS = 400_000

#: Characters of text whose new words are encoded together.
GROUP_CHARS = 1_000_000

# The pre-tokenizer pattern of the word-level BPE files that the short way below is right for.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Lower-case ASCII and Latin-1 letters: NFC leaves them alone and they form one pre-token.
PLAIN_WORD = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")

_ENCODERS: dict[str, Callable[[list[str]], list[bytes]]] = {}


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE's visible character for every byte: printable ones stand for themselves, the rest follow from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def word_encoder(vocabulary: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their token ids as little-endian unsigned 32-bit bytes.

    For a ``tokenizers`` file that lower-cases, drops white space and splits into letters, digits and
    signs, the ids of a text are those of its chunks between white space, one after another. A chunk
    is encoded once per worker; plain words go straight to the BPE model. Any other file encodes
    whole texts. Texts are always encoded to their end.
    """
    if vocabulary not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        _ENCODERS[vocabulary] = _by_words(tokenizer) if _splits_words(tokenizer) else _whole(tokenizer)
    return _ENCODERS[vocabulary]


def _splits_words(tokenizer) -> bool:
    import json

    parts = json.loads(tokenizer.to_str())
    normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    cut = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (normal == ["NFC", "Replace", "Lowercase"] and len(cut) == 2 and cut[0].get("type") == "Split"
            and cut[0]["pattern"] == {"Regex": WORD_PATTERN} and cut[0]["invert"] and cut[1].get("type") == "ByteLevel"
            and not cut[1]["use_regex"] and not cut[1]["add_prefix_space"]
            and all("<|" in t["content"] and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
                    for t in parts["added_tokens"]))


def _ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _whole(tokenizer) -> Callable[[list[str]], list[bytes]]:
    return lambda texts: [_ids(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def _by_words(tokenizer) -> Callable[[list[str]], list[bytes]]:
    known: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}
    model, shown = tokenizer.model, byte_alphabet()
    stops = {s: _ids(tokenizer.encode(s, add_special_tokens=False).ids) for s in (",", ".")}

    def word(text: str) -> bytes:
        if not text.isascii():
            text = text.lower().encode().decode("latin-1").translate(shown)
        return _ids([t.id for t in model.tokenize(text)])

    def learn(chunks: set[bytes]) -> None:
        other = []
        for chunk in chunks:
            if chunk in older:
                known[chunk] = older[chunk]
                continue
            text = chunk.decode()
            if PLAIN_WORD.fullmatch(text):
                known[chunk] = word(text)
            elif text[-1] in stops and PLAIN_WORD.fullmatch(text, 0, len(text) - 1):
                known[chunk] = word(text[:-1]) + stops[text[-1]]
            else:
                other.append(chunk)
        for at in range(0, len(other), 1000):
            some = other[at:at + 1000]
            found = tokenizer.encode_batch_fast([c.decode() for c in some], add_special_tokens=False)
            known.update((c, _ids(f.ids)) for c, f in zip(some, found, strict=True))

    def encode(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            lines, size = [], 0
            while at < len(texts) and (not lines or size < GROUP_CHARS):
                raw = texts[at].encode()
                # ASCII letters are lowered at once, unless the text may hold a special token.
                lines.append((raw if b"<|" in raw else raw.lower()).split())
                size += len(raw)
                at += 1
            missing = set().union(*lines).difference(known)
            if missing:
                if len(missing) + len(known) > REMEMBERED_WORDS // 2:
                    older.clear()
                    older.update(known)
                    known.clear()
                    missing = set().union(*lines)
                learn(missing)
            out += [b"".join([known[c] for c in line]) for line in lines]
        return out

    return encode
