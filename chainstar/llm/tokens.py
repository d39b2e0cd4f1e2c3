"""Token ids of the tokenizers library, computed once per distinct chunk.

A text is cut before each run of ASCII white space.  No pre-token of the two
public vocabularies crosses such a cut, and what a tokenizer does within a
chunk does not depend on its neighbours, so a text's ids are the ids of its
chunks, one after another.  With the two vocabularies known here a chunk also
ends between an ASCII letter and an ASCII mark other than the apostrophe, which
no pre-token crosses either.  Arrow and numpy cut the texts of a slice and put
the ids together; Python sees each different chunk of the slice once.  A
worker remembers chunks it has seen (bounded); a text with any other white
space is encoded whole.

A new chunk of plain letters, digits and punctuation is split here into its
pre-tokens, which go straight to the library's BPE model; any other chunk
goes through the library's whole pipeline.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 13, 32]] = True
_IS_LETTER = np.array([n < 128 and chr(n).isalpha() for n in range(256)])
_IS_MARK = np.array([33 <= n < 127 and not chr(n).isalnum() and n != 39 for n in range(256)])    # not the apostrophe
_LOWER = np.array([n + 32 if 65 <= n <= 90 else n for n in range(256)], dtype=np.uint8)
_OTHER_SPACES = [chr(n) for n in range(0x3001) if chr(n).isspace() and chr(n) not in " \t\n\r"]
_LONG = 64            # longer chunks are not remembered
_ENCODERS: dict = {}  # per Python worker
assert array("I").itemsize == 4 and sys.byteorder == "little"

# Letters that NFC leaves alone (Latin, Cyrillic), and ASCII marks but for the apostrophe.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ"
_MARK = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[ \n]?[{_LETTER}0-9{_MARK}]+")
# Pre-tokens of a plain chunk: the byte vocabulary keeps white space and runs of digits, the word vocabulary neither.
_BYTE_PARTS = re.compile(f"\n| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+")
_WORD_PARTS = re.compile(f"[{_LETTER}]+|[0-9]|[{_MARK}]+")
# Byte-level vocabularies write a byte without a visible form as a character from 256 on, in order of the bytes.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SPACE, _LINE_FEED = chr(_BYTES[32]), chr(_BYTES[10])


def _parts_of(path: str) -> tuple[re.Pattern | None, bool]:
    """(pre-token pattern, lower case) of a vocabulary whose rules are known here, else (None, False)."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    norm, pre = rules["normalizer"], rules["pre_tokenizer"] or {}
    steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
    if not norm and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return _BYTE_PARTS, False
    if steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre.get("pretokenizers", [])] == [
            "Split", "ByteLevel"] and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in pre["pretokenizers"][0]["pattern"]["Regex"]:
        return _WORD_PARTS, True
    return None, False


def _cuts(data: np.ndarray, starts: np.ndarray, marks: bool) -> np.ndarray:
    """Where the chunks of the texts in ``data`` (UTF-8 bytes) begin; ``starts``: where the texts begin;
    ``marks``: also cut between a letter and a mark."""
    white = _WHITE[data]
    first = white.copy()
    first[1:] &= ~white[:-1]
    if marks:
        first[1:] |= _IS_LETTER[data[:-1]] & _IS_MARK[data[1:]]
    first[starts[starts < len(data)]] = True
    return np.flatnonzero(first).astype(np.int32)


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but for one before another byte than ASCII: a combining mark would first join it."""
    alone = np.append(data[1:] < 128, True)
    return np.where(alone, _LOWER[data], data)


class Encoder:
    """``flat(texts)`` gives the ids of an Arrow array of texts in one array, ``ids(texts)`` each
    text's ids as little-endian unsigned 32-bit bytes.

    Arrow finds the different chunks of a call, so that Python looks up each of them once.

    At most ``most`` chunks are remembered, in two generations: when the young
    one is full it becomes the old one, and what is met again moves back.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        # A text with the name of an added token goes to the library whole: the name becomes the token's id there.
        self.names = tuple({x.content for x in self.tok.get_added_tokens_decoder().values()})
        self.whole = "|".join([re.escape(x) for x in self.names] + [f"[{''.join(_OTHER_SPACES)}]"])
        self.parts, self.lower = _parts_of(path)
        self.part = lru_cache(maxsize=1 << 16)(self._part)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = most

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in got]

    def _shown(self, shown: str) -> bytes:
        """The ids of one pre-token as the model spells it."""
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of one pre-token."""
        if part.isascii():
            return self._shown(part.replace(" ", _SPACE).replace("\n", _LINE_FEED))
        return self._shown(part.encode().decode("latin-1").translate(_BYTES))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if not self.parts:
            return self._encode(chunks)
        out, odd = [], []
        for chunk in chunks:
            plain = chunk.lower() if self.lower else chunk
            if chunk[0] == " " and chunk.isascii() and chunk[1:].isalpha():      # a single pre-token
                out.append(self._shown(plain[1:] if self.lower else _SPACE + plain[1:]))
            elif _PLAIN.fullmatch(plain):
                out.append(b"".join([self.part(x) for x in self.parts.findall(plain)]))
            else:
                odd.append((len(out), chunk))
                out.append(b"")
        for (i, _), ids in zip(odd, self._encode([x for _, x in odd])):
            out[i] = ids
        return out

    def _known(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks, remembered or new."""
        if len(self.young) > self.most // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        got = list(map(young.get, chunks))
        missing = [i for i, ids in enumerate(got) if ids is None]
        new = []
        for i in missing:
            ids = got[i] = old.get(chunks[i])
            if ids is None:
                new.append(i)
            else:
                young[chunks[i]] = ids
        for i, ids in zip(new, self._chunks([chunks[i] for i in new])):
            got[i] = ids
            if len(chunks[i]) <= _LONG:          # others are rare and large
                young[chunks[i]] = ids
        return got

    def _joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``flat`` of texts without nulls whose chunks do not depend on each other."""
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        cuts = _cuts(data, at[:-1], self.parts is not None)
        if self.lower:
            data = _lowered(data)
        bounds = np.append(cuts, np.int32(len(data)))
        chunks = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()       # each different chunk is looked up once
        which = coded.indices.to_numpy()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int32, len(known)) // 4
        start = np.cumsum(size, dtype=np.int32) - size
        n = size[which]
        end = np.append(np.int32(0), np.cumsum(n, dtype=np.int32))       # ids are no more than bytes
        flat = ids[np.repeat(start[which] - end[:-1], n) + np.arange(end[-1], dtype=np.int32)]
        return flat, end[np.searchsorted(cuts, at)].astype(np.int64)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one after another, where each text's ids begin and the last one's end)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        alone = np.flatnonzero(pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False))
        if not len(alone):
            return self._joined(texts)
        flats, sizes, at = [], [], 0
        for i in [*alone.tolist(), len(texts)]:
            flat, ends = self._joined(texts.slice(at, i - at))
            flats.append(flat)
            sizes.append(np.diff(ends))
            if i < len(texts):
                flats.append(np.frombuffer(self._encode([texts[i].as_py()])[0], "<u4"))
                sizes.append([len(flats[-1])])
            at = i + 1
        return np.concatenate(flats), np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int64)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        flat, at = self.flat(pa.array(texts, pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


def by_bytes(batch: pa.RecordBatch, text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of text (column number ``text``), a row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(size, dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def with_end(flat: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``Encoder.flat``'s result with an end id after each text."""
    return np.insert(flat, at[1:], end_id), at + np.arange(len(at))


def as_binary(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column of little-endian ids: one value between each two places of ``at``."""
    if 4 * int(at[-1]) >= 1 << 31:
        raise ValueError("ids of one batch exceed 2 GB")
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [
        None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat, "<u4"))])


def encoder(path: str, most: int = 800_000) -> Encoder:
    """This worker's encoder for a vocabulary file, remembering at most ``most`` chunks."""
    if (path, most) not in _ENCODERS:
        _ENCODERS[path, most] = Encoder(path, most)
    return _ENCODERS[path, most]
