"""SentencePiece encoding and decoding by streaming Viterbi (operator 8).

The best segmentation under the model's piece scores is found while the text
streams by.  Only a window of as many positions as the longest piece has
characters is kept; whenever the backpointer paths of all positions in the
window meet in one boundary, the ids before that boundary are committed and
forgotten.  A character that no piece covers becomes its UTF-8 byte pieces.

Blanks are written as U+2581, and one is put in front of the text, as the
model's own normaliser does.  Where no piece runs over the place before a blank
or around a newline, all paths meet there.  Arrow and numpy cut the texts of a
slice into the segments between such places; Python sees each different one
once and remembers it (bounded).  A new segment no longer than the window ends
before anything in it could be committed, so such segments go side by side, one
step of the same search for all of them at a time; longer ones, and those with
a character that no piece covers, stream by on their own.

Decoding joins the pieces, turns byte pieces back into UTF-8 (invalid bytes:
U+FFFD) and U+2581 into blanks, and drops the blank in front.  It restores
every text without U+2581 exactly.  Arrow joins the pieces of a slice; only rows
with byte pieces beyond ASCII or with special ids are decoded one by one.

Defined results: a null text counts as empty and has no id; its decoded text
is empty.  Equal scores prefer the longer last piece.  Repeated rows give
equal rows, extra columns are ignored, an empty table gives an empty result,
null doc_ids are passed through.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chainstar.llm.common import c, give_back
from chainstar.llm.tokens import as_binary, by_bytes

BLANK = "▁"
BYTE_SCORE = -100.0     # added below the least score, for each byte of a character without a piece
SLICE_BYTES = 2 << 20   # of texts encoded together
SIDE_BY_SIDE = 1 << 14  # segments searched together
_LONG = 64              # longer segments are not remembered
_MODELS: dict = {}      # per Python worker


class Trie:
    """The pieces as a double array: the child of ``node`` by a character's code is ``base[node] + code``
    if ``check`` names ``node`` there.  The root is 0 and its children are the codes themselves; code 0 is no character's."""

    def __init__(self, table: dict[str, tuple[float, int]]):
        kids: dict[str, list[str]] = {"": []}
        for p in sorted({p[:k] for p in table for k in range(1, len(p) + 1)}):
            kids.setdefault(p[:-1], []).append(p)
        code = {ch: n for n, ch in enumerate(sorted({ch for p in table for ch in p}), 1)}
        self.code_of = np.zeros(0x110000, np.int32)
        for ch, n in code.items():
            self.code_of[ord(ch)] = n
        self.code_of[ord(" ")] = code.get(BLANK, 0)
        base, slot = {"": 0}, {p: code[p] for p in kids.pop("")}
        top = len(code) + 1
        free = np.ones(2 * (top + sum(map(len, kids.values()))), bool)
        free[:top] = False
        width, at, gaps = 0, 0, np.zeros(0, np.intp)
        for p, below in sorted(kids.items(), key=lambda x: -len(x[1])):
            codes = np.array([code[x[-1]] for x in below])
            if len(below) != width:              # smaller groups fit into the gaps that larger ones left
                width, at, gaps = len(below), 0, np.flatnonzero(free[:-top])
            while not len(fit := np.flatnonzero(free[gaps[at:at + 64, None] + (codes - codes[0])].all(1))):
                at += 64
                if at >= len(gaps):
                    free = np.append(free, np.ones(len(free), bool))
                    at, gaps = 0, np.flatnonzero(free[:-top])
            at += int(fit[0]) + 1
            base[p] = int(gaps[at - 1] - codes[0])
            free[base[p] + codes] = False
            slot.update((x, base[p] + int(n)) for x, n in zip(below, codes))
        size = max(slot.values(), default=0) + top + 1
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.score, self.id, self.length = np.full(size, -np.inf), np.zeros(size, np.uint32), np.zeros(size, np.intp)
        for p, n in slot.items():
            self.check[n] = slot[p[:-1]] if len(p) > 1 else 0
            self.base[n] = base.get(p, 0)
            self.length[n] = len(p)
        for p, (score, i) in table.items():
            self.score[slot[p]], self.id[slot[p]] = score, i
        self.piece = np.zeros(size, bool)
        self.piece[[slot[p] for p in table]] = True


class Codec:
    """Pieces and scores of a SentencePiece model file.

    ``flat(texts)`` gives the ids of an Arrow array of texts in one array, ``texts(ids)`` the texts of an
    Arrow array of ids; ``encode`` and ``decode`` do one.  At most ``most`` segments are remembered, in two
    generations: when the young one is full it becomes the old one, and what is met again moves back.
    """

    def __init__(self, path: str, most: int = 500_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.special = {i for i in range(n) if special[i]}
        self.unknown = sp.unk_id()
        self._setup({self.pieces[i]: (sp.get_score(i), i) for i in range(n)
                     if not special[i] and i not in self.byte_of}, most)
        # The bytes of each id, and of each id at the beginning of a text.
        spelled = [b"" if special[i] else bytes([self.byte_of[i]]) if i in self.byte_of
                   else self.pieces[i].replace(BLANK, " ").encode() for i in range(n)]
        self.spelled = pa.array(spelled + [x.removeprefix(b" ") for x in spelled], pa.binary())
        self.alone = np.array([special[i] or self.byte_of.get(i, 0) >= 128 for i in range(n)])

    def _setup(self, table: dict[str, tuple[float, int]], most: int) -> None:
        self.table = table
        # Every beginning of a piece; a whole piece with its score and its ids.
        self.prefixes = {p[:k]: None for p in table for k in range(1, len(p))}
        self.prefixes |= {p: (score, (i,)) for p, (score, i) in table.items()}
        self.longest = max(map(len, table), default=1)
        self.least = min((s for s, _ in table.values()), default=0.0) + BYTE_SCORE
        self.trie = Trie(table)
        # Every path has a boundary before a blank that follows another character, and around a newline,
        # unless some piece runs over it.
        self.cut = not any(re.search(f"[^{BLANK}]{BLANK}", p) or ("\n" in p and p != "\n") for p in table)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = most

    def _bytes(self, ch: str) -> list[int]:
        return [self.byte_id.get(b, self.unknown) for b in ch.encode()]

    def viterbi(self, text: str):
        """Yields ids of ``text``, committed as soon as all paths agree.

        ``best`` holds the scores of the positions ahead, at most ``longest``
        of them; ``back`` the boundaries behind them since the last commit.
        The open paths are the chains of boundaries behind the positions
        ahead; where they meet past the last commit, the ids up to there are
        final.
        """
        longest, get = self.longest, self.prefixes.get
        best: dict[int, float] = {0: 0.0}
        back: dict[int, tuple[int, tuple[int, ...]]] = {}
        done, n = 0, len(text)
        for start in range(n):
            base = best.pop(start)
            for end in range(start + 1, min(n, start + longest) + 1):
                hit = get(text[start:end], False)
                if hit is False:                   # no piece begins so
                    break
                if hit is not None and (end not in best or base + hit[0] > best[end]):
                    best[end], back[end] = base + hit[0], (start, hit[1])
            ch = text[start]
            if ch not in self.table:
                ids, end = self._bytes(ch), start + 1
                score = base + self.least * len(ids)
                if end not in best or score > best[end]:
                    best[end], back[end] = score, (start, tuple(ids))
            if start - done >= longest:
                meet = self._meet(best, back, done)
                if meet > done:
                    yield from self._path(back, done, meet)
                    for k in range(done + 1, meet + 1):
                        back.pop(k, None)
                    done = meet
        yield from self._path(back, done, n)

    @staticmethod
    def _meet(best: dict, back: dict, done: int) -> int:
        """The last boundary that the paths of all kept positions share."""
        heads = set(best)
        while len(heads) > 1:
            far = max(heads)
            heads.discard(far)
            heads.add(back[far][0] if far > done else far)
        return heads.pop()

    @staticmethod
    def _path(back: dict, start: int, end: int) -> list[int]:
        parts = []
        while end > start:
            end, ids = back[end][0], back[end][1]
            parts.append(ids)
        return [i for ids in reversed(parts) for i in ids]

    def _side_by_side(self, segments: list[str]) -> list[bytes | None]:
        """The ids of segments of at most ``longest`` characters; None if a character is no piece.

        Position k of segment i is place ``k * n + i`` of a grid, so a step of the search takes the
        same position of all segments.
        """
        trie, n = self.trie, len(segments)
        size = np.fromiter(map(len, segments), np.intp, n)
        codes = trie.code_of[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        segment = np.repeat(np.arange(n), size)
        row = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
        grid = np.zeros((self.longest + 1) * n, np.int32)
        grid[row * n + segment] = codes
        bare = np.bincount(segment[~trie.piece[codes]], minlength=n) > 0

        # The pieces of each length: where they begin, in order, and which.
        at = np.flatnonzero(grid)
        node, found = grid[at], []
        for k in range(1, self.longest + 1):
            hit = trie.piece[node]
            begin = at[hit]
            found.append((k, begin, node[hit], np.searchsorted(begin, np.arange(self.longest + 1) * n).tolist()))
            if k < self.longest:                 # a path past its segment's end has met a 0
                child = trie.base[node] + grid[at + k * n]
                alive = trie.check[child] == node
                at, node = at[alive], child[alive]

        best, last = np.full(len(grid), -np.inf), np.zeros(len(grid), np.int32)
        best[:n] = 0.0
        for start in range(self.longest):
            for k, begin, which, places in found[:self.longest - start]:
                a, b = places[start], places[start + 1]
                if a < b:
                    score = best[begin[a:b]] + trie.score[which[a:b]]
                    end = begin[a:b] + k * n
                    better = score > best[end]
                    end = end[better]
                    best[end], last[end] = score[better], which[a:b][better]

        on_path = np.zeros(len(grid), bool)
        at = (size * n + np.arange(n))[~bare]
        while len(at):
            on_path[at] = True
            at = at - trie.length[last[at]] * n
            at = at[at >= n]
        on_path = on_path.reshape(-1, n).T
        ids = trie.id[last.reshape(-1, n).T[on_path]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(on_path.sum(1))).tolist()
        return [None if no else ids[a:b] for no, a, b in zip(bare.tolist(), [0, *ends], ends)]

    def _segments(self, segments: list[str]) -> list[bytes]:
        """The ids of new segments (blanks as such)."""
        out: list[bytes | None] = [None] * len(segments)
        short = [i for i, x in enumerate(segments) if len(x) <= self.longest]
        for at in range(0, len(short), SIDE_BY_SIDE):
            some = short[at:at + SIDE_BY_SIDE]
            for i, ids in zip(some, self._side_by_side([segments[i] for i in some])):
                out[i] = ids
        return [np.fromiter(self.viterbi(x.replace(" ", BLANK)), "<u4").tobytes() if ids is None else ids
                for x, ids in zip(segments, out)]

    def _known(self, segments: list[str]) -> list[bytes]:
        """The ids of different segments, remembered or new."""
        if len(self.young) > self.most // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        got = list(map(young.get, segments))
        new = []
        for i in [i for i, ids in enumerate(got) if ids is None]:
            ids = got[i] = old.get(segments[i])
            if ids is None:
                new.append(i)
            else:
                young[segments[i]] = ids
        for i, ids in zip(new, self._segments([segments[i] for i in new])):
            got[i] = ids
            if len(segments[i]) <= _LONG:        # others are rare and large
                young[segments[i]] = ids
        return got

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one after another, where each text's ids begin and the last one's end)."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), BLANK, " ")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        first = np.zeros(len(data), bool)
        if self.cut:
            blank, line = data == 32, data == 10
            first |= blank | line
            first[1:] &= ~(blank[1:] & blank[:-1])
            first[1:] |= line[:-1]
        first[at[:-1][at[:-1] < len(data)]] = True
        cuts = np.flatnonzero(first).astype(np.int32)
        bounds = np.append(cuts, np.int32(len(data)))
        coded = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
                                      ).dictionary_encode()      # each different segment is looked up once
        which = coded.indices.to_numpy()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int32, len(known)) // 4
        start = np.cumsum(size, dtype=np.int32) - size
        n = size[which]
        end = np.append(np.int32(0), np.cumsum(n, dtype=np.int32))       # ids are no more than bytes
        flat = ids[np.repeat(start[which] - end[:-1], n) + np.arange(end[-1], dtype=np.int32)]
        return flat, end[np.searchsorted(cuts, at)].astype(np.int64)

    def encode(self, text: str | None) -> list[int]:
        return self.flat(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.special:
                out.append(self.pieces[i])
        out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text

    def texts(self, ids: pa.Array) -> pa.Array:
        """``decode`` of each value of a binary array of little-endian unsigned 32-bit ids (null: empty)."""
        if not len(ids):
            return pa.array([], pa.string())
        ids = pc.fill_null(ids.cast(pa.binary()), b"")
        at = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
        if (np.diff(at) % 4).any():
            raise ValueError("ids are 4 bytes each")
        flat = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].view("<u4").astype(np.int64)
        at = (at - at[0]) // 4
        if flat.max(initial=0) >= len(self.pieces):
            raise IndexError("an id is not in the model")
        alone = np.unique(np.searchsorted(at, np.flatnonzero(self.alone[flat]), "right") - 1).tolist()
        singly = {i: self.decode(flat[at[i]:at[i + 1]].tolist()) for i in alone}
        flat[at[:-1][np.diff(at) > 0]] += len(self.pieces)       # the form at the beginning
        joined = self.spelled.take(pa.array(flat))
        ends = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset:joined.offset + len(flat) + 1]
        out = pa.Array.from_buffers(pa.binary(), len(ids), [
            None, pa.py_buffer(ends[at].astype(np.int32)), joined.buffers()[2] or pa.py_buffer(b"")])
        if singly:
            out = pa.array([x if (text := singly.get(i)) is None else text.encode()
                            for i, x in enumerate(out.to_pylist())], pa.binary())
        return out.cast(pa.string())


def codec(path: str) -> Codec:
    if path not in _MODELS:
        _MODELS[path] = Codec(path)
    return _MODELS[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (little-endian unsigned 32-bit), n_ids, ids_crc32."""

    rows = docs.select(c(id_col), c(text_col))
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids binary, n_ids long, ids_crc32 long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        sp = codec(model)
        for batch in batches:
            for part in by_bytes(batch, 1, SLICE_BYTES):
                flat, at = sp.flat(part.column(1))
                raw, ends = memoryview(flat.astype("<u4").tobytes()), (4 * at).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(arrow[0].type), as_binary(flat, at), pa.array(np.diff(at)),
                     pa.array([zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())], schema=arrow)
            give_back()

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id, text (null ids: empty)."""

    rows = rows.select(c(id_col), c(ids_col))
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, text string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        sp = codec(model)
        for batch in batches:
            for part in by_bytes(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(arrow[0].type), sp.texts(part.column(1))], schema=arrow)
            give_back()

    return rows.mapInArrow(run, schema)
