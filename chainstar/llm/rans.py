"""Static range asymmetric numeral system (rANS) over blocks of token ids.

Format of a block (all numbers little endian):

    magic "RNS1" | version u16 | lanes u16 | n_tokens u32 | every u32 | n_words u32 | n_checkpoints u32
    crc32 of the ids u32 | crc32 of the body u32
    body: for each checkpoint: word position u32, then lanes x state u64; then n_words x u32

Token i belongs to lane i mod lanes.  The frequency table is shared by all
blocks (2**PRECISION slots).  A checkpoint stands before every ``every``-th
step of the lanes and holds what a decoder needs to begin there, so the parts
between checkpoints are decoded independently (here: side by side in numpy).
Both checksums are verified.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PRECISION = 20                 # bits of the frequency table's sum
LOW = np.uint64(1 << 31)       # states stay in [2**31, 2**63)
LANES, EVERY = 256, 128
_HEAD = struct.Struct("<4sHHIIIIII")


def quantise(counts: np.ndarray, bits: int = PRECISION) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 wherever the count is not 0."""
    counts = np.asarray(counts, dtype=np.int64)
    used = np.nonzero(counts)[0]
    total, slots = int(counts.sum()), 1 << bits
    freq = np.zeros(len(counts), dtype=np.int64)
    if not len(used):
        return freq
    if len(used) > slots:
        raise ValueError(f"{len(used)} different ids need more than {bits} bits")
    # The share of each id, the rest of the division by the largest remainders.
    spare = slots - len(used)
    share = [int(n) * spare for n in counts[used]]
    freq[used] = 1 + np.array([s // total for s in share], dtype=np.int64)
    left = slots - int(freq.sum())
    rest = np.array([s % total for s in share], dtype=np.float64)
    freq[used[np.argsort(-rest, kind="stable")[:left]]] += 1
    return freq


class Coder:
    """Encodes and decodes blocks under one frequency table."""

    def __init__(self, freq: np.ndarray, bits: int = PRECISION):
        self.bits = np.uint64(bits)
        self.freq = np.asarray(freq, dtype=np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.mask = np.uint64((1 << bits) - 1)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = EVERY) -> bytes:
        return self.encode_all([ids], lanes, every)[0]

    def encode_all(self, blocks: list[np.ndarray], lanes: int = LANES, every: int = EVERY) -> list[bytes]:
        """Every array of ids as a block of its own; step t is taken in all blocks at once."""
        blocks = [np.ascontiguousarray(x, dtype="<u4") for x in blocks]
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))     # blocks still live are the first ones
        n = np.array([len(blocks[i]) for i in order], dtype=np.int64)
        steps = -(-n // lanes)
        row0 = np.cumsum(steps) - steps
        rows = np.zeros((int(steps.sum()), lanes), dtype="<u4")
        flat = rows.reshape(-1)
        for i, at, k in zip(order, row0 * lanes, steps * lanes):
            flat[at:at + len(blocks[i])] = blocks[i]
            flat[at + len(blocks[i]):at + k] = blocks[i][:1]         # an id of the table; never coded
        state = np.full((len(blocks), lanes), LOW, dtype=np.uint64)
        top, half = np.uint64(63) - self.bits, np.uint64(32)
        sent = np.zeros(len(blocks), dtype=np.int64)                # words emitted so far
        words: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        number = np.min_scalar_type(len(blocks))
        marks: list[list[tuple[int, bytes]]] = [[] for _ in blocks]    # (words emitted so far, states)
        for t in range(int(steps.max(initial=0)) - 1, -1, -1):
            k = int(np.searchsorted(-steps, -t))                       # blocks with more than t steps
            s, x = rows[row0[:k] + t], state[:k]
            f = self.freq[s]
            if not f.all():
                raise ValueError("an id outside the frequency table")
            real = None if n[k - 1] >= (t + 1) * lanes else t * lanes + np.arange(lanes) < n[:k, None]
            full = x >= (f << top)
            if real is not None:
                full &= real
            emitted = full.sum(axis=1)
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            owners.append(np.repeat(np.arange(k, dtype=number), emitted))
            sent[:k] += emitted
            y = np.where(full, x >> half, x)
            q = y // f
            y = (q << self.bits) + (y - q * f) + self.first[s]
            state[:k] = y if real is None else np.where(real, y, x)
            if t % every == 0:
                for i in range(k):
                    marks[i].append((int(sent[i]), state[i].astype("<u8").tobytes()))
        owner = np.concatenate([*reversed(owners), np.empty(0, number)])
        emitted = np.concatenate([*reversed(words), np.empty(0, "<u4")])[np.argsort(owner, kind="stable")]
        out = [b""] * len(blocks)
        for j, (i, end) in enumerate(zip(order, np.cumsum(sent).tolist())):
            count = int(sent[j])
            body = b"".join([struct.pack("<I", count - at) + x for at, x in reversed(marks[j])]
                            + [emitted[end - count:end].astype("<u4").tobytes()])
            out[i] = _HEAD.pack(b"RNS1", 1, lanes, len(blocks[i]), every, count, len(marks[j]),
                                zlib.crc32(blocks[i]), zlib.crc32(body)) + body
        return out

    def decode(self, block: bytes) -> np.ndarray:
        """The ids of a block; a ValueError where a checksum differs."""
        return self.decode_all([block])[0]

    def decode_all(self, blocks: list[bytes]) -> list[np.ndarray]:
        """The ids of every block; a ValueError where a checksum differs."""
        heads, alike = [], {}
        for i, block in enumerate(blocks):
            if len(block) < _HEAD.size:
                raise ValueError("not a sound block")
            magic, version, lanes, n, every, n_words, n_marks, ids_crc, body_crc = _HEAD.unpack_from(block)
            body = memoryview(block)[_HEAD.size:]
            if magic != b"RNS1" or version != 1 or not lanes or not every or zlib.crc32(body) != body_crc:
                raise ValueError("not a sound block")
            if len(body) != n_marks * (4 + 8 * lanes) + 4 * n_words or n_marks != -(-n // (lanes * every)):
                raise ValueError("block of another length")
            heads.append((body, n, n_words, n_marks, ids_crc))
            alike.setdefault((lanes, every), []).append(i)
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(blocks)
        for (lanes, every), some in alike.items():
            for i, ids in zip(some, self._run([heads[i] for i in some], lanes, every), strict=True):
                if zlib.crc32(ids) != heads[i][4]:
                    raise ValueError("ids differ from their checksum")
                out[i] = ids
        return out

    def _run(self, heads, lanes, every) -> list[np.ndarray]:
        """All parts between checkpoints, of all blocks, side by side: one step of every part at a time."""
        size, at, left, states, words = 4 + 8 * lanes, [], [], [], []
        base = 0
        for body, n, n_words, n_marks, _ in heads:
            for i in range(n_marks):
                at.append(base + struct.unpack_from("<I", body, i * size)[0])
                left.append(min(n - i * every * lanes, every * lanes))
                states.append(np.frombuffer(body, "<u8", lanes, i * size + 4))
            words.append(np.frombuffer(body, "<u4", n_words, n_marks * size))
            base += n_words
        words = np.concatenate([*words, np.zeros(1, "<u4")]).astype(np.uint64)
        left = np.array(left, dtype=np.int64)
        order = np.argsort(-left, kind="stable")                    # parts still live are the first ones
        at = np.array(at, dtype=np.int64)[order]
        state = np.stack(states)[order].astype(np.uint64) if states else np.empty((0, lanes), np.uint64)
        left_in = left[order]
        steps = -(-int(left.max(initial=0)) // lanes)
        out = np.zeros((len(at), steps, lanes), dtype="<u4")
        for t in range(steps):
            k = int(np.searchsorted(-left_in, -t * lanes))          # parts with more than t steps
            x = state[:k]
            low = x & self.mask
            s = self.slots[low]
            y = self.freq[s] * (x >> self.bits) + low - self.first[s]
            need = y < LOW
            if left_in[k - 1] < (t + 1) * lanes:
                real = t * lanes + np.arange(lanes) < left_in[:k, None]
                need &= real
                s = np.where(real, s, 0)
                y = np.where(real, y, x)
            taken = need.sum(axis=1)
            # The words of a part follow one another, lane by lane.
            first = np.repeat(at[:k] - (np.cumsum(taken) - taken), taken)
            y[need] = (y[need] << np.uint64(32)) | words.take(first + np.arange(len(first)), mode="clip")
            state[:k] = y
            at[:k] += taken
            out[:k, t] = s
        place = np.argsort(order)
        ids, done = [], 0
        for _, n, _, n_marks, _ in heads:
            parts = place[done:done + n_marks]
            done += n_marks
            ids.append(np.concatenate([out[p].reshape(-1)[:m] for p, m in zip(parts, left[done - n_marks:done])]
                                      or [np.empty(0, "<u4")]))
        return ids
