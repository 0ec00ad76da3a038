"""Memoized use of public tokenizers.

Neither vocabulary here joins text across a space before a word, around a single line end, or between a
letter or digit and a sign after it, so a text's ids are those of the pieces between these places. Many texts
are cut, in numpy over their bytes, and their distinct pieces numbered at a time, in Arrow; a Python process
remembers the ids of pieces it has met, gives the tokenizer only new ones, as few calls as can be, and gathers
the ids of all texts by places. `tests/llm` holds the results against plain calls.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Characters, and texts, worked on at a time; a longer text is worked on alone.
CHARACTERS = 1_000_000
TEXTS = 4_096
# Pieces that a process remembers at most, and the longest one that it does. When there are more, the half that
# fewer calls have met is forgotten.
MEMO = 1_000_000
LONGEST = 64
SPACE, LINE_END, LATIN = 0x20, 0x0A, 0xC3
SIGNS = np.isin(np.arange(256), list(string.punctuation.encode()))
# ASCII letters and digits, and the second bytes of Latin-1 letters, whose first one is LATIN.
ALNUM = np.array([chr(byte).isascii() and chr(byte).isalnum() for byte in range(256)])
LATIN_TAILS = np.array([byte in range(0x80, 0xC0) and byte not in (0x97, 0xB7) for byte in range(256)])
# Letters, of which each alphabet here makes a word of its own.
LETTERS = r"^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"



def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def as_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `flat` at `starts`, one after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class Store:
    """Ids of numbered pieces, in one growing array."""

    def __init__(self) -> None:
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.met, self.n = *(np.zeros(1 << 14, np.int64) for _ in range(3)), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Store pieces whose `ids` stand one after the other; returns their numbers."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.n + len(sizes) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
            self.met = np.concatenate((self.met, np.zeros_like(self.met)))
        numbers = np.arange(self.n, self.n + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.sizes[numbers], self.met[numbers] = sizes, 0
        self.used, self.n = self.used + len(ids), self.n + len(sizes)
        return numbers

    def cut_back(self, n: int) -> None:
        """Forget all pieces from number `n` on."""
        if n < self.n:
            self.used, self.n = int(self.starts[n]), n

    def meet(self, numbers: np.ndarray) -> None:
        """Note that a call has met these (different) pieces."""
        self.met[numbers] += 1

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has."""
        sizes = self.sizes[numbers]
        return gather(self.flat, self.starts[numbers], sizes), sizes


class Memo:
    """Numbers of pieces: short ones by their bytes, found through sorted hashes, longer ones in a dictionary."""

    SHORT = 15
    MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self) -> None:
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # Bytes and length of the short pieces, in the order they came, and their numbers.
        self.keys, self.numbers, self.long = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), {}

    def __len__(self) -> int:
        return len(self.numbers) + len(self.long)

    def __iter__(self) -> Iterator[str]:
        for key in self.keys:
            data = key.astype("<u8").tobytes()
            yield data[: data[self.SHORT]].decode()
        yield from self.long

    @classmethod
    def keys_of(cls, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """16 bytes for each piece, the last one its length, and which pieces are too long for that."""
        _, offsets, data = pieces.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(pieces) + 1, 8 * pieces.offset)
        data = np.concatenate((np.frombuffer(data or b"", np.uint8)[: offsets[-1]], np.zeros(16, np.uint8)))
        words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        sizes = np.minimum(np.diff(offsets), cls.SHORT + 1)
        low = words[offsets[:-1]] & cls.MASKS[np.minimum(sizes, 8)]
        high = words[offsets[:-1] + 8] & cls.MASKS[np.clip(sizes - 8, 0, 7)]
        return np.column_stack((low, high | sizes.astype(np.uint64) << np.uint64(56))), sizes > cls.SHORT

    @staticmethod
    def hashed(keys: np.ndarray) -> np.ndarray:
        mixed = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ mixed >> np.uint64(32)

    def find(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Numbers of pieces, -1 for unknown ones."""
        keys, long = self.keys_of(pieces)
        numbers = np.full(len(pieces), -1, np.int64)
        if len(self.hashes):
            hashes = self.hashed(keys)
            order = np.argsort(hashes)
            near = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
            place = self.places[near]
            # A piece is known by all its bytes, the hash only says where to look.
            same = (self.keys[place] == keys[order]).all(axis=1) & ~long[order]
            numbers[order[same]] = self.numbers[place[same]]
        at = np.flatnonzero(long)
        for i, piece in zip(at.tolist(), pieces.take(pa.array(at)).to_pylist(), strict=True):
            numbers[i] = self.long.get(piece, -1)
        return numbers

    def add(self, pieces: pa.LargeStringArray, numbers: np.ndarray) -> None:
        """Note unknown, different pieces."""
        keys, long = self.keys_of(pieces)
        at = np.flatnonzero(long)
        self.long.update(zip(pieces.take(pa.array(at)).to_pylist(), numbers[at].tolist(), strict=True))
        self.add_short(keys[~long], numbers[~long])

    def add_short(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        hashes = self.hashed(keys)
        order = np.argsort(hashes)
        where = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, where, hashes[order])
        self.places = np.insert(self.places, where, len(self.keys) + order)
        self.keys, self.numbers = np.concatenate((self.keys, keys)), np.concatenate((self.numbers, numbers))

    def kept(self, renumbered: np.ndarray) -> Memo:
        """A memo of the pieces whose number has a new one, which is not negative, in `renumbered`."""
        memo, numbers = Memo(), renumbered[self.numbers]
        memo.add_short(self.keys[numbers >= 0], numbers[numbers >= 0])
        memo.long = {piece: int(renumbered[n]) for piece, n in self.long.items() if renumbered[n] >= 0}
        return memo


class Pieces:
    """`encode(texts)`: the ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.memo, self.store = Memo(), Store()
        # The empty piece, number 0, stays.
        self.memo.add(pa.array([""], pa.large_string()), self.store.add(*self.joined([b""])))

    @staticmethod
    def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [as_bytes(e.ids) for e in encoded]

    def encode(self, texts: list[str]) -> list[bytes]:
        array = pa.array(texts, pa.large_string())
        # Also where only a change of case makes a special token: cutting may change it.
        fits = np.ones(len(texts), bool)
        for special in self.special:
            fits &= ~pc.match_substring(array, special, ignore_case=True).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(texts)
        places = np.flatnonzero(fits)
        if len(places):
            pieces, ends = self.cut(array.take(pa.array(places)))
            for place, ids in zip(places.tolist(), self.encode_cut(pieces, ends), strict=True):
                out[place] = ids
        return [self.whole([text])[0] if ids is None else ids for text, ids in zip(texts, out, strict=True)]

    def folded(self, data: np.ndarray) -> np.ndarray:
        """Bytes of texts that give the same ids."""
        return data

    def cut(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The pieces of all texts, one after the other, and the places among them where texts begin and end."""
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
        data = self.folded(np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]])
        offsets = offsets - offsets[0]
        inner = np.unique(offsets)
        first, last = inner[:-1], inner[1:] - 1
        solid = data > SPACE
        after = np.append(solid[1:], False)
        after[last] = False
        before = np.insert(solid[:-1], 0, False) if len(data) else solid
        before[first] = False
        line_end = np.flatnonzero((data == LINE_END) & before & after)
        sign = np.flatnonzero(SIGNS[data] & before)
        word = data[sign - 1]
        sign = sign[ALNUM[word] | LATIN_TAILS[word] & (data[sign - 2] == LATIN)]
        begins = (data == SPACE) & after
        for at in (first, line_end, line_end + 1, sign):
            begins[at] = True
        starts = np.flatnonzero(begins)
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
        return pieces, np.searchsorted(starts, offsets)

    def encode_cut(self, pieces: pa.LargeStringArray, ends: np.ndarray) -> list[bytes | None]:
        """Ids of texts given as pieces and their ends; None where a new piece does not stand for itself."""
        numbered = pieces.dictionary_encode()
        at, distinct = numbered.indices.to_numpy(zero_copy_only=False), numbered.dictionary
        numbers = self.memo.find(distinct)
        kept = self.store.n
        new = np.flatnonzero(numbers < 0)
        fresh = distinct.take(pa.array(new)).to_pylist()
        odd = self.uncertain(fresh)
        if odd:
            fresh = [piece for i, piece in enumerate(fresh) if i not in odd]
            odd, new = new[sorted(odd)], np.delete(new, sorted(odd))
        if fresh:
            numbers[new] = self.encode_new(fresh)
        bad = np.zeros(len(ends) - 1, bool)
        if len(odd):
            text_of = np.repeat(np.arange(len(bad)), np.diff(ends))
            bad[text_of[np.isin(at, odd)]] = True
            numbers[odd] = 0  # the empty piece: these texts are encoded whole
        ids, sizes = self.store.get(numbers[at])
        total = np.concatenate(([0], np.cumsum(sizes)))[ends].tolist()
        data = ids.astype("<u4", copy=False).tobytes()
        self.store.meet(numbers)
        if fresh:
            self.remember(kept, distinct, new[np.fromiter(map(len, fresh), np.int64, len(fresh)) <= LONGEST], numbers)
        if self.store.n > MEMO:
            self.forget_half()
        return [None if b else data[4 * i : 4 * j] for b, i, j in zip(bad.tolist(), total[:-1], total[1:], strict=True)]

    def remember(self, kept: int, distinct: pa.LargeStringArray, stay: np.ndarray, numbers: np.ndarray) -> None:
        """Of the newest pieces (from number `kept` on), keep those at the places `stay` of `distinct`."""
        mine = numbers[stay]
        if len(stay) < self.store.n - kept:
            ids, sizes, met = *self.store.get(mine), self.store.met[mine]
            self.store.cut_back(kept)
            mine = self.store.add(ids, sizes)
            self.store.met[mine] = met
        self.memo.add(distinct.take(pa.array(stay)), mine)

    def forget_half(self) -> None:
        """Keep the pieces that most calls have met, and the empty one."""
        n, met = self.store.n, self.store.met[: self.store.n]
        stay = np.sort(np.concatenate(([0], 1 + np.argsort(-met[1:], kind="stable")[: MEMO // 2])))
        ids, sizes = self.store.get(stay)
        renumbered = np.full(n, -1, np.int64)
        self.store = Store()
        renumbered[stay] = self.store.add(ids, sizes)
        self.store.met[: len(stay)] = met[stay] // 2
        self.memo = self.memo.kept(renumbered)

    def encode_new(self, new: list[str]) -> np.ndarray:
        """Numbers of new pieces: those of a kind are encoded in one call, the others each for itself."""
        kinds, numbers = self.kinds(new), np.empty(len(new), np.int64)
        for kind in np.unique(kinds).tolist():
            at = np.flatnonzero(kinds == kind)
            pieces = [new[i] for i in at.tolist()]
            numbers[at] = self.store.add(*(self.encode_kind(kind, pieces) if kind else self.joined(self.whole(pieces))))
        return numbers

    def sizes_at(self, at: np.ndarray, n_ids: int, pieces: list[str]) -> np.ndarray:
        """How many ids each piece has, given where each begins."""
        if len(at) != len(pieces):
            raise ValueError("the tokenizer cuts pieces in another way than this class expects")
        return np.diff(np.append(at, n_ids)).astype(np.int64)


class BytePieces(Pieces):
    """Byte-level BPE: a space belongs to the word after it, and no id spans its front."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        # The byte-level alphabet writes a space as U+0120, a line end as U+010A.
        self.opens = [np.array([name.startswith(sign) for name in self.names]) for sign in "ĠĊ"]

    def uncertain(self, pieces: list[str]) -> set[int]:
        """Which of the new pieces begin with white space beyond ASCII, which the piece before may take."""
        first = (piece.lstrip(" ")[:1] for piece in pieces)
        return {i for i, sign in enumerate(first) if sign > "\x7f" and sign.isspace()}

    def kinds(self, pieces: list[str]) -> np.ndarray:
        """1: one space, in front; 2: no white space; 0: others."""
        return np.array([1 if p[0] == " " and p.count(" ") == 1 else 2 if p.split() == [p] else 0 for p in pieces])

    def encode_kind(self, kind: int, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(pieces) if kind == 1 else "\n" + "\n".join(pieces)
        ids = np.frombuffer(self.whole([text])[0], "<u4")
        opens = self.opens[kind - 1][ids]
        sizes = self.sizes_at(np.flatnonzero(opens), len(ids), pieces)
        # The line ends before pieces without white space are not theirs.
        return (ids, sizes) if kind == 1 else (ids[~opens], sizes - 1)


class WordPieces(Pieces):
    """BPE with word ends: white space and case are dropped, and each word ends in an id of its own kind."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.ends = np.array([name.endswith("</w>") for name in self.names])

    def folded(self, data: np.ndarray) -> np.ndarray:
        """ASCII capitals in lower case, but before what may be a mark that combines with one of the cases only."""
        capital = (data >= ord("A")) & (data <= ord("Z"))
        capital[:-1] &= (data[1:] < 0x80) | (data[1:] == LATIN)
        return np.where(capital, data | 0x20, data)

    def uncertain(self, pieces: list[str]) -> set[int]:
        return set()

    def kinds(self, pieces: list[str]) -> np.ndarray:
        """1: one word of letters; 0: others."""
        return pc.match_substring_regex(pa.array(pieces, pa.large_string()), LETTERS).to_numpy(zero_copy_only=False).astype(int)

    def encode_kind(self, kind: int, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(self.whole([" ".join(pieces)])[0], "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        return ids, self.sizes_at(np.concatenate(([0], ends[:-1])), len(ids), pieces)


@cache
def byte_pieces(path: str) -> BytePieces:
    return BytePieces(path)


@cache
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)


def encoded(rows: Iterable[tuple], encoder: Pieces, characters: int = CHARACTERS) -> Iterator[tuple]:
    """(doc_id, text) rows to (doc_id, ids), so many at a time that new pieces share a call.

    More `characters` at a time take more memory and less time, as fewer pieces are met again in later calls.
    """
    held, size = [], 0
    for doc_id, text in rows:
        held.append((doc_id, text or ""))
        size += len(held[-1][1])
        if size >= characters or len(held) >= TEXTS:
            yield from zip((doc_id for doc_id, _ in held), encoder.encode([text for _, text in held]), strict=True)
            held, size = [], 0
    if held:
        yield from zip((doc_id for doc_id, _ in held), encoder.encode([text for _, text in held]), strict=True)
