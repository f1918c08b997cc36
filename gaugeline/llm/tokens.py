"""Encoding whole texts with the ``tokenizers`` library, each distinct word once.

A pre-tokenizer that splits on words never joins a space to the non-space
character before it, so a text may be cut there and its pieces encoded alone:
the ids are those of the whole text. Arrow cuts the texts and finds the distinct pieces of
a run of texts; only those that the memory lacks meet the tokenizer.

The memory is three flat arrays (the pieces, their ids, and where these start). Beyond
``limit`` bytes it keeps the newer half, which changes no result. A worker process keeps it
for its next task. Arrow hashes the whole memory for every run of texts, so runs should be
long.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of remembered pieces and ids of one worker process.
MEMORY = 48_000_000
#: New pieces given to the tokenizer at once, and those of them that are joined to one text.
TOGETHER, JOINED = 12_800, 256

#: White space other than a space, or a space, and then a space.
_SPACE_AFTER_SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}] "
_CUT = re.compile(r"(?<=\S) ")
#: A space and a word: pieces that may stand side by side in one text. The one letter that
#: lower case turns into a letter and a mark is left out.
_JOINABLE = r"^ [\p{L}]+$"
#: ASCII punctuation; behind a letter it begins a token of its own.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class PieceEncoder:
    """Ids of texts by one tokenizer file."""

    def __init__(self, path: str, limit: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.begins, self.bounds = _bounds(self.tokenizer)
        self.limit = limit
        self.pieces = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the number of ids of each; null texts
        are empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _SPACE_AFTER_SPACE).to_numpy(zero_copy_only=False)
        if odd.any():
            lists = pa.array([_CUT.split(t.as_py()) if o else t.as_py().split(" ") for t, o in zip(texts, odd)],
                             pa.list_(pa.string()))
        else:
            lists = pc.split_pattern(texts, " ")
        flat = lists.flatten()
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        stops = np.concatenate([[0], np.cumsum(counts)])
        if not len(flat):
            return np.zeros(0, np.uint32), counts
        # All but the first piece of a text have a space before them.
        first = np.zeros(len(flat), bool)
        first[stops[:-1]] = True
        coded = pc.replace_with_mask(pc.binary_join_element_wise("", flat, " "), pa.array(first),
                                     flat.take(pa.array(stops[:-1]))).dictionary_encode()
        slots = self._known(coded.dictionary)[coded.indices.to_numpy()]
        ids, lengths = self._gather(slots)
        before = np.concatenate([[0], np.cumsum(lengths)])
        self._forget()
        return ids, np.diff(before[stops])

    def _known(self, pieces: pa.Array) -> np.ndarray:
        """Places in the memory of distinct pieces, after what was unknown has been learned."""
        parts, words, tails = _parted(pieces)
        # The pieces come first, in their order; the memory is searched once for all.
        wanted = pc.unique(pa.concat_arrays([pieces, words, tails]))
        place = _places(wanted, self.pieces)
        parted = np.zeros(len(wanted), bool)
        parted[:len(pieces)] = parts.to_numpy(zero_copy_only=False)
        new = np.flatnonzero((place < 0) & ~parted)
        joinable = _joinable(wanted.take(pa.array(new))) & (self.bounds is not None)
        new, n_joinable = np.concatenate([new[joinable], new[~joinable]]), int(joinable.sum())
        place[new] = np.arange(len(new)) + len(self.pieces)
        unknown = wanted.take(pa.array(new))
        self._encode_joined(unknown.slice(0, n_joinable))
        self._encode(unknown.slice(n_joinable))
        joined = np.flatnonzero((place < 0) & parted)
        if joined.size:
            fresh = place[:len(pieces)][parted[:len(pieces)]] < 0
            both = place[_places(pa.concat_arrays([words.filter(pa.array(fresh)), tails.filter(pa.array(fresh))]),
                                 wanted)].reshape(2, -1).T
            ids, lengths = self._gather(both.ravel())
            place[joined] = np.arange(len(joined)) + len(self.pieces)
            self._store(wanted.take(pa.array(joined)), ids, lengths.reshape(-1, 2).sum(1))
        return place[:len(pieces)]

    def _encode_joined(self, pieces: pa.Array) -> None:
        """Learns joinable pieces. Many make one text, whose ids are cut where words begin or
        end: the library takes longer for every text than for a word."""
        for start in range(0, len(pieces), TOGETHER):
            some = pieces.slice(start, TOGETHER)
            words = some.to_pylist()
            groups = [words[n:n + JOINED] for n in range(0, len(words), JOINED)]
            codes = self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
            ids, lengths = [], []
            for group, code in zip(groups, codes):
                found = np.array(code.ids, np.uint32)
                cuts = np.flatnonzero(self.bounds[found])
                if len(cuts) == len(group):
                    sizes = np.diff(np.append(cuts, len(found)) if self.begins else np.append(-1, cuts))
                else:  # the library sees several words in a piece
                    found, sizes = self._alone(group)
                ids.append(found)
                lengths.append(sizes)
            self._store(some, np.concatenate(ids), np.concatenate(lengths))

    def _encode(self, pieces: pa.Array) -> None:
        for start in range(0, len(pieces), TOGETHER):
            some = pieces.slice(start, TOGETHER)
            self._store(some, *self._alone(some.to_pylist()))

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.ends[slots + 1] - self.ends[slots]
        stops = np.cumsum(lengths)
        places = np.arange(int(stops[-1]) if stops.size else 0)
        places += np.repeat(self.ends[slots] - (stops - lengths), lengths)
        return self.ids[places], lengths

    def _store(self, pieces: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def _forget(self) -> None:
        if self.pieces.nbytes + self.ids.nbytes + self.ends.nbytes > self.limit:
            half = len(self.pieces) // 2
            self.pieces = pa.concat_arrays([self.pieces.slice(half)])
            self.ids, self.ends = self.ids[self.ends[half]:].copy(), self.ends[half:] - self.ends[half]


def _joinable(pieces: pa.Array) -> np.ndarray:
    letters = pc.match_substring_regex(pieces, _JOINABLE)
    return pc.and_not(letters, pc.match_substring(pieces, "\u0130")).to_numpy(zero_copy_only=False)


def _bounds(tokenizer) -> tuple[bool, np.ndarray | None]:
    """Whether words are told apart by the tokens they begin with (a space) or end with (a
    suffix), and which ids these are; none if a byte has no token, which would then be lost."""
    from tokenizers.pre_tokenizers import ByteLevel

    vocab = tokenizer.get_vocab(with_added_tokens=False)
    letters, space = ByteLevel.alphabet(), "\u0120"
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not all(c in vocab and c + (suffix or "") in vocab for c in letters):
        return False, None
    bounds = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    bounds[[n for word, n in vocab.items() if (word.endswith(suffix) if suffix else word.startswith(space))]] = True
    return not suffix, bounds


def _places(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Where values are found among others, -1 for those that are not."""
    return pc.fill_null(pc.index_in(values, among), -1).to_numpy().astype(np.int64)


def _parted(pieces: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Which pieces are words that end in a letter and have punctuation behind; the words and
    the punctuation. The one letter that lower case turns into a letter and a mark is left out."""
    words = pc.utf8_rtrim(pieces, _MARKS)
    last = pc.utf8_slice_codeunits(words, -1, None)
    parts = pc.and_(pc.not_equal(words, pieces), pc.and_(pc.utf8_is_alpha(last), pc.not_equal(last, "\u0130")))
    words, whole = words.filter(parts), pieces.filter(parts)
    ends = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1].astype(np.int64)
    sizes = ends[1:] - ends[:-1] - pc.binary_length(words).to_numpy()
    stops = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(stops[-1]) + np.repeat(ends[1:] - stops[1:], sizes)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[places]
    tails = pa.Array.from_buffers(pa.string(), len(whole), [None, pa.py_buffer(stops.astype(np.int32)),
                                                             pa.py_buffer(data)])
    return parts, words, tails


@lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    """The encoder that this worker process keeps for a tokenizer file."""
    return PieceEncoder(path)


def runs(texts: pa.Array, limit: int):
    """Places of first and last + 1 of consecutive texts of together about ``limit`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = min(len(texts), int(np.searchsorted(ends, done + limit, "right")) + 1)
        yield start, stop
        start = stop
