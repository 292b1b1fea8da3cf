"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is written with a mark for every space and one more in front, cut into symbols,
and merged by an agenda: all adjacent pairs that together are a piece, the highest
score first, the leftmost of equals; a merge puts the pairs with the new neighbours on
the agenda. Symbols that are no piece become their bytes.

Where no piece holds the mark after another character, no pair across such a place can
merge, so the parts between these places (words) have agendas of their own, and a word
that comes again is not merged again. New short words of a slice of texts are merged side
by side in numpy, each row an agenda whose best entry is taken; long ones have a heap.
Each Arrow batch is checked, as a whole, against the sentencepiece library.
"""

from __future__ import annotations

import codecs
import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm import bytewords as bw

MARK = "▁"
# Words whose ids a task remembers; beyond it, it starts anew.
REMEMBERED_WORDS = 500_000
# Symbols up to which words are merged side by side, and how many words at once.
SHORT = 48
SIDE_BY_SIDE = 8192
_NONE = np.iinfo(np.int32).max
# Stands for a control id; a lone surrogate, which no piece or byte is.
_BREAK = "\ud800"


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


class MergeVocabulary(dict):
    """Pieces and scores of a model, and the ids of the words met so far (the dict), as
    little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes):
        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, ids = self.library, range(self.library.vocab_size())
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.id_of = {lib.id_to_piece(i): i for i in plain}
        self.rank = {p: -lib.get_score(i) for p, i in self.id_of.items()}
        self._pairs()
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if lib.normalize(" a  ﬁ\t") != f"{MARK}{MARK}a{MARK}{MARK}ﬁ\t" or not all(map(lib.is_byte, self.byte_ids)):
            raise ValueError("the vocabulary must leave texts as they are, put a space in front, and fall back to bytes")
        apart = all(MARK not in p.lstrip(MARK) for p in self.id_of)
        # Words are known by what follows their first mark.
        self.apart = apart
        self.words = re.compile(f"{MARK}({MARK}*[^{MARK}]*)" if apart else "(?s).(.*)").findall
        # What an id says: bytes above 127 as lone surrogates, to be joined before they are decoded.
        said = {i: lib.id_to_piece(i).replace(MARK, " ") for i in plain}
        said |= {i: chr(b) if b < 128 else chr(0xDC00 + b) for b, i in enumerate(self.byte_ids)}
        said[lib.unk_id()] = " ⁇ "
        self.said = [said.get(i, _BREAK) for i in ids]

    def _symbol(self, text: str) -> int | None:
        """The number of a symbol: its id if it is a piece, and one of its own if it is
        another character."""
        return self.id_of.get(text, self.others + ord(text) if len(text) == 1 else None)

    def _pairs(self) -> None:
        """All pairs of symbols that are a piece, sorted: what they make and the rank of it."""
        self.others = self.library.vocab_size()
        self.base = self.others + 0x110001
        splits = []
        for piece, i in self.id_of.items():
            for k in range(1, len(piece)):
                a, b = self._symbol(piece[:k]), self._symbol(piece[k:])
                if a is not None and b is not None:
                    splits.append((a * self.base + b, i))
        keys, self.made = np.array(sorted(splits), np.int64).reshape(-1, 2).T
        self.pair_keys = np.append(keys, np.iinfo(np.int64).max)
        self.made = np.append(self.made, -1)
        score = np.array([self.rank[p] for p in self.id_of])
        rank = dict(zip(self.id_of.values(), np.unique(score, return_inverse=True)[1].tolist()))
        self.pair_rank = np.array([rank.get(i, _NONE) for i in self.made.tolist()], np.int32)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the pairs of symbols are among all pairs; the last place for those that are none."""
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, at, len(self.pair_keys) - 1)

    def side_by_side(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols all words end as, in one array, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        known, which = np.unique(points, return_inverse=True)
        number = np.array([self._symbol(chr(c)) for c in known.tolist()], np.int32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        n, width = len(words), int(length.max())
        # One column more than symbols, so that the last one has a right neighbour: none.
        symbols = np.full((n, width + 1), -1, np.int32)
        symbols[np.arange(width + 1) < length[:, None]] = number[which]
        left = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        right = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        right[:, -1] = width
        pair = np.full((n, width + 1), len(self.pair_keys) - 1)
        pair[:, :-1] = self._pair(symbols[:, :-1], symbols[:, 1:])
        agenda = self.pair_rank[pair]
        row = np.arange(n)
        while len(row):
            a = agenda[row].argmin(axis=1)
            some = agenda[row, a] < _NONE
            row, a = row[some], a[some]
            b = right[row, a]
            after = right[row, b]
            symbols[row, a] = self.made[pair[row, a]]
            symbols[row, b] = -1
            agenda[row, b] = _NONE
            right[row, a] = after
            left[row, after] = a
            pair[row, a] = self._pair(symbols[row, a], symbols[row, after])
            agenda[row, a] = self.pair_rank[pair[row, a]]
            inner = left[row, a] >= 0
            r, c, d = row[inner], left[row, a][inner], a[inner]
            pair[r, c] = self._pair(symbols[r, c], symbols[r, d])
            agenda[r, c] = self.pair_rank[pair[r, c]]
        live = symbols >= 0
        return symbols[live], live.sum(axis=1)

    def _packed(self, symbols: list[int]) -> bytes:
        """Ids of symbols; characters that are no piece become their bytes."""
        ids = (i for s in symbols for i in ([s] if s < self.others else [self.byte_ids[b] for b in chr(s - self.others).encode()]))
        return np.fromiter(ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Merge the words that are not known yet. Words are given without their first mark."""
        new = [w for w in words - self.keys() if len(w) < SHORT]
        new.sort(key=len)
        for at in range(0, len(new), SIDE_BY_SIDE):
            part = new[at:at + SIDE_BY_SIDE]
            symbols, count = self.side_by_side([MARK + w for w in part])
            end = np.cumsum(count)
            packed, stops = symbols.astype("<u4").tobytes(), (4 * end).tolist()
            self.update(zip(part, (packed[a:b] for a, b in zip([0, *stops], stops))))
            for k in np.flatnonzero(np.add.reduceat(symbols >= self.others, end - count)):
                self[part[k]] = self._packed(symbols[end[k] - count[k]:end[k]].tolist())

    def __missing__(self, rest: str) -> bytes:
        return self._packed([self._symbol(s) for s in self.by_heap(MARK + rest)])

    def by_heap(self, word: str) -> list[str]:
        """The symbols a word ends as, by a heap of (score, place) over linked symbols."""
        symbols: list[str | None] = list(word)
        last = len(symbols) - 1
        left, right = list(range(-1, last)), list(range(1, last + 2))
        rank, agenda = self.rank, []

        def note(a, b):
            if a >= 0 and b <= last:
                pair = symbols[a] + symbols[b]
                if pair in rank:
                    heapq.heappush(agenda, (rank[pair], a, b, pair))

        for a in range(last):
            note(a, a + 1)
        while agenda:
            _, a, b, pair = heapq.heappop(agenda)
            # One of the two may have gone into another piece since.
            if symbols[a] is None or symbols[b] is None or right[a] != b or symbols[a] + symbols[b] != pair:
                continue
            symbols[a], symbols[b] = pair, None
            right[a] = right[b]
            if right[a] <= last:
                left[right[a]] = a
            note(left[a], a)
            note(a, right[a])
        return [s for s in symbols if s is not None]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts, without begin and end, packed as the dict holds them."""
        split = [self._words(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        out = [b"".join(map(self.__getitem__, words)) for words in split]
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        return out

    def _words(self, text: str) -> list[str]:
        plain = self.apart and text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text
        return text.split(" ") if plain else self.words(MARK + text.replace(" ", MARK))

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Control ids say nothing, bytes between two of them that are no
        UTF-8 become U+FFFD one by one, and the space put in front is taken away."""
        parts = "".join(map(self.said.__getitem__, ids)).split(_BREAK)
        text = "".join(p if p.isascii() else p.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte") for p in parts)
        first = next((i for i in ids if self.said[i] != _BREAK), None)
        return text[1:] if first is not None and self.library.id_to_piece(first).startswith(MARK) else text


@lru_cache(maxsize=1)
def vocabulary_of(model: bytes) -> MergeVocabulary:
    """One vocabulary a Python worker, with the words it has met."""
    codecs.register_error("each_byte", _each_byte)
    return MergeVocabulary(model)


def encode_texts(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded, agrees``: a row per document row.

    ``ids`` are the ids of the whole text with begin and end, as little-endian unsigned
    32-bit integers (the form of token files); ``decoded`` is what they say again;
    ``agrees`` tells whether the sentencepiece library gives the same ids and text. A null
    text is an empty one: begin and end only. Null and repeated ids are kept row by
    row; an empty table gives no rows; other columns are not read. ``model`` is the
    content of a model file and must be of the merge type.
    """

    def code(batches):
        vocabulary = vocabulary_of(model)
        lib = vocabulary.library
        begin, end = (np.array([i], "<u4").tobytes() for i in (lib.bos_id(), lib.eos_id()))
        for batch in batches:
            for a, b in bw.slices(np.diff(bw.text_bytes(batch.column("text"))[1])):
                texts = [t or "" for t in batch.column("text").slice(a, b - a).to_pylist()]
                ids = [begin + i + end for i in vocabulary.encode(texts)]
                decoded = [vocabulary.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
                wanted = lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)
                said = lib.decode(wanted, num_threads=1)
                agrees = [x == array("I", y).tobytes() and s == t for x, y, s, t in zip(ids, wanted, decoded, said)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_()),
                ], ["doc_id", "n_tokens", "ids", "decoded", "agrees"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(code, "doc_id bigint, n_tokens bigint, ids binary, decoded string, agrees boolean")


def piece_report(docs: DataFrame, model_file: str) -> DataFrame:
    """``encode_texts`` with digests for ids and texts; the model file is read here, by the driver."""
    with open(model_file, "rb") as file:
        coded = encode_texts(docs, file.read())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees"
    )
