"""SentencePiece encoding and decoding by streaming Viterbi over the model's pieces.

The lattice holds, for every position, the last piece of the best segmentation of the text so far. Two
objectives are offered: ``merge``, where a piece may follow another only if merging would leave the pair as
it is (this gives the ids of a BPE model, whose scores are merge ranks), and ``score``, the largest sum
of scores (a unigram model). Only the last ``max_piece`` positions can be reached by a later piece, so the
encoder follows their backpointers and commits all ids up to the boundary on which they converge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
STRIDE = 64  # positions between looks for a common boundary
CACHED = 100_000  # entries of each memo, about 40 MB a worker with the older ones; a full one gives way, its recent entries return
PAIR_BITS = 21
LETTERS = 192  # columns of the trie
MEMO_CHARS = 48  # longer stretches are not remembered


class Pieces:
    """A model's pieces, and the encoder and decoder over them."""

    def __init__(self, model: bytes, objective: str = "merge"):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(lib.get_piece_size())
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.id_of = {lib.id_to_piece(i): i for i in plain}
        self.score_of = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.unknown = lib.unk_id()
        self.byte_id = {b: i for b in range(256) for i in [lib.piece_to_id(f"<0x{b:02X}>")] if lib.is_byte(i)}
        self.max_piece = max(map(len, self.id_of), default=1)
        # Every beginning of a piece: its id, or -1 where it is no piece itself.
        self.table = {p[:n]: -1 for p in self.id_of for n in range(1, len(p))} | self.id_of
        self.worst = min(self.score_of.values(), default=0.0) - 10.0
        self.objective = objective
        byte_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        special = {i for i in ids if lib.is_control(i) or lib.is_unused(i)}
        self.bytes_of = [
            byte_of[i] if i in byte_of
            else b"" if i in special
            else " ⁇ ".encode() if i == self.unknown
            else lib.id_to_piece(i).replace(SPACE, " ").encode()
            for i in ids
        ]
        self.piece_of = {i: p for p, i in self.id_of.items()}
        self.trie: _Trie | None = None
        self.pair_key = np.zeros(2**PAIR_BITS, np.int64)
        self.pair_fits = np.zeros(2**PAIR_BITS, bool)
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.memo = _Memo(self)
        # A stretch ends before a space that follows another character, if no piece reaches over that place,
        # and at a line break, if no piece holds one.
        reaches = any(SPACE in p.lstrip(SPACE) for p in self.id_of)
        breaks = not any("\n" in p for p in self.id_of)
        self.words_alone = not reaches and breaks
        self.stretch = None if reaches else re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if breaks else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves, best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score_of.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends in just these two. Holds for a text if it holds for all neighbours."""
        followers = self.pairs.setdefault(left, {})
        found = followers.get(right)
        if found is None:
            if self.n_pairs >= CACHED:
                for others in self.pairs.values():
                    others.clear()
                self.n_pairs = 0
            self.n_pairs += 1
            found = followers[right] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def _step(self, text: str, end_of: list[tuple[int, str, float] | None], begin: int, base: int) -> None:
        """Enter all pieces that begin at ``begin``. ``end_of[e - base]``: (begin, piece, score) of the best path to e."""
        here = end_of[begin - base]
        if here is None:
            return
        _, left, score = here
        for end in range(begin + 1, min(len(text), begin + self.max_piece) + 1):
            piece = text[begin:end]
            number = self.table.get(piece)
            if number is not None and number >= 0 or end == begin + 1:
                if self.objective == "merge":
                    if end_of[end - base] is None and self.may_follow(left, piece):
                        end_of[end - base] = (begin, piece, 0.0)
                else:
                    total = score + self.score_of.get(piece, self.worst)
                    other = end_of[end - base]
                    if other is None or total > other[2]:
                        end_of[end - base] = (begin, piece, total)
            if number is None:
                break

    def _lattices(self, stretches: list[str]) -> list[bytes]:
        """Ids of many short stretches at once, as int32 bytes: the same lattice, one column of all at a time.

        A short stretch lies within the window, so all its paths converge at its end.
        """
        if self.trie is None:
            self.trie = _Trie(self.id_of)
        trie = self.trie
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        letters = trie.letters(stretches, sizes)
        hard = (letters < 0).any(axis=1)
        letters[letters < 0] = trie.dead
        last = np.full((len(stretches), letters.shape[1] + 1), -2, np.int32)  # -2: not reached, -1: the start
        last[:, 0] = -1
        for begin in range(letters.shape[1]):
            rows = np.flatnonzero((last[:, begin] != -2) & (sizes > begin))
            state = np.zeros(len(rows), np.int32)
            for end in range(begin + 1, min(letters.shape[1], begin + self.max_piece) + 1):
                state = trie.next[state, letters[rows, end - 1]]
                alive = state >= 0
                if end == begin + 1:
                    hard[rows[~alive | (trie.piece[state] < 0)]] = True
                rows, state = rows[alive], state[alive]
                if not len(rows):
                    break
                number = trie.piece[state]
                tried = np.flatnonzero((number >= 0) & (last[rows, end] == -2))
                at = rows[tried]
                fits = self._fit(last[at, begin], number[tried])
                last[at[fits], end] = number[tried[fits]]
        path, at, rows = [], sizes.copy(), np.arange(len(stretches))
        hard |= last[rows, sizes] < 0
        at[hard] = 0
        while (at > 0).any():
            number = np.where(at > 0, last[rows, at], -1)
            path.append(number)
            at -= np.where(number >= 0, trie.length[number], 0)
        steps = np.stack(path[::-1], axis=1).astype(np.int32) if path else np.empty((len(stretches), 0), np.int32)
        count = (steps >= 0).sum(axis=1)
        return [
            np.array(self.ids(text), np.int32).tobytes() if slow else row[len(row) - n :].tobytes()
            for text, slow, row, n in zip(stretches, hard, steps, count, strict=True)
        ]

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``may_follow`` of ids, remembered in a table of fixed size in which later pairs displace earlier ones."""
        key = (left.astype(np.int64) + 1) * len(self.bytes_of) + right + 1
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.pair_fits[slot]
        new = self.pair_key[slot] != key
        if new.any():
            keys = np.unique(key[new])
            found = np.array([self._may_follow_ids(*divmod(int(k) - 1, len(self.bytes_of))) for k in keys])
            fits[new] = found[np.searchsorted(keys, key[new])]
            self.pair_key[slot[new]] = key[new]
            self.pair_fits[slot[new]] = fits[new]
        return fits

    def _may_follow_ids(self, left: int, right: int) -> bool:
        pair = [self.piece_of[i] for i in (left - 1, right) if i >= 0]
        return self.merged("".join(pair)) == pair

    def segments(self, text: str) -> Iterator[str]:
        """The pieces of a text, as soon as they are certain."""
        base = begin = 0
        end_of: list[tuple[int, str, float] | None] = [(0, "", 0.0)] + [None] * min(len(text), self.max_piece + STRIDE)
        while begin < len(text):
            need = min(len(text), begin + self.max_piece) - base + 1
            end_of.extend([None] * (need - len(end_of)))
            self._step(text, end_of, begin, base)
            begin += 1
            if begin == len(text) or begin % STRIDE == 0:
                # Every later path passes through one of these ends; follow them back until one is left.
                live = {e for e in range(begin, min(len(text), begin + self.max_piece - 1) + 1) if end_of[e - base] is not None}
                if begin == len(text):
                    live = {begin}
                while len(live) > 1 and max(live) > base:
                    last = max(live)
                    live.remove(last)
                    live.add(end_of[last - base][0])
                common = live.pop()
                if common > base:
                    path, at = [], common
                    while at > base:
                        at, piece, _ = end_of[at - base]
                        path.append(piece)
                    yield from reversed(path)
                    end_of = end_of[common - base :]
                    _, left, score = end_of[0]
                    end_of[0] = (common, left, score)
                    base = common

    def ids(self, text: str) -> list[int]:
        """The ids of a stretch whose spaces are already marked; unknown characters become bytes."""
        out: list[int] = []
        for piece in self.segments(text):
            known = self.id_of.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return out

    def stretches(self, text: str | None) -> list[str] | None:
        """The parts between places that every path passes; None if the model has no such places."""
        if not text:
            return []
        if self.stretch is None:
            return None
        if self.words_alone and "  " not in text and SPACE not in text and text[0] != " ":
            # The usual case: a word with its space, or the first word after a line break.
            first, *lines = text.split("\n")
            out = (SPACE + first.replace(" ", " " + SPACE)).split(" ")
            for line in lines:
                out.append("\n")
                out.extend((line.replace(" ", " " + SPACE)).split(" ") if line else ())
            return [s for s in out if s]
        return self.stretch.findall(SPACE + text.replace(" ", SPACE))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null or empty text has none."""
        parts = [self.stretches(text) for text in texts]
        if self.objective == "merge":
            wanted = {s for part in parts if part for s in part}
            new = [s for s in wanted.difference(self.memo) if len(s) <= MEMO_CHARS and self.memo.again(s)]
            new.sort(key=len)
            for first in range(0, len(new), 4096):
                some = new[first : first + 4096]
                self.memo.update(zip(some, self._lattices(some), strict=True))
        out = [
            np.array(self.ids(SPACE + text.replace(" ", SPACE)), np.int32) if part is None
            else np.frombuffer(b"".join(map(self.memo.__getitem__, part)), np.int32)
            for part, text in zip(parts, texts, strict=True)
        ]
        self.memo.age()
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD. Begins after the space that encoding adds."""
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Trie:
    """The pieces as a table of states and letters; letters outside the most frequent ones have no column."""

    def __init__(self, id_of: dict[str, int]):
        often: dict[str, int] = {}
        for piece in id_of:
            for letter in piece:
                often[letter] = often.get(letter, 0) + 1
        chosen = sorted((c for c in often if ord(c) < 65536), key=lambda c: (-often[c], c))[:LETTERS]
        self.dead = len(chosen)
        self.letter = np.full(65536, -1, np.int16)
        self.letter[[ord(c) for c in chosen]] = np.arange(len(chosen))
        column = {c: i for i, c in enumerate(chosen)}
        inside = {p: i for p, i in id_of.items() if all(c in column for c in p)}
        states = {p: n for n, p in enumerate(sorted({p[:k] for p in inside for k in range(len(p) + 1)} | {""}, key=len))}
        self.next = np.full((len(states), len(chosen) + 1), -1, np.int32)
        self.piece = np.full(len(states), -1, np.int32)
        for prefix, state in states.items():
            if prefix:
                self.next[states[prefix[:-1]], column[prefix[-1]]] = state
            self.piece[state] = inside.get(prefix, -1)
        self.length = np.zeros(max(id_of.values(), default=0) + 1, np.int64)
        for piece, number in id_of.items():
            self.length[number] = len(piece)

    def letters(self, stretches: list[str], sizes: np.ndarray) -> np.ndarray:
        codes = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat = np.where(codes < 65536, self.letter[np.minimum(codes, 65535)], -1)
        out = np.full((len(sizes), int(sizes.max(initial=0))), self.dead, np.int16)
        out[np.arange(out.shape[1]) < sizes[:, None]] = flat
        return out


class _Memo(dict):
    """The ids of stretches between places where all paths converge, as int32 bytes; recent ones are kept."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.older = pieces, {}

    def __missing__(self, stretch: str) -> bytes:
        return np.array(self.pieces.ids(stretch), np.int32).tobytes()

    def again(self, stretch: str) -> bool:
        """Take a stretch over from the older entries; whether it is new."""
        ids = self.older.get(stretch)
        if ids is not None:
            self[stretch] = ids
        return ids is None

    def age(self) -> None:
        if len(self) > CACHED:
            self.older = dict(self)
            self.clear()


_LOADED: dict[tuple[int, str], Pieces] = {}


def _pieces(model: bytes, objective: str) -> Pieces:
    """One decoder per worker process; it needs no trie and no memo."""
    key = (hash(model), objective)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(model, objective)
    return _LOADED[key]


def encode_documents(docs: DataFrame, model_path: str = MODEL, objective: str = "merge") -> DataFrame:
    """One row per document: doc_id, n_ids, ids, decoded_equal.

    ``ids`` are those of the SentencePiece library for the model. ``decoded_equal`` tells whether decoding
    them gives the text back (not so for texts that hold the mark U+2581 itself, which stands for a space).
    A null or empty text has no ids. Ties, repeated rows and null ids are ordinary rows. Only doc_id and text
    are read. The driver reads the model, so executors need no file.
    """
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # half a megabyte: the vocabulary file

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of this task alone: workers outlive a stage, and 100 MB in each would stay.
        pieces = Pieces(shared.value, objective)
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = part.column("text").to_pylist()
                ids = pieces.encode_all(texts)
                equal = [pieces.decode(i) == (text or "") for i, text in zip(ids, texts, strict=True)]
                lengths = np.array([len(i) for i in ids], np.int32)
                offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_ids": pa.array(lengths),
                        "ids": pa.ListArray.from_arrays(pa.array(offsets), flat),
                        "decoded_equal": pa.array(equal, pa.bool_()),
                    }
                )

    texts = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return texts.mapInArrow(encode, "doc_id long, n_ids int, ids array<int>, decoded_equal boolean")


def decode_documents(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """One row per row of ``encoded``: doc_id, text. ``ids`` may be integers of any width.

    Null or empty ids give an empty text. A null among the ids, or a number that the model does not have, is an
    error that names the document: there is no text that it stands for. Repeated rows and null doc_ids are ordinary rows;
    only doc_id and ids are read. Decoding what ``encode_documents`` made gives the text back wherever it says so.
    """
    with open(model_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value, "merge")
        known = len(pieces.bytes_of)
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = []
                for doc_id, ids in zip(part.column("doc_id"), part.column("ids"), strict=True):
                    own = ids.values if ids.is_valid else pa.array([], pa.int64())
                    numbers = own.fill_null(-1).to_numpy()
                    if ((numbers < 0) | (numbers >= known)).any():
                        raise ValueError(f"document {doc_id.as_py()}: an id that is not one of the model's {known}")
                    texts.append(pieces.decode(numbers))
                yield pa.record_batch({"doc_id": part.column("doc_id"), "text": pa.array(texts, pa.string())})

    ids = encoded.selectExpr("cast(doc_id as bigint) doc_id", "cast(ids as array<bigint>) ids")
    return ids.mapInArrow(decode, "doc_id long, text string")
