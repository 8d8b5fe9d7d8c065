"""Byte-level BPE in linear time by backtracking over longest matches.

A token sequence is what the merges give exactly when every two neighbours are
compatible: merging the bytes of both gives just these two tokens. So a word is
encoded left to right, taking the longest token that starts at a position and is
compatible with the one before; where none is left, the last token is given up for its
next shorter prefix and the position is closed for good. Every position is closed at most
once, which bounds the work by the word's length. Compatibility of two tokens is
found by undoing their merges, latest first; remembered is what of a token fits after
another. This needs a vocabulary whose every token is the merge of two earlier ones, as
training gives; others are refused.

Texts are encoded many at a time: each distinct unit of them is looked up or encoded once.

Longest matches come from an Aho-Corasick automaton, whose keys are texts: bytes are
mapped to Latin-1 for it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelsight.llm.common import released, sliced

RANKS = "byte_bpe_50k.tiktoken"
#: Words whose ids a Python worker remembers.
MEMO = 250_000
#: Rows and bytes of the texts that are encoded at once; a longer text is taken alone.
ROWS_AT_ONCE, BYTES_AT_ONCE = 4_096, 1 << 20
_NEVER = 1 << 62


class Memo:
    """Remembered values by text, in two generations: when the young one is full it becomes the old
    one, and what is still asked for there moves up. So frequent texts stay, and at most `size` are held.

    A text is entered when it is met a second time, as most rare ones never are; whether it
    was met is known from one bit per hash, which may take a new text for a known one."""

    BITS = 1 << 21

    def __init__(self, size: int):
        self.half = max(1, size // 2)
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.met, self.n_met = bytearray(self.BITS), 0

    def aged(self, text: str) -> tuple[int, ...] | None:
        """The value of a text that the young generation does not have."""
        found = self.old.get(text)
        if found is not None:
            self._enter(text, found)
        return found

    def offer(self, text: str, value: tuple[int, ...]) -> None:
        at = hash(text) & (self.BITS - 1)
        if self.met[at]:
            self._enter(text, value)
            return
        if self.n_met >= self.BITS // 4:
            self.met, self.n_met = bytearray(self.BITS), 0
        self.met[at] = 1
        self.n_met += 1

    def _enter(self, text: str, value: tuple[int, ...]) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[text] = value


class Codec:
    """Encoder and decoder for the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, memo: int = MEMO):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.decoded = Pieces(self.bytes)
        self.decimals = Pieces({rank: b"%d " % rank for rank in self.bytes})
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.by_text = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.most = max(map(len, ranks))
        self.patterns = regex.compile(pattern)
        self.parts: dict[int, tuple[int, ...]] = {}
        self.shorter: dict[int, int] = {}
        self.fits: dict[tuple[int, int], int] = {}
        self.units, self.words = Memo(memo), Memo(memo)
        self.memo = memo
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.by_text.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()

    def forget(self) -> None:
        """Let go of all texts and pairs that were remembered."""
        self.units.forget()
        self.words.forget()
        self.fits.clear()

    def _parts(self, token: int) -> tuple[int, ...]:
        """The two tokens whose merge gives this one, or the byte itself for a byte."""
        found = self.parts.get(token)
        if found is None:
            found = self.parts[token] = tuple(merge(self.bytes[token], self.ranks, below=token))
            if len(found) > 2:
                raise ValueError(f"token {token} is no merge of two earlier ones")
        return found

    def _prefix(self, token: int) -> int:
        """The longest token that is a shorter prefix of this one; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            whole = self.bytes[token]
            ranks = (self.ranks.get(whole[:n], -1) for n in range(len(whole) - 1, 0, -1))
            found = self.shorter[token] = next((rank for rank in ranks if rank >= 0), -1)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Merging the bytes of both gives these two. left is -1 at the start of a word."""
        self._parts(right)
        return left < 0 or self._compatible(left, right)

    def _fit(self, left: int, token: int) -> int:
        """The longest prefix of a token, itself included, that is compatible with the one
        before; -1 if there is none."""
        if len(self.fits) >= 2 * self.memo:
            self.fits.clear()
        fit = token
        while fit >= 0 and not self.compatible(left, fit):
            fit = self._prefix(fit)
        self.fits[left, token] = fit
        return fit

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the merges of both sides, latest first; no state may offer an earlier merge across."""
        until = _NEVER
        while True:
            across = self.ranks.get(self.bytes[left] + self.bytes[right])
            if across is not None and across < until:
                return False
            of_left, of_right = self._parts(left), self._parts(right)
            if len(of_left) == len(of_right) == 1:
                return True
            if len(of_right) == 1 or (len(of_left) == 2 and left > right):
                until, left = left, of_left[1]
            else:
                # A merge across lies further left than this one, so it wins a tie.
                until, right = right + 1, of_right[0]

    def encode_word(self, word: str) -> list[int]:
        latin = word if word.isascii() else word.encode().decode("latin-1")
        whole = self.by_text.get(latin)
        if whole is not None:
            return [whole]
        size, fits, longest = self.size, self.fits, self.automaton.iter_long
        ids: list[int] = []
        last, at = -1, 0
        for _, token in longest(latin):  # mostly the longest matches do
            fit = fits.get((last, token))
            if fit is None:
                fit = self._fit(last, token)
            if fit != token:
                break
            ids.append(token)
            last, at = token, at + size[token]
        else:
            return ids
        closed: set[int] = set()
        while True:  # fit is the longest token that is left to try at this position
            if fit < 0:
                closed.add(at)
                token = ids.pop()
                at -= size[token]
                last = ids[-1] if ids else -1
                token = self._prefix(token)
            elif at + size[fit] in closed:
                token = self._prefix(fit)
            else:
                ids.append(fit)
                last, at = fit, at + size[fit]
                if at == len(latin):
                    return ids
                _, token = next(longest(latin[at : at + self.most]))
            if token < 0:
                fit = -1
                continue
            fit = fits.get((last, token))
            if fit is None:
                fit = self._fit(last, token)

    def _encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of words, each distinct one looked up or encoded once."""
        memo, made = self.words, dict.fromkeys(words, ())
        for word in made:
            ids = memo.young.get(word) or memo.aged(word)
            if ids is None:
                ids = tuple(self.encode_word(word))
                if len(word) < 64:
                    memo.offer(word, ids)
            made[word] = ids
        return list(map(made.__getitem__, words))

    def _encode_texts(self, texts: list[str]) -> list[tuple[int, ...]]:
        words = list(map(self.patterns.findall, texts))
        ids = iter(self._encode_words(list(chain.from_iterable(words))))
        return [tuple(chain.from_iterable(islice(ids, len(own)))) for own in words]

    def _encode_units(self, units: list[str]) -> list[tuple[int, ...]]:
        """Ids of units, none of them empty or with white space first, each after a blank.
        No blank is in a unit, so a word with a blank starts the next one."""
        words = self.patterns.findall(" " + " ".join(units)) if units else []
        ids = self._encode_words(words)
        starts = [i for i, word in enumerate(words) if word[0] == " "]
        runs = pairwise([*starts, len(words)])
        return [ids[a] if b - a == 1 else tuple(chain.from_iterable(ids[a:b])) for a, b in runs]

    def _encode_known(self, units: list[str]) -> list[tuple[int, ...]]:
        """The same for distinct units, whose ids are remembered."""
        memo = self.units
        found = list(map(memo.young.get, units))
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = memo.aged(units[i])
                if found[i] is None:
                    missing.append(i)
        for i, ids in zip(missing, self._encode_units([units[i] for i in missing]), strict=True):
            found[i] = ids
            if len(units[i]) < 64:
                memo.offer(units[i], ids)
        return found

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin, with the end of all;
        a null counts as empty.

        A blank before a visible sign always starts a word of the pattern, so texts fall there
        into units. A text's first unit has no blank before it, and texts with runs of
        blanks are encoded apart."""
        texts = texts.fill_null("")
        lists = pc.split_pattern(texts, " ")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        firsts = np.concatenate([[0], ends])[:-1]
        coded = lists.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        units = coded.dictionary.to_pylist()

        inner = np.ones(len(numbers), bool)
        inner[firsts] = False
        asked = np.bincount(numbers[inner], minlength=len(units)) > 0
        odd = np.array([not unit or unit[0].isspace() for unit in units], bool)
        plain = np.flatnonzero(asked & ~odd).tolist()
        pieces: list[tuple[int, ...]] = [()] * len(units)
        for i, ids in zip(plain, self._encode_known([units[i] for i in plain]), strict=True):
            pieces[i] = ids

        own = [units[i] for i in numbers[firsts].tolist()]
        if (asked & odd).any():
            apart = np.searchsorted(ends, np.flatnonzero(inner & odd[numbers]), side="right")
            for n in np.unique(apart).tolist():
                own[n] = texts[n].as_py()
                numbers[firsts[n] : ends[n]] = len(units) + len(own)
        numbers[firsts] = len(units) + np.arange(len(own))
        pieces += [*self._encode_texts(own), ()]

        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.fromiter(chain.from_iterable(pieces), np.int32, size.sum())
        until = np.cumsum(size[numbers])
        return gathered(ids, np.cumsum(size) - size, size, numbers), np.concatenate([[0], until[ends - 1]])

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return self.encode_all(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids) -> bytes:
        return self.decoded.join(ids).tobytes()

    def written(self, ids) -> str:
        """Decimal ids with one space between."""
        return self.decimals.join(ids).tobytes()[:-1].decode()


class Pieces:
    """Byte strings by number, joined for many numbers at once."""

    def __init__(self, pieces: dict[int, bytes]):
        self.size = np.zeros(max(pieces, default=-1) + 1, np.int64)
        for number, piece in pieces.items():
            self.size[number] = len(piece)
        self.start = np.cumsum(self.size) - self.size
        self.all = np.frombuffer(b"".join(pieces[i] for i in sorted(pieces)), np.uint8)

    def join(self, numbers) -> np.ndarray:
        return gathered(self.all, self.start, self.size, np.asarray(numbers, np.int64))


def gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The runs of values with these numbers, one after the other."""
    size = size[numbers]
    ends = np.cumsum(size)
    places = np.repeat(start[numbers] - ends + size, size)
    places += np.arange(len(places))
    return values[places]


def merge(word: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[int]:
    """Plain merging, lowest rank and leftmost first, with ranks under a bound."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@lru_cache(maxsize=1)
def codec(path: str, pattern: str = public_tokenizers.PATTERN, memo: int = MEMO) -> Codec:
    """One codec per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern, memo)


def _path(vocabulary: str | None) -> str:
    return vocabulary or public_tokenizers.path(RANKS)


def _plus(df: DataFrame, *names: str) -> None:
    """Refuse names that a column has already; Spark takes no notice of the case of letters."""
    clash = {n.lower() for n in names} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; name others")


def bounded(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded rows and bytes of a text column, or of one longer text."""
    for batch in sliced(batches, ROWS_AT_ONCE):
        size = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(size, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right")))
            yield batch.slice(at, end - at)
            at = end


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "ids",
    vocabulary: str | None = None,
    round_trip: str | None = None,
    memo: int = MEMO,
) -> DataFrame:
    """All columns of docs and the token ids of a text column; null text has no ids.

    With a name for it, `round_trip` tells whether the ids decode to the text's bytes; one
    worker does both, where `decode` after `encode` would need two. `memo` bounds what
    a worker remembers. Rows are independent: no shuffle, repeated rows stay, an empty table
    stays empty. A clashing output name is refused. Texts are taken whole.
    """
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if round_trip:
        added.append(T.StructField(round_trip, T.BooleanType()))
    names = [f.name for f in added]
    _plus(docs, *names)
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, memo=memo)
        return released(encoded_batches(batches, own), own.forget)

    def encoded_batches(batches: Iterator[pa.RecordBatch], own: Codec) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text):
            texts = batch.column(text)
            encoded, starts = own.encode_all(texts)
            made = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(encoded))]
            if round_trip:
                each = zip(np.split(encoded, starts[1:-1]), texts)
                made.append(pa.array([own.decode(i) == (x.as_py() or "").encode() for i, x in each], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """All columns and the bytes that token ids stand for; null ids give empty bytes."""
    _plus(df, decoded)
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in sliced(batches):
            made = pa.array([own.decode(x or ()) for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, decoded])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of ids and decoded bytes per document, in one Python stage so that ids need
    not cross to the JVM: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        return released(digests(batches, own), own.forget)

    def digests(batches: Iterator[pa.RecordBatch], own: Codec) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            counts, of_ids, of_bytes = [], [], []
            encoded, starts = own.encode_all(batch.column("text"))
            for ids in np.split(encoded, starts[1:-1]):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(own.written(ids).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kept = docs.select("doc_id", "text")
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return kept.mapInArrow(run, T.StructType([kept.schema["doc_id"], *T.StructType.fromDDL(made).fields]))
