"""Operator 11, SentencePiece encoding and decoding of merge-type (BPE) models, exact, by backtracking.

A text is cut before each space that follows another sign, because no piece reaches over such a place. For each word an
Aho-Corasick automaton of the pieces gives the longest match at each position that is reached. Matches are laid one after the other; a match
may follow its predecessor only if merging the signs of both anew gives just these two. Where it may not, its next shorter
prefix is tried, and where none is left, a bit marks the position as failed and the token before it is taken back. A row of
pieces whose neighbours all fit is what merging the whole word gives, so the first complete row is the answer.

This holds for pieces of distinct scores. Pieces that share a score (runs of spaces) are merged leftmost first; they rank
below all others, so they are merged when the others are done, on the tokens found so far. Signs in no piece become bytes.

Cases: null or empty texts have no ids and decode to the empty text; repeated rows each give a row; extra columns stay as
they are; a column named `ids` or `decoded` of the input is replaced. Texts are encoded whole, whatever their length. A model
with user-defined or unused pieces, without byte pieces or with a normalization of its own is an error.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carledger.llm.bytewords import gather, list_array, slices, tidied

SPACE = "▁"  # stands for a space in pieces
BLOCK_CHARS = 2 << 20  # texts of about so many characters are encoded together
MEMO_WORDS = 300_000  # words whose ids a worker remembers; beyond, it forgets the rarer half and computes it again
ALONE = 200  # longer words are encoded on their own
PLACES = 1 << 20  # of pairs whose fit is found without asking
FEW = 40  # signs that are merged without a queue
MEMO_PAIRS = 1_000_000  # pairs of pieces whose fit a worker remembers, likewise

# Fields and kinds of the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialized message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while data[at] > 127:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
        return value | data[at] << shift, at + 1

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Pieces:
    """A model file: its pieces, and which of them merging can give."""

    def __init__(self, model: bytes):
        self.pieces, self.kinds, scores, spec, normal = [], [], [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.kinds.append(piece.get(3, NORMAL))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            elif number == 2:
                spec = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if spec.get(3) != 2 or not spec.get(35) or not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE} or spec.get(24):
            raise ValueError("a BPE model with byte pieces, without user-defined or unused ones, is needed")
        if normal.get(2) or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
            raise ValueError("a model with a leading space, without other normalization, is needed")
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)) if kind == NORMAL}
        byte = [i for i, kind in enumerate(self.kinds) if kind == BYTE]
        self.bytes = dict(sorted((int(self.pieces[i][1:-1], 16), i) for i in byte))
        if len(self.bytes) != 256:
            raise ValueError("there must be a piece for each byte")
        merged = {p: -scores[i] for p, i in self.ids.items() if len(p) > 1}
        times = defaultdict(int)
        for cost in merged.values():
            times[cost] += 1
        self.ranked = {p: cost for p, cost in merged.items() if times[cost] == 1}
        self.merged = merged
        self.tied = {p for p in merged if p not in self.ranked}
        if self.tied and min(merged[p] for p in self.tied) < max(self.ranked.values(), default=0):
            raise ValueError("pieces of equal scores must rank below all others")
        signs = {c for p in self.ids for c in p}
        #: Single signs, and the pieces that their own signs merge to. A sign that is no piece itself goes as bytes.
        self.tokens = signs | {p for p in self.ranked if merge(list(p), self.ranked) == [p]}
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.tokens), None) for p in self.tokens}
        #: Whether no piece goes on with a space after another sign.
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in merged)

    def spelled(self, token: str) -> list[int]:
        """The ids of a token: its own, or those of its bytes."""
        i = self.ids.get(token)
        return [self.bytes[b] for b in token.encode()] if i is None else [i]


def merge(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """Merges neighbours whose concatenation has the least cost, the leftmost of equals first, until none has a cost."""
    if len(symbols) < 2:
        return symbols
    if len(symbols) <= FEW:  # a plain search is faster than a queue
        symbols, none = [*symbols], float("inf")
        costs = [cost.get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while costs and (least := min(costs)) < none:
            i = costs.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = cost.get(symbols[i] + symbols[i + 1], none)
            if i:
                costs[i - 1] = cost.get(symbols[i - 1] + symbols[i], none)
        return symbols
    after = [*range(1, len(symbols)), None]
    before = [None, *range(len(symbols) - 1)]
    symbols = [*symbols]
    queue = [(cost[s], i, s) for i, s in enumerate(map(str.__add__, symbols, symbols[1:])) if s in cost]
    heapq.heapify(queue)
    while queue:
        _, i, made = heapq.heappop(queue)
        j = after[i]
        if symbols[i] is None or j is None or symbols[i] + symbols[j] != made:
            continue
        symbols[i], symbols[j] = made, None
        after[i] = k = after[j]
        if k is not None:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left is not None and right is not None and (s := symbols[left] + symbols[right]) in cost:
                heapq.heappush(queue, (cost[s], left, s))
    return [s for s in symbols if s is not None]


class Encoder:
    """Encodes texts; remembers the ids of words and the fit of pairs seen before."""

    def __init__(self, model: Pieces):
        self.model = model
        self.find = ahocorasick.Automaton()
        for p in model.tokens:
            self.find.add_word(p, p)
        self.find.make_automaton()
        self.longest = max(map(len, model.tokens))
        #: The longest token on each path from the root of the automaton.
        self.reach: dict[str, str] = {}
        for p in sorted(model.tokens, key=len, reverse=True):
            for n in range(len(p), 0, -1):
                if len(self.reach.get(p[:n], "")) < n:
                    self.reach[p[:n]] = next(p[:k] for k in range(n, 0, -1) if p[:k] in model.tokens)
        self.rows = Rows(model, self.reach, self.fits)
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if model.by_words else "(?s).+")
        self.simple = all(p.startswith(SPACE * 2) for p in model.tied)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.number = defaultdict(count().__next__)
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)  # of the numbered words, in order
        self.seen = np.zeros(0, np.int64)  # how often each word occurred

    def _forget(self) -> None:
        """Keeps the more frequent half of the words."""
        kept = np.sort(np.argsort(-self.seen, kind="stable")[: MEMO_WORDS // 2])
        words = list(self.number)
        self.ids = gather(self.ids, np.cumsum(self.size) - self.size, self.size, kept)
        self.size, self.seen = self.size[kept], self.seen[kept] // 2
        self.number = defaultdict(count(len(kept)).__next__, zip([words[i] for i in kept.tolist()], range(len(kept)), strict=True))

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the signs of two tokens anew gives just these two."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = merge(list(left + right), self.model.ranked) == [left, right]
        return found

    def word(self, word: str) -> list[int]:
        find, reach, shorter, pairs = self.find.longest_prefix, self.reach, self.model.shorter, self.pairs
        failed = bytearray(len(word) // 8 + 1)  # a bit for each position where no complete row can go on
        done, tokens, at, last = [], [], 0, None
        token = reach.get(word[: find(word)])
        while at < len(word):
            if token is None and last is None:  # a sign in no piece, or the end of what stands before one
                done += tokens + [word[at]]
                tokens, at = [], at + 1
                token = reach.get(word[at : at + find(word[at : at + self.longest])])
                continue
            while token is not None:
                end = at + len(token)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    fit = pairs.get((last, token))
                    if self.fits(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token is not None:
                tokens.append(token)
                at, last = end, token
                token = reach.get(word[at : at + find(word[at : at + self.longest])])
                if token is None:
                    last = None  # the end, or a sign in no piece: what stands before is complete
            else:
                failed[at >> 3] |= 1 << (at & 7)
                tokens.pop()
                at -= len(last)
                token, last = shorter[last], tokens[-1] if tokens else None
        tokens = done + tokens
        if SPACE * 2 in word or not self.simple:
            if any(left + right in self.model.tied for left, right in zip(tokens, tokens[1:], strict=False)):
                tokens = merge(tokens, self.model.merged)
        own = self.model.ids
        try:
            return [own[token] for token in tokens]
        except KeyError:
            return [i for token in tokens for i in self.model.spelled(token)]

    def split(self, text: str) -> list[str]:
        """The words of a text. The space before a word goes without saying, if it is one."""
        if not text:
            return []
        if self.model.by_words and "  " not in text and SPACE not in text and text[0] != " " != text[-1]:
            return text.split(" ")
        return [w if w[1:2] == SPACE else w[1:] for w in self.words.findall(SPACE + text.replace(" ", SPACE))]

    def _learn(self, words: list[str]) -> None:
        """Appends the ids of new words. Those that are long or begin with several spaces are encoded on their own."""
        words = [w if w[:1] == SPACE else SPACE + w for w in words]
        alone = np.array([not self.simple or len(w) > ALONE or SPACE * 2 in w for w in words], bool)
        ids, n = self._together([w for w, a in zip(words, alone.tolist(), strict=True) if not a])
        lone = [np.array(self.word(words[i]), np.int32) for i in np.flatnonzero(alone).tolist()]
        size = np.zeros(len(words), np.int64)
        size[~alone], size[alone] = n, [len(x) for x in lone]
        held, start = _in_order(alone, size, ids, np.concatenate([np.zeros(0, np.int32), *lone]))
        self.ids = np.concatenate([self.ids, gather(held, start, size, np.arange(len(words)))]).astype(np.int32)
        self.size = np.concatenate([self.size, size])

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each has. Signs in no piece part what stands around them."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, first = self.rows.code[points], np.zeros(len(points), bool)
        sizes = np.array([len(w) for w in words], np.int64)
        first[np.cumsum(sizes) - sizes] = True
        unknown = codes < 0
        begin = np.flatnonzero(first | unknown | np.r_[False, unknown[:-1]])
        strange = unknown[begin]
        ids, n = self.rows.encode(codes[~unknown], np.diff(np.r_[begin, len(points)])[~strange])
        signs, which = np.unique(points[begin[strange]], return_inverse=True)
        spelled = [np.array(self.model.spelled(chr(c)), np.int32) for c in signs.tolist()]
        flat = np.concatenate([np.zeros(0, np.int32), *spelled])
        each = np.array([len(x) for x in spelled], np.int64)
        size = np.zeros(len(begin), np.int64)
        size[~strange], size[strange] = n, each[which]
        held, start = _in_order(strange, size, ids, gather(flat, np.cumsum(each) - each, each, which))
        total = np.r_[0, np.cumsum(size)]
        ends = np.searchsorted(begin, np.cumsum(sizes))
        return gather(held, start, size, np.arange(len(begin))), np.diff(total[np.r_[0, ends]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        if len(self.size) > MEMO_WORDS:
            self._forget()
        number, each, n_words = self.number.__getitem__, [np.zeros(0, np.int32)], [0]
        for text in texts:
            words = self.split(text)
            each.append(np.fromiter(map(number, words), np.int32, len(words)))
            n_words.append(len(words))
        new = list(islice(self.number, len(self.size), None))
        self._learn(new)
        word = np.concatenate(each)
        self.seen = np.bincount(word, minlength=len(self.size)) + np.r_[self.seen, np.zeros(len(new), np.int64)]
        ids = gather(self.ids, np.cumsum(self.size) - self.size, self.size, word)
        total = np.r_[0, np.cumsum(self.size[word])]
        return ids, np.diff(total[np.cumsum(n_words)])


def _in_order(second: np.ndarray, size: np.ndarray, ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays one after the other, and where the ids of each unit begin there; `second` marks units of the other."""
    order = np.r_[np.flatnonzero(~second), np.flatnonzero(second)]
    start = np.zeros(len(size), np.int64)
    start[order] = np.cumsum(size[order]) - size[order]
    return np.concatenate([ids, others]), start


class Rows:
    """The same search for many words at once: each step tries one token of every word that isn't done."""

    def __init__(self, model: Pieces, reach: dict[str, str], fits):
        self.fits = fits
        self.tokens = sorted(p for p in model.tokens if p in model.ids)
        number = {p: i for i, p in enumerate(self.tokens)}
        self.id = np.array([model.ids[p] for p in self.tokens], np.int32)
        self.length = np.array([len(p) for p in self.tokens], np.int64)
        self.shorter = np.array([number.get(model.shorter[p], -1) for p in self.tokens], np.int32)
        signs = sorted(p for p in self.tokens if len(p) == 1)
        self.code = np.full(0x110000, -1, np.int32)  # of each sign that is a token
        self.code[[ord(c) for c in signs]] = np.arange(len(signs))
        # Paths of the automaton: the state after a sign, -1 where there is none.
        paths = sorted(p for p in reach if all(c in number for c in p))
        state = {p: i for i, p in enumerate(paths)}
        self.token = np.array([number.get(reach[p], -1) for p in paths], np.int32)
        self.first = np.array([state[c] for c in signs], np.int64)
        self.signs = len(signs)
        longer = [p for p in paths if len(p) > 1]
        keys = np.array([state[p[:-1]] * self.signs + self.code[ord(p[-1])] for p in longer], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array([state[p] for p in longer], np.int64)[order]
        # Fits of pairs seen before: the pair in each place and whether it fits; the other pairs are asked for.
        self.pair, self.fit = np.full(PLACES, -1, np.int64), np.zeros(PLACES, bool)

    def longest(self, codes: np.ndarray, room: np.ndarray) -> np.ndarray:
        """The longest token at each position that has `room` signs up to the end of its word."""
        state = self.first[codes]
        at, depth = np.flatnonzero(room > 1), 1
        while len(at):
            key = state[at] * self.signs + codes[at + depth]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[k] == key
            at, depth = at[found], depth + 1
            state[at] = self.next[k[found]]
            at = at[room[at] > depth]
        return self.token[state]

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * len(self.tokens) + right
        place = (key * 0x9E3779B1 >> 12) & (PLACES - 1)
        fit = self.fit[place]
        other = np.flatnonzero(self.pair[place] != key)
        if len(other):
            asked, which = np.unique(key[other], return_inverse=True)
            n = len(self.tokens)
            found = np.array([self.fits(self.tokens[k // n], self.tokens[k % n]) for k in asked.tolist()], bool)
            fit[other] = found[which]
            place = (asked * 0x9E3779B1 >> 12) & (PLACES - 1)
            place, one = np.unique(place, return_index=True)
            self.pair[place], self.fit[place] = asked[one], found[one]
        return fit

    def encode(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words that follow each other, and how many each has."""
        stop = np.cumsum(sizes)
        room = np.repeat(stop, sizes) - np.arange(len(codes))
        longest = self.longest(codes, room)
        chosen = np.full(len(codes), -1, np.int32)  # the token that starts at a position
        before = np.full(len(codes) + 1, -1, np.int64)  # where the token that ends at a position starts
        failed = np.zeros((len(codes) >> 3) + 1, np.uint8)  # a bit for each position where no complete row can go on
        begin, at = stop - sizes, stop - sizes
        token = longest[at]
        while len(at):
            lives = token >= 0
            end = at + np.where(lives, self.length[token], 0)
            lives &= failed[end >> 3] >> (end & 7).astype(np.uint8) & 1 == 0
            ask = np.flatnonzero(lives & (at > begin))
            if len(ask):
                lives[ask] = self.may_follow(chosen[before[at[ask]]], token[ask])
            # Lay the token and go on; or try its next shorter prefix; or take back the one before.
            yes, no = np.flatnonzero(lives), np.flatnonzero(~lives)
            chosen[at[yes]] = token[yes]
            inner = end[yes] < stop[yes]
            before[end[yes][inner]] = at[yes][inner]
            shorter = np.where(token[no] >= 0, self.shorter[token[no]], -1)
            stuck = no[shorter < 0]
            token[no] = shorter
            at[yes] = end[yes]
            go = yes[inner]
            token[go] = longest[at[go]]
            if len(stuck):
                where = at[stuck]
                np.bitwise_or.at(failed, where >> 3, np.left_shift(1, where & 7).astype(np.uint8))
                back = before[where]
                taken = chosen[back]
                chosen[back] = -1
                at[stuck], token[stuck] = back, self.shorter[taken]
            left = at < stop
            if not left.all():
                at, token, stop, begin = at[left], token[left], stop[left], begin[left]
        laid = np.flatnonzero(chosen >= 0)
        total = np.r_[0, np.cumsum(chosen >= 0)]
        ends = np.cumsum(sizes)
        return self.id[chosen[laid]], total[ends] - total[ends - sizes]


class Decoder:
    """Texts of ids: pieces with spaces, without the leading one; bytes that are no UTF-8 become replacement characters."""

    def __init__(self, model: Pieces):
        self.kind = np.array(model.kinds)
        surface = {NORMAL: lambda p: p.replace(SPACE, " ").encode(), BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        surface |= {CONTROL: lambda p: b"", UNKNOWN: lambda p: UNKNOWN_TEXT.encode()}
        self.surface = [surface[kind](p) for p, kind in zip(model.pieces, model.kinds, strict=True)]
        self.size = np.array([len(s) for s in self.surface], np.int64)
        self.start, self.data = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(self.surface), np.uint8)
        self.spaced = np.array([p.startswith(SPACE) and kind == NORMAL for p, kind in zip(model.pieces, model.kinds, strict=True)])

    def one(self, ids: list[int]) -> str:
        """The text of ids among which are bytes."""
        out, run, opened = [], bytearray(), False
        for i in [*ids, -1]:
            if i >= 0 and self.kind[i] == BYTE:
                run += self.surface[i]
                continue
            out.append(_utf8(bytes(run)))
            opened, run = opened or bool(out[-1]), bytearray()
            if i >= 0:
                text = self.surface[i].decode()
                out.append(text[1:] if not opened and self.spaced[i] else text)
                opened = opened or bool(text)
        return "".join(out)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The texts of ids that follow each other, `sizes` for each text."""
        stop = np.cumsum(sizes)
        begin = stop - sizes
        special = np.r_[0, np.cumsum(self.kind[ids] != NORMAL)]
        plain = special[stop] == special[begin]
        filled = plain & (sizes > 0)
        data = gather(self.data, self.start, self.size, ids)
        at = np.r_[0, np.cumsum(self.size[ids])]
        first, last = at[begin], at[stop]
        first = first + np.where(filled, self.spaced[ids[np.minimum(begin, max(len(ids) - 1, 0))]] if len(ids) else False, False)
        texts = [bytes(data[i:j]) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
        for k in np.flatnonzero(~plain).tolist():
            texts[k] = self.one(ids[begin[k] : stop[k]].tolist()).encode()
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int32)
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(b"".join(texts)))


def _utf8(data: bytes) -> str:
    """Bytes as text; each byte that is part of no character is a replacement character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at : at + error.start].decode() + "�")
            at += error.start + 1
    return "".join(out)


def load(path: str) -> Pieces:
    with open(path, "rb") as file:
        return Pieces(file.read())


def _with(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _shared(docs: DataFrame, path: str):
    """The model, to be sent to each executor once; what workers build from it is kept for their next tasks."""
    return docs.sparkSession.sparkContext.broadcast({"model": load(path)})  # as large as the vocabulary


def _encoding(tokenizer, at: int):
    """A function over batches that appends the ids of the text column `at`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer.value
        encoder = own["encoder"] = own.get("encoder") or Encoder(own["model"])
        for batch in batches:
            for block in slices(batch, pc.utf8_length(batch.column(at)), BLOCK_CHARS):
                ids, sizes = encoder.encode([t or "" for t in block.column(at).to_pylist()])
                yield _with(block, list_array(ids, sizes, pa.int32()), "ids")

    return run


def _decoding(tokenizer, at: int):
    """A function over batches that appends the text of the ids in column `at`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer.value
        decoder = own["decoder"] = own.get("decoder") or Decoder(own["model"])
        for batch in batches:
            for block in slices(batch, pc.list_value_length(batch.column(at)), BLOCK_CHARS):
                lists = block.column(at)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield _with(block, decoder.decode(ids, sizes), "decoded")

    return run


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds `ids` (array<int>): the ids of `text` under the model file at `path`, which the driver reads."""
    docs = docs.drop("ids")
    run = _encoding(_shared(docs, path), docs.columns.index(text))
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, _IDS]))


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`: the text of `ids`."""
    docs = docs.drop("decoded")
    run = _decoding(_shared(docs, path), docs.columns.index(ids))
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, _DECODED]))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`encode` and `decode` in one pass, so that a task needs one worker."""
    docs = docs.drop("ids", "decoded")
    shared = _shared(docs, path)
    forth, back = _encoding(shared, docs.columns.index(text)), _decoding(shared, len(docs.columns))
    return docs.mapInArrow(tidied(lambda batches: back(forth(batches))), T.StructType([*docs.schema.fields, _IDS, _DECODED]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text, one row for each row."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
