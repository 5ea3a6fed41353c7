"""Operator 3, byte-pair encoding and decoding by an index of pair occurrences.

All distinct words of a block of texts are laid out in one symbol array. An index maps the rank of each pair to all its
positions. Active ranks leave a heap in ascending order; all occurrences of a rank are merged at once with numpy, and the
pairs that this makes are put into the lists of their ranks. Words do not touch, so each word ends as if merged alone.

Cases: null or empty texts have no ids and decode to the empty text; repeated rows each give a row; extra columns stay as
they are; a column named `ids` or `decoded` of the input is replaced. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carledger.llm.bytewords import gather, list_array, tidied

BLOCK_CHARS = 3 << 20  # texts of about so many characters share one pair index
MEMO_WORDS = 200_000  # runs without white space whose ids a worker remembers; beyond, it forgets them all and computes them again
_SPACE_CLASS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # white space of Unicode
_SPACE = re.compile(f"[{_SPACE_CLASS}]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")  # white space to str.split only


class Merges:
    """A tokenizer file of the kind `BPE` with word ends, as arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.suffix or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model with word ends is needed")
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens = [""] * size
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = size
        keys = self.left * size + self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        signs = byte_signs()
        self.inner = np.array([vocab[c] for c in signs], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in signs], np.int64)
        # A rank is early if a pair with what it makes ranks before it: then one occurrence a word is merged at a time.
        least = np.full(size, len(pairs))
        np.minimum.at(least, self.left, np.arange(len(pairs)))
        np.minimum.at(least, self.right, np.arange(len(pairs)))
        self.early = least[self.made] < np.arange(len(pairs))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (UTF-8, not empty), as bytes of int32."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.final[data[ends - 1]]
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        word = np.repeat(np.arange(len(words)), sizes)
        alive = np.ones(len(data), bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            rank = self.rank(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for first, part in zip([0, *cuts.tolist()], np.split(at, cuts), strict=True):
                if len(part):
                    r = int(rank[first])
                    if r not in index:
                        index[r] = []
                        heapq.heappush(active, r)
                    index[r].append(part)

        enter(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[alive[at]]
            at = at[(symbol[at] == self.left[r]) & (after[at] >= 0)]
            at = at[symbol[after[at]] == self.right[r]]
            if not len(at):
                continue
            if self.left[r] == self.right[r] and len(at) > 1:  # of a run of equal symbols, every other pair
                at = np.sort(at)
                new = np.r_[True, after[at[:-1]] != at[1:]]
                run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if self.early[r] and len(at) > 1:
                at = np.sort(at)
                later = at[1:][word[at[1:]] == word[at[:-1]]]
                at = np.setdiff1d(at, later, assume_unique=True)
                if len(later):
                    index[r] = [later]
                    heapq.heappush(active, r)
            gone = after[at]
            far = after[gone]
            symbol[at] = self.made[r]
            alive[gone] = False
            after[at] = far
            before[far[far >= 0]] = at[far >= 0]
            left = before[at]
            enter(np.unique(np.concatenate([left[left >= 0], at[far >= 0]])))
        kept = symbol[alive].astype(np.int32).tobytes()
        stops = (4 * np.cumsum(np.bincount(word[alive], minlength=len(words)))).tolist()
        return [kept[i:j] for i, j in zip([0, *stops], stops, strict=False)]


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            signs[b] = chr(b)
        else:
            signs[b] = chr(extra)
            extra += 1
    return signs


class Encoder:
    """Encodes texts; remembers the ids of words seen before."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words = re.compile(_as_ranges(merges.pattern))
        self.special = re.compile("(" + "|".join(map(re.escape, merges.special)) + ")") if merges.special else None
        self._forget()

    def _forget(self) -> None:
        self.number = defaultdict(count().__next__)  # of each word; a special token is a tuple
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)  # of the numbered words, in order

    def split(self, text: str) -> list:
        """The runs of a text without white space; special tokens are tuples."""
        if self.special is None or not self.special.search(text):
            return _runs(text)
        parts = self.special.split(text)
        return [w for k, x in enumerate(parts) for w in ([(x,)] if k % 2 else _runs(x))]

    def learn(self) -> None:
        """Encodes the runs that got a number since the last call."""
        new, find = list(islice(self.number, len(self.size), None)), self.words.findall
        words = [find(x) if isinstance(x, str) else x for x in new]
        distinct = list({w for x, ws in zip(new, words, strict=True) if x is not ws for w in ws})
        ids = dict(zip(distinct, self.merges.encode([w.encode() for w in distinct]), strict=True)) if distinct else {}
        special = self.merges.special
        found = [
            np.int32(special[x[0]]).tobytes() if x is ws else b"".join([ids[w] for w in ws])
            for x, ws in zip(new, words, strict=True)
        ]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.int32)])
        self.size = np.concatenate([self.size, np.array([len(x) // 4 for x in found], np.int64)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        if len(self.size) > MEMO_WORDS:
            self._forget()
        number, each, n_words = self.number.__getitem__, [np.zeros(0, np.int32)], [0]
        for text in texts:
            words = self.split(text)
            each.append(np.fromiter(map(number, words), np.int32, len(words)))
            n_words.append(len(words))
        if len(self.number) > len(self.size):
            self.learn()
        word = np.concatenate(each)
        ids = gather(self.ids, np.cumsum(self.size) - self.size, self.size, word)
        total = np.r_[0, np.cumsum(self.size[word])]
        return ids, np.diff(total[np.cumsum(n_words)])


def _as_ranges(pattern: str) -> str:
    """The pattern with the classes L and N written out for the standard library, which matches faster."""
    ranges = {"L": "", "N": ""}
    for kind in ranges:
        signs = [i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == kind]
        cuts = [k for k in range(len(signs)) if k == 0 or signs[k] != signs[k - 1] + 1]
        for k, j in zip(cuts, [*cuts[1:], len(signs)], strict=True):
            ranges[kind] += f"\\U{signs[k]:08x}-\\U{signs[j - 1]:08x}"
    return pattern.replace(r"\s", _SPACE_CLASS).replace(r"\p{L}", ranges["L"]).replace(r"\p{N}", ranges["N"])


def _runs(text: str) -> list[str]:
    text = _normal(text)
    return [x for x in _SPACE.split(text) if x] if _SEPARATORS.search(text) else text.split()


def _normal(text: str) -> str:
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no special form of sigma at a word's end


def load(path: str) -> Merges:
    with open(path, encoding="utf-8") as file:
        return Merges(file.read())


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _blocks(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK_CHARS characters of text, or half as many ids, each."""
    size, first, column = 0, 0, batch.column(at)
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    lengths = pc.utf8_length(column) if text else pc.multiply(pc.list_value_length(column), 2)
    for i, n in enumerate(lengths.to_pylist()):
        size += n or 0
        if size >= BLOCK_CHARS:
            yield batch.slice(first, i + 1 - first)
            size, first = 0, i + 1
    if first < batch.num_rows:
        yield batch.slice(first)


def _with(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _encoding(docs: DataFrame, path: str, at: int):
    """A function over batches that appends the ids of the text column `at`."""
    with open(path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast({"file": file.read()})  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer.value  # kept by the worker for its next tasks
        encoder = own["encoder"] = own.get("encoder") or Encoder(Merges(own["file"]))
        for batch in batches:
            for block in _blocks(batch, at):
                ids, sizes = encoder.encode(_texts(block.column(at)))
                yield _with(block, list_array(ids, sizes, pa.int32()), "ids")

    return run


def _decoding(docs: DataFrame, path: str, at: int):
    """A function over batches that appends the text of the ids in column `at`."""
    tokens = [t.encode() + b" " for t in load(path).tokens]
    signs = docs.sparkSession.sparkContext.broadcast((b"".join(tokens), [len(t) for t in tokens]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, size = np.frombuffer(signs.value[0], np.uint8), np.array(signs.value[1])
        start = np.cumsum(size) - size
        for batch in batches:
            for block in _blocks(batch, at):
                lists = block.column(at)
                which = lists.flatten().to_numpy(zero_copy_only=False)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                text = gather(data, start, size, which)
                end = np.r_[0, np.cumsum(size[which])][np.cumsum(n)].astype(np.int64)
                begin = np.r_[0, end[:-1]]
                # Each text ends one space early; that space would be the first sign of the next text.
                cut = np.ones(len(text), bool)
                cut[end[end > begin] - 1] = False
                offsets = np.r_[0, np.cumsum(end - begin - (end > begin))]
                buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[cut])]
                yield _with(block, pa.StringArray.from_buffers(len(n), buffers[1], buffers[2]), "decoded")

    return run


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds `ids` (array<int>): the ids of `text` under the tokenizer file at `path`, which the driver reads."""
    docs = docs.drop("ids")
    return docs.mapInArrow(tidied(_encoding(docs, path, docs.columns.index(text))), T.StructType([*docs.schema.fields, _IDS]))


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`: the tokens of `ids` joined by single spaces, as a tokenizer without a decoder gives them."""
    docs = docs.drop("decoded")
    return docs.mapInArrow(tidied(_decoding(docs, path, docs.columns.index(ids))), T.StructType([*docs.schema.fields, _DECODED]))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`encode` and `decode` in one pass, so that a task needs one worker."""
    docs = docs.drop("ids", "decoded")
    forth, back = _encoding(docs, path, docs.columns.index(text)), _decoding(docs, path, len(docs.columns))
    return docs.mapInArrow(tidied(lambda batches: back(forth(batches))), T.StructType([*docs.schema.fields, _IDS, _DECODED]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text, one row for each row."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
