"""Encoding and decoding with a public word-level BPE vocabulary, by tree concatenation.

A long text is cut into halves, the halves again, down to leaves that are encoded side by side; a
cut may fall inside a word. Each half keeps its tokens and their places. Going up the tree, only the
text around each join is encoded once more, in a window that grows until it agrees on both sides with
what the halves have; the tokens between the two places of agreement replace what the cut spoilt. White space ends a word for this vocabulary, so
a window of one word is enough where words are short; a long run without white space is mended in
windows of growing length, down to single tokens. If no window agrees, the window becomes the whole
run, so results are always those of the library on the uncut text.

That agreement is enough: two neighbouring tokens of any encoding stay neighbours in the encoding of
any text around them unless the pair of them alone is encoded otherwise, and every pair of the mended
sequence stood side by side in an encoding by the library.

Cases: a null text counts as empty and has no tokens; rows that repeat are encoded alike; an empty
table gives no rows; other columns are not looked at. A text may be as long as a row can be.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tillflow.llm.batches import slices

LEAF = 2048  # characters of a leaf
WINDOW = 32  # characters on each side of a join, to start with
LOOKAHEAD = 4  # characters behind a token that decide where it ends, as in 're and 've
CACHED = 300_000  # words after which a worker forgets those it has not met since the last time
_SPACES = " \t\n\v\f\r"


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    # Tasks fill the cores already; threads of the library would only add to their work.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class Word(NamedTuple):
    """Token ids of a word, as numbers and as decimal digits, and what they decode to."""

    ids: tuple[int, ...]
    digits: str
    decoded: str


class Leaf:
    """Words, in UTF-8, of a stretch of text, their tokens, and whether it starts or ends in one."""

    __slots__ = ("words", "tokens", "open_left", "open_right")

    def __init__(self, words, tokens, open_left, open_right):
        self.words, self.tokens = words, tokens
        self.open_left, self.open_right = open_left, open_right


def halves(text: str, leaf: int) -> list[tuple[int, int]]:
    """The leaves of a text, in order, as spans of characters."""
    spans = [(0, len(text))]
    while any(b - a > leaf for a, b in spans):
        spans = [
            part
            for a, b in spans
            for part in ([(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > leaf else [(a, b)])
        ]
    return spans


class Spans(NamedTuple):
    """Token ids of a run of text, and from where to where in it each stands."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def shifted(self, by: int) -> Spans:
        return Spans(self.ids, self.starts + by, self.ends + by)

    def part(self, start: int | None, stop: int | None) -> Spans:
        return Spans(*[x[start:stop] for x in self])

    def clean(self, k: int) -> bool:
        """Whether token k shares no character with a neighbour, as parts of one character would."""
        return (k == 0 or self.ends[k - 1] <= self.starts[k]) and (
            k + 1 == len(self.ids) or self.ends[k] <= self.starts[k + 1]
        )


def spans_of(codec: Tokenizer, text: str) -> Spans:
    encoded = codec.encode(text, add_special_tokens=False)
    places = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
    return Spans(np.array(encoded.ids, dtype=np.int64), places[:, 0], places[:, 1])


def mend(
    codec: Tokenizer, left: str, a: Spans, right: str, b: Spans, window: int = WINDOW
) -> Spans:
    """Tokens of left + right, a text without white space, from those of both and windows around the join.

    Only the windows are encoded. They begin and end at tokens that the halves have.
    """
    shift = len(left)
    while True:
        first = int(np.searchsorted(a.starts, shift - window, side="left"))
        last = int(np.searchsorted(b.ends, window, side="right")) - 1
        start = int(a.starts[first]) if first < len(a.ids) else shift
        end = int(b.ends[last]) if last >= 0 else 0
        if window >= len(left):
            first, start = 0, 0
        if window >= len(right):
            last, end = len(b.ids) - 1, len(right)
        if start == 0 and end == len(right):
            return spans_of(codec, left + right)
        middle = spans_of(codec, left[start:] + right[:end]).shifted(start)
        places = zip(middle.starts.tolist(), middle.ends.tolist(), strict=True)
        ours = {span: k for k, span in enumerate(places) if middle.clean(k)}

        def at(half: Spans, k: int, by: int, ours=ours, middle=middle) -> int | None:
            """The token of the window that is token k of a half."""
            found = ours.get((int(half.starts[k]) + by, int(half.ends[k]) + by))
            same = found is not None and middle.ids[found] == half.ids[k] and half.clean(k)
            return found if same else None

        head = begin = 0 if start == 0 else None
        for k in range(first, len(a.ids)):
            if begin is not None:
                break
            begin, head = at(a, k, 0), k
        tail, stop = (len(b.ids), len(middle.ids)) if end == len(right) else (None, None)
        for k in range(last, -1, -1):
            if stop is not None:
                break
            if b.ends[k] + LOOKAHEAD <= end:
                stop, tail = at(b, k, shift), k
        if begin is not None and stop is not None and begin <= stop:
            parts = (a.part(None, head), middle.part(begin, stop), b.part(tail, None).shifted(shift))
            return Spans(*[np.concatenate(x) for x in zip(*parts, strict=True)])
        window *= 2


class Encoder:
    """Encodes texts with a tokenizer file, remembering the tokens of words."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        self.codec = tokenizer(path)
        self.leaf, self.window = leaf, window
        self.known: dict[bytes, Word] = {}
        self.older: dict[bytes, Word] = {}
        self.digits, self.strings = spellings(path)

    def word(self, ids) -> Word:
        digits, strings = self.digits, self.strings
        return Word(tuple(ids), " ".join([digits[i] for i in ids]), " ".join([strings[i] for i in ids]))

    def learn(self, words) -> dict[bytes, Word]:
        """Tokens of all given words: a dictionary to look them up in."""
        known, missing = self.known, []
        for word in set(words).difference(known):
            old = self.older.get(word)
            if old is None:
                missing.append(word)
            else:
                known[word] = old
        texts = [word.decode() for word in missing]
        found = self.codec.encode_batch_fast(texts, add_special_tokens=False)
        for word, encoded in zip(missing, found, strict=True):
            known[word] = self.word(encoded.ids)
        if len(known) > CACHED:
            self.known, self.older = {}, known
        return known

    def leaves(self, text: str) -> list[Leaf]:
        parts = []
        for a, b in halves(text, self.leaf):
            piece = text[a:b]
            # Bytes are split at the six signs of ASCII white space alone.
            words = piece.encode().split()
            inside = bool(words)
            parts.append(
                Leaf(words, None, inside and piece[0] not in _SPACES, inside and piece[-1] not in _SPACES)
            )
        return parts

    def join(self, left: Leaf, right: Leaf) -> Leaf:
        """One level up the tree."""
        if not left.words:
            return Leaf(right.words, right.tokens, False, right.open_right)
        if not right.words:
            return Leaf(left.words, left.tokens, left.open_left, False)
        words, tokens = left.words, left.tokens
        if left.open_right and right.open_left:
            a, b = words[-1], right.words[0]
            if len(a) + len(b) <= 2 * self.window:
                mended = self.learn([a + b])[a + b]
            else:
                one, two = a.decode(), b.decode()
                known = [
                    t if isinstance(t, Spans) else spans_of(self.codec, text)
                    for t, text in ((tokens[-1], one), (right.tokens[0], two))
                ]
                mended = mend(self.codec, one, known[0], two, known[1], self.window)
            words = words[:-1] + [a + b] + right.words[1:]
            tokens = tokens[:-1] + [mended] + right.tokens[1:]
        else:
            words, tokens = words + right.words, tokens + right.tokens
        return Leaf(words, tokens, left.open_left, right.open_right)

    def _cut(self, tree: list[Leaf]) -> dict[tuple[int, int], Spans]:
        """Tokens, with places, of the long parts of words that the ends of leaves cut, by leaf and word."""
        found = {}
        for k, leaf in enumerate(tree):
            ends = {0} if k > 0 and leaf.open_left else set()
            if k + 1 < len(tree) and leaf.open_right:
                ends.add(len(leaf.words) - 1)
            for word in ends:
                if len(leaf.words[word]) > self.window:
                    found[k, word] = spans_of(self.codec, leaf.words[word].decode())
        return found

    @staticmethod
    def _whole(k: int, leaf: Leaf, cut: dict) -> list[bytes]:
        """The words of a leaf but for the parts that were encoded with their places."""
        if not cut:
            return leaf.words
        return [word for w, word in enumerate(leaf.words) if (k, w) not in cut]

    def encode(self, texts: list[str]) -> list[list[Word]]:
        """Per text, its words with their tokens."""
        trees = [self.leaves(text) for text in texts]
        cuts = [self._cut(tree) for tree in trees]
        known = self.learn(
            chain.from_iterable(
                self._whole(k, leaf, cut)
                for tree, cut in zip(trees, cuts, strict=True)
                for k, leaf in enumerate(tree)
            )
        )
        results = []
        for tree, cut in zip(trees, cuts, strict=True):
            for k, leaf in enumerate(tree):
                if not cut:
                    leaf.tokens = [known[word] for word in leaf.words]
                    continue
                leaf.tokens = [
                    cut[k, w] if (k, w) in cut else known[word] for w, word in enumerate(leaf.words)
                ]
            while len(tree) > 1:
                pairs = [self.join(*tree[k : k + 2]) for k in range(0, len(tree) - 1, 2)]
                tree = pairs + tree[len(pairs) * 2 :]
            tokens = tree[0].tokens
            if cut:
                tokens = [self.word(t.ids.tolist()) if isinstance(t, Spans) else t for t in tokens]
            results.append(tokens)
        return results


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker and vocabulary, as it remembers words."""
    return Encoder(path)


@lru_cache(maxsize=4)
def spellings(path: str) -> tuple[list[str], list[str]]:
    """Of each id, its decimal digits and the string of its token."""
    codec = tokenizer(path)
    ids = range(codec.get_vocab_size(with_added_tokens=True))
    return [str(i) for i in ids], [codec.id_to_token(i) or "" for i in ids]


def decode(path: str, ids) -> str:
    """Tokens joined by blanks: this vocabulary has no decoder of its own, and keeps word ends."""
    return " ".join(map(spellings(path)[1].__getitem__, ids))


def _encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[pa.Array, list[list[Word]]]]:
    """doc_id and the encoded words of all rows, a slice at a time."""
    text = batch.column("text")
    for start, stop in slices(text):
        texts = [t or "" for t in text.slice(start, stop - start).to_pylist()]
        yield batch.column("doc_id").slice(start, stop - start), encoder(path).encode(texts)


def _run(docs: DataFrame, columns: str, per_slice) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(per_slice, f"doc_id {kind}, {columns}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids of the whole text, without special tokens added."""

    def run(batches):
        for batch in batches:
            for doc_id, words in _encoded(batch, path):
                ids = [list(chain.from_iterable(w.ids for w in row)) for row in words]
                tokens = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([doc_id, tokens], ["doc_id", "ids"])

    return _run(docs, "ids array<int>", run)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the tokens in `ids` decode to; null ids decode to nothing."""

    def run(batches):
        for batch in batches:
            texts = [decode(path, ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts)], names)

    names = ["doc_id", "text"]
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: how many tokens, and digests of the ids and of the text decoded."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        for batch in batches:
            for doc_id, words in _encoded(batch, path):
                parts = [tuple(zip(*row, strict=True)) or ((), (), ()) for row in words]
                # A word has no token where the vocabulary drops all its signs.
                columns = [
                    doc_id,
                    pa.array([sum(map(len, ids)) for ids, _, _ in parts], pa.int64()),
                    pa.array([sha(" ".join(filter(None, digits))) for _, digits, _ in parts]),
                    pa.array([sha(" ".join(filter(None, decoded))) for _, _, decoded in parts]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return _run(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", run)
