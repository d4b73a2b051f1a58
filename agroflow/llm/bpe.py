"""Word-level BPE by a trie that shared prefixes go through once.

Byte-pair encodings can be built from left to right: the encoding of a prefix is that of a shorter prefix and one
last token, and the last token of each prefix is unique. Two tokens may stand side by side if no merge across
their border comes before the merges that make them; a sequence is the encoding of its text if that holds for all
neighbours. So the distinct words of the texts go into a trie whose nodes keep their last token and the node where
that token begins. Words come sorted, nodes are numbered depth first, and a node's state follows from those above
it: whatever words begin alike is worked out once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, texts

TOKENIZER = "word_bpe_49k.json"
#: Nodes of a trie after which a worker starts a new one, and characters of text whose words enter it together.
TRIE_NODES, GROUP_CHARS = 50_000, 1 << 20
#: What a worker remembers: bytes of words and their ids, with what Python adds to a pair of them, and pairs of tokens.
CODE_BYTES, PAIR_BYTES, KNOWN_PAIRS = 48 << 20, 150, 1 << 18
#: Words of more bytes get a trie of their own, which is not kept.
LONG_WORD = 2048

# The vocabulary's mark of a word's end, its word pattern, and the letters that stand for bytes.
_END = "</w>"
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Characters on which the two libraries' tables are tested to agree; texts with others are cut by ``tokenizers`` itself.
_OTHER = regex.compile("[^\t-\r\x20-ɏ‐-‧‰-›€]")
# The same for texts of ASCII alone, in lower case.
_ASCII_WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_ASCII_OTHER = re.compile("[^\t-\r\x20-\x7f]")

_INSIDE, _BITS = 256, 9
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter for each byte: printable ones stand for themselves, the others follow above 255 in their order."""
    rest = [b for b in range(256) if b not in set(_PRINTABLE)]
    letters = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Merges:
    """Tokens over symbols (a byte, or 256 and more for the byte that ends a word) and the merges that make them."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]):
        letters = byte_letters()
        self.base = [vocabulary[c] for c in letters] + [vocabulary[c + _END] for c in letters]
        self.spelled = {token: (symbol,) for symbol, token in enumerate(self.base)}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if made in self.spelled or left not in self.spelled or right not in self.spelled:
                raise ValueError("a merge must make a new token of tokens made before")
            self.rank[left, right] = rank
            self.parts[made] = (left, right, rank)
            self.spelled[made] = self.spelled[left] + self.spelled[right]
        self._known: dict[int, bool] = {}
        made = {t for t in self.base}
        # Tokens read from their end: (state, symbol) -> state, and the token that ends there.
        self.backward: dict[int, int] = {}
        self.token_at = [-1]
        for token, symbols in self.spelled.items():
            if token in self.parts:
                left, right, _ = self.parts[token]
                # Some tokens never arise: other merges take their parts first.
                if left not in made or right not in made or self._meeting(left, right) != (left, right):
                    continue
                made.add(token)
            state = 0
            for symbol in reversed(symbols):
                step = state << _BITS | symbol
                state = self.backward.setdefault(step, len(self.token_at))
                if state == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[state] = token

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that lie at one side of a token while it is made, smallest first, each with the rank of the
        merge that takes it in."""
        out = [(token, _NEVER)]
        while token in self.parts:
            rank = self.parts[token][2]
            token = self.parts[token][side]
            out.append((token, rank))
        return out[::-1]

    def _meeting(self, left: int, right: int) -> tuple[int, int] | None:
        """The first two tokens that a merge would join across the border of two tokens; None if the border stays."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            rank = self.rank.get((a[i][0], b[j][0]), _NEVER)
            # Of equal merges the leftmost comes first.
            if rank < a[i][1] and rank <= b[j][1] and rank < _NEVER:
                return a[i][0], b[j][0]
            if a[i][1] == b[j][1] == _NEVER:
                return None
            if a[i][1] <= b[j][1]:
                i += 1
            else:
                j += 1

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens stay side by side."""
        key = left << 20 | right
        known = self._known.get(key)
        if known is None:
            if len(self._known) > KNOWN_PAIRS:
                self._known.clear()
            known = self._known[key] = self._meeting(left, right) is None
        return known


class PrefixTrie:
    """Distinct words by their prefixes; every node knows the last token of its prefix and where that begins."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.steps: dict[int, int] = {}
        self.parent, self.symbol = [0], [0]
        self.last, self.begins = [-1], [0]

    def __len__(self) -> int:
        return len(self.parent)

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The token ids of each word as little-endian unsigned 32-bit numbers."""
        first, leaves = len(self), {}
        steps, parent, symbol = self.steps, self.parent, self.symbol
        for word in sorted(words):
            node = 0
            for s in (*word[:-1], word[-1] + _INSIDE):
                step = node << _BITS | s
                child = steps.get(step)
                if child is None:
                    child = steps[step] = len(parent)
                    parent.append(node)
                    symbol.append(s)
                node = child
            leaves[word] = node
        self._descend(first)
        return {word: self._tokens(leaf) for word, leaf in leaves.items()}

    def _descend(self, first: int) -> None:
        """States of the nodes from ``first`` on; parents come before their children."""
        parent, symbol, last, begins = self.parent, self.symbol, self.last, self.begins
        backward, token_at, apart = self.merges.backward, self.merges.token_at, self.merges.apart
        for node in range(first, len(parent)):
            state, above, found = 0, node, []
            while above:
                state = backward.get(state << _BITS | symbol[above])
                if state is None:
                    break
                above = parent[above]
                if token_at[state] >= 0:
                    found.append((token_at[state], above))
            # Exactly one of the tokens that end here fits; it is mostly a long one.
            for token, above in reversed(found):
                if not above or apart(last[above], token):
                    last.append(token)
                    begins.append(above)
                    break
            else:
                raise ValueError("no token fits; the merges are not a byte-pair encoding")

    def _tokens(self, node: int) -> bytes:
        out = []
        while node:
            out.append(self.last[node])
            node = self.begins[node]
        return np.array(out[::-1], "<u4").tobytes()


class WordEncoder:
    """Texts to token ids and back, as ``tokenizers`` does with the same file."""

    def __init__(self, path: str, trie_nodes: int = TRIE_NODES):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.path, self.trie_nodes = path, trie_nodes
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.merges = Merges(content["model"]["vocab"], [tuple(m) for m in content["model"]["merges"]])
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._bytes = {c: b for b, c in enumerate(byte_letters())}
        self._library = None
        self.trie = PrefixTrie(self.merges)
        self.codes: dict[bytes | int, bytes] = {}
        self._held = 0

    def _pieces(self, text: str) -> list[bytes]:
        """The words of a text without special tokens."""
        if text.isascii():
            if _ASCII_OTHER.search(text) is None:
                return _ASCII_WORD.findall(text.lower().encode())
        elif _OTHER.search(text) is None:
            return [w.encode() for w in _WORD.findall(unicodedata.normalize("NFC", text).lower())]
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        cut = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(self._bytes.__getitem__, piece)) for piece, _ in cut]

    def _words(self, text: str) -> list[bytes | int]:
        """The words of a text, and its special tokens as ids."""
        if not any(s in text for s in self.special):
            return self._pieces(text)
        out: list[bytes | int] = []
        for part in self._split.split(text):
            out += [self.special[part]] if part in self.special else self._pieces(part)
        return out

    def encode(self, group: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        worded = [self._words(text) for text in group]
        new = {w for words in worded for w in words if w not in self.codes}
        for word in {w for w in new if isinstance(w, int)}:
            self.codes[word] = np.array([word], "<u4").tobytes()
            new.discard(word)
        own = {w: PrefixTrie(self.merges).encode([w])[w] for w in new if len(w) > LONG_WORD}
        added = self.trie.encode(w for w in new if w not in own)
        self.codes |= added
        self._held += sum(len(w) + len(ids) + PAIR_BYTES for w, ids in added.items())
        codes = self.codes | own if own else self.codes
        out = [b"".join([codes[w] for w in words]) for words in worded]
        if len(self.trie) > self.trie_nodes:
            self.trie = PrefixTrie(self.merges)
        if self._held > CODE_BYTES:
            self.codes, self._held = {}, 0
        return out


def decoded(ids: bytes, spellings: dict[int, bytes]) -> str:
    """The tokens' spellings, parted by spaces: the file names no decoder."""
    return b" ".join(map(spellings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


@lru_cache(maxsize=1)
def token_spellings(path: str) -> dict[int, bytes]:
    """How the file spells each token, special ones included; once for each worker process."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    names = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
    return {i: name.encode() for name, i in names.items()}


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    return WordEncoder(path)


def _grouped(values: pa.Array, chars: int) -> Iterator[list]:
    """The texts, or ids, in lists of about ``chars`` characters, or bytes; what a list makes bounds a worker's memory."""
    group, size = [], 0
    for value in values:
        group.append(value.as_py())
        size += len(group[-1] or ())
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text; other columns are ignored): the ids as little-endian
    unsigned 32-bit numbers.

    Null and empty texts, and texts of white space, have no ids. Repeated rows come out as often as they go in, a
    null doc_id is kept. An empty table gives an empty result. Words of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            first = 0
            for group in _grouped(batch.column(1), group_chars):
                ids = pa.array(coder.encode(group), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), ids], ["doc_id", "ids"])
                first += len(group)

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, group_bytes: int = GROUP_CHARS) -> DataFrame:
    """The rows (doc_id, ids) with their decoded text; no ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = token_spellings(path)
        for batch in batches:
            first = 0
            for group in _grouped(batch.column(1), group_bytes):
                rows = batch.slice(first, len(group))
                out = pa.array([decoded(ids or b"", spellings) for ids in group], pa.string())
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), out], ["doc_id", "ids", "text"])
                first += len(group)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op13_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return decode(encode(read_table(spark, folder, "documents"), path), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
