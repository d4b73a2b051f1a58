"""Toxicity of restored text: obfuscated spellings are decoded first, then the words are scored.

A noisy-channel decoder reads spans that look disguised (digits and signs among letters, letters set apart,
letters repeated) as a lattice of intended letters and takes the likeliest path under a character trigram
model of the whole corpus. The evidence of a text is its most telling word: a word counts with a careful estimate
of the share of toxic documents among the labelled ones that have it, or one of its beginnings. How likely a text
with so much evidence is toxic is read off the labelled texts, each judged without its own label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, texts

THRESHOLD = 0.7
#: Expected number of labelled rows at most that the words' shares are learned from, chosen by a hash.
FIT_ROWS = 100_000
#: Lengths of the word beginnings that are scored beside the word.
BEGINNINGS = (4, 5, 6, 7)
#: Rows that the base rate weighs, deviations taken off a share, and the mean share that a telling word needs.
PRIOR_ROWS, CAUTION, FAINT = 1.0, 0.5, 0.25
#: Steps of evidence in which the labelled texts are counted.
BINS = 2000
#: Spans and words that a task remembers; a bound on memory, it changes no result.
REMEMBERED = 200_000
#: Characters counted in one step, of the same kind.
COUNTED_AT_ONCE = 500_000
#: Rows that are judged, and handed on, at once.
STEP_ROWS = 250

# Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e",
}
SEPARATORS = " .-_*\n"
#: What stands apart from a word's end as a mark of its own, and other signs, which may be its last letter.
_MARKS = "!"
_LAST = "".join(c for c in SIGNS if not c.isdigit() and c not in _MARKS)
#: Chances that a separator among letters set apart parts words, and that a last sign is meant as it is.
PARTS_WORDS, LAST_AS_IS = 0.2, 0.4

#: Letters of the character model: a-z and those of Latin-1; code 0 is everything else.
LETTERS = "".join(c for c in map(chr, range(0x61, 0x100)) if c.isalpha() and c == c.lower())
SIZE = len(LETTERS) + 1
_CODE = np.zeros(1 << 16, np.int64)
_CODE[[ord(c) for c in LETTERS]] = np.arange(1, SIZE)
_CODE_OF = {c: i + 1 for i, c in enumerate(LETTERS)}

# Letters, without the few number signs that Python counts among word characters in Latin-1.
_LETTER = "[^\\W\\d_²³¹¼½¾]"
_SIGN = "[" + re.escape("".join(SIGNS)) + "]"
_MIXED = re.compile(f"{_SIGN}{_LETTER}|{_LETTER}[0-9{re.escape(_LAST)}]")
_TOKEN = re.compile(f"(?:{_LETTER}|{_SIGN})+")
_BETWEEN = f"[{re.escape(SEPARATORS)}]"
_APART = re.compile(rf"(?<!\w)(?:(?:{_LETTER}|{_SIGN}){_BETWEEN}{{1,3}}){{3,}}(?:{_LETTER}|{_SIGN})(?!\w)")
_RUN = re.compile(f"{_BETWEEN}+")
_REPEATED = re.compile(rf"({_LETTER})\1\1")
_WORD = re.compile(f"{_LETTER}+")


def _classes(letter: bytes, digit: bytes, sign: bytes, separator: bytes) -> bytes:
    """A Latin-1 translation table to classes of characters; all others become spaces."""
    table = bytearray(b" " * 256)
    for c in range(256):
        if chr(c).isalpha():
            table[c] = letter[0] if letter else c
        elif chr(c) in SIGNS:
            table[c] = (digit if chr(c).isdigit() else b"m" if chr(c) in _MARKS and sign == b"s" else sign)[0]
        elif chr(c) in SEPARATORS:
            table[c] = separator[0]
    return bytes(table)


_KINDS = _classes(b"l", b"d", b"s", b" ")
_SPACING = _classes(b"l", b"l", b"l", b".")
_WORDS = _classes(b"", b" ", b" ", b" ")
_IS_LETTER = np.array([chr(c).isalpha() for c in range(256)])


def may_be_disguised(lowered: str) -> bool:
    """False only if no span of the text can look disguised; a quick test for texts in Latin-1."""
    try:
        raw = lowered.encode("latin-1")
    except UnicodeEncodeError:
        return True
    kinds = raw.translate(_KINDS)
    if any(pair in kinds for pair in (b"sl", b"ml", b"ls", b"dl", b"ld")):
        return True
    # Up to three separators in a row, and some more, count as one.
    if b"l.l.l.l" in raw.translate(_SPACING).replace(b"..", b".").replace(b"..", b"."):
        return True
    codes = np.frombuffer(raw, np.uint8)
    thrice = (codes[1:-1] == codes[:-2]) & (codes[1:-1] == codes[2:])
    return bool(_IS_LETTER[codes[1:-1][thrice]].any())


def words_of(restored: str) -> set[bytes]:
    """The different words of a text, runs of letters; in Latin-1 if that holds them."""
    try:
        return set(restored.encode("latin-1").translate(_WORDS).split())
    except UnicodeEncodeError:
        pass
    found = set()
    for word in _WORD.findall(restored):
        try:
            found.add(word.encode("latin-1"))
        except UnicodeEncodeError:
            found.add(word.encode())
    return found


def _trigrams(items: list[str]) -> np.ndarray:
    joined = "\n\n".join(["", *items, ""]).lower()
    codes = _CODE[np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)]
    return np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of the letter trigrams of all rows; SIZE ** 3 numbers, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                held.append(text.as_py())
                size += len(held[-1])
                if size > COUNTED_AT_ONCE:
                    counts += _trigrams(held)
                    held, size = [], 0
            counts += _trigrams(held)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["gram", "n"])

    seen = texts(docs).select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3)
    for gram, n in seen.collect():
        counts[gram] = n
    return counts


class Decoder:
    """The likeliest intended text of a disguised span."""

    def __init__(self, counts: np.ndarray, smooth: float = 0.05):
        cube = counts.reshape(SIZE, SIZE, SIZE)
        self._log = np.log((cube + smooth) / (cube.sum(2, keepdims=True) + smooth * SIZE)).astype(np.float32)
        self._spans: dict[str, str] = {}

    def options(self, span: str, at: int, tail: int | None = None) -> list[tuple[str, float]]:
        """(intended character or none, log probability of the disguise) of one character; last signs begin at ``tail``."""
        c = span[at]
        tail = len(span.rstrip(_LAST)) if tail is None else tail
        if c in SEPARATORS:
            return [("", math.log(1 - PARTS_WORDS)), (" ", math.log(PARTS_WORDS))]
        if c in SIGNS:
            as_is = LAST_AS_IS if at >= tail else 0.1
            meant = [(letter, math.log((1 - as_is) / len(SIGNS[c]))) for letter in SIGNS[c]]
            return [*meant, (c, math.log(as_is))]
        if at and span[at - 1] == c:
            return [(c, math.log(0.5)), ("", math.log(0.5))]
        return [(c, 0.0)]

    def decode(self, span: str) -> str:
        layers: list[dict] = []
        states, tail = {(0, 0): 0.0}, len(span.rstrip(_LAST))
        for at in range(len(span)):
            options = [(text, _CODE_OF.get(text, 0), p) for text, p in self.options(span, at, tail)]
            nexts: dict = {}
            for state, score in states.items():
                for text, code, p in options:
                    to = (state[1], code) if text else state
                    total = score + p + (float(self._log[state[0], state[1], code]) if text else 0.0)
                    if to not in nexts or total > nexts[to][0]:
                        nexts[to] = (total, state, text)
            layers.append(nexts)
            states = {to: found[0] for to, found in nexts.items()}
        state = max(states, key=lambda s: states[s] + float(self._log[s[0], s[1], 0]))
        out = []
        for layer in reversed(layers):
            _, state, text = layer[state]
            out.append(text)
        return "".join(reversed(out))

    def _remembered(self, span: str) -> str:
        # Exclamation marks at the end are punctuation.
        span, after = span.rstrip(_MARKS), span[len(span.rstrip(_MARKS)) :]
        if span not in self._spans:
            if len(self._spans) > REMEMBERED:
                self._spans.clear()
            self._spans[span] = self.decode(span)
        return self._spans[span] + after

    def restore(self, text: str) -> str:
        """The text in lower case with every disguised span decoded."""
        text = text.lower()
        if not may_be_disguised(text):
            return text
        text = _APART.sub(lambda m: self._remembered(_RUN.sub(" ", m[0])), text)
        for disguise, whole in ((_MIXED, _TOKEN), (_REPEATED, _WORD)):
            text = self._replaced(text, disguise, whole)
        return text

    def _replaced(self, text: str, disguise: re.Pattern, whole: re.Pattern) -> str:
        """Every run of ``whole`` characters that holds a disguise, decoded."""
        out, at = [], 0
        for match in disguise.finditer(text):
            start = match.start()
            if start < at:
                continue
            while start > at and whole.match(text[start - 1]):
                start -= 1
            end = whole.match(text, start).end()
            out += [text[at:start], self._remembered(text[start:end])]
            at = end
        return "".join([*out, text[at:]])


def features(word: bytes) -> list[bytes]:
    return [word + b"$", *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def careful_share(toxic: int, n: int, prior: float) -> float:
    share = (toxic + PRIOR_ROWS * prior) / (n + PRIOR_ROWS)
    return share - CAUTION * math.sqrt(share * (1 - share) / (n + PRIOR_ROWS + 1))


def words_evidence(words: set[bytes], counts: dict[bytes, tuple[int, int]], heads: Collection[bytes], prior: float, own: int | None = None) -> float:
    """The largest careful share of a telling feature, 0 without one. ``own`` is the label of a text that the
    counts hold, which is taken out of them."""
    best = 0.0
    for word in words:
        if word[: BEGINNINGS[0]] in heads:
            for feature in features(word):
                toxic, n = counts.get(feature, (0, 0))
                if own is not None:
                    toxic, n = toxic - own, n - 1
                if toxic > 0:
                    best = max(best, careful_share(toxic, n, prior))
    return best


def isotonic(toxic: np.ndarray, n: np.ndarray) -> tuple[list[float], list[float]]:
    """Corners (evidence, share of toxic) of the rising curve that fits the counts of each step best."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(n):
        blocks.append([toxic[i], n[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t, m, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + m, blocks[-1][2], last]
    places = [(x + 0.5) / len(n) for block in blocks for x in block[2:]]
    return places, [block[0] / block[1] for block in blocks for _ in range(2)]


class Scorer:
    """Scores of restored texts from counts (toxic, all) of labelled texts by feature and a calibration curve."""

    def __init__(self, counts: dict[bytes, tuple[int, int]], prior: float):
        self.counts, self.prior = counts, prior
        self._set_shares({f: careful_share(toxic, n, prior) for f, (toxic, n) in counts.items()})
        self.curve: tuple[list[float], list[float]] = ([0.0], [0.0])

    def _set_shares(self, shares: dict[bytes, float]) -> None:
        self.shares = shares
        # A telling word begins like one of its features; with the largest share of these.
        self.heads: dict[bytes, float] = {}
        for f, share in shares.items():
            head = f.removesuffix(b"$")[: BEGINNINGS[0]]
            self.heads[head] = max(share, self.heads.get(head, 0.0))

    def calibrate(self, curve: tuple[list[float], list[float]]) -> None:
        """Take the curve, and drop the counts and all features that leave a text at its lowest score."""
        self.curve = curve
        flat = max(x for x, y in zip(*curve) if y == curve[1][0])
        self._set_shares({f: share for f, share in self.shares.items() if share > flat})
        self.counts = {}

    def evidence(self, restored: str, own: int | None = None) -> float:
        words = words_of(restored)
        if own is not None:
            return words_evidence(words, self.counts, self.heads, self.prior, own)
        best, most, share = 0.0, self.heads.get, self.shares.get
        for word in words:
            if most(word[: BEGINNINGS[0]], 0.0) > best:
                best = max(best, *(share(f, 0.0) for f in features(word)))
        return best

    def score(self, restored: str) -> float:
        """The calibrated share of toxic texts; a thousandth of the evidence itself keeps ties apart."""
        found = self.evidence(restored)
        return 0.999 * float(np.interp(found, *self.curve)) + 0.001 * found


def learn(docs: DataFrame, labels: DataFrame, decoder: Decoder, fit_rows: int = FIT_ROWS) -> Scorer:
    """A scorer from the labelled rows that are not held out.

    A label is the largest of a doc_id's labels; null labels do not count. With more than ``fit_rows`` labelled
    rows, a hash of doc_id chooses about as many, which bounds what is learned and sent to the tasks.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    n, toxic = marked.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic:
        return Scorer({}, 0.0)
    if n > fit_rows:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))
    prior = toxic / n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            rows = [(f, n if label else 0, n) for label in (0, 1) for f, n in counts[label].items()]
            for c in counts:
                c.clear()
            columns = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()))], ["feature", "toxic", "n"]
            )

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                found = set()
                for word in words_of(decoder.restore(text.as_py())):
                    found.update(features(word))
                counts[label].update(found)
                if len(counts[0]) + len(counts[1]) > REMEMBERED:
                    yield flush()
        yield flush()

    # At most about fit_rows rows of two numbers.
    chosen = texts(docs).join(F.broadcast(marked), "doc_id").select("text", "toxic")
    seen = chosen.mapInArrow(count, "feature binary, toxic long, n long")
    share = (F.col("toxic") + PRIOR_ROWS * prior) / (F.col("n") + PRIOR_ROWS)
    counted = seen.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    telling = counted.filter("toxic >= 2").filter(share >= FAINT)
    scorer = Scorer({bytes(r["feature"]): (r["toxic"], r["n"]) for r in telling.collect()}, prior)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.zeros((2, BINS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                found = scorer.evidence(decoder.restore(text.as_py()), own=label)
                steps[label, min(BINS - 1, max(0, int(found * BINS)))] += 1
        used = np.flatnonzero(steps.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used.astype(np.int32), steps[1, used], steps.sum(0)[used])], ["step", "toxic", "n"])

    toxic_at, n_at = np.zeros(BINS), np.zeros(BINS)
    judged = chosen.mapInArrow(judge, "step int, toxic long, n long").groupBy("step").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    for r in judged.collect():
        toxic_at[r["step"]], n_at[r["step"]] = r["toxic"], r["n"]
    if n_at.any():
        scorer.calibrate(isotonic(toxic_at, n_at))
    return scorer


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, held_out, score, predicted.

    Only ``labels`` (doc_id, toxic) of rows that are not held out are learned from, and only texts are scored.
    Null and empty texts score like all without a telling word; without a toxic label every score is 0. Repeated rows come out as often as
    they go in; a row without a doc_id is scored, but never held out or learned from.
    """
    decoder = Decoder(trigram_counts(docs))
    scorer = learn(docs, labels, decoder, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(decoder.restore(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns, whatever their names.

    Null and empty texts are scored like all without a telling word; repeated rows share their fate, rows without a
    doc_id are scored like any other. An empty table stays empty; without toxic labels nothing goes.
    """
    decoder = Decoder(trigram_counts(docs))
    scorer = learn(docs, labels, decoder, fit_rows)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, STEP_ROWS):
                block = batch.slice(first, STEP_ROWS)
                yield block.filter(pa.array([scorer.score(decoder.restore(t.as_py() or "")) < threshold for t in block.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity_channel(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
