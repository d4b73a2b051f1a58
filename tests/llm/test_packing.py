import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from agroflow.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


RANKS = public_tokenizers.path(packing.RANKS)


def test_fast_encoder_equals_the_tokenizer():
    rng = random.Random(1)
    alphabet = ["a", "b", "é", " ", " ", "\n", "  ", "\t", "'s", "'ll", "1", "23", ".", "<|endoftext|>", " ", "日本", "_", "\r\n", "#", "I'm", "\x85", "\u2028"]
    items = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["", " ", "a ", " a"]
    plain_characters = [*range(0x250), *range(0x2010, 0x203B), 0x20AC]
    for c in map(chr, plain_characters):
        items += [c, f"a{c}a", f" {c} ", f"1{c}{c}1", f".{c}.", f"'{c}", f"{c}'s", f"\n{c}\n", f"a {c}a", f"a{c} a"]
    plain = Tokenizer.from_file(PATH)
    fast = packing.TokenEncoder(PATH, RANKS)
    slow = packing.TokenEncoder(PATH, None)
    for text in items:
        wanted = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert fast.encode(text) == wanted and slow.encode(text) == wanted


def check_layout(rows, capacity):
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_plan_is_valid_and_tight():
    rng = random.Random(4)
    for trial in range(40):
        capacity = rng.choice([12, 100, 1024])
        counts = {s: rng.randrange(1, 30) for s in rng.sample(range(1, capacity + 1), min(capacity, rng.randrange(1, 90)))}
        placements = packing.plan(counts, capacity)
        fill, used, ranks = defaultdict(int), defaultdict(list), defaultdict(set)
        large = defaultdict(int)
        for p in placements:
            for i in range(p.n):
                assert p.rank + i not in ranks[p.length]
                ranks[p.length].add(p.rank + i)
                used[p.sequence + i // p.each].append((p.offset + i % p.each * p.length, p.length))
                large[p.sequence + i // p.each] += 3 * p.length > capacity
        assert {s: len(r) for s, r in ranks.items()} == counts
        assert all(max(r) == len(r) - 1 for r in ranks.values())
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert max(large.values(), default=0) <= 2
        # Best-fit decreasing item by item needs no fewer sequences.
        gaps = []
        for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            fits = [g for g in gaps if g >= s]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - s)
            else:
                gaps.append(capacity - s)
        assert len(used) <= len(gaps) * 1.02 + 1


def test_pieces_and_checksums(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "sun", "über", "x1", "\n"]) for _ in range(rng.choice([1, 50, 900, 4000])))) for i in range(40)]
    rows += [(100, None), (101, ""), (101, ""), (None, "a b")]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, part int, length int")
    got = packing.pack(df.repartition(3)).collect()
    check_layout(got, 1024)
    plain = Tokenizer.from_file(PATH)
    wanted = []
    for doc_id, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    key = lambda t: (t[0] is None, t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(wanted, key=key)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
