import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from agroflow.llm.bpe import TOKENIZER, Merges, PrefixTrie, WordEncoder, byte_letters, decode, decoded, encode, op13_trie_bpe, token_spellings
from agroflow.llm.common import read_table

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return WordEncoder(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def got(coder, group):
    return [np.frombuffer(x, "<u4").tolist() for x in coder.encode(group)]


def test_every_character_is_cut_and_encoded_as_by_the_library(library, coder):
    points = [chr(c) for c in range(1, 0x110000, 3) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(1, 0x500)]
    probes = [f"a{c}1 {c}{c}b" for c in points]
    wanted = [e.ids for e in library.encode_batch_fast(probes, add_special_tokens=False)]
    for first in range(0, len(probes), 20_000):
        assert got(coder, probes[first : first + 20_000]) == wanted[first : first + 20_000]


def test_words_of_random_letters_and_special_tokens(library, coder):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdeinorstu'AÉ 0!?=", k=rng.randint(0, 80))) for _ in range(3000)]
    texts += [
        "<|startoftext|>Hello<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|ENDOFTEXT|> <|endoftext", "it's we'LL I'd 's'T",
        "İΣΑΣ ΟΔΟΣ ﬀ ǅ", "é é ä̈", "日本語 文字 कि क्ष", "a b c​d\x85e\x1cf", "½²Ⅷ 1234", "", " \n\t",
    ]
    assert got(coder, texts) == [ids_of(library, t) for t in texts]
    for text in texts:
        ids = ids_of(library, text)
        assert decoded(np.array(ids, "<u4").tobytes(), token_spellings(PATH)) == library.decode(ids, skip_special_tokens=False)


def test_very_long_words_are_encoded_whole(library, coder):
    rng = random.Random(1)
    texts = ["=" * 30_000, "".join(rng.choices("thean", k=20_000)), "ab" * 5000 + " " + "ab" * 5000 + "c"]
    assert got(coder, texts) == [ids_of(library, t) for t in texts]


def test_a_full_trie_is_renewed(library):
    small = WordEncoder(PATH, trie_nodes=50)
    for text in ("the quick brown fox", "the quicker browner fox", "jumps over the lazy dog") * 3:
        assert got(small, [text]) == [ids_of(library, text)]
        assert len(small.trie) <= 50 + len(text)


def test_shared_prefixes_are_worked_out_once(coder):
    trie = PrefixTrie(coder.merges)
    trie.encode([b"international"])
    nodes = len(trie)
    trie.encode([b"internationally", b"international"])
    # Only two "l" that do not end the word, and "y" that does, are new.
    assert len(trie) == nodes + 3


def test_a_token_that_never_arises_is_not_used():
    # "bc" merges before "ab", so "ab" + "c" is never made.
    vocabulary = {c: i for i, c in enumerate(byte_letters())}
    vocabulary |= {c + "</w>": 256 + i for i, c in enumerate(byte_letters())}
    for made in ("bc", "ab", "abc"):
        vocabulary[made] = len(vocabulary)
    merges = Merges(vocabulary, [("b", "c"), ("a", "b"), ("ab", "c")])
    ids = np.frombuffer(PrefixTrie(merges).encode([b"abcd"])[b"abcd"], "<u4").tolist()
    assert ids == [vocabulary["a"], vocabulary["bc"], vocabulary["d</w>"]]


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op13_trie_bpe(spark, folder).collect()}
    docs = read_table(spark, folder, "documents").collect()
    assert len(docs) == len(rows)
    for d in docs:
        ids = ids_of(library, d["text"] or "")
        row = rows[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_clashes_and_empty_tables(spark, library):
    docs = spark.createDataFrame(
        [(1, None, "x", 1), (2, "", "y", 2), (3, "Two words", "z", 3), (3, "Two words", "z", 3), (None, "null id", "w", 4)],
        "doc_id long, text string, ids string, n_tokens int",
    )
    rows = decode(encode(docs, PATH), PATH).collect()
    found = sorted((r["doc_id"] is None, r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in rows)
    two, null = ids_of(library, "Two words"), ids_of(library, "null id")
    assert found == [(False, 1, [], ""), (False, 2, [], ""), (False, 3, two, library.decode(two)), (False, 3, two, library.decode(two)),
                     (True, None, null, library.decode(null))]
    assert decode(encode(docs.limit(0), PATH), PATH).collect() == []


def test_what_a_worker_remembers_is_bounded():
    rng = random.Random(3)
    groups = [[" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(4000))] for _ in range(20)]
    coder = WordEncoder(PATH)
    coder.encode(["a warm start"])
    tracemalloc.start()
    try:
        for group in groups:
            coder.encode(group)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # All prefixes of these words took over 100 MB.
    assert peak < 70e6


def test_forgotten_words_are_encoded_again(library, monkeypatch):
    monkeypatch.setattr("agroflow.llm.bpe.CODE_BYTES", 1000, raising=False)
    small = WordEncoder(PATH, trie_nodes=50)
    for text in ("the quick brown fox", "the quicker browner fox <|endoftext|>", "jumps over the lazy dog", "naïve façade 12") * 3:
        assert got(small, [text]) == [ids_of(library, text)]
        assert len(small.codes) < 20


def test_groups_of_any_size_decode_alike(spark, library):
    rows = [(i, None if i == 2 else np.array(ids_of(library, f"some words, number {i}" * i), "<u4").tobytes()) for i in range(6)]
    encoded = spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1)
    wanted = {i: library.decode([] if ids is None else np.frombuffer(ids, "<u4").tolist()) for i, ids in rows}
    for size in (1, 40, 1 << 20):
        assert {r["doc_id"]: r["text"] for r in decode(encoded, PATH, group_bytes=size).collect()} == wanted
