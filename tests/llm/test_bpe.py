import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
OURS = bpe.Encoder(bpe.read_tokenizer(PATH))
PIECES = st.sampled_from(["the", "ing", "'s", "'S", "''", " ", "\n", "\x1c", "\x85", "aaaa", "!!", "...", "<|endoftext|>",
                          "<|startoftext|>", "ΣΑΣ", "İ", "é", "é", "½", "你好", "𝔘", "_", "123", "Straße", "-="])


def _same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = OURS.encode(text)
    assert got == want
    assert OURS.decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES | st.text(max_size=4), max_size=12))
def test_agrees_with_the_library(parts):
    _same("".join(parts).encode("utf-8", "ignore").decode())


@settings(max_examples=200, deadline=None)
@given(st.text("abthein", min_size=1, max_size=60))
def test_agrees_on_long_words(text):
    _same(text)


def test_every_token_encodes_to_itself():
    wrong = [i for i, t in OURS.strings.items() if t.endswith("</w>") and t.isascii()
             and OURS.encode_word(t[:-4].encode()) != [i]]
    assert not wrong


def test_suffix_automaton_lists_all_tokens_that_end():
    tokens = {0: [1], 1: [2], 2: [1, 2], 3: [2, 1, 2], 4: [2, 2]}
    sam = bpe.SuffixAutomaton(tokens)
    state = 0
    for c in (2, 1, 2):
        state = sam.edges[state][c]
    assert [t for t, _ in sam.ending[state]] == [3, 2, 1]


def test_cache_keeps_a_bound_of_keys():
    calls = []
    cache = bpe._Recent(lambda k: calls.append(k) or k, bound=4)
    for k in "abcabcdefga":
        assert cache[k] == k
    assert len(cache) + len(cache.old) <= 4 and len(calls) > 7


def test_digests_and_defined_cases(spark, odd_docs, no_docs):
    rows = bpe.encode_digests(odd_docs, PATH).collect()
    assert len(rows) == 12
    for r in rows:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    full = bpe.encode(odd_docs.where("doc_id = 7"), PATH).first()
    assert OURS.decode(full.ids) == full.decoded and len(full.ids) == 10
    assert bpe.encode_digests(no_docs, PATH).count() == 0
