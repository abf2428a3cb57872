"""BPE round trip and token files against the tokenizers library itself."""

import zlib

import numpy as np
import pytest
from cases import LONG, ODD, clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm import bpe, queries, token_files
from tidemark.session import new_folder

WORD, BYTE = (queries.tokenizer_file(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
WORDS, BYTES = (Tokenizer.from_file(p) for p in (WORD, BYTE))
TEXT = st.text(st.sampled_from("ab'stle .,!\n\t   \x1c\x02é好̈ΣI0") | st.characters(codec="utf-8"), max_size=80)


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_chunked_ids_equal_whole_ids(texts):
    encoder = bpe.ChunkEncoder(WORDS)
    assert [x.tolist() for x in encoder.encode_batch(texts)] == [plain(WORDS, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_piecewise_ids_equal_whole_ids(texts):
    ids, lengths = token_files.PieceEncoder(BYTES).encode_batch(texts)
    parts = np.split(ids, np.cumsum(lengths)[:-1]) if texts else []
    assert [x.tolist() for x in parts] == [plain(BYTES, t) for t in texts]


SHARED = token_files.PieceEncoder(BYTES)
SPACED = st.text(st.sampled_from("ab'stmdrevl '  \n\t\r1२½.!_|\xa0\x85\x1c\u2028\u3000\x00ßé́ñ好ʼ’ǅ🙂"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(SPACED, max_size=5))
def test_words_are_cut_as_the_tokenizer_cuts(texts):
    words, counts = SHARED._cut(texts)
    got = iter(w.decode() for w in words.to_pylist())
    for text, n in zip(texts, counts.tolist()):
        want = [text[a:b] for _, (a, b) in BYTES.pre_tokenizer.pre_tokenize_str(text)]
        assert [next(got) for _ in range(n)] == want


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **kwargs):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **kwargs)


def test_long_white_space_and_punctuation_do_not_ask_for_whole_texts():
    texts = ["  it's\t a word,\n\n a word. " * 500, "word; word: (word) word!\r\n" * 500]
    counting = Counting(BYTES)
    encoder = token_files.PieceEncoder(counting)
    ids, lengths = encoder.encode_batch(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [plain(BYTES, t) for t in texts]
    assert counting.given == 0 and len(encoder.words.number) < 30


def test_other_tokenizers_encode_whole_texts():
    texts = ["ab ab! é", "", "  abab", None, "<s>ab ab"]
    for prefix, regex in ((False, True), (True, True), (False, False)):
        tokenizer = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "Ġ": 2, "ab": 3, "Ġab": 4}, merges=[("a", "b"), ("Ġ", "ab")]))
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=prefix, use_regex=regex)
        tokenizer.add_special_tokens(["<s>"])
        ids, lengths = token_files.PieceEncoder(tokenizer).encode_batch(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [plain(tokenizer, t) for t in texts]


def test_small_chunks_are_reused_and_repaired(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BITS", 4)
    monkeypatch.setattr(bpe, "CHUNK_MAX", 40)
    texts = [t for _, t in ODD] + [LONG[:3000], "prefix " + LONG[:3000]]
    encoder = bpe.ChunkEncoder(WORDS)
    assert [x.tolist() for x in encoder.encode_batch(texts)] == [plain(WORDS, t) for t in texts]
    assert encoder.reused > 100 and encoder.repaired > 10


def test_words_are_let_go(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    encoder = bpe.ChunkEncoder(WORDS)
    for i in range(6):
        text = " ".join(f"word{j} common" for j in range(i * 7, i * 7 + 9))
        assert encoder.encode_batch([text])[0].tolist() == plain(WORDS, text)
    assert len(encoder.pieces.number) <= 25


def test_roundtrip_table(documents):
    df = clashing(documents(ODD))
    out = bpe.roundtrip(df, WORD)
    assert out.columns == [*df.columns, "_ids", "_decoded"]
    got = {r["doc_id"]: (r["_ids"], r["_decoded"]) for r in out.collect()}
    for key, text in ODD:
        ids = plain(WORDS, text)
        assert got[key] == (ids, WORDS.decode(ids, skip_special_tokens=False))
    assert bpe.roundtrip(documents([]), WORD).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3) | st.just(0), max_size=300))
def test_pack_and_unpack(values):
    values = np.array(values * 5, np.uint64)
    assert (token_files.unpack(*token_files.pack(values), len(values)) == values).all()


def test_blocks_can_be_read_alone():
    values = np.random.default_rng(1).integers(0, 50_000, 5_000).astype(np.uint64)
    words, firsts, escaped = token_files.pack(values)
    part = token_files.unpack(words[firsts[2]:firsts[3]], np.zeros(1, np.uint32), escaped, token_files.BLOCK)
    assert (part == values[2 * token_files.BLOCK:3 * token_files.BLOCK]).all()


def test_bad_segments_are_refused():
    with pytest.raises(ValueError):
        token_files.read_segment(b"\0" * 64)


def test_token_files(spark, documents):
    rows = [*ODD, (12, "tie again"), (None, "no id"), *[(i, f"text {i} " * (i % 7)) for i in range(1000, 1300)]]
    path = new_folder(spark, "tokens")
    token_files.write_tokens(clashing(documents(rows)).repartition(5), path, BYTE)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r["key"] for r in got] == sorted((k for k, _ in rows), key=lambda k: -1 if k is None else k)
    start = 0
    want = {k: plain(BYTES, t) + [0] for k, t in rows if k != 12}
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["key"] == 12 or r["ids"] == want[r["key"]]
        start += r["n_tokens"]
    empty = new_folder(spark, "tokens")
    token_files.write_tokens(documents([]), empty, BYTE)
    assert token_files.read_tokens(spark, empty).count() == 0
