from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_rows import documents, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmart.llm import separators, token_files
from eventmart.llm.tokens import KNOWN, WORD, Encoder
from eventmart.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 15, 16, 17, 24, 31, 32])
def test_packing_is_exact_at_any_width(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 3 * token_files.BLOCK_IDS + 11).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits), bits, len(ids)) == ids).all()
    assert len(token_files.pack(ids[:8], bits)) == bits


def test_bits_for():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


def test_pieces_give_the_ids_of_the_whole_text():
    own, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["a  b", "a \nb c", "  x", "a\n b\n\n c ", "it's  <|endoftext|> here", "", " ", "　a 　b", "a\x1c b \x1cc", "x <|endoftext|> y<|endoftext|>", "Ġa Ġ Ġb", "don't 12 3 ab1\t\tq", "\U0001f600 \U0001f600‍ x"]
    for _ in range(2):  # the second time from the cache
        for t in texts:
            assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_those_of_the_pre_tokenizer():
    chars = [c for c in map(chr, range(0x20AD)) if KNOWN.fullmatch(c)]
    around = [f"{a}{c}{b}" for c in chars if c != " " for a in ("a", "1", ".", "\n", "'") for b in ("", "a", "1", ".", "\n\n", "\t1")]
    text = " ".join(["", *around, *(f"{a}'{b}" for a in ("", "x", ".", "1", "\n") for b in ("s", "st", "ll", "LL", "re.", "'ve", "d'm"))])
    plain = Tokenizer.from_file(PATH)
    assert WORD.findall(text) == [text[a:b] for _, (a, b) in plain.pre_tokenizer.pre_tokenize_str(text)]


def test_words_are_encoded_once_whatever_stands_around_them(monkeypatch):
    """Only what begins a text, and pieces with white space inside, go through the whole tokenizer."""
    own, plain, seen = Encoder(PATH), Tokenizer.from_file(PATH), []
    through, of_words = Encoder._ids, Encoder._words
    monkeypatch.setattr(Encoder, "_ids", lambda self, texts: seen.extend(texts) or through(self, texts))
    monkeypatch.setattr(Encoder, "_words", lambda self, words: seen.extend(words) or of_words(self, words))
    texts = ["a qwerzu qwerzu, b", "a qwerzu. (qwerzu) qwerzu\nqwerzu! b qwerzu,", "a qwerzu  qwerzu \nb qwerzu;"]
    got = [np.frombuffer(own.encode([t])[0], "<u4").tolist() for t in texts]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(seen) == sorted([*"aaa", " qwerzu", ",", " b", ".", " (", "qwerzu", ")", "\n", "!", " qwerzu ", " qwerzu \nb", ";"])


def expected(rows):
    plain, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    got = token_files.token_files(documents(rows), PATH, 2).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected(rows))


def test_null_ids_come_first_and_the_empty_table_has_no_file(documents, odd_rows, spark):
    got = token_files.token_files(documents(odd_rows), PATH, 2).collect()
    assert len(got) == len(odd_rows)
    assert {r.start for r in got if r.doc_id is None} == {0, min(r.start for r in got if r.doc_id is None and r.start)}
    assert token_files.token_files(documents([]), PATH, 2).count() == 0


def test_random_access(documents, spark):
    rows = [(i, f"text number {i} " * (i * 700 + 1)) for i in range(6)]
    manifest = token_files.write_token_files(documents(rows).coalesce(1), fresh_path(spark, "tokens"), PATH, 2)
    plain = Tokenizer.from_file(PATH)
    for f in manifest:
        reader = token_files.Reader(f["file"])
        assert reader.bits == 16
        for k in reversed(range(f["n_docs"])):
            text = rows[reader.doc_ids[k]][1]
            assert reader.document(k).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_separators(documents, odd_rows, spark):
    rows = [*odd_rows, (20, "<|endoftext|> is text")]
    got = separators.token_counts(documents(rows), PATH, 50256).collect()
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = sorted((r[0] or -1, len(plain.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == want
    assert separators.token_counts(documents([]), PATH, 50256).count() == 0


def test_documents_span_blocks(spark, tmp_path):
    """Any size of block gives the same counts, also for ids after the last separator."""
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 50, 5_000).astype("<u2")
    ids[1000:3000] = 7
    ids[-1] = 3
    ends = np.flatnonzero(ids == 9)
    path = tmp_path / "flat.bin"
    path.write_bytes(ids.tobytes())
    (tmp_path / "none.bin").write_bytes(np.full(10, 5, "<u2").tobytes())
    files = [(f"file://{path}", 10_000), (f"file://{tmp_path}/none.bin", 20)]
    for size in (2, 14, 1_000, 1 << 20):
        size = max(size, 20)
        rows = separators.scan_separators(spark, files, 9, block_bytes=size).withColumn("f", F.col("file").contains("none")).collect()
        own = sorted((r.ordinal, r.start, r.n_tokens, r.complete) for r in rows if not r.f)
        starts = [0, *(ends + 1).tolist()]
        want = [(k, s, int(e) - s + 1, True) for k, (s, e) in enumerate(zip(starts, ends.tolist()))]
        assert own == [*want, (len(ends), starts[-1], 5_000 - starts[-1], False)]
        assert [(r.ordinal, r.start, r.n_tokens, r.complete) for r in rows if r.f] == [(0, 0, 10, False)]
