"""BPE and token files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailweave.llm import bpe, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library_on_random_texts(library):
    own = bpe.Bpe(PATH, leaf=16, long=40, remembered=50)
    rnd = random.Random(1)
    kinds = ["abcde", "ab  \n\t", "áéñßü漢字仮名", "a1 2.,!?'", "'s't're ", "<|endoftext|> x", "  \x1c\x85 a", "😀👍🏽 é", "of the "]
    for _ in range(600):
        alphabet = rnd.choice(kinds) + rnd.choice(kinds)
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(300)))
        if rnd.random() < 0.3:
            text += rnd.choice(["a", "ab", " ", "\n", "漢", "aB3"]) * rnd.randrange(300)
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode([text])[0]
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)
        some = [rnd.randrange(50257) for _ in range(9)]
        assert own.decode(np.array(some, "<u4").tobytes()) == library.decode(some, skip_special_tokens=False)


def test_halved_texts_equal_the_library(library):
    own = bpe.Bpe(PATH, leaf=16, long=40, remembered=50, halved=20)
    rnd = random.Random(2)
    kinds = ["abcde ", "ab  \n\t", "áéñßü漢字 ", "a1 2.,!?'", "'s't're ", "<|endoftext|> x", "  \x1c\x85 a", "😀👍🏽 é", "of the "]
    for _ in range(400):
        alphabet = rnd.choice(kinds) + rnd.choice(kinds)
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(600)))
        text += rnd.choice(["", " ", "word " * 30, "<|endoftext|> and <|endoftext|>" * 3, "x" * 90])
        got = own.encode([text, text[::-1]])
        for t, ids in zip([text, text[::-1]], got):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert own.joined > 5000


def test_halves_are_whole_and_even():
    for n in (0, 1, 4096, 4097, 9000, 100_001):
        parts = bpe.halves("ab" * (n // 2) + "c" * (n % 2), 4096)
        assert sum(map(len, parts)) == n and max(map(len, parts)) <= 4096 and max(map(len, parts)) - min(map(len, parts)) <= len(parts)


def test_texts_of_the_given_table_are_joined(library, docs):
    """Long documents, and the one without spaces, go through the trees."""
    own = bpe.Bpe(PATH)
    texts = [r.text or "" for r in docs.select("text").collect()]
    long_ones = [t for t in texts if len(t) > bpe.TEXT]
    found = own.encode(texts)
    assert len(long_ones) > 10 and own.joined == sum(len(bpe.halves(t, bpe.TEXT)) - 1 for t in long_ones)
    for t, ids in zip(texts, found):
        if len(t) > bpe.TEXT:
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    own.encode(["漢字かな交じり文" * 2000])
    assert own.joined_tokens > 10


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_round_trip(request, library, name):
    df = request.getfixturevalue(name)
    out = bpe.decode_ids(bpe.encode_texts(df)).select("text", "ids", "decoded").collect()
    assert len(out) == df.count()
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_token_files(request, library, tmp_path, name):
    df = request.getfixturevalue(name)
    index = token_files.write_token_files(df, str(tmp_path / "out"), length=64)
    found = {}
    for r in token_files.read_token_files(index).orderBy("start").collect():
        found.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids))
    at = 0
    rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = {}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4").tobytes())
    for doc, parts in want.items():
        assert sorted(parts) == sorted(ids for *_, ids in found[doc])
        for start, n, ids in sorted(found[doc]):
            assert start == at and len(ids) == 4 * n
            at += n


def test_sequences_are_views_and_masks_mark_padding(spark, docs, tmp_path):
    index = token_files.write_token_files(docs, str(tmp_path / "out"), length=128)
    for file, total in index.groupBy("file").agg(F.sum("n_tokens")).collect():
        reader = token_files.SequenceReader(file)
        before = pa.total_allocated_bytes()
        rows = sum(reader.file.get_batch(b).num_rows for b in range(reader.file.num_record_batches))
        ids, mask = reader.sequence(rows - 1)
        assert pa.total_allocated_bytes() == before and len(ids) == len(mask) == 128
        assert rows == -(-total // 128) and sum(mask.to_pylist()) == (total - 1) % 128 + 1
        assert zlib.crc32(ids.tobytes()) is not None
        reader.close()


def test_empty_table(none, tmp_path):
    assert bpe.decode_ids(bpe.encode_texts(none)).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(none, str(tmp_path / "out"))).count() == 0
