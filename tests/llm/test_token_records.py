import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lexispark.llm import spans as sp
from lexispark.llm import token_records as tr

from .helpers import frame, odd_rows, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_library(library):
    random.seed(3)
    parts = ["'s", "'re", "'ll", "'t", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "漢", "1", "23", "²", "!", "'", '"', "...", "\xa0", " ", "\x85", "\x1c", "<|endoftext|>", " don't", "'S", "'ve", "\U0001f44d", "́", "_", "'r"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(3000)] + [None, ""]
    raw, offsets = sp.bytes_of(pa.array(texts))
    ids, count = tr.ByteEncoder(PATH).encode(raw, offsets)
    for text, got in zip(texts, np.split(ids, np.cumsum(count)[:-1]), strict=True):
        assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_write_and_read(spark, tmp_path, library):
    data = odd_rows() + rows([f"text {i}, it's number {i}" for i in range(40)], 100)
    folder = f"file:{tmp_path}/run"
    offsets = tr.write_records(frame(spark, data), folder, PATH, end_id=2)
    records = tr.read_records(spark, folder)
    got = records.orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in data), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at and r.ids[-1] == 2
        at += len(r.ids)
    want = sorted((str(r[0]), library.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in data)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    digests = {(r.start, r.n_tokens, r.ids_crc32) for r in tr.sequence_digests(records).collect()}
    assert digests == {(r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    shuffled = tr.shuffled_reads(offsets, folder, 5).collect()
    assert sorted((str(r.doc_id), r.ids) for r in shuffled) == want


def test_files_without_a_place_in_the_table_are_not_read(spark, tmp_path):
    folder = f"file:{tmp_path}/run"
    tr.write_records(frame(spark, rows(["a", "b"])), folder, PATH, end_id=2)
    (tmp_path / "run/data/tokens-000000-lost.bin").write_bytes(b"half a record")
    assert tr.read_records(spark, folder).count() == 2


def test_damage_is_found(spark, tmp_path):
    folder = f"file:{tmp_path}/run"
    tr.write_records(frame(spark, rows(["some words of text"])), folder, PATH, end_id=2)
    (name,) = glob.glob(f"{tmp_path}/run/data/*.bin")
    whole = open(name, "rb").read()
    for at in (2, 9, 14, len(whole) - 2):
        broken = bytearray(whole)
        broken[at] ^= 1
        open(name, "wb").write(broken)
        with pytest.raises(ValueError, match="record|checksum"), open(name, "rb") as f:
            tr.unframed(f)


def test_empty_table(spark, tmp_path):
    folder = f"file:{tmp_path}/run"
    assert tr.write_records(frame(spark, []), folder, PATH, end_id=2).count() == 0
    assert tr.read_records(spark, folder).count() == 0
