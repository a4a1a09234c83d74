import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lexispark.llm import spans as sp
from lexispark.llm import token_records as tr

from .helpers import frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library_with_its_default_settings(library):
    random.seed(5)
    parts = [END, END, "<|", "|>", "endoftext", END[:-1], END[1:], " ", "  ", "\n", "a", "漢", "'s", "é", "1", "!", " don't"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(3000)] + [None, "", END, END + END, f"a {END} b", END[:5], END[5:]]
    encoder = tr.byte_encoder(PATH)
    for some in (texts, texts[-7:], ["no such string"]):
        raw, offsets = sp.bytes_of(pa.array(some))
        ids, count = encoder.encode(raw, offsets)
        for text, got in zip(some, np.split(ids, np.cumsum(count)[:-1]), strict=True):
            assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_records_of_a_text_with_an_added_token(spark, tmp_path, library):
    texts = [f"a {END} b", "after", END]
    folder = f"file:{tmp_path}/run"
    tr.write_records(frame(spark, rows(texts)), folder, PATH, end_id=2)
    got = tr.sequence_digests(tr.read_records(spark, folder)).orderBy("doc_id").collect()
    assert library.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    at = 0
    for r, text in zip(got, texts, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
