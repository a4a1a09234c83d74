import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lexispark.llm import bpe_units as bpe
from lexispark.llm import pieces
from lexispark.llm import spans as sp
from lexispark.llm.queries import QUERIES

from .helpers import frame, odd_rows, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def model():
    return bpe.BytePairs(PATH)


def encoded(model, texts):
    raw, offsets = sp.bytes_of(pa.array(texts, pa.string()))
    ids, count = model.encode(raw, offsets)
    return np.split(ids, np.cumsum(count)[:-1]), ids, count


def test_ids_and_decoded_texts_equal_the_librarys(model, library):
    random.seed(7)
    parts = [END, END[:-1], END[1:], "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "漢", "1", "23", "²", "!", "'", "...", "\xa0", "\x85", "\x1c", " don't", "'S", "\U0001f44d", "_", "\0", "�", "the", "ing", "ation"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(4000)]
    texts += [None, "", "a" * 3000, "abcab" * 1000, "e" * 999 + "é" * 999, "=" * 5000, " " * 4000 + "x", END + END]
    got, ids, count = encoded(model, texts)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in got] == want
    assert model.decode(ids, count) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_any_ids_decode_as_by_the_library(model, library):
    random.seed(8)
    runs = [[random.randrange(50257) for _ in range(random.randint(0, 12))] for _ in range(2000)]
    flat = np.array([i for r in runs for i in r], np.int32)
    assert model.decode(flat, np.array([len(r) for r in runs])) == [library.decode(r, skip_special_tokens=False) for r in runs]
    assert model.decode(np.array([64, 99999, -1, 65], np.int32), np.array([0, 2, 0, 1, 1, 0])) == ["", "a", "", "", "b", ""]


def by_scanning(model, data):
    """The plain rule: merge the leftmost pair of least rank until there is none."""
    s = [model.byte_ids[b] for b in data]
    while True:
        ranks = [(model.rank.get(a * model.width + b, 1 << 60), i) for i, (a, b) in enumerate(zip(s, s[1:], strict=False))]
        r, i = min(ranks, default=(1 << 60, 0))
        if r == 1 << 60:
            return s
        s[i : i + 2] = [model.made[r]]


def test_merges_equal_repeated_scanning(model):
    random.seed(9)
    for _ in range(500):
        data = "".join(random.choice("aabceinrst é") for _ in range(random.randint(1, 60))).encode()
        assert model.merged(data) == by_scanning(model, data)


def test_a_long_text_without_blanks(model, library):
    text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=300_000))
    got, _, _ = encoded(model, [text, "short"])
    assert got[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_units_do_not_stay(monkeypatch):
    monkeypatch.setattr(pieces, "IDS", 10_000)
    cache = pieces.PieceCache()
    for i in range(50):
        ids, _ = cache.encode(np.array([i], np.uint64), lambda places: [[1] * 5000 for _ in places])
        assert len(ids) == 5000 and len(cache.ids) <= 15_000


def test_odd_rows(spark, library):
    data = odd_rows()
    got = bpe.encode_decode(frame(spark, data), PATH).collect()
    want = sorted((str(r[0]), np.array(library.encode(r[1] or "", add_special_tokens=False).ids, "<u4").tobytes(), r[1] or "") for r in data)
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got) == want
    ids = bpe.encode(frame(spark, data), PATH)
    assert sorted((str(r.doc_id), np.array(r.ids, "<u4").tobytes()) for r in ids.collect()) == [w[:2] for w in want]
    assert sorted((str(r.doc_id), r.decoded) for r in bpe.decode(ids, PATH).collect()) == sorted((w[0], w[2]) for w in want)
    odd = spark.createDataFrame([(1, None), (2, [64, None, 65]), (3, [])], "doc_id int, ids array<bigint>")
    assert sorted(map(tuple, bpe.decode(odd, PATH).collect())) == [(1, ""), (2, "ab"), (3, "")]
    assert bpe.encode_decode(frame(spark, []), PATH).count() == 0 and bpe.encode_decode(frame(spark, rows(["a"])), PATH).columns == ["doc_id", "ids", "decoded"]


def test_query_over_the_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((d.doc_id, len(ids), digest, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    df = QUERIES["op12_bpe"](spark, sf_dir)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_other_kinds_of_files_are_refused(tmp_path):
    with pytest.raises((ValueError, KeyError)):
        bpe.BytePairs(public_tokenizers.path("word_bpe_49k.json"))
