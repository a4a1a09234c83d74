import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from lexispark.llm import sentencepiece_units as su
from lexispark.llm import spans as sp

from .helpers import frame, odd_rows, rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["s", "re", " ", "  ", "\n", "\t", "a", "é", "ß", "漢", "字", "1", "²", "!", "the", " don't", "\U0001f44d", "́", "_", "tion", "    ", "Ж", "\xa0", "pre", "ing"]


def varied(n, seed):
    random.seed(seed)
    return ["".join(random.choice(PARTS) for _ in range(random.randint(0, 40))) for _ in range(n)]


def encoded(model, texts):
    raw, offsets = sp.bytes_of(pa.array(texts))
    ids, count = model.encode(raw, offsets)
    return ids, count, [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


def best_score(model, pieces, text):
    """Highest sum of scores over all segmentations of a text with the marker for blanks, by plain recursion over characters."""
    best = [0.0] + [-np.inf] * len(text)
    for p in range(len(text)):
        if (text[p]) not in pieces:
            best[p + 1] = max(best[p + 1], best[p] + float(model.unknown))
        for q in range(p + 1, min(len(text), p + 16) + 1):
            if text[p:q] in pieces:
                best[q] = max(best[q], best[p] + float(model.scores[pieces[text[p:q]]]))
    return best[-1]


def test_best_segmentation():
    import sentencepiece

    model, file = su.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = {file.id_to_piece(i): i for i in range(259, file.get_piece_size())}
    texts = [t for t in varied(400, 4) if t]
    _, _, got = encoded(model, texts)
    for text, ids in zip(texts, got, strict=True):
        marked = "▁" + text.replace(" ", "▁")
        total, run = 0.0, b""
        for i in [*ids, None]:
            if i is not None and i in model.byte_ids:
                run += bytes(model.surface[model.first[i] : model.first[i] + 1])
                continue
            total, run = total + len(run.decode()) * float(model.unknown), b""
            total += float(model.scores[i]) if i is not None else 0
        assert abs(total - best_score(model, pieces, marked)) < 1e-2, text


def test_equals_the_library_on_short_texts():
    import pytest
    import sentencepiece

    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model, proto = su.load(PATH), pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    for i, p in enumerate(proto.pieces):
        p.score = float(model.scores[i]) if p.type == 1 else p.score
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = varied(1500, 5)
    assert encoded(model, texts)[2] == library.encode(texts)


def test_long_units_equal_short_ones(monkeypatch):
    texts = varied(300, 6) + ["x" * 300 + "é" * 50, "漢字" * 90]
    want = encoded(su.load(PATH), texts)[2]
    monkeypatch.setattr(su, "SHORT", 2)
    su.load.cache_clear()
    assert encoded(su.load(PATH), texts)[2] == want
    su.load.cache_clear()


def test_round_trip(spark):
    data = odd_rows() + rows(["a▁b ▁ c", "▁", " ▁ ", "x▁", "  two  blanks  ", "\x00\x01", *varied(50, 7)], 100)
    df = su.decode(su.encode(frame(spark, data).select("doc_id", "text", "ids"), PATH), PATH)
    got = df.collect()
    assert len(got) == len(data)
    assert all(r.decoded == (r.text or "") for r in got)
    assert all(r.ids == [] for r in got if not r.text)
    both = su.encode_decode(frame(spark, data).select("doc_id", "text", "ids"), PATH).collect()
    assert sorted(map(str, both)) == sorted(map(str, (type(both[0])(**r.asDict()) for r in df.select(*both[0].asDict()).collect())))


def test_odd_ids_decode(spark):
    df = spark.createDataFrame([(None,), ([],), ([0, 1, 2],), ([3 + 0xFF],)], "ids array<int>")
    assert [r.decoded for r in su.decode(df, PATH).collect()] == ["", "", "", "�"]


def test_empty_table(spark):
    assert su.decode(su.encode(frame(spark, []), PATH), PATH).count() == 0
