import json

import public_tokenizers
import pytest

from lexispark.llm import token_records as tr

from .helpers import frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """The tokenizer file with an added token beyond two bytes."""
    data = json.load(open(PATH))
    data["model"]["vocab"]["<|far|>"] = 70_000
    data["added_tokens"].append({**data["added_tokens"][0], "id": 70_000, "content": "<|far|>"})
    path = tmp_path_factory.mktemp("wide") / "wide.json"
    path.write_text(json.dumps(data))
    return str(path)


def test_width_comes_from_the_tokenizer_file(spark, tmp_path, wide):
    from tokenizers import Tokenizer

    want = [*Tokenizer.from_file(wide).encode("a <|far|>", add_special_tokens=False).ids, 2]
    folder = f"file:{tmp_path}/run"
    tr.write_records(frame(spark, rows(["a <|far|>"])), folder, wide, end_id=2)
    assert tr.read_records(spark, folder).first().ids == want and max(want) > 65_535


def test_ids_beyond_the_width_are_errors(spark, tmp_path, wide):
    with pytest.raises(ValueError, match="end_id"):
        tr.write_records(frame(spark, []), f"file:{tmp_path}/a", PATH, end_id=70_000, vocabulary=1 << 16)
    with pytest.raises(Exception, match="does not fit"):
        tr.write_records(frame(spark, rows(["<|far|>"])), f"file:{tmp_path}/b", wide, end_id=2, vocabulary=1 << 16)
