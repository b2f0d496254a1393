import os
import random
from array import array

import pytest

from noticeworks.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def ids(text):
    out = array("i")
    bpe.transducer(bpe.VOCABULARY).encode(text, out)
    return list(out)


def test_against_the_library(reference):
    random.seed(3)
    letters = list("aábcdeéfghiklmn  ,.;'\n\t1234567890的一是不了 <|endoftext|>'s're ABC中国人民🚧☎️ЖдüÅßﬁ​ 　")
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(1, 40))) for _ in range(3000)]
    texts += ["", " ", "<|endoftext|>", "a" * 5000, "的" * 5000, "\u0000￿", "  \n\n  x", "don't we'll I'M"]
    for text, expected in zip(texts, reference(texts)):
        assert ids(text) == expected, text
        assert "".join(bpe.decode(expected, bpe.token_bytes(bpe.VOCABULARY))) == text


def test_dropping_moves_changes_nothing(monkeypatch):
    machine = bpe.Transducer(bpe.read_ranks(bpe.VOCABULARY))
    monkeypatch.setattr(bpe, "KEPT_MOVES", 20)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    out = array("i")
    text = "服务内容为设计版式封面、编制竣工资料。 The contract runs 47 months." * 3
    machine.encode(text, out)
    assert list(out) == ids(text)


def test_tables(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "数据 data", 0), (3, "数据 data", 0), (4, "x" * 100_000, 0)], "doc_id long, text string, ids int")
    got = bpe.encode_texts(df)
    assert got.schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
    rows = [(r["doc_id"], r["ids"]) for r in got.collect()]
    assert [r for r in rows if r[0] < 3] == [(1, []), (2, [])] and rows[2] == rows[3]
    back = {r["doc_id"]: r["text"] for r in bpe.decode_texts(got).collect()}
    assert back == {1: "", 2: "", 3: "数据 data", 4: "x" * 100_000}
    assert bpe.encode_texts(df.where("false")).count() == 0


def test_utf8_machine_against_the_standard():
    random.seed(8)
    good = "aé的🚧Ж".encode()
    for n in range(4000):
        data = b"".join(random.choice([good[random.randrange(len(good)) :][:2], bytes([random.randrange(256)]), "的🚧".encode()]) for _ in range(random.randint(0, 6)))
        machine = bpe.Utf8Machine(surrogates=False)
        cuts = sorted(random.choices(range(len(data) + 1), k=2))
        text = "".join(machine.feed(p) for p in (data[: cuts[0]], data[cuts[0] : cuts[1]], data[cuts[1] :])) + machine.finish()
        assert text == data.decode("utf-8", "replace"), data


def test_broken_ids_are_decoded():
    bytes_of = {1: b"\x80", 2: b"a", 3: b"\xe4\xbd", 4: b"\xa0"}
    assert "".join(bpe.decode([1, 2], bytes_of)) == "\ufffda" and "".join(bpe.decode([3], bytes_of)) == "\ufffd"
    assert "".join(bpe.decode([3, 4, 2], bytes_of)) == "你a" and "".join(bpe.decode([3, 2, 99], bytes_of)) == "\ufffda\ufffd"
