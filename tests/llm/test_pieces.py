"""SentencePiece coding against the library: whole tables, random Unicode, odd ids, nulls and long texts."""

import hashlib
import random

import public_tokenizers
import pytest

from kitchenlens.llm import pieces as pc

PATH = public_tokenizers.path(pc.MODEL)


@pytest.fixture(scope="module")
def model():
    return pc.PieceModel(PATH)


def test_random_texts(model):
    rnd = random.Random(1)
    chars = "ab  ▁éßİi̇\n\t\r日本語한국\U0001f600‍,.-'\"123\x00\xa0　�the ing "
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(20000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(rnd.randint(1, 20))) for _ in range(5000)]
    texts += [t.replace("  ", " ").strip(" ▁").replace("▁", "x") for t in texts[:4000]]
    texts += ["<s> </s> <0x41> <unk>", " ", "▁", "  ", "a ", " a", None, ""]
    ids, agrees = model.encode(texts)
    assert [i.tolist() for i in ids] == model.library.encode([t or "" for t in texts])
    assert all(agrees) and not model.differing


def test_random_ids(model):
    rnd = random.Random(2)
    for _ in range(20000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), 0, 1, 2, 259, 28705]) for _ in range(rnd.randint(0, 9))]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_long_strings_without_a_cut(model):
    text = "ab" * 40_000 + " " * 30_000 + "a" * 50_000 + "\n" * 10_000
    assert model.encode([text])[0][0].tolist() == model.library.encode(text)


def test_agenda_order(model):
    """The best score first and the leftmost first among equals, whatever was pushed before."""
    rnd = random.Random(3)
    for _ in range(3000):
        word = "▁" + "".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, rnd.choice([25, 25, 25, 120]))))
        symbols = list(word)
        while True:
            at = [(model.ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in model.ranks]
            if not at:
                break
            i = min(at)[1]
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        assert model.merge(word) == symbols


def test_slices_by_bytes():
    column = pc.pa.array(["ab", None, "é" * 5, "", "x" * 30, "y", "z"])
    assert [s.to_pylist() for s in pc.byte_slices(column, 10)] == [["ab", None], ["é" * 5, ""], ["x" * 30], ["y", "z"]]
    assert list(pc.byte_slices(column.slice(0, 0), 10)) == [] and [len(s) for s in pc.byte_slices(column.slice(4), 1)] == [1, 1, 1]


def test_the_check_finds_and_mends_a_difference(model, monkeypatch):
    broken = pc.PieceModel(PATH)
    monkeypatch.setattr(broken, "merge", list)      # characters, never merged
    ids, agrees = broken.encode(["hello there", "a", "q"])
    assert [i.tolist() for i in ids] == broken.library.encode(["hello there", "a", "q"])
    assert agrees == [False, False, False] and "▁hello" in broken.differing


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        pc.PieceModel(str(path))


def test_without_byte_fallback_and_prefix(tmp_path):
    """Unknown characters in a row are one unknown piece; without a prefix no space is added or stripped."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.byte_fallback = False
    proto.normalizer_spec.add_dummy_prefix = False
    for p in proto.pieces:
        if p.type == pb.ModelProto.SentencePiece.BYTE:
            p.type = pb.ModelProto.SentencePiece.NORMAL
            p.score = -1e9
    path = tmp_path / "plain.model"
    path.write_bytes(proto.SerializeToString())
    other, rnd = pc.PieceModel(str(path)), random.Random(4)
    for _ in range(3000):
        text = "".join(rnd.choice("the in\n\t\U0001f984 a▁é") for _ in range(rnd.randint(0, 15)))
        assert other.encode([text])[0][0].tolist() == other.library.encode(text), text
        ids = [rnd.choice([0, 1, 2, 259, 264, 28705, 900]) for _ in range(rnd.randint(0, 6))]
        assert other.decode(ids) == other.library.decode(ids), ids


def test_frames(spark):
    rows = [(1, "Hello  world\n", "x"), (1, "Hello  world\n", "x"), (2, None, "y"), (3, "", "z"), (None, "naïve 日本", None), (4, "word " * 60_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, PIECES string")
    out = pc.with_pieces(df, check_texts=True)
    assert out.columns == ["doc_id", "text", "pieces"]
    library = pc.PieceModel(PATH).library
    for r in out.collect():
        assert r.pieces.ids == library.encode(r.text or "") and r.pieces.decoded == library.decode(r.pieces.ids) == (r.text or "") and r.pieces.agrees
    assert pc.with_pieces(df.limit(0)).collect() == []


def test_contract(spark):
    got = pc.op12_pieces(spark, "/root/testdata/sf0.001")
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    library = pc.PieceModel(PATH).library
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id])
        assert r.agrees and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
