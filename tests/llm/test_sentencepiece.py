import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from marquee.llm import sentencepiece
from marquee.llm.registered import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "th", "ing", "t", "e", "in", " ", "  ", "\n", "\t", "1", "23", "!", "=", "é", "ß", "日本", "語", "\U0001f600", "ﬁ", "▁", "<s>", "</s>",
    "<0x0A>", "<unk>", "\x00", "�", "་", "가", "ab", "aa", "'s", " the", "\xa0", "\r",
]


@pytest.fixture(scope="module")
def judge():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.Model(open(PATH, "rb").read())


def texts(count, seed):
    chance = random.Random(seed)
    return ["".join(chance.choices(PARTS[: chance.randint(1, len(PARTS))], k=chance.randint(0, chance.choice([3, 20, 150])))) for _ in range(count)]


def test_encoding_and_decoding_equal_the_library(model, judge):
    for text in [*texts(3000, 1), "", " ", "   ", "a" * 3000, " " * 2000, "=" * 2001, "ab" * 1500, "".join(map(chr, range(1, 3000)))]:
        ids = judge.encode(text)
        assert model.encode(text) == ids
        assert model.decode([1, *ids, 2]) == judge.decode([1, *ids, 2])


def test_decoding_of_any_ids_equals_the_library(model, judge):
    chance = random.Random(2)
    for _ in range(3000):
        # Many bytes, so that there are whole and broken characters, and pieces with spaces in front.
        ids = [chance.choice([0, 1, 2, chance.randint(3, 258), 3 + 0xC3, 3 + 0xA9, 3 + 0xF0, 259, 29871, chance.randint(259, 31999)]) for _ in range(chance.randint(0, 12))]
        assert model.decode(ids) == judge.decode(ids), ids


def test_parts_are_whole_and_no_piece_crosses_their_borders(model):
    rnd = random.Random(8)
    signs = ".,;:!?()\"'-\n\t|#ab zßé中😀²" + sentencepiece.SPACE
    pairs = {p[k : k + 2] for p in model.ids for k in range(len(p) - 1)}
    for _ in range(3000):
        text = sentencepiece.SPACE + "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12)))
        parts = model.parts(text)
        assert "".join(parts) == text and all(parts)
        assert not any(left[-1] + right[0] in pairs for left, right in zip(parts, parts[1:]))
    assert model.parts("▁well,▁then") == ["▁well", ",", "▁then"]


def test_a_model_without_letters_cuts_at_spaces_alone(model):
    bare = sentencepiece.Model.__new__(sentencepiece.Model)
    bare.ids = {sentencepiece.SPACE: 0, "1": 1, "2": 2}
    bare.made = set(bare.ids)
    assert bare.parts("▁12▁▁x.1") == ["▁12", "▁▁x.1"]


def test_merges_equal_the_search(model):
    for text in texts(400, 3):
        if len(text) < 60:
            plain = model.merged(sentencepiece.SPACE + text.replace(" ", sentencepiece.SPACE)) if text else []
            assert [p for p in plain] == (model.searched(sentencepiece.SPACE + text.replace(" ", sentencepiece.SPACE)) if text else [])


def small_model(pieces, **normal):
    """A model of merge type of these pieces, best first, after the special ones and the bytes."""
    out = proto.ModelProto()
    out.trainer_spec.model_type = proto.TrainerSpec.BPE
    out.trainer_spec.byte_fallback = True
    out.trainer_spec.vocab_size = 259 + len(pieces)
    out.normalizer_spec.name = "identity"
    out.normalizer_spec.add_dummy_prefix = True
    out.normalizer_spec.escape_whitespaces = True
    out.normalizer_spec.remove_extra_whitespaces = normal.get("squeeze", False)
    special = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    for piece, score, kind in special + [(p, -float(k // 2), 1) for k, p in enumerate(pieces)]:
        added = out.pieces.add()
        added.piece, added.score, added.type = piece, score, kind
    return out.SerializeToString()


@pytest.mark.parametrize("seed", range(25))
def test_random_models_with_equal_scores_and_pieces_over_spaces(seed):
    chance = random.Random(seed)
    letters = "ab▁" if seed % 2 else "abc"
    made = {"".join(chance.choices(letters, k=chance.randint(2, 5))) for _ in range(12)} | set(letters)
    content = small_model(chance.sample(sorted(made), len(made)))
    own, judge = sentencepiece.Model(content), SentencePieceProcessor(model_proto=content)
    for _ in range(300):
        text = "".join(chance.choices("abc ", k=chance.randint(0, 14)))
        assert own.encode(text) == judge.encode(text), (text, sorted(made))


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="merge-type"):
        sentencepiece.Model(small_model(["a"], squeeze=True))


def test_odd_rows(odd, none, judge):
    encoded = sentencepiece.encode(odd, PATH)
    assert set(encoded.columns) == set(odd.columns)
    rows = sentencepiece.decode(encoded, PATH).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = [1, *judge.encode(r["text"] or ""), 2]
        assert r["ids"] == ids and r["decoded"] == judge.decode(ids) == (r["text"] or "")
    assert sentencepiece.encode(none, PATH).count() == 0
    lost = odd.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {r["decoded"] for r in sentencepiece.decode(lost, PATH).collect()} == {""}


def test_query_equals_the_library(spark, small, judge):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    found = QUERIES["op13_sentencepiece"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = judge.encode(docs[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(judge.decode(ids).encode()).hexdigest()
