"""SentencePiece: equal to the library, spans that cover the text, normalisers with a map."""

import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from roadspark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_round_trip_equals_library(spark):
    texts = ["  a\tb\n c  ", "", None, "é—②​", "plain text", "x" * 5000, "<s> </s> <unk> ▁ a▁b", "a\0b"]
    docs = spark.createDataFrame([(k % 6, t, 1) for k, t in enumerate(texts)] + [(None, "q", 2)], "doc_id long, text string, pieces int")
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for t in [*texts, "q"]:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        expected.append((len(ids), sha(np.array(ids, "<u4").tobytes()), sha(sp.decode(ids).encode())))
    got = pieces.round_trip(docs, PATH).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expected)
    coded = pieces.encode(docs, PATH)
    assert coded.columns == [*docs.columns, "pieces_"]
    for r in pieces.decode(coded, PATH, "pieces_").collect():
        data = (r.text or "").encode()
        spans = [(p["begin"], p["end"]) for p in r["pieces_"]]
        assert b"".join(data[b:e] for b, e in spans) == data
        assert r.decoded == sp.decode([p["id"] for p in r["pieces_"]])
    assert pieces.round_trip(docs.limit(0), PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aé ②ﬁ　Ａ½̈e\tx￼한글"), max_size=40))
def test_compiled_map_equals_library(text):
    for rule in ("nfkc", "nmt_nfkc", "nfkc_cf"):
        theirs, ours = test_compiled_map_equals_library.__dict__.setdefault(rule, _pair(rule))
        normal, align = ours.apply(text.encode())
        assert normal.decode() == theirs.normalize(text)
        assert len(align) == len(normal) + 1 and (np.diff(align) >= 0).all()


def _pair(rule):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    return theirs, pieces.Normaliser(theirs.serialized_model_proto())
