"""SentencePiece Viterbi against the library's unigram reader and plain search."""

import random

import public_tokenizers
import numpy as np
import pytest

from hexloom.llm.pieces import MODEL, DoubleArray, Pieces, decode_ids, encode_texts, load, op9_sentencepiece


def library_and_own():
    """The same pieces, read as a unigram model by the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    with open(public_tokenizers.path(MODEL), "rb") as file:
        proto = pb.ModelProto.FromString(file.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    # scores of few digits, so that the library's single precision adds them without rounding
    kinds = pb.ModelProto.SentencePiece
    for i, p in enumerate(proto.pieces):
        if p.type == kinds.NORMAL:
            p.score = -((i * 7919) % 1024) / 64 - 1
    data = proto.SerializeToString()
    return sentencepiece.SentencePieceProcessor(model_proto=data), Pieces(data)


def random_texts(n=400):
    rng = random.Random(6)
    words = ["the", "Straße", "ouèêç", "  ", "\n", "\t", "ciónñ", "漢字", "😀", "x1", "token", "!!", "▁", "́", "gnu", "▁▁"]
    return ["", " ", "  a", "a  ", "\n\n a"] + [
        rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(n)]


def test_trie_holds_all_keys():
    keys = {bytes([a, b % 7, 255 - a][:1 + (a + b) % 3]): a for a in range(256) for b in range(9)}
    trie = DoubleArray(keys)

    def find(word):
        node = 0
        for c in word:
            t = trie.base[node] + c + 1
            if trie.check[t] != node:
                return -1
            node = t
        return trie.value[node]
    assert all(find(k) == v for k, v in keys.items()) and find(b"\x01\x02\x03\x04") == -1


def test_equals_the_library():
    library, own = library_and_own()
    encode = own.encoder(bound=50)
    for text in random_texts():
        if "▁" in text:  # a marker in the text itself reads as a blank
            continue
        ids = list(memoryview(encode(text)).cast("i"))
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids) == text


def test_path_is_best():
    own = load()

    def plain(run):
        best = {0: 0.0}
        by_text = {p: i for i, p in enumerate(own.written)}
        for j in range(1, len(run) + 1):
            options = []
            for i in range(max(0, j - 16), j):
                number = by_text.get(run[i:j].replace("▁", " ").encode())
                if number is not None and number not in own.byte_ids.values() and number > 2:
                    options.append(best[i] + own.scores[number])
                elif j - i == 1:
                    options.append(best[i] + own.unknown)
            best[j] = max(options)
        return best[len(run)]
    for run in ["▁token", "▁thorreou", "▁Straße", "▁▁▁x", "ciónmente"]:
        assert sum(own.scores[i] for i in own.best_path(run)) == pytest.approx(plain(run))


def test_round_trip_of_table(spark):
    texts = [None, *[t for t in random_texts(60) if "▁" not in t], "long " * 50_000, "same", "same"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    pieces = load()
    coded = encode_texts(df, pieces)
    assert coded.columns == ["doc_id", "text", "ids"]
    for r in decode_ids(coded, pieces).collect():
        assert r.decoded == (texts[r.doc_id] or "") and (len(r.ids) > 0) == bool(texts[r.doc_id])
    assert encode_texts(df.limit(0), pieces).count() == 0


def test_query(spark):
    got = op9_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.round_trip for r in got) and all(r.n_ids > 0 for r in got if r.n_chars)


def test_runs_side_by_side_equal_one_by_one():
    own = load()
    rng = np.random.default_rng(4)
    letters = list("etaoinshrd") + ["é", "ñ", "日", "😀", "\u0378", "▁", ".", "Q", "\n"]
    runs = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(2000)] + ["▁the", "▁" * 60, "x" * 200]
    got = own.best_paths(runs)
    assert [list(memoryview(b).cast("i")) for b in got] == [own.best_path(r) for r in runs]


def test_byte_pieces_and_the_marker_are_told():
    own = load()
    texts = ["plain words", "a \u0378 b", "with ▁ inside", None, ""]
    low, high = min(own.byte_ids.values()), max(own.byte_ids.values())
    for text, (ids, singles, same) in zip(texts, own.lookup(bound=4)(texts)):
        ids = memoryview(ids).cast("i")
        assert singles == sum(low <= i <= high for i in ids)
        assert same == (own.decode(ids) == (text or "")) == ("▁" not in (text or ""))
