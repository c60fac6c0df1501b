import random
from itertools import product

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as proto

from helpers import by_id, docs_frame
from hazardry.llm import pieces as P
from hazardry.llm.queries import MODEL

TEXTS = [
    "", " ", "  two  blanks ", "Hello world", "naïve façade ﬁ", "日本語 テキスト", "tab\tline\nend\r\n", "🙂🙂 \U0001f9ff", "a" * 300, "\x00\x01",
    "x = {'k': [1, 2.5]}; // ok", "Éauouon.\nEnpaeux leaux", "        indented", "  odd blanks",
    "\n", "\n\nlines\n and  more \nend ", "a\nb\n\nc d\n", " \n \n", "    four", " one  two   ",
]


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.load(MODEL)


@pytest.fixture(scope="module")
def library():
    """The library's own best-path encoder over the same pieces and scores."""
    model = proto.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def score(vocabulary, ids):
    return sum(vocabulary.scores[i] for i in ids)


@pytest.mark.parametrize("text", TEXTS)
def test_known_texts(vocabulary, library, text):
    ids = vocabulary.encode(text)
    assert vocabulary.decode(ids) == text
    assert score(vocabulary, ids) == pytest.approx(score(vocabulary, library.encode(text)))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeé theion日.,\n\n  ñ🙂"), max_size=40))
def test_best_path_like_the_library(vocabulary, library, text):
    ids = vocabulary.encode(text)
    assert vocabulary.decode(ids) == text
    assert ids == library.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60).filter(lambda t: P.MARK not in t))
def test_round_trip(vocabulary, text):
    assert vocabulary.decode(vocabulary.encode(text)) == text


def test_against_every_segmentation():
    names = ["<unk>", "a", "b", "ab", "ba", "aba", "▁", "▁a", "bb"]
    scores = [0.0, -3.0, -3.5, -4.0, -4.1, -6.0, -2.0, -4.5, -7.5]
    vocabulary = P.Vocabulary(names, scores, ["unknown"] + ["normal"] * 8)
    for n in range(1, 7):
        for letters in product("abx ", repeat=n):
            text = "▁" + "".join(letters).replace(" ", "▁")
            best = [0.0] + [-1e18] * len(text)
            for end in range(1, len(text) + 1):
                for start in range(end):
                    part = text[start:end]
                    if part in names[1:]:
                        best[end] = max(best[end], best[start] + scores[names.index(part)])
                if text[end - 1] == "x":
                    best[end] = max(best[end], best[end - 1] + vocabulary.floor)
            ids = vocabulary.encode("".join(letters))
            total = sum(vocabulary.floor if i == 0 else scores[i] for i in ids)
            assert total == pytest.approx(best[-1]), letters


def test_vocabulary_with_pieces_across_words():
    vocabulary = P.Vocabulary(["<unk>", "▁", "a", "b", "a▁b", "▁a"], [0.0, -1, -1, -1, -0.5, -1.5], ["unknown"] + ["normal"] * 5)
    assert not vocabulary.by_word
    assert [vocabulary.pieces[i] for i in vocabulary.encode("a b")] == ["▁", "a▁b"]


def test_frame(spark, vocabulary):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (51, "▁"), (3, TEXTS[3]), (None, "null id")]
    rng = random.Random(3)
    rows.append((60, " ".join("".join(rng.choices("etaoin", k=5)) for _ in range(20_000))))
    frame = docs_frame(spark, rows).withColumn("n_tokens", P.F.lit("clash"))
    got = P.encode(frame, MODEL)
    want = [(d, vocabulary.encode(t or ""), len(vocabulary.encode(t or "")), t != "▁") for d, t in rows]
    assert by_id(got, "token_ids", "n_tokens", "round_trip") == sorted(want, key=lambda r: (r[0] is None, r[0], str(r[1:])))
    back = P.decode(got, MODEL, to="decoded")
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect() if r["doc_id"] != 51)
    assert P.encode(docs_frame(spark, []), MODEL).collect() == []
