import edges
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import sentencepiece_codec as sc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
some_text = st.text(st.sampled_from("abcdehinorst  ▁\n.,<>0é日🙂\x00"), max_size=200)


def encoded(codec, texts):
    ids, counts = codec.encode(pa.array(texts, pa.string()))
    out, at = [], 0
    for n in counts:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(some_text, max_size=4))
def test_ids_of_the_library(texts):
    codec = sc.codec(MODEL)
    assert encoded(codec, texts) == [library.encode(t) for t in texts]
    # the bounded window, given the text in parts
    for t in texts:
        parts = codec.processor.normalize(t)
        assert [i for ids in codec.stream([parts[:7], parts[7:]]) for i in ids] == library.encode(t)


@pytest.mark.parametrize("texts", [["0"], ["a"], ["", "0"], ["é"], ["日"], ["🙂"], [""], [], ["ab", "", "c"], [" "], ["  "], ["▁"], ["0", "1", "2"]])
def test_tables_of_a_few_bytes(texts):
    codec = sc.codec(MODEL)
    assert encoded(codec, texts) == [library.encode(t) for t in texts]


def test_texts_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(sc, "PART_CHARS", 5)
    codec = sc.codec(MODEL)
    for text in ("aab" * 100, "some plain text " * 20, "x" * 300, "日本語" * 50):
        assert [i for ids in codec.stream([codec.processor.normalize(text)]) for i in ids] == library.encode(text)


def test_long_texts_stream_in_bounded_pieces():
    codec = sc.codec(MODEL)
    text = "aab" * 5000
    got = list(codec.stream([codec.processor.normalize(text)]))
    assert len(got) > 100 and max(map(len, got)) <= 4 * codec.reach
    assert sum(got, []) == library.encode(text)


def test_unigram_paths_have_the_best_score():
    codec = sc.Codec(open(MODEL, "rb").read())
    codec.type = "unigram"
    codec.score = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.2, "aba": -4.9, "bab": -5.1, "▁a": -2.9}
    codec.reach, codec.lowest = 3, -20.0

    def best(text):
        top = {0: 0.0}
        for i in range(1, len(text) + 1):
            top[i] = max(top[j] + codec.score.get(text[j:i], codec.lowest if i - j == 1 else -1e9) for j in range(max(0, i - 3), i))
        return top[len(text)]

    for text in ("▁abababba", "▁ab▁ba" * 30, "ba" * 100 + "?" + "ab"):
        paths = []
        codec._emit = lambda pieces, out, paths=paths: paths.extend(pieces)
        list(iter(codec.stream([text]))) if len(text) < 12 else None
        if len(text) >= 12:
            codec._emit = lambda pieces, out, paths=paths: (paths.extend(pieces), out.append(0))
            list(codec.stream([text]))
        assert "".join(paths) == text
        assert sum(codec.score.get(p, codec.lowest) for p in paths) == pytest.approx(best(text))


def test_edges(spark):
    docs = edges.documents(spark)
    back = sc.decode(sc.encode(docs, MODEL), MODEL)
    assert set(docs.columns) <= set(back.columns)
    rows = back.collect()
    assert len(rows) == docs.count()
    at_once = sc.encode(docs, MODEL, decoded="decoded")
    assert at_once.columns == back.columns and sorted(map(str, at_once.collect())) == sorted(map(str, rows))
    for r in rows:
        assert r.decoded == (r.text or "") and list(r.ids) == library.encode(r.text or "")
    assert sc.decode(sc.encode(docs.limit(0), MODEL), MODEL).count() == 0
