import hashlib
import random
from collections import Counter

import edges
import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import token_alignment as ta

VOCABULARY, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
side_a = Tokenizer.from_file(VOCABULARY)
side_a.encode_special_tokens = True
side_b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ALPHABET = ta.byte_alphabet()


def tokens(text):
    """(id, bytes) of both sides; none if they do not spell a space and the text."""
    if not text:
        return [], []
    a = [(i, bytes(ALPHABET[c] for c in side_a.id_to_token(i))) for i in side_a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in side_b.encode(text):
        piece = side_b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if side_b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def ends(side):
    out, at = [], 0
    for _, spelt in side:
        at += len(spelt)
        out.append(at)
    return out


def brute(rows):
    links, groups = [], []
    for _, text in rows:
        a, b = tokens(text)
        ea, eb = ends(a), ends(b)
        at_b = {e: j for j, e in enumerate(eb)}
        links.append([(a[i][0], b[at_b[e]][0]) for i, e in enumerate(ea) if e in at_b])
        cut, text_of = 0, []
        for e in sorted(set(ea) & set(eb)):
            parts = [",".join(str(x[0]) for x, y in zip(side, at) if cut < y <= e) for side, at in ((a, ea), (b, eb))]
            text_of.append("|".join(parts))
            cut = e
        groups.append((len(a), len(b), text_of))
    counts = Counter(p for doc in links for p in doc)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (doc_id, _), doc, (n_a, n_b, text_of) in zip(rows, links, groups):
        sha = hashlib.sha256(";".join(text_of).encode()).hexdigest() if text_of else ""
        out.append((doc_id, n_a, n_b, len(text_of), len(doc), sum(counts[p] == most[p[1]] for p in doc), sum(counts[p] for p in doc), sha))
    return out


def some_text(rng):
    parts = ["the", "Text", "tokeniz", "ation", " ", "  ", "\n", "é", "日本", "🙂", "<|endoftext|>", "</s>", "<0x41>", "123", "...", "ähn", "\x00", "\x0b"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))


def test_query(spark, tmp_path):
    rng = random.Random(1)
    texts = [some_text(rng) for _ in range(300)] + [None, "", " ", "▁", "a▁b", "plain words of a plain text", "x" * 5000]
    rows = [*enumerate(texts), (5, texts[5]), (5, "another"), (None, "null id")]
    spark.createDataFrame([(i, t, "u") for i, t in rows], "doc_id long, text string, a_ids string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in ta.op13_token_alignment(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert sum(r[3] for r in got) > 1000 and sum(r[1] == 0 for r in got) >= 4


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=8), min_size=1, max_size=4), st.randoms())
def test_overlaps_against_all_pairs(docs, rng):
    a, b, at = [], [], 0
    for d, sizes in enumerate(docs):
        total = sum(sizes)
        cuts = sorted({0, *(rng.randrange(total) for _ in range(3))})
        starts = np.cumsum([0, *sizes[:-1]])
        a += [(at + s, at + s + n, d) for s, n in zip(starts.tolist(), sizes)]
        b += [(at + s, at + e, d) for s, e in zip(cuts, [*cuts[1:], total])]
        at += total
    got = ta.overlaps(*(np.array([t[k] for t in side]) for side in (a, b) for k in (0, 2)))
    want = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]]
    assert list(zip(*(g.tolist() for g in got))) == want


def test_ids_of_the_library_with_and_without_chunks():
    rng = random.Random(2)
    texts = [some_text(rng) for _ in range(300)] + ["", " ", "  ", "a ", " a  b  "]
    model = ta.PieceModel(MODEL)
    assert model.in_chunks
    joined = [(" " + t).encode() for t in texts]
    data, ends = np.frombuffer(b"".join(joined), np.uint8), np.cumsum([0, *map(len, joined)])
    for model.in_chunks in (True, False):
        ids, counts = model.encode(data, ends)
        got = np.split(ids, np.cumsum(counts)[:-1])
        for t, g in zip(texts, got):
            assert g.tolist() == (side_b.encode(t) or ([model.space] if model.in_chunks else []))


def test_pairs_stay_within_their_bound():
    a, b = ta.byte_level_spelling(VOCABULARY), ta.piece_model(MODEL).spelling
    spelt = lambda s: [s.data[x:y].tobytes() for x, y in zip(s.ends, s.ends[1:])]
    a, b = spelt(a), spelt(b)
    held_a, held_b = Counter(a), Counter(b)
    assert max(held_a.values()) == 1 and max(held_b.values()) == 2
    endings = sum(held_b[x[k:]] for x in a for k in range(len(x))) + sum(held_a[x[k:]] for x in b for k in range(1, len(x)))
    assert endings <= ta.pair_bound(VOCABULARY, MODEL) < 2_000_000


def test_edges(spark):
    docs = edges.documents(spark).withColumn("b_sizes", ta.F.lit(1))
    got = ta.align(docs, VOCABULARY, MODEL)
    assert set(docs.columns) <= set(got.columns)
    for r in got.collect():
        a, b = tokens(r.text)
        assert (r.a_ids, r.b_ids) == ([i for i, _ in a], [i for i, _ in b])
        assert sum(r.a_sizes) == len(a) and sum(r.b_sizes) == len(b) and len(r.a_sizes) == len(r.b_sizes) == len(set(ends(a)) & set(ends(b)))
        assert len(r.overlap_a) == len(r.overlap_b) == len(set(ends(a)) | set(ends(b)))
    assert ta.align(docs.limit(0), VOCABULARY, MODEL).count() == 0
    empty = ta.linked_documents(docs.limit(0), VOCABULARY, MODEL)
    assert ta.link_frequencies(empty, ta.link_counts(empty)).count() == 0
