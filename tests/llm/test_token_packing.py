import zlib

import edges
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import token_packing as tp

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
library = Tokenizer.from_file(VOCABULARY)
plain = Tokenizer.from_file(VOCABULARY)
plain.encode_special_tokens = True


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab the's ll1 \t\n\x0b\x1c\x85\xa0 　é日🙂.,<|endoftext|>"), max_size=60), min_size=1, max_size=4))
def test_ids_of_the_library(texts):
    ids, counts = tp.encode_texts(pa.array(texts), VOCABULARY)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


@pytest.mark.parametrize("bits", [1, 3, 8, 15, 16, 17, 31, 32])
def test_packing_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 5001).astype(np.uint32)
    shard = tp.Shard(pa.BufferReader(tp.shard_bytes(np.array([4, 9, 9]), np.array([1, 0, 5000]), ids, bits, block_ids=37)))
    assert (shard.ids(0, 5001) == ids).all() and len(shard.document(1)) == 0
    for a, b in ((0, 1), (36, 38), (100, 2222), (4990, 5001), (7, 7)):
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert tp.bits_for(50257) == 16 and tp.bits_for(1) == 1 and tp.bits_for(257) == 9


def test_written_and_read_back(spark, tmp_path):
    docs = edges.documents(spark)
    manifest = tp.write_packed(docs, f"file://{tmp_path}/packed", VOCABULARY, end_id=2, shard_ids=30_000)
    got = sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in tp.read_packed(manifest).collect())
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((str(doc_id), start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert got == sorted(want)


def test_empty(spark, tmp_path):
    docs = edges.documents(spark).limit(0)
    assert tp.read_packed(tp.write_packed(docs, f"file://{tmp_path}/packed", VOCABULARY)).count() == 0
