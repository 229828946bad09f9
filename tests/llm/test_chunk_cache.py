import random

import numpy as np
import pytest

from shelfmark.llm.chunk_cache import ChunkIds


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_ids_of_chunks_within_any_limit(limit):
    seen = []

    def encode(chunks):
        assert len(set(chunks)) == len(chunks)
        seen.extend(chunks)
        back = chunks[::-1]  # in another order
        return back, np.array([b for c in back for b in c], np.uint32), np.array(list(map(len, back)), np.int64)

    rng, table = random.Random(limit), ChunkIds(encode, limit)
    for _ in range(60):
        chunks = [bytes(rng.choices(b"abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 30))]
        data = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum(list(map(len, chunks)), dtype=np.int64)
        ids, counts = table(data, ends - np.array(list(map(len, chunks)), np.int64), ends)
        assert bytes(ids.astype(np.uint8)) == data.tobytes() and counts.tolist() == list(map(len, chunks))
        assert len(table.hashes) <= max(limit, 30)
    assert limit < 1000 or len(seen) == len(set(seen))
