import hashlib
import random
import re
from collections import Counter, defaultdict

import edges
import sentencepiece
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as cp
from shelfmark.llm import decontamination as dc
from shelfmark.llm.quality_rules import judge_quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = cp.quality_rules(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.row.doc_id for r in judge_quality(docs).where("kept").collect())
    lines = cp.line_dedup(spark, kept, SF)
    assert lines.count() == kept.count()
    near = cp.ngram_jaccard(spark, lines, SF)
    rows, left = {r.doc_id: r.text for r in lines.collect()}, {r.doc_id for r in near.collect()}
    sets = {}
    for i, t in rows.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    for i in rows:
        similar = [j for j in rows if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert (i not in left) == bool(similar)  # groups here are such that each member links with a smaller one
    clean = cp.decontamination(spark, near, SF)
    automaton = dc.ItemAutomaton([(str(i), dc.words_of(t)) for i, t in items], 10)
    for r in clean.collect():
        before = rows[r.doc_id]
        assert r.n_chars == len(r.text)
        if r.text != before:
            assert automaton.hits(dc.words_of(before))[0]
        else:
            assert not automaton.hits(dc.words_of(before))[0]
    for stage in (kept, lines, near, clean):
        assert stage.columns == columns
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in cp.sentencepiece(spark, clean, SF).collect():
        assert list(r.ids) == model.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_edges(spark):
    docs = edges.documents(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(0).cast("long")})
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0


def tokens_of(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def near_copy(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (tokens_of(a.lower()), tokens_of(b.lower())))
    return 100 * len(x & y) >= 80 * len(x | y)


def without_lines(texts):
    """What the line stage leaves of each different text, by comparing everything with everything."""
    masked = {t: [["<*>" if re.search("[0-9]", w) else w for w in tokens_of(x)] for x in t.split("\n")] for t in texts}
    held, places = Counter(), defaultdict(set)
    for t in texts:
        for m in masked[t]:
            for at, w in enumerate(m if len(m) >= 3 else []):
                held[len(m), *m[:2], at, w] += w != "<*>"
    for t in masked:
        for k, m in enumerate(masked[t]):
            fixed = [held[len(m), *m[:2], at, w] >= 10 for at, w in enumerate(m)]
            if len(m) >= 3 and sum(fixed) >= 0.7 * len(m):
                places[*m[:2], *(w if f else "<*>" for w, f in zip(m, fixed))].add((t, k))
    gone = defaultdict(set)
    for found in places.values():
        if len({t for t, _ in found}) >= 10:
            for t, k in found:
                gone[t].add(k)
    long, recurring = defaultdict(set), {t: set(gone[t]) for t in masked}
    for t in masked:
        for k, x in enumerate(t.split("\n")):
            if len(tokens_of(x)) >= 20:
                long[" ".join(tokens_of(x))].add((hashlib.md5(t.encode()).hexdigest(), t, k))
    for found in long.values():
        if len({t for _, t, _ in found}) >= 2:
            for digest, t, k in found:
                recurring[t].add(k)
                if digest != min(found)[0]:
                    gone[t].add(k)
    over = [t for t in masked if 2 * sum(len(masked[t][k]) for k in recurring[t]) > len(tokens_of(t))]
    whole = {t for t in over if any(u != t and near_copy(t, u) for u in over)}
    return {t: t if t in whole else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[t]) for t in masked}


def line_texts():
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    footer, cookies, passage, article = words(20), words(13), words(30), [words(20) for _ in range(4)]
    texts = [f"{words(27)}\n{footer}\n{cookies}" for _ in range(12)]  # 55 % in recurring lines
    texts += [f"{footer}\n{cookies}\n{words(3)}" for _ in range(4)]
    texts += ["\n".join([*article, words(1)]) for _ in range(12)]  # near copies
    texts += [f"{words(40)}\n{passage}\n{words(40)}" for _ in range(3)]  # one passage in three texts
    texts += [f"{words(40)}\nseen by user{k} on the site\n{words(9)}" for k in range(12)]
    return [*texts, texts[0], texts[13], "", footer]


def test_line_stage_against_all_pairs(spark):
    texts = line_texts()
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    want = without_lines(texts)
    got = {r.doc_id: r.text for r in cp.line_dedup(spark, docs, SF).collect()}
    assert got == {i: want[t] for i, t in enumerate(texts)}
    assert sum(want[t] == t for t in texts[16:28]) == 12 and all("\n" not in want[t] for t in texts[:12])
    passage = texts[28].split("\n")[1]
    assert sum(passage in want[t] for t in texts[28:31]) == 1
