import edges

from shelfmark.llm import line_templates as lt


def test_templates_go_and_copies_stay(spark):
    unique = lambda i: " ".join(f"u{chr(97 + i % 26)}{chr(97 + k)}{i}" for k in range(12))
    rows = [(i, f"{unique(i)}\nPosted by user{i} on day {i % 7} in the news\n{unique(i + 50)}") for i in range(12)]
    rows += [(100 + i, "a copied text that stands\nin many documents as it is") for i in range(12)]
    rows += [(200, "a copied text that stands\n" + unique(300) + unique(301))]
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        lines = text.split("\n")
        assert got[i] == ("\n".join([lines[0], lines[2]]) if i < 100 else text)


def test_variable_words(spark):
    names = "anna bert carl dora emil fred gina hugo ida jan kurt lena".split()
    body = lambda n: " ".join(f"{n}{k}" for k in "abcdefghijkl")
    rows = [(i, f"Posted by {n} in the daily news\n{body(n)}") for i, n in enumerate(names)]
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted(body(n) for n in names)


def test_edges(spark):
    docs = edges.documents(spark)
    got = lt.drop_recurring_lines(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert lt.mark_lines(docs.limit(0)).count() == 0
