import random
import time

import edges
import public_tokenizers
import pytest

from shelfmark.llm import secret_scan as s

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_base_spans():
    assert s.base_spans('x "Api_Key" : "abcdefghijkl" y') == [(3, 27, "assign")]
    assert s.base_spans("token=password=abcdefghijklmn") == [(0, 29, "assign")]
    assert s.base_spans("token: secret: abcdefghijklmnop") == []  # the short match takes the second word with it
    assert s.base_spans("ſecret=abcdefghijklm") == []
    assert s.base_spans("é AKIA0123456789ABCD AKIA012") == [(2, 20, "access")]
    assert s.base_spans("x0123456789abcdefx 0123456789abcde") == [(1, 17, "hex")]


def test_guess_costs():
    cost = s.guess_cost(VOCABULARY)
    assert cost("changeme") < 2 < cost("password123") < cost("qwerty12345") < 7
    assert cost("2024-01-31") < 6 and cost("aaaaaaaaaaaa") < 4 and cost("abcabcabcabc") < 6
    assert cost("x9$Kq!27fz") > 10 and cost("9f8a7c6b5d4e") > 10


def test_cheapest_cut_is_found():
    cost = s.guess_cost(VOCABULARY)

    def brute(value):  # every way to cut
        parts = cost._parts(value)
        best = {}

        def rest(j, brute_after):
            if j == 0:
                return -s.PART
            if (j, brute_after) not in best:
                ways = [rest(i, False) + own + s.PART for i, own in parts.get(j, ())]
                ways.append(rest(j - 1, True) + s._brute(value[j - 1]) + (0 if brute_after else s.PART))
                best[j, brute_after] = min(ways)
            return best[j, brute_after]

        return rest(len(value), False)

    rng = random.Random(3)
    pieces = ["pass", "summer", "and", "is", "2020", "1999", "qwe", "asd", "aaa", "abab", "x", "9", "!", "mera", "cing"]
    values = ["hunter2", "x9pass2020!!", "qwertyaaa1", "zz19991231zz", "tttttt", "andsisummera", "cing2cirx", "a"]
    values += ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(2000)]
    for value in values:
        assert cost(value) == pytest.approx(brute(value), abs=1e-9)


def _word(c):
    return c.isascii() and (c.isalnum() or c in "+/_.=-")


def plain_base_spans(text):
    """The fixed patterns, character by character."""
    out = []
    names = ("password", "passwd", "secret", "token", "apikey", "api_key")
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    i = 0
    while i < len(text):
        ends = []
        for name in names:
            if lower.startswith(name, i):
                for j in {i + len(name), i + len(name) + (text[i + len(name) : i + len(name) + 1] in ('"', "'"))}:
                    while text[j : j + 1] == " ":
                        j += 1
                    if text[j : j + 1] in (":", "="):
                        ends.append(j + 1)
        found = None
        if ends:
            j = ends[0]
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in ('"', "'") and _word(text[j + 1 : j + 2] or " "):
                j += 1
            k = j
            while k < len(text) and _word(text[k]):
                k += 1
            found = (j, k) if k > j else None
        if found:
            if found[1] - found[0] >= 12:
                out.append((i, found[1], "assign"))
            i = found[1]
        else:
            i += 1
    for kind, prefix, good, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), ("hex", "", "0123456789abcdef", 16)):
        i = 0
        while i < len(text):
            k = i + len(prefix)
            if text.startswith(prefix, i) and text[k : k + 1] and text[k] in good:
                while k < len(text) and text[k] in good:
                    k += 1
                if k - i >= least:
                    out.append((i, k, kind))
                i = k
            else:
                i += 1
    return sorted(out)


def test_base_spans_against_a_plain_scan():
    rng = random.Random(8)
    pieces = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY", "api", "_key", ":", "=", " ", "  ", '"', "'", "AKIA", "AKI", "0123456789abcdef", "ABCDEF0123456789", "a", "F", "é", "ſ", "K", "\n", "-", "x" * 12]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        assert sorted(s.base_spans(text)) == plain_base_spans(text), text


def test_many_values_of_one_text():
    cost = s.guess_cost(VOCABULARY)
    line = "db_token=abcdefghijkl0123 and password: changeme\n"
    text = line * 20_000
    base = s.base_spans(text)
    started = time.process_time()
    assert len(base) == 20_000 and s.guess_spans(text, cost, 10.0, base) == []
    assert time.process_time() - started < 20


def test_guess_spans_and_edges(spark):
    rows = [(1, "pwd = x9$Kq!27fz, ok"), (2, "password is changeme"), (3, "client_secret: 'gT7#kP0z!Qw' "), (4, "pass the salt is good")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: r.spans for r in s.scan_secrets(docs, VOCABULARY).collect()}
    assert got == {1: "guess:6:16", 2: "", 3: "guess:16:27", 4: ""}
    docs = edges.documents(spark)
    got = {r.row.doc_id: (r.n_assign, r.spans) for r in s.scan_secrets(docs, VOCABULARY).collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert got[0] == got[1] == (0, "") and got[10] == (1, "assign:22:44")
    assert s.scan_secrets(docs.limit(0), VOCABULARY).count() == 0


def test_credential_words_in_longer_names_and_schemes():
    cost = s.guess_cost(VOCABULARY)
    value, jwt = "Xk!9$qz7Lw", "eyJhbGciOiJIUzI1NiJ9.q7Zr"
    for before, secret in [
        ("db_password=", value), ("AWS_SECRET_ACCESS_KEY=", value), ("secret_access_key: ", value), ("userPassword: ", value), ("my-token => ", value),
        ("Authorization: Bearer ", jwt), ("Authorization: Basic ", "dXNlcjpYazkkcXo3"), ('"Authorization": "Bearer ', jwt), ("Bearer ", jwt), ("basic ", jwt),
    ]:
        text = f"see {before}{secret} there"
        assert s.guess_spans(text, cost, 10.0, []) == [(4 + len(before), 4 + len(before) + len(secret), "guess")], before
    for text in ("basic understanding of it", "Bearer Zwqxkvjbhpfm", "bypass is changeme", "Authorization: Bearer changeme"):
        assert s.guess_spans(text, cost, 10.0, []) == []
