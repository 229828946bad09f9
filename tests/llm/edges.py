"""Documents with every awkward case, and extra columns whose names the operators use themselves."""

SCHEMA = "doc_id long, text string, row string, ids int, tokens string, spans int, digest string, n_words int, c int"
LONG = "long text with words " * 20_000
TEXTS = [
    None, "", " \n\t ", "one", "Ünï çödé 日本語 🙂", LONG, "x" * 100_000, "same words here in this line again\n" * 30,
    "a tie a tie", "a tie a tie", "Password: hunter2 and token=abcdefghijkl0123 ok", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 tail",
]


def documents(spark):
    rows = [(i, t, "r", 1, "t", 2, "d", 3, 4) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "null id", None, None, None, None, None, None, None)], SCHEMA)
