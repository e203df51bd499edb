"""Small fixtures shared by the corpus operators' tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: DOCS with columns whose names the operators use themselves.
CLASHING = DOCS + ", score double, sig long, row_no long, _bucket int, _row string, kept boolean, block long, component string, _text string"


def messy_rows():
    """Nulls in every column, empty and blank texts, repeats, ties, a very long text, unusual characters."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    long_text = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(30_000))
    plain = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(plain)]
    rows += [(100, None, "en", "s", None), (101, "", "de", "s", 0), (102, " \n\t ", None, None, 4), (None, "no id at all here", "fr", "s", 1),
             (103, plain[3], "en", "s", 1), (104, plain[3], "de", "s", 1), (105, plain[3].upper(), "en", "s", 1),
             (7, plain[7], "en", "s", 1), (8, "another text for the same id", "en", "s", 1),
             (106, long_text, "en", "s", len(long_text)), (107, "x" * 200_000, "xx", "s", 1),
             (108, "naïve 中文 \U0001f600 é 　 end\x00.", "es", "s", 1), (109, None, None, None, None),
             (None, None, None, None, None), (110, "one", "en", "s", 3), (111, "one two", "en", "s", 7)]
    return rows


def messy(spark):
    rows = [r + (0.5, 1, 2, 3, "r", True, 4, "c", "t") for r in messy_rows()]
    return spark.createDataFrame(rows, CLASHING)


def empty(spark):
    return spark.createDataFrame([], CLASHING)


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))
